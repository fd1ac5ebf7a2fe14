"""Scores and labels as Column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendcast import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def recommendation_score(search_volume="search_volume", increase_percentage="increase_percentage",
                         active="active", duration_hrs="trend_duration_hrs") -> Column:
    """Rounded weighted score; NULL volume or increase gives NULL."""
    sv, inc, act, dur = map(_c, (search_volume, increase_percentage, active, duration_hrs))
    lo, hi = K.SCORE_WINDOW_HRS
    raw = (
        sv * F.lit(K.SCORE_VOLUME_WEIGHT)
        + inc * F.lit(K.SCORE_INCREASE_WEIGHT)
        + F.when(act, F.lit(K.SCORE_ACTIVE_BONUS)).otherwise(F.lit(0))
        + F.when(dur <= K.SCORE_EARLY_MAX_HRS, F.lit(K.SCORE_EARLY_BONUS)).otherwise(F.lit(0))
        + F.when(dur.between(lo, hi), F.lit(K.SCORE_WINDOW_BONUS)).otherwise(F.lit(0))
    )
    return F.round(raw, 0)


def content_window(active="active", duration_hrs="trend_duration_hrs") -> Column:
    act, dur = _c(active), _c(duration_hrs)
    expr = None
    for max_hrs, label in K.CONTENT_WINDOWS:
        cond = act & (dur <= max_hrs)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.when(act, K.CONTENT_WINDOW_ACTIVE_REST).otherwise(K.CONTENT_WINDOW_ENDED)


def urgency_tier(search_volume="search_volume", active="active") -> Column:
    sv, act = _c(search_volume), _c(active)
    expr = None
    for min_sv, label in K.URGENCY_TIERS:
        cond = (sv >= min_sv) & act
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.when(act, K.URGENCY_ACTIVE_REST).otherwise(K.URGENCY_ENDED)


def time_of_day(hour="start_hour_eat") -> Column:
    """Daypart of a local hour; NULL hour falls through to the last bucket."""
    h = _c(hour)
    expr = None
    for lo, hi, label in K.TIME_OF_DAY:
        cond = h.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(K.TIME_OF_DAY_REST)


def recurrence_label(times="times_trended", span_days="active_span_days") -> Column:
    t, span = _c(times), _c(span_days)
    series_times, series_span, series_label = K.RECUR_SERIES
    rec_times, rec_label = K.RECUR_RECURRING
    twice_times, twice_label = K.RECUR_TWICE
    return (
        F.when((t >= series_times) & (span >= series_span), series_label)
        .when(t >= rec_times, rec_label)
        .when(t >= twice_times, twice_label)
        .otherwise(K.RECUR_ONE_OFF)
    )


def scheduling_tip(tod="most_common_time_of_day", dow="most_common_day") -> Column:
    """NULL-propagating concatenation, like SQL CONCAT."""
    return F.concat(F.lit(K.TIP_PREFIX), _c(tod), F.lit(K.TIP_JOIN), _c(dow))


def gap_score(search_volume="search_volume", median_views="median_views") -> Column:
    """Demand over supply: volume / (median views + 1), 2 decimals."""
    return F.round(F.try_divide(_c(search_volume).cast("double"), _c(median_views) + F.lit(1)), 2)


def opportunity(score="gap_score") -> Column:
    s = _c(score)
    expr = None
    for bound, label in K.OPPORTUNITY:
        cond = s > bound
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(K.OPPORTUNITY_REST)


def engagement_rate(score="score", comments="num_comments", subscribers="subscribers") -> Column:
    """(score + comments) per thousand subscribers; NULL when subscribers is 0."""
    return F.try_divide((_c(score) + _c(comments)).cast("double"),
                        _c(subscribers).cast("double") / F.lit(1000.0))


def engagement_intensity(score="score", ratio="upvote_ratio", comments="num_comments",
                         awards="awards") -> Column:
    return (_c(score) * F.coalesce(_c(ratio), F.lit(1.0)) + _c(comments)
            + F.coalesce(_c(awards), F.lit(0)))
