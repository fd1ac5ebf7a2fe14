from trendcast.functions.aggregates import approx_median, counter_names, domain_counts, most_counted
from trendcast.functions.scoring import (
    content_window,
    engagement_intensity,
    engagement_rate,
    gap_score,
    opportunity,
    recommendation_score,
    recurrence_label,
    scheduling_tip,
    time_of_day,
    urgency_tier,
)
from trendcast.functions.text import (
    fill_defaults,
    int_or_zero,
    iso_duration_secs,
    join_names,
    tags_text,
)
from trendcast.functions.timeparts import (
    duration_hours,
    from_epoch,
    local_parts,
    monday_week,
    month_suffix,
    month_tag,
    ntz_literal,
    parse_iso_ts,
    to_local,
)

__all__ = [
    "approx_median", "counter_names", "domain_counts", "most_counted",
    "content_window", "engagement_intensity", "engagement_rate", "gap_score", "opportunity",
    "recommendation_score", "recurrence_label", "scheduling_tip", "time_of_day", "urgency_tier",
    "fill_defaults", "int_or_zero", "iso_duration_secs", "join_names", "tags_text",
    "duration_hours", "from_epoch", "local_parts", "monday_week", "month_suffix", "month_tag",
    "ntz_literal", "parse_iso_ts", "to_local",
]
