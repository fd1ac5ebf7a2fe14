"""Keyword-to-video chain: recent trending keywords -> their videos -> snapshot -> gap mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from trendcast import constants as K
from trendcast.operators.joins import semi_on_folded
from trendcast.plans.marts import mart_gap_analysis
from trendcast.plans.rollover import compact, rollover_merge
from trendcast.plans.staging import keywords_last_hours
from trendcast.sources.landing import keyword_video_rounds
from trendcast.sources.snapshots import SnapshotStore, month_tags


def keyword_gap(stg: DataFrame, search_pages: DataFrame, detail_pages: DataFrame,
                categories: DataFrame, trends: DataFrame, store: SnapshotStore,
                as_of: dt.datetime, hours: int = K.KEYWORD_WINDOW_HOURS) -> DataFrame:
    """Search results are kept for keywords that trended in the last ``hours``
    (case-insensitive match, as a search is), flattened with their video details,
    merged into this month's snapshot, compacted on the dataset key and scored
    against all trends.
    """
    cur, _ = month_tags(as_of)
    if not search_pages.isEmpty():          # nothing landed: the snapshot stays as it is
        keywords = keywords_last_hours(stg, as_of, hours)
        hits = semi_on_folded(search_pages, "keyword", keywords, "query")
        videos = keyword_video_rounds(hits, detail_pages, categories)
        rollover_merge(store, videos, as_of, "published_ts", guard_empty=False)
        compact(store, cur, K.KEYS["keyword_videos"], ["captured_at"])
    return mart_gap_analysis(store.load(cur), trends, as_of)
