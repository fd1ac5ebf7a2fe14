from trendcast.operators.dedupe import duplicate_count, keep_one
from trendcast.operators.filters import (
    has_rows_in_month,
    in_month,
    last_hours,
    rows_in_month,
    watchable,
    with_id,
)
from trendcast.operators.joins import (
    attach_stats,
    lookup,
    not_yet_present,
    semi_on_folded,
)
from trendcast.operators.ranking import leaderboard, row_number_split, top_n_per_group
from trendcast.operators.topk import arg_max_per_group, top_value_per_group
from trendcast.operators.unions import union_all

__all__ = [
    "duplicate_count", "keep_one", "has_rows_in_month", "in_month", "last_hours",
    "rows_in_month", "watchable", "with_id", "attach_stats", "lookup", "not_yet_present",
    "semi_on_folded", "leaderboard", "row_number_split", "top_n_per_group",
    "arg_max_per_group", "top_value_per_group", "union_all",
]
