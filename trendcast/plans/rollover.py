"""Month rollover: let the new month's snapshot start from the previous month's.

The driver only decides which branch to take, from an existence check or two
counts; carrying a month over is a manifest entry of the store, so history is
neither read nor written again.
"""

from __future__ import annotations

import datetime as dt
from itertools import chain

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trendcast import constants as K
from trendcast.operators.dedupe import keep_one
from trendcast.operators.filters import has_rows_in_month, in_month
from trendcast.operators.joins import not_yet_present
from trendcast.sources.snapshots import Batch, Rows, SnapshotStore, month_tags, previous_month


def rollover(store: SnapshotStore, batch: DataFrame, as_of: dt.datetime, ts_col: str,
             grace_days: int, when_present: str = "append", guard_empty: bool = True,
             by: Batch | None = None, rules: dict[str, Column] | None = None) -> str:
    """Flag form (an empty batch does nothing at all; pass ``guard_empty=False``
    when the caller already checked the raw input, since checking a processed
    batch runs its shuffles): inside the grace days, a month without rows of its own starts from the
    previous snapshot plus the batch. ``when_present`` says what happens to the
    batch when the month already has rows: 'append' or 'skip'.

    ``by`` names the batch of an incremental run. The run decides once, with its
    first batch, and all its batches follow; a batch that is run again does nothing.
    """
    if by and store.applied(by):
        return "replayed"
    if guard_empty and batch.isEmpty():
        return "no_data"
    cur, prev = month_tags(as_of)
    decided = store.run_of(by.writer, cur) if by else None
    if decided is None:
        action = "appended"
        if as_of.day <= grace_days:
            if not has_rows_in_month(store.load(cur), ts_col, as_of):
                action = "rolled_over"
            elif when_present == "skip":
                action = "skipped"
    else:
        action = "appended" if decided == "rolled_over" else decided
    if action == "skipped":
        if by:
            store.note_batch(by, action, cur)
        return action
    store.append(batch, cur, by=by, run=None if decided else action, rules=rules,
                 carry=(prev, None) if action == "rolled_over" else None)
    return action


def rollover_merge(store: SnapshotStore, batch: Rows, as_of: dt.datetime, ts_col: str,
                   grace_days: int = K.GRACE_DAYS["keyword_videos"],
                   keys: list[str] | None = None, guard_empty: bool = True, against: str = "days",
                   by: Batch | None = None) -> str:
    """Count form: inside the grace days the previous month counts as merged when it is
    empty or the new month already holds at least as many of its rows; otherwise
    the previous rows not yet present (by ``keys``, NULL-safe) are carried over.

    The store remembers which versions of the previous month have been carried or
    compared, so a further run of the grace days reads and writes nothing of it
    unless that month has changed since, and then only its changed days.
    Days of which the new month has no row yet are carried as they are.

    ``against`` says which rows count as present in a day that both months have:
    'days' all rows of the new month there, 'leaked' only those whose ``ts_col``
    (a timestamp column) lies in the previous month itself. Keys fix the day.

    A batch may come in parts, which are written one by one and published together
    (with ``guard_empty=False``).
    """
    keys = keys or K.ROLLOVER_MATCH_KEYS
    if by and store.applied(by):
        return "replayed"
    if guard_empty and batch.isEmpty():
        return "no_data"
    cur, prev = month_tags(as_of)
    fresh = store.not_carried(prev, cur) if as_of.day <= grace_days else {}
    if not fresh or _fully_merged(store, cur, prev, ts_col, as_of):
        store.append(batch, cur, by=by, merged=(prev, fresh))
        return "appended"
    have = store.entries(cur)
    both = {d: versions for d, versions in fresh.items() if d in have}
    if both:
        now = store.read({d: have[d] for d in both})
        if against == "leaked":
            now = now.where(in_month(now, ts_col, previous_month(as_of)))
        missing = not_yet_present(store.read(both), now.select(*keys), keys)
        batch = missing.unionByName(batch, allowMissingColumns=True) if isinstance(batch, DataFrame) else chain([missing], batch)
    store.append(batch, cur, by=by, carry=(prev, [d for d in fresh if d not in have]), merged=(prev, fresh))
    return "merged"


def _fully_merged(store: SnapshotStore, cur: str, prev: str, ts_col: str, as_of: dt.datetime) -> bool:
    total = store.load(prev).count()
    now = store.load(cur)
    return total == 0 or now.where(in_month(now, ts_col, previous_month(as_of))).count() >= total


def compact(store: SnapshotStore, month: str, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Keyed dedupe of one month: the first row by ``order`` stays (newest capture first, as a rule).

    Only days (or key buckets) with rows that no compaction has seen are read and
    rewritten, once. Rows of one key lie in one of them: the store's day column is
    part of the key or fixed by it, or the buckets are the key's. A store with
    neither is rewritten whole. Many bytes are rewritten in rounds, each with the
    keys of a hash range, as rows shuffle for the dedupe and for the days.
    """
    compacted(store, month, keys, order)
    return store.load(month)


def compacted(store: SnapshotStore, month: str, keys: list[str], order: list[str | Column]) -> int:
    """:func:`compact`, returning how many rows it removed (counted in its own pass)."""
    if not order:
        raise ValueError("a compaction needs an order: which of two captures stays")
    seen = store.entries(month, store.uncompacted_days(month))
    if not seen:
        return 0
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    n = store.rounds(seen)
    if n == 1:
        read = Observation()
        rows = store.read(seen).observe(read, F.count(F.lit(1)).alias("rows"))
        kept = store.replace_days(keep_one(rows, keys, order), month, list(seen), compacted=True, seen=seen)
        return read.get["rows"] - kept
    mine = F.pmod(F.xxhash64(*keys), F.lit(n))
    parts = (keep_one(store.read(seen).where(mine == i), keys, order) for i in range(n))
    return store.read(seen).count() - store.replace_days(parts, month, list(seen), compacted=True, seen=seen)
