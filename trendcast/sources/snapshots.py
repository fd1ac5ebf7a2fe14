"""Monthly cumulative snapshots as manifests over day-partitioned, immutable parquet.

A month's snapshot holds the whole history as of that month. Rows are written
once, below ``data/v=<version>/day=<day>``; a month is an entry in a manifest
that lists, per day, the versions that make it up. Rolling a month over copies
manifest entries, not rows; a compaction rewrites only the days that got new
rows since the last one. Where a key holds no time, hash buckets of the key take
the place of the days.

Every change writes a new manifest file with the next number: readers see the old
state or the new one. The number and the state that is changed come from one
listing, and a number is taken once; a writer that finds its number taken applies
its change to the newer state, or is refused (:class:`Conflict`) if rows it was
computed from are gone. What a failed run has written is in no manifest, is never
read, and goes with :meth:`SnapshotStore.vacuum`. The manifest also remembers

* for each incremental writer the last batch whose changes are in (:class:`Batch`),
  so that a batch that runs again changes nothing, and what its run decided;
* which versions of a month came from the month before, so that a merge that is
  run again looks only at what is new there.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendcast.functions.timeparts import add_months, month_tag
from trendcast.session import rounds_for, shuffles_freed

MONTH_COL = "snapshot_month"
NO_DAY = "none"
_DAY, _VERSION = "_day", "_v"
COMMIT_TRIES = 20

Entries = dict[str, list[str]]  # day or bucket -> versions that hold its rows
Rows = DataFrame | Iterable[DataFrame]  # what a version is written from: at once, or part by part as they are made


class Conflict(RuntimeError):
    """Another writer has replaced rows that a change was computed from."""


class RulesBroken(ValueError):
    """A written version breaks rules and was not published; ``counts`` says which, and on how many rows."""

    def __init__(self, counts: dict[str, int]):
        super().__init__("not published, rows break rules: " + ", ".join(f"{k} ({v})" for k, v in sorted(counts.items())))
        self.counts = counts


@dataclass(frozen=True)
class Batch:
    """Batch ``number`` of an incremental writer (the id of a streaming query lives in its checkpoint)."""
    writer: str
    number: int


def not_null(columns: list[str]) -> dict[str, Column]:
    """Rules for :meth:`SnapshotStore.append`: the rows that break them, by name."""
    return {f"not_null:{c}": F.col(c).isNull() for c in columns}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; missing columns become NULL, extras are dropped."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


class SnapshotStore:
    """Snapshots of one dataset.

    ``day_col`` names the timestamp whose UTC day partitions the rows (NULL goes
    to a day of its own). ``grain`` may be coarser than a day where few rows come
    each day over many years. ``buckets`` (key columns, number) partitions by a
    hash of a key instead; the number is fixed by the store's first write. With
    neither all rows form a single partition.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, day_col: str | None = None,
                 grain: str = "yyyy_MM_dd", part_col: str = MONTH_COL, buckets: tuple[list[str], int] | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        self.schema = schema
        self.day_col = day_col
        self.grain = grain
        self.part_col = part_col
        self.buckets = buckets
        if buckets:
            self.buckets = (buckets[0], self._manifest()["buckets"] or buckets[1])

    # -- reads ------------------------------------------------------------------------
    def scan(self) -> DataFrame:
        """All months with their tag; an absent store reads as empty."""
        tagged = [self.load(m).withColumn(self.part_col, F.lit(m)) for m in self.months()]
        empty = self._empty().withColumn(self.part_col, F.lit(None).cast("string"))
        return reduce(DataFrame.unionByName, tagged) if tagged else empty

    def load(self, month: str) -> DataFrame:
        """One month; a month never written reads as empty."""
        return self.read(self.entries(month))

    def load_days(self, month: str, days: list[str]) -> DataFrame:
        return self.read(self.entries(month, days))

    def entries(self, month: str, days: list[str] | None = None) -> Entries:
        """The versions that make up a month, or some days of it."""
        have = self._manifest()["months"].get(month, {})
        return dict(have) if days is None else {d: have[d] for d in days if d in have}

    def row_counts(self) -> DataFrame:
        return self.scan().groupBy(self.part_col).agg(F.count(F.lit(1)).alias("row_count"))

    def months(self) -> list[str]:
        return sorted(m for m, days in self._manifest()["months"].items() if days)

    def days(self, month: str) -> list[str]:
        return sorted(self._manifest()["months"].get(month, {}))

    def day_of(self) -> Column:
        """The partition of a row, as a column expression."""
        if self.buckets:
            keys, n = self.buckets
            return F.format_string("b%05d", F.pmod(F.xxhash64(*keys), F.lit(n)))
        if self.day_col is None:
            return F.lit(NO_DAY)
        return F.coalesce(F.date_format(self.day_col, self.grain), F.lit(NO_DAY))

    # -- writes -----------------------------------------------------------------------
    def append(self, df: Rows, month: str, by: Batch | None = None, run: str | None = None,
               carry: tuple[str, list[str] | None] | None = None, merged: tuple[str, Entries] | None = None,
               rules: dict[str, Column] | None = None) -> int:
        """Add rows to a month: one write (one for each part), then one manifest; the number of rows.

        In the same manifest: ``carry`` (source month, days or None for all) starts
        the month from another one; ``merged`` (source month, its versions) notes
        what has been compared with this month. ``by`` and ``run`` see
        :meth:`applied` and :meth:`run_of`; ``rules`` name conditions that no row may
        meet, else the rows are not published (:class:`RulesBroken`).
        """
        if by and self.applied(by):
            return 0
        version, days, rows = self._write(df, rules)

        def add(state: dict) -> None:
            if carry:
                self._carry(state, carry[0], month, carry[1])
            if merged:
                self._note(state, month, merged[1])
            entries = state["months"].setdefault(month, {})
            for d in days:
                entries.setdefault(d, []).append(version)
        self._apply(add, by, run, month)
        return rows

    def append_by_month(self, df: DataFrame) -> None:
        """Add rows to the months of their own days, in one write."""
        version, days, _ = self._write(df)

        def add(state: dict) -> None:
            for d in days:
                month = d if d == NO_DAY else month_tag(dt.date(int(d[:4]), int(d[5:7]), 1))
                state["months"].setdefault(month, {}).setdefault(d, []).append(version)
        self._commit(add)

    def replace(self, df: DataFrame, month: str) -> None:
        """Swap a month for ``df``, whatever it holds by then; an empty ``df`` removes the month."""
        version, days, _ = self._write(df)

        def swap(state: dict) -> None:
            state["months"][month] = {d: [version] for d in days}
        self._commit(swap)

    def replace_days(self, df: Rows, month: str, days: list[str], compacted: bool = False,
                     seen: Entries | None = None, by: Batch | None = None, note: dict | None = None) -> int:
        """Swap the rows of some days of a month for ``df`` (all of whose rows lie in these days); the number of rows.

        ``seen`` are the entries that ``df`` was computed from: rows that others have
        added to these days since stay beside it, and if some of ``seen`` are gone the
        change is refused. Without it the days become ``df`` whatever they hold by then.
        ``note`` is kept with the change (see :meth:`note`).
        """
        if by and self.applied(by):
            return 0
        version, written, rows = self._write(df)
        if not set(written) <= set(days):
            raise ValueError("rows outside the days that are replaced")

        def swap(state: dict) -> None:
            entries = state["months"].setdefault(month, {})
            for d in days:
                now, read = entries.pop(d, []), (seen or {}).get(d, [])
                if not set(read) <= set(now):
                    raise Conflict(f"{d} of {month} was replaced by another writer; run again")
                new = [version] * (d in written) + [v for v in now if seen is not None and v not in read]
                if new:
                    entries[d] = new
            if compacted:
                state["compacted"].append(version)
            state["notes"].update(note or {})
        self._apply(swap, by, None, month)
        return rows

    def carry(self, source: str, target: str, days: list[str] | None = None) -> None:
        """Let month ``target`` start from (some days of) month ``source``: a manifest entry, no rows are moved."""
        self._commit(lambda state: self._carry(state, source, target, days))

    def not_carried(self, source: str, target: str) -> Entries:
        """The versions of month ``source`` that ``target`` has neither started from nor been compared with."""
        state = self._manifest()
        known = state["carried"].get(target, {})
        fresh = {d: [v for v in versions if v not in known.get(d, [])] for d, versions in state["months"].get(source, {}).items()}
        return {d: versions for d, versions in fresh.items() if versions}

    @staticmethod
    def _note(state: dict, target: str, entries: Entries) -> None:
        known = state["carried"].setdefault(target, {})
        for d, versions in entries.items():
            known[d] = sorted({*known.get(d, []), *versions})

    def _carry(self, state: dict, source: str, target: str, days: list[str] | None) -> None:
        into = state["months"].setdefault(target, {})
        taken = {d: v for d, v in state["months"].get(source, {}).items() if days is None or d in days}
        for d, versions in taken.items():
            into[d] = into.get(d, []) + [v for v in versions if v not in into.get(d, [])]
        self._note(state, target, taken)

    def uncompacted_days(self, month: str) -> list[str]:
        """Days of a month that hold rows no compaction has seen together."""
        state = self._manifest()
        done = set(state["compacted"])
        return sorted(d for d, versions in state["months"].get(month, {}).items()
                      if len(versions) > 1 or versions[0] not in done)

    def note(self, name: str, default):
        """What a writer has noted with its last change, such as what its rows were computed from."""
        return self._manifest()["notes"].get(name, default)

    # -- incremental writers ------------------------------------------------------------
    def applied(self, by: Batch) -> bool:
        """Whether the changes of this batch are in already."""
        return self._manifest()["writers"].get(by.writer, {}).get("batch", -1) >= by.number

    def run_of(self, writer: str, month: str) -> str | None:
        """What the writer's open run has decided for a month; None before its first batch."""
        run = self._manifest()["writers"].get(writer, {}).get("run")
        return run["action"] if run and run["month"] == month else None

    def note_batch(self, by: Batch, run: str, month: str) -> None:
        """Take note of a batch that changes nothing."""
        self._apply(lambda state: None, by, run, month)

    def end_run(self, writer: str) -> None:
        """The writer has seen all there was: its next batch begins a run and decides anew."""
        if self._manifest()["writers"].get(writer, {}).get("run"):
            self._commit(lambda state: state["writers"][writer].update(run=None))

    def _apply(self, change: Callable[[dict], None], by: Batch | None, run: str | None, month: str) -> None:
        """Commit a change together with the batch it belongs to, once."""
        def once(state: dict) -> None:
            if by:
                writer = state["writers"].setdefault(by.writer, {"batch": -1, "run": None})
                if writer["batch"] >= by.number:
                    return
                writer["batch"] = by.number
                if run:
                    writer["run"] = {"action": run, "month": month}
            change(state)
        self._commit(once)

    # -- retention --------------------------------------------------------------------
    def expire(self, as_of: dt.datetime, days: int) -> list[str]:
        """Drop months that ended more than ``days`` before ``as_of``; other tags than months stay."""
        cutoff = (as_of - dt.timedelta(days=days)).replace(hour=0, minute=0, second=0, microsecond=0)
        dropped = [m for m in self.months() if re.fullmatch(r"\d{4}_[a-z]{3}", m)
                   and add_months(dt.datetime.strptime(m, "%Y_%b"), 1) <= cutoff]
        if dropped:
            self._commit(lambda state: [state["months"].pop(m) for m in dropped])
        return dropped

    def vacuum(self) -> list[str]:
        """Delete versions that no month refers to (of expired months, replaced days, failed runs).

        Run it when no writer and no reader of an older state is active.
        """
        state = self._manifest()
        used = {v for days in state["months"].values() for versions in days.values() for v in versions}
        gone = [v for v in self._list(f"{self.base}/data", f"{_VERSION}=") if v not in used]
        for v in gone:
            self._delete(f"{self.base}/data/{_VERSION}={v}")
        return gone

    def drop(self) -> None:
        """Delete the whole store."""
        self._delete(self.base)

    # -- storage ----------------------------------------------------------------------
    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def read(self, entries: Entries) -> DataFrame:
        paths = [f"{self.base}/data/{_VERSION}={v}/{_DAY}={d}" for d, versions in sorted(entries.items()) for v in versions]
        if not paths:
            return self._empty()
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rounds(self, entries: Entries) -> int:
        """In how many rounds to work on some days' rows, by the bytes of their files."""
        size = lambda *p: self._size("/".join([f"{self.base}/data", *p]))
        if rounds_for(sum(size(f"{_VERSION}={v}") for v in {v for vs in entries.values() for v in vs})) == 1:
            return 1
        return rounds_for(sum(size(f"{_VERSION}={v}", f"{_DAY}={d}") for d, vs in entries.items() for v in vs))

    def _write(self, df: Rows, rules: dict[str, Column] | None = None) -> tuple[str, list[str], int]:
        """Write rows as a new version, counting them and the rows that break a rule on the way; the version, its days, its rows."""
        version, rules, total = uuid.uuid4().hex, rules or {}, Counter()
        path = f"{self.base}/data/{_VERSION}={version}"
        for part in [df] if isinstance(df, DataFrame) else df:
            total.update(self._write_part(part, rules, path))
        broken = {name: total[name] for name in rules if total[name]}
        if broken:
            raise RulesBroken(broken)
        return version, self._list(path, f"{_DAY}="), total["_rows"]

    def _write_part(self, df: DataFrame, rules: dict[str, Column], path: str) -> dict[str, int]:
        seen = Observation()
        rows = conform(df, self.schema).withColumn(_DAY, self.day_of())
        # AQE merges small days and splits a hot one, so files come out near the advisory size.
        rows = rows.hint("rebalance", _DAY) if self.day_col or self.buckets else rows
        counts = [F.count_if(c).alias(name) for name, c in rules.items()]
        rows = rows.observe(seen, F.count(F.lit(1)).alias("_rows"), *counts)
        with shuffles_freed(self.spark):
            rows.write.mode("append").partitionBy(_DAY).option("compression", "zstd").parquet(path)
        return seen.get

    def _manifest(self) -> dict:
        return self._state()[1]

    def _state(self) -> tuple[int, dict]:
        """The newest manifest and its number, from one listing."""
        numbers = self._manifest_numbers()
        state = {"months": {}, "compacted": [], "carried": {}, "writers": {}, "notes": {}, "buckets": None}
        if not numbers:
            return 0, state
        fs, path = self._fs(f"{self.base}/manifest/{numbers[-1]:012d}.json")
        stream = fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return numbers[-1], state | json.loads(text)

    def _manifest_numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._list(f"{self.base}/manifest", "") if n.endswith(".json"))

    def _commit(self, change: Callable[[dict], None]) -> None:
        """Apply ``change`` to the newest manifest and publish the result under the next number.

        If another writer takes that number first, the change is applied to its
        state instead.
        """
        for _ in range(COMMIT_TRIES):
            number, state = self._state()
            change(state)
            if self.buckets:
                if state["buckets"] not in (None, self.buckets[1]):
                    raise Conflict(f"the store has {state['buckets']} buckets, these rows have {self.buckets[1]}; open it again")
                state["buckets"] = self.buckets[1]
            used = {v for days in state["months"].values() for versions in days.values() for v in versions}
            state["compacted"] = sorted(used & set(state["compacted"]))
            # What a month was made from matters while both the month and the version are there.
            state["carried"] = {m: {d: kept for d, vs in days.items() if (kept := [v for v in vs if v in used])}
                                for m, days in state["carried"].items() if m in state["months"]}
            if self._publish(number + 1, json.dumps(state)):
                return
        raise RuntimeError(f"another writer was first {COMMIT_TRIES} times; run again")

    def _publish(self, number: int, text: str) -> bool:
        """Put a manifest in place under its number unless there is one; whether this one is it.

        A local file is linked, elsewhere it is renamed: both leave an existing
        file alone on local disks and on file systems like HDFS. A store without
        such a rename (plain object stores) needs one writer at a time.
        """
        fs, temporary = self._fs(f"{self.base}/manifest/_{uuid.uuid4().hex}.tmp")
        _, path = self._fs(f"{self.base}/manifest/{number:012d}.json")
        stream = fs.create(temporary, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            if fs.getUri().getScheme() != "file":
                return not fs.exists(path) and fs.rename(temporary, path)
            local = lambda p: self.spark.sparkContext._jvm.java.io.File(p.toUri().getPath()).toPath()
            self.spark.sparkContext._jvm.java.nio.file.Files.createLink(local(path), local(temporary))
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception.getClass().getName()):
                raise
            return False
        finally:
            fs.delete(temporary, False)

    # -- file system ------------------------------------------------------------------
    def _fs(self, p: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(p)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _list(self, p: str, prefix: str) -> list[str]:
        """Names in a folder that start with ``prefix``, without it; an absent folder has none."""
        fs, path = self._fs(p)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(n[len(prefix):] for n in names if n.startswith(prefix) and not n.startswith(("_SUCCESS", ".")))

    def _size(self, p: str) -> int:
        fs, path = self._fs(p)
        return fs.getContentSummary(path).getLength()

    def _delete(self, p: str) -> None:
        fs, path = self._fs(p)
        fs.delete(path, True)


def previous_month(as_of: dt.datetime) -> dt.datetime:
    return add_months(as_of, -1)


def month_tags(as_of: dt.datetime) -> tuple[str, str]:
    """(current, previous) month tags of ``as_of``."""
    return month_tag(as_of), month_tag(previous_month(as_of))
