"""Job entry points.

    spark-submit trendcast/__main__.py load DATASET --landing DIR --store DIR --checkpoint DIR [--dimensions DIR] [--required COL ...] [--as-of ISO]
    spark-submit trendcast/__main__.py load keyword_videos --landing DIR --details DIR --store DIR --checkpoint DIR ...
    spark-submit trendcast/__main__.py refresh --store DIR --videos DIR --out DIR [--partials DIR] [--as-of ISO]
    python -m trendcast ...            (local run)

``load`` is one scheduled load of trends, jobs, posts, popular or keyword_videos:
the files that are new in the landing folder are flattened, rolled into this
month's snapshot, and the month is compacted on the dataset's key. ``refresh``
rebuilds staging and the marts from this month's snapshots and writes them as
tables; with ``--partials`` the pulse, recurrence and gap marts come from stored
partial aggregates, of which only changed days are computed again. The session comes from the environment (spark-submit), so no master is
set here.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from trendcast.functions.timeparts import month_tag
from trendcast.plans import loads
from trendcast.plans.refresh import refresh_from_partials, refresh_marts


def _as_of(text: str | None) -> dt.datetime:
    if text:
        return dt.datetime.fromisoformat(text)
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def load(spark: SparkSession, args: argparse.Namespace) -> dict:
    dimensions = loads.dimensions_from(spark, args.dimensions)
    if args.dataset == "keyword_videos":
        return loads.load_keyword_videos(spark, args.landing, args.details, args.store, args.checkpoint, _as_of(args.as_of),
                                         loads.distinct_pairs(dimensions["categories"]))
    return loads.load(spark, args.dataset, args.landing, args.store, args.checkpoint, _as_of(args.as_of), dimensions,
                      args.when_present, args.required)


def refresh(spark: SparkSession, args: argparse.Namespace) -> dict:
    as_of = _as_of(args.as_of)
    month = month_tag(as_of)
    trends = loads.store_of(spark, "trends", args.store)
    videos = loads.store_of(spark, "keyword_videos", args.videos)
    if args.partials:
        return refresh_from_partials(trends, videos, month, as_of, args.partials, args.out)
    return refresh_marts(spark, trends.load(month), videos.load(month), as_of, args.out)


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="trendcast")
    sub = parser.add_subparsers(dest="command", required=True)
    p_load = sub.add_parser("load")
    p_load.add_argument("dataset", choices=[*loads.LOADS, "keyword_videos"])
    for name in ("--landing", "--store", "--checkpoint"):
        p_load.add_argument(name, required=True)
    p_load.add_argument("--details")
    p_load.add_argument("--dimensions")
    p_load.add_argument("--when-present", choices=["append", "skip"], default="append")
    p_load.add_argument("--required", nargs="*", help="columns without which a row is not published")
    p_load.add_argument("--as-of")
    p_ref = sub.add_parser("refresh")
    for name in ("--store", "--videos", "--out"):
        p_ref.add_argument(name, required=True)
    p_ref.add_argument("--partials", help="folder of stored partials: aggregate only what has changed since the last refresh")
    p_ref.add_argument("--as-of")
    args = parser.parse_args(argv)
    if args.command == "load" and args.dataset == "keyword_videos" and not (args.details and args.dimensions):
        parser.error("keyword_videos needs --details and --dimensions")
    spark = SparkSession.builder.appName(f"trendcast-{args.command}").getOrCreate()
    result = load(spark, args) if args.command == "load" else refresh(spark, args)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
