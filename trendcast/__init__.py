"""Trend and content analytics as Spark DataFrame functions.

Layout:
  sources/    table reads, landed-JSON flattening, monthly snapshot store
  functions/  Column-level expressions (scores, labels, local time, text)
  operators/  DataFrame operators (dedupe, lookups, skew-safe ranking, top-k)
  plans/      staging view, marts, rollover, compaction, quality checks
  streaming/  incremental landing ingest with Structured Streaming
"""

from trendcast.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
