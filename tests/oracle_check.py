"""Spark result vs DuckDB oracle: row count, column names and types, row multiset.

Usable from pytest and from the command line:
    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from trendcast.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


_EXACT = {"long": "BIGINT", "integer": "INTEGER", "short": "SMALLINT", "byte": "TINYINT", "double": "DOUBLE",
          "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
          "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def _exact_spark(t) -> str:
    return _EXACT.get(t.typeName(), t.simpleString().upper())


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    rows = df.select(*cols).collect()
    spark_secs = time.time() - t0
    out = {"name": name, "rows": len(rows), "spark_secs": round(spark_secs, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    dcols = rel.columns
    dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
    drows = rel.fetchall()
    out["oracle_rows"] = len(drows)
    problems = []
    if sorted(dcols) != cols:
        problems.append(f"columns differ: spark-only {sorted(set(cols) - set(dcols))}, "
                        f"oracle-only {sorted(set(dcols) - set(cols))}")
    else:
        sexact = {f.name: _exact_spark(f.dataType) for f in df.schema.fields}
        bad = [c for c in cols if sexact[c] != dtypes[c]]
        if bad:
            problems.append("types differ: " + ", ".join(f"{c}:{sexact[c]}/{dtypes[c]}" for c in bad))
        idx = [dcols.index(c) for c in cols]
        a = Counter(tuple(_norm(v) for v in r) for r in rows)
        b = Counter(tuple(_norm(r[i]) for i in idx) for r in drows)
        if a != b:
            only_s = list((a - b).elements())[:3]
            only_d = list((b - a).elements())[:3]
            problems.append(f"values differ ({sum((a - b).values())} spark-only rows); "
                            f"cols={cols}; spark e.g. {only_s}; oracle e.g. {only_d}")
    out["status"] = "ok" if not problems else "MISMATCH"
    if problems:
        out["problems"] = problems
    return out


def main(argv: list[str]) -> int:
    from trendcast.catalog import REGISTRY
    from trendcast.oracle import QUERIES
    from trendcast.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(REGISTRY)
    spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    failed = 0
    for name in names:
        try:
            res = compare(spark, con, sf_dir, name, REGISTRY[name], QUERIES.get(name))
        except Exception as e:  # noqa: BLE001
            res = {"name": name, "status": "ERROR", "error": repr(e)[:600]}
        failed += res["status"] not in ("ok", "rows-only")
        print(res, flush=True)
    print(f"{len(names) - failed}/{len(names)} passed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
