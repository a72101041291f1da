"""Compare every query with its reference SQL: python tests/check_oracles.py [sf_dir] [key ...]."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

from lamina.plans.fixtures import TABLES


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}") + 0.0
    if isinstance(v, (datetime, date)):
        return str(v)
    return v


def _family(t: str) -> str:
    t = str(t).lower()
    if t in ("bigint", "long", "hugeint"):
        return "bigint"
    if t in ("int", "integer"):
        return "int"
    if t in ("string", "varchar"):
        return "text"
    return t


def compare(spark, con, fn, sql: str, sf: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf)
    rel = con.sql(sql)
    cols = list(rel.columns)
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} against {sorted(cols)}"
    order = sorted(cols)
    types_a = {f.name: _family(f.dataType.simpleString()) for f in df.schema.fields}
    types_b = {c: _family(t) for c, t in zip(rel.columns, rel.types)}
    bad = {c: (types_a[c], types_b[c]) for c in order if types_a[c] != types_b[c] and types_b[c] != '"null"'}
    mine = sorted((tuple(_cell(r[c]) for c in order) for r in df.select(*(f"`{c}`" for c in order)).collect()), key=repr)
    pos = [cols.index(c) for c in order]
    theirs = sorted((tuple(_cell(r[p]) for p in pos) for r in rel.fetchall()), key=repr)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}; e.g. {mine[:2]} / {theirs[:2]}"
    for m, t in zip(mine, theirs):
        if m != t:
            return f"{dict(zip(order, m))} against {dict(zip(order, t))}"
    if not mine:
        return "no rows on either side"
    if bad:
        return f"types {bad}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from lamina.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    con, oracles, failed = connect(sf), oracle_sql(), 0
    for key, fn in queries().items():
        if args and key not in args:
            continue
        t0 = time.time()
        try:
            if key in oracles:
                problem = compare(spark, con, fn, oracles[key], sf)
            else:
                problem = None if fn(spark, sf).count() else "no rows"
        except Exception as e:  # noqa: BLE001 - a broken query must not hide the others
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {key:24s} {time.time() - t0:6.2f}s {'' if key in oracles else '(rows only) '}{problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
