"""Compare registered queries with their SQL statements run by DuckDB.

    python tests/oracle.py sf0.001 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = os.environ.get("SKERRY_TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else ("float", value + 0.0)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def difference(con, df, sql: str) -> str | None:
    """None when schema names and all values agree exactly, else what differs."""
    got_cols = df.columns
    got = _rows(got_cols, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = _rows(want_cols, cur.fetchall())
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}: {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"value {a} != {b}"
    if not got:
        return "no rows on either side"
    return None


def main(argv: list[str]) -> int:
    from skerry.plans import load_all
    from skerry.plans.registry import Tables
    from tests.conftest import local_session

    spark = local_session()
    sf_dir = f"{TESTDATA}/{argv[0]}"
    con = connect(sf_dir)
    registry = load_all()
    wanted = argv[1:]
    bad = 0
    for name, q in registry.items():
        if wanted and not any(name == w or name.startswith(w.rstrip("*")) and w.endswith("*") or q.build.__module__.endswith("." + w) for w in wanted):
            continue
        start = time.time()
        try:
            df = q.build(Tables(spark, sf_dir))
            if q.oracle:
                problem = difference(con, df, q.oracle)
            else:
                n = len(df.collect())
                problem = None if n else "no rows"
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:700]}"
        took = time.time() - start
        if problem:
            bad += 1
        if problem or took > 3:
            print(f"{'FAIL' if problem else 'slow'} {name} {took:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad of {len(registry)}")
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main(sys.argv[1:]) else 0)
