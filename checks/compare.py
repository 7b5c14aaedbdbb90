"""Run queries in Spark and their SQL in DuckDB and compare the rows.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from labelflow.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, name: str, sf_dir: str) -> str:
    """Empty when both sides give the same columns and rows."""
    df = QUERIES[name](spark, sf_dir)
    mine = _rows(df.columns, df.collect())
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            i = next(i for i in range(len(a)) if a[i] != b[i])
            return f"column {sorted(names)[i]}: {a[i][:200]} != {b[i][:200]} in {str(a)[:300]}"
    return ""


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            if name in ORACLE:
                found = differences(spark, con, name, sf_dir)
                state = f"DIFFERS {found}" if found else "ok"
            else:
                state = f"rows only: {len(QUERIES[name](spark, sf_dir).collect())}"
        except Exception as e:  # report and go on with the next query
            state = "DIFFERS " + str(e).strip()[:600]
        bad += state.startswith("DIFFERS")
        print(f"{name:32s} {time.time() - start:6.2f}s {state}", flush=True)
    print("all equal" if not bad else f"{bad} differ")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
