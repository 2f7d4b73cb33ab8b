"""Run a query and its SQL twin side by side and compare rows as multisets."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from .queries import QUERIES
from .sql import SQL


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf: str, name: str) -> str | None:
    """None when equal, else what differs."""
    df = QUERIES[name](spark, sf)
    got_names = sorted(df.columns)
    got = Counter(tuple(r[c] for c in got_names) for r in df.collect())
    rel = con.execute(SQL[name])
    names = [d[0] for d in rel.description]
    if sorted(names) != got_names:
        return f"columns {got_names} != {sorted(names)}"
    at = [names.index(c) for c in got_names]
    want = Counter(tuple(r[i] for i in at) for r in rel.fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (f"{sum(got.values())} rows, expected {sum(want.values())}; "
            f"extra {list(extra)[:2]}, missing {list(missing)[:2]}")


def main(sf: str, names: list[str]) -> int:
    from ..session import build
    spark = build("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in names or list(QUERIES):
        if name not in SQL:
            print(f"{name:28s} rows {QUERIES[name](spark, sf).count()} (no SQL twin)")
            continue
        began = time.time()
        found = difference(spark, con, sf, name)
        bad += found is not None
        print(f"{name:28s} {time.time() - began:5.1f}s {'ok' if found is None else 'DIFF ' + found}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
