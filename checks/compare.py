"""Run queries against their SQL twins: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import QUERIES
from checks.oracle import ORACLE
from formweave.session import build_session

DATA = Path("/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str:
    """Empty when both sides give the same rows under the same column names."""
    rows = QUERIES[name](spark, sf_dir)
    columns = sorted(rows.columns)
    ours = sorted((repr(tuple(r[c] for c in columns)) for r in rows.collect()))
    if name not in ORACLE:
        return "" if ours else "no rows"
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} / {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())
    if ours == theirs:
        return "" if ours else "both empty"
    only_ours = sorted(set(ours) - set(theirs))[:3]
    only_theirs = sorted(set(theirs) - set(ours))[:3]
    return f"{len(ours)} / {len(theirs)} rows\n   ours only  {only_ours}\n   theirs only {only_theirs}"[:1800]


def main(argv: list[str]) -> int:
    scale = argv[0] if argv else "0.001"
    chosen = argv[1:] or list(QUERIES)
    sf_dir = str(DATA / f"sf{scale}")
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    for name in chosen:
        started = time.time()
        try:
            problem = difference(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - started:.1f}s {problem}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
