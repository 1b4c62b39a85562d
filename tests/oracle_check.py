"""Run queries against their SQL: ``python tests/oracle_check.py [sf] [name …]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.10g}")
    return value


def normal(columns, rows):
    """Rows with columns in name order, as a sorted list that can be compared."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def compare(spark, con, name, run, sql, sf_dir) -> str:
    """'' when equal, else what differs."""
    df = run(spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    result = con.sql(sql)
    want = normal(result.columns, result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    diff = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(diff)} rows differ, first {diff[0]}" if diff else ""


def main() -> None:
    import __spark_entry__ as entry
    from lakejobs.session import build_session

    sf, *names = sys.argv[1:] or ["0.01"]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, run, oracles[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if not problem else problem}", flush=True)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
