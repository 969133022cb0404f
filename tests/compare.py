"""Run registered queries beside their SQL and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 9)
    return str(value)


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


UNWANTED = ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def difference(spark, sf_dir: str, name: str, function, sql: str, con) -> str | None:
    """None when both agree, else what differs."""
    frame = function(spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    if any(step in plan for step in UNWANTED):
        return f"plan has one of {UNWANTED}"
    ours = sorted_rows(frame.columns, frame.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = sorted_rows(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{str(a)[:600]}\n   / {str(b)[:600]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry

    from strataflow import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(sf_dir), entry.oracle_sql()
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = difference(spark, sf_dir, name, function, oracles[name], con) or "ok"
            else:
                verdict = f"{len(function(spark, sf_dir).collect())} rows"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__}: {str(error)[:1200]}"
        print(f"{name}: {verdict} ({time.time() - start:.1f}s)", flush=True)
