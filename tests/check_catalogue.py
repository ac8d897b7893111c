"""Compare every catalogue query with its SQL: rows, columns, values.

python tests/check_catalogue.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver  # noqa: E402
from starloom.session import build_session  # noqa: E402

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(con: duckdb.DuckDBPyConnection, frame, text: str) -> str | None:
    """None when both sides agree, otherwise what differs."""
    actual = frame.toArrow()
    con.register("actual", actual)
    con.execute(f"CREATE OR REPLACE TEMP TABLE expected AS {text}")
    columns = sorted(c[0] for c in con.execute("SELECT * FROM expected LIMIT 0").description)
    if sorted(actual.column_names) != columns:
        return f"columns {sorted(actual.column_names)} vs {columns}"
    types = {
        side: {r[0]: r[1] for r in con.execute(f"DESCRIBE {side}").fetchall()} for side in ("actual", "expected")
    }
    n = con.execute("SELECT count(*) FROM expected").fetchall()[0][0]
    if n != actual.num_rows:
        return f"rows {actual.num_rows} vs {n}"
    listed = ", ".join(f'"{c}"' for c in columns)
    diff = f"(SELECT {listed} FROM {{}} EXCEPT ALL SELECT {listed} FROM {{}})"
    extra = con.execute(diff.format("actual", "expected") + " LIMIT 3").fetchall()
    lost = con.execute(diff.format("expected", "actual") + " LIMIT 3").fetchall()
    if extra or lost:
        return f"values {columns}\n  spark only {extra}\n  sql only {lost}"
    if types["actual"] != types["expected"]:
        odd = {c: (types["actual"][c], types["expected"][c]) for c in columns if types["actual"][c] != types["expected"][c]}
        return f"types {odd}"
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(master="local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(sf_dir), driver.oracle_sql(), 0
    for name, run in driver.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            frame = run(spark, sf_dir)
            problem = difference(con, frame, oracle[name]) if name in oracle else f"(no SQL) {frame.count()} rows"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None and not problem.startswith("(no SQL)")
        n = con.execute("SELECT count(*) FROM expected").fetchall()[0][0] if problem is None else ""
        print(f"{name:32s} {time.time() - begin:6.2f}s  {problem or f'ok {n} rows'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
