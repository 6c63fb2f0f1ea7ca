"""Run the catalog next to its SQL and report what differs: python tools/check_oracles.py SF_DIR [key ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from postlens.plans.catalog import QUERIES  # noqa: E402
from postlens.plans.oracles import ORACLES  # noqa: E402
from postlens.session import build_session  # noqa: E402


# Spark type → DuckDB type
ALIKE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def views(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder: str, key: str) -> str:
    started = time.time()
    frame = QUERIES[key](spark, folder)
    rows = frame.collect()
    took = time.time() - started
    if key not in ORACLES:
        return f"rows {len(rows):7d} {took:6.1f}s  {key}: {rows[:3]}"
    started = time.time()
    cursor = connection.execute(ORACLES[key])
    expected = cursor.fetchall()
    names = [d[0] for d in cursor.description]
    sql_took = time.time() - started
    if sorted(names) != sorted(frame.columns):
        return f"FAIL {key}: columns {sorted(frame.columns)} != {sorted(names)}"
    types = dict(zip(names, (str(d[1]) for d in cursor.description)))
    odd_types = [(c, t, types[c]) for c, t in frame.dtypes if ALIKE.get(t, t.upper()) != types[c].upper()]
    if odd_types:
        print(f"     types of {key}: {odd_types}")
    left, right = sorted_rows(frame.columns, rows), sorted_rows(names, expected)
    if left != right:
        odd = [(a, b) for a, b in zip(left, right) if a != b]
        return f"FAIL {key}: rows {len(left)} != {len(right)}, differing {len(odd)}; {str(odd[:2])[:600]}"
    return f"same {len(rows):7d} {took:6.1f}s {sql_took:6.1f}s  {key}"


def main() -> None:
    folder, keys = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]", **{"spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": tempfile.mkdtemp()}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = views(folder)
    for key in keys:
        try:
            print(compare(spark, connection, folder, key), flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"FAIL {key}: {type(error).__name__} {str(error)[:700]}", flush=True)


if __name__ == "__main__":
    main()
