"""Run queries and their SQL side by side and report differences.

``python tests/compare.py <sf_dir> [name …]``
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of strings, columns in name order."""
    frame = frame[sorted(frame.columns)]

    def show(value) -> str:
        if value is None or value is pd.NA or (isinstance(value, float) and value != value):
            return "NULL"
        if isinstance(value, bool):
            return str(value)
        try:
            return repr(round(float(value), 9)) if not isinstance(value, str) else value
        except (TypeError, ValueError):
            return str(value)

    return sorted(tuple(map(show, row)) for row in frame.itertuples(index=False, name=None))


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    ours = queries()[name](spark, sf_dir).toPandas()
    theirs = connection.sql(oracle_sql()[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    left, right = canonical(ours), canonical(theirs)
    if left == right:
        return None
    extra = sorted(set(left) - set(right))[:3]
    missing = sorted(set(right) - set(left))[:3]
    return f"rows {len(left)} vs {len(right)}; only ours {extra}; only SQL {missing}"


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import queries
    from policyscan.session import configure

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(queries())
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    builder = builder.config("spark.driver.memory", "12g")
    spark = configure(builder.config("spark.ui.showConsoleProgress", "false")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = []
    for name in names:
        started = time.time()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s", flush=True)
        if problem:
            failed.append(name)
            print("     ", problem[:1500], flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
