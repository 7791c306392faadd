"""Run registered queries beside their SQL in DuckDB and compare the rows.

    python tests/check_queries.py [--sf-dir DIR] [names ...]
"""

from __future__ import annotations

import argparse
import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

import __spark_entry__ as contract


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normalised(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False):
        rows.append(tuple(None if pd.isna(v) else float(v) if isinstance(v, float) else v for v in row))
    return sorted(rows, key=repr)


def difference(expected: pd.DataFrame, got: pd.DataFrame) -> str | None:
    if sorted(expected.columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} instead of {sorted(expected.columns)}"
    for column in expected.columns:
        kinds = expected[column].dtype.kind, got[column].dtype.kind
        if kinds[0] != kinds[1] and not expected[column].isna().any():
            return f"type of {column}: {got[column].dtype} instead of {expected[column].dtype}"
        if kinds == ("i", "i") and expected[column].dtype != got[column].dtype:
            return f"type of {column}: {got[column].dtype} instead of {expected[column].dtype}"
    if len(expected) != len(got):
        return f"{len(got)} rows instead of {len(expected)}"
    a, b = normalised(expected), normalised(got)
    if a != b:
        wrong = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(wrong)} rows differ, first: {wrong[0]}"
    return None


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    arguments = parser.parse_args()
    spark, connection = session(), connect(arguments.sf_dir)
    oracles, failed = contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if arguments.names and name not in arguments.names:
            continue
        try:
            start = time.time()
            got = query(spark, arguments.sf_dir).toPandas()
            seconds = time.time() - start
            if name not in oracles:
                print(f"rows  {name}: {len(got)} rows {seconds:.2f}s")
                continue
            problem = difference(connection.execute(oracles[name]).df(), got)
        except Exception as error:  # report and go on with the next query
            problem, seconds = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += problem is not None
        print(f"{'FAIL ' if problem else 'ok   '} {name}: {problem or len(got)} {seconds:.2f}s", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
