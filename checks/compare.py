"""Run every query against its oracle: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries
from tripwire.functions.frames import own_folder

RAW = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in RAW:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _text(value: object) -> str:
    if pd.isna(value):
        return ""
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return str(value)


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows in order."""
    frame = frame[sorted(frame.columns)]
    text = frame.astype(object).apply(lambda column: column.map(_text))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str:
    """Empty when equal, else what differs first."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    for column in a.columns:
        wrong = a[column] != b[column]
        if wrong.any():
            return f"{column}: {a[wrong].iloc[0].to_dict()} and {b[wrong].iloc[0].to_dict()}"
    return ""


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("checks")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return own_folder(spark)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con, sql = session(), connect(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        ours = query(spark, sf_dir).toPandas()
        spent = time.time() - start
        start = time.time()
        problem = differences(ours, con.execute(sql[name]).df()) if name in sql else "no oracle"
        bad += bool(problem)
        print(f"{name:32s} {len(ours):8d} rows {spent:6.2f}s / {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
