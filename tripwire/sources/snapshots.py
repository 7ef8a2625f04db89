"""Snapshot tables: read them and bring text quirks to one form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.schemas import TABLES, table_schema


def text_flag(flag: Column) -> Column:
    """A boolean from the flag spellings t/f and true/false, any case."""
    text = F.lower(F.trim(flag))
    return F.when(text.isin("t", "true"), True).when(text.isin("f", "false"), False)


def normalise(df: DataFrame, table: str) -> DataFrame:
    """Strip the padding of part numbers and turn text flags into booleans.

    Only columns that need it are rewritten, so filters on all others still
    reach the parquet scan.
    """
    found = {f.name: f.dataType for f in df.schema}
    for field in table_schema(table):
        kind = found.get(field.name)
        if field.name == "prt_no" and kind is not None:
            df = df.withColumn("prt_no", F.rtrim("prt_no"))
        elif isinstance(field.dataType, T.BooleanType) and isinstance(kind, T.StringType):
            df = df.withColumn(field.name, text_flag(F.col(field.name)))
    return df


def read_snapshots(
    spark: SparkSession, root: str, names: Iterable[str] | None = None, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """The business tables below ``root``, one folder or file set per table."""
    return {
        name: normalise(spark.read.format(fmt).load(f"{root}/{name}"), name)
        for name in (names or TABLES)
    }
