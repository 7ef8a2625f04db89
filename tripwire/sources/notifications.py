"""Notification payloads from text files: one payload a line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_WITH_TIME = "time_stamp timestamp_ntz, payload string"


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated time and payload, as columns time_stamp and payload."""
    return _columns(spark.read.text(path))


def stream_payloads(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _columns(reader.text(path))


def _columns(lines: DataFrame) -> DataFrame:
    parts = F.split(F.col("value"), "\t", 2)
    return lines.select(
        F.get(parts, F.lit(0)).try_cast("timestamp_ntz").alias("time_stamp"),
        F.get(parts, F.lit(1)).alias("payload"),
    )
