"""The alert log, the dispositions and the outbox, as partitioned tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.schemas import ALERT_LOG

LOG_COLUMNS = [f.name for f in ALERT_LOG]


def batch_folder(path: str, source: str, batch_id: int) -> str:
    return f"{path}/source={source}/batch_id={batch_id}"


def write_batch(rows: DataFrame, path: str, source: str, batch_id: int) -> None:
    """Write one batch's rows so that writing it again replaces them.

    Partitions are source, batch and day. A repeated batch replaces all days of
    its own folder, so nothing of an earlier attempt stays. Rows are rebalanced
    by day, with a busy day spread over several tasks.
    """
    (
        rows.withColumn("alert_date", F.to_date("time_stamp"))
        .hint("rebalance", "alert_date")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("alert_date").parquet(batch_folder(path, source, batch_id))
    )


def write_lines(lines: DataFrame, path: str, source: str, batch_id: int) -> None:
    """Write the lists of one batch's messages, which replaces those of an earlier attempt."""
    lines.write.mode("overwrite").parquet(batch_folder(path, source, batch_id))


def append_alerts(accepted: DataFrame, path: str, source: str, batch_id: int) -> None:
    """Add accepted alerts to the log."""
    write_batch(accepted.select(*LOG_COLUMNS), path, source, batch_id)


def read_log(
    spark: SparkSession, path: str, source: str | None = None,
    before_batch: int | None = None, since: datetime | None = None, every_source: bool = False,
) -> DataFrame:
    """Logged alerts; empty where no log exists. The limits prune partitions.

    ``every_source`` takes the other sources' alerts whatever their batch, and
    ``before_batch`` then limits the alerts of ``source`` alone.
    """
    schema = ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in ALERT_LOG]
        + ["source string", "batch_id long", "alert_date date"]
    )
    if not _exists(spark, path):
        return spark.createDataFrame([], schema).select(*LOG_COLUMNS)
    log = spark.read.schema(schema).parquet(path)
    own, earlier = F.lit(True), F.lit(True)
    if source is not None:
        own = F.col("source") == source
    if before_batch is not None:
        earlier = F.col("batch_id") < before_batch
    log = log.filter(~own | earlier if every_source else own & earlier)
    if since is not None:
        log = log.filter((F.col("alert_date") >= since.date()) & (F.col("time_stamp") >= F.lit(since).cast("timestamp_ntz")))
    return log.select(*LOG_COLUMNS)


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(location)
