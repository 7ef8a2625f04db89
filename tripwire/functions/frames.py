"""Small DataFrame helpers."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the jobs rely on: run-time re-planning, splitting of a hot join key even
# where the split costs one more shuffle, and shuffle files that go when their query
# ends. Otherwise those of all queries so far lie on disk until the driver happens to
# collect its garbage.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# What a task of a shuffle takes, where the session does not say. Shuffled rows are some ten times as large
# in memory as they are compressed, so Spark's own 64 MB make tasks that sort and aggregate on disk.
TASK_BYTES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")


def tune(spark: SparkSession) -> SparkSession:
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    if spark.conf.get(TASK_BYTES[0], None) is None:
        spark.conf.set(*TASK_BYTES)
    return spark


def one_row_per_key(df: DataFrame, key: str, attrs: list[str], order: str | None = None) -> DataFrame:
    """Reduce a lookup table to a single row per key.

    Takes the attributes of the row with the smallest ``order`` column (the
    smallest attributes among equals), so re-runs agree. The minimum is
    combined before the shuffle: a key with very many rows costs one row per task.
    """
    row = F.struct(*([order] if order else []), *[a for a in attrs if a != order])
    best = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("best"))
    return best.select(key, *[F.col(f"best.{a}").alias(a) for a in attrs])


def join_unique(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join a side whose keys may be hot to one with a single row per key.

    At run time Spark splits a hot partition of a join only where both inputs
    come straight out of a shuffle. A side that was just aggregated by the same
    key would skip that shuffle, and the hot key would stay in one task. The
    hash of the key as a second join key asks for the shuffle; it moves one row
    per key. Sides small enough to broadcast are broadcast as ever. The hash
    comes first so that sorts compare numbers before they compare texts.
    """
    keys = [on] if isinstance(on, str) else on
    spread = F.xxhash64(*keys)
    return left.withColumn("spread", spread).join(
        right.withColumn("spread", spread), ["spread", *keys], how
    ).drop("spread")


def estimated_bytes(df: DataFrame) -> int:
    """What Catalyst expects a table to hold; very much where it knows nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """The size up to which Spark broadcasts a side of a join; -1 for never."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


# A cut pays where the keys asked about are fewer than one in so many bytes of the key column.
CUT_PAYS = 8


def only(rows: DataFrame, keys: DataFrame | None, *on: str) -> DataFrame:
    """The rows whose ``on`` columns are among ``keys``, where dropping the others early pays.

    That is where the keys are small enough to broadcast, so that the cut moves no
    row of ``rows``, and few against the table. All rows else: what they give for
    other keys goes at the end, see ``cut``, in a join that moves nothing either.
    """
    if keys is None:
        return rows
    size = estimated_bytes(keys)
    if size > broadcast_limit(rows.sparkSession) or size * CUT_PAYS > estimated_bytes(rows.select(*on)):
        return rows
    return rows.join(keys.select(*on), list(on), "left_semi")


def cut(facts: DataFrame, keys: DataFrame | None, *on: str) -> DataFrame:
    """The facts of ``keys``; both were aggregated by ``on`` and lie alike, so that this is no shuffle."""
    return facts if keys is None else facts.join(keys.select(*on), list(on), "left_semi")


def merge_by_key(frames: list[DataFrame], keys: DataFrame) -> DataFrame:
    """The columns of all frames, each unique by key, for each of ``keys``; all lie alike."""
    if len(frames) == 1:
        return frames[0]
    on = keys.columns
    return reduce(lambda known, frame: known.join(frame, on, "left"), frames, keys)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, which all executors see."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(folder)
    return folder


def own_folder(spark: SparkSession) -> SparkSession:
    """For tests and trials on one machine: name a folder where the session names none."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not named and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tripwire-"))
    return spark


# The folder below the shared one that tables go to at the moment.
_PLACE: ContextVar[str | None] = ContextVar("place", default=None)


def written(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    This cuts the lineage and survives lost executors, as a checkpoint does.
    Unlike a checkpoint, the result has statistics, so Spark can weigh a
    broadcast, and the scan can prune its columns and rows.
    """
    spark = df.sparkSession
    place = _PLACE.get() or f"tables-{spark.sparkContext.applicationId}"
    path = f"{shared_folder(spark)}/{place}/{name or uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside are removed at the end.

    Yields a function that writes a result where it outlives them.
    """
    place = f"scratch-{uuid4().hex}"
    outer = _PLACE.get()
    token = _PLACE.set(place)

    def keep(df: DataFrame) -> DataFrame:
        inner = _PLACE.set(outer)
        try:
            return written(df)
        finally:
            _PLACE.reset(inner)

    try:
        yield keep
    finally:
        _PLACE.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{place}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
