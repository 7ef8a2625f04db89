"""Mixing sources to target weights by weighted fair queueing.

The documents of a source stand in a queue, in an order shuffled by a hash. A
document's virtual finish time is the number of tokens in its source's queue up
to and including it, over the source's target. Sorted by finish time over all
sources and cut where the token budget is spent, the corpus holds every source
near its target at any point. A source whose target exceeds its size is queued a
second time behind itself; nothing is taken more than twice.

No window covers a source or the whole corpus: tokens are summed for buckets of
the shuffled order (combined before the shuffle), the small table of bucket sums
is added up, and rows are sorted only inside their bucket. The global cut is
found likewise: sums over bins of finish times, then rows of one bin.

Defined results: a null or empty text has size 0 and is never taken; null is a
source of its own, last in order; equal rows are interchangeable, each counted;
null ids sort first; an empty table gives no rows; other columns are not looked
at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.functions.frames import scratch, written
from tripwire.llm.common import text_of, words_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
BUCKET_DIGITS = 3  # 4,096 buckets of the shuffled order for each source
BINS = 4096


def size_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def shuffled(doc_id: Column, seed: str = "mix") -> Column:
    """The place of a document in its source's queue."""
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source, rank, source_size, target`` for ``sizes(source, size)``.

    A target is the source's share of the budget by weight but at most
    MOST_REPEATS times its size; what that cuts off is shared anew by weight.
    With sources in order of size over weight, the first one below its limit
    fixes the tokens a unit of weight gets. The table has a row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cap, weight = F.col("cap"), F.col("weight")
    ordered = Window.orderBy("ratio", "rank")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    weighed = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                           ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", (MOST_REPEATS * F.col("source_size")).cast("double"))
        .withColumn("ratio", cap / weight)
        .withColumn("budget", share * F.sum("source_size").over(every))
    )
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    return (
        weighed.withColumn("level", level)
        .withColumn("level", F.min(F.when(
            F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(every)["level"])
        .withColumn("target", F.least(cap, weight * F.coalesce(F.col("level"), cap / weight)))
        .select("source", "rank", "source_size", "target", "budget")
    )


def mix(rows: DataFrame, keep: list[str], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Mix ``rows`` with ``keep`` columns, ``doc_id``, ``source`` and ``size``.

    Adds ``source_size``, ``target``, ``finish_1`` and ``finish_2`` (the finish
    times of the first and second copy) and ``taken``. The result is a written
    table; those it is made from are removed.
    """
    with scratch(rows.sparkSession) as hold:
        return hold(_mixed(rows, [c for c in keep if c not in ("doc_id", "source", "size")], weights, share))


def _mixed(rows: DataFrame, extra: list[str], weights: tuple[int, ...], share: float) -> DataFrame:
    queued = written(rows.select(
        *extra, "doc_id", "source", "size", shuffled(F.col("doc_id")).alias("place"),
    ).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS)))
    light = queued.select("source", "size", "bucket")
    targets = written(source_targets(light, weights, share))

    # Tokens in the queue before each bucket; null sources are told from empty ones by their rank.
    by_bucket = light.groupBy("source", "bucket").agg(F.sum("size").alias("sum"))
    ranked = by_bucket.join(
        targets.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    ahead = ranked.withColumn("ahead", F.sum("sum").over(
        Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("sum"))

    key = F.xxhash64(F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull(), F.col("bucket"))
    inside = Window.partitionBy("queue").orderBy("place", "doc_id", "size", "source").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = queued.withColumn("queue", key).join(
        ahead.withColumn("queue", key).select("queue", "rank", "source_size", "target", "budget", "ahead"),
        "queue",
    ).withColumn("upto", F.col("ahead") + F.sum("size").over(inside))
    finish = lambda upto: F.when(F.col("size") > 0, upto / F.col("target"))
    timed = written(
        placed.withColumn("finish_1", finish(F.col("upto")))
        .withColumn("finish_2", finish(F.col("upto") + F.col("source_size")))
        .drop("queue", "place", "bucket", "ahead", "upto"))

    cut = _cut(timed)
    within = lambda name: F.when(
        F.struct(F.col(name).alias("finish"), F.col("rank").alias("rank"))
        <= F.struct(F.lit(cut[0]).alias("finish"), F.lit(cut[1]).cast("int").alias("rank")), F.col("size")).otherwise(0)
    size_twice = F.when(F.col("size") > 0, within("finish_1") + within("finish_2")).otherwise(0)
    return timed.withColumn("taken", size_twice.cast("long")).drop("budget")


def _bin(finish: Column) -> Column:
    """A bin that grows with the finish time, so that few bins hold any range of times."""
    return F.floor(F.when(finish <= 2, finish * BINS).otherwise(2 * BINS + F.log2(finish / 2) * 64))


def _cut(timed: DataFrame) -> tuple[float, int]:
    """The last (finish time, source rank) within the budget."""
    copies = timed.filter(F.col("size") > 0).select(
        "size", "rank", "budget", F.explode(F.array("finish_1", "finish_2")).alias("finish"),
    ).withColumn("bin", _bin(F.col("finish")))
    bins = copies.groupBy("bin").agg(F.sum("size").alias("sum"), F.max("budget").alias("budget"))
    running = bins.withColumn(
        "upto", F.sum("sum").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    crossed = running.filter(F.col("upto") > F.col("budget")).orderBy("bin").select(
        "bin", (F.col("upto") - F.col("sum")).alias("before")).first()
    if crossed is None:
        return float("inf"), 0
    order = Window.orderBy("finish", "rank").rowsBetween(Window.unboundedPreceding, 0)
    fitting = copies.filter(F.col("bin") == crossed["bin"]).withColumn(
        "upto", F.lit(crossed["before"]) + F.sum("size").over(order)).filter(F.col("upto") <= F.col("budget"))
    for part in (fitting, copies.filter(F.col("bin") < crossed["bin"])):
        last = part.agg(F.max(F.struct("finish", "rank")).alias("last")).first()["last"]
        if last:
            return last["finish"], last["rank"]
    return float("-inf"), 0
