"""Suppression: an alert repeated within an hour of its last accepted copy is dropped.

Two alerts are the same when all five fields of ``ALERT_KEY`` agree. A repeat
is dropped when an *accepted* copy is strictly earlier and less than the window
away, so acceptance depends on earlier acceptance and copies with equal times
share one fate.

How it scales. Time is cut into buckets of one window. In a bucket at most one
time of a key is accepted, and only a gap of a whole window starts a new chain,
so the lowest and highest time per key and bucket - combined before the shuffle
- show where chains begin and end. Then

* a chain shorter than the window accepts its first time and nothing else, and
  so does an alert whose times all lie within one window;
* a longer chain with few rows is folded in one array;
* a longer chain with many rows, such as a key that holds a large share of all
  alerts, is followed by pointer doubling: every time points to the first one at
  least a window later, and joins on (key, time), which no row shares with
  another, double the followed path each round.

All three are exact; ``fold_rows`` only chooses between the last two.

Most alerts are raised once. They are told by a hash of the key whose rows all
have one time: eight bytes and a time are shuffled for each row, and only rows
whose hash has several times meet the steps above with their key's texts.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.functions.columns import MICROS, wall_micros
from tripwire.functions.frames import join_unique, written
from tripwire.schemas import ALERT_KEY

HOUR = 3600
FOLD_ROWS = 5_000

ACCEPTED, DUPLICATE = "accepted", "duplicate"


def is_duplicate(
    candidates: DataFrame, log: DataFrame, key: list[str] = ALERT_KEY, ts: str = "time_stamp",
    window_seconds: int = HOUR,
) -> DataFrame:
    """Adds ``is_duplicate``: whether the log holds a copy less than a window earlier.

    No pairs of candidates and log rows are formed. A log row in the candidate's
    own bucket counts when it is earlier, which the bucket's lowest time tells;
    one in the bucket before counts when it is recent enough, which that
    bucket's highest time tells.
    """
    width = window_seconds * MICROS
    logged = log.select(*key, wall_micros(F.col(ts)).alias("at"))
    bucket = F.floor(F.col("at") / width).cast("long")
    none = F.lit(None).cast("long")
    reach = logged.select(
        *key,
        F.inline(F.array(
            F.struct(bucket.alias("bucket"), F.col("at").alias("own"), none.alias("previous")),
            F.struct((bucket + 1).alias("bucket"), none.alias("own"), F.col("at").alias("previous")),
        )),
    ).groupBy(*key, "bucket").agg(F.min("own").alias("own_low"), F.max("previous").alias("previous_high"))
    at = wall_micros(F.col(ts))
    probed = candidates.withColumn("at", at).withColumn("bucket", F.floor(F.col("at") / width).cast("long"))
    hit = (F.col("own_low") < F.col("at")) | (F.col("previous_high") + width > F.col("at"))
    return (
        join_unique(probed, reach, [*key, "bucket"], "left")
        .withColumn("is_duplicate", F.coalesce(hit, F.lit(False)))
        .select(*candidates.columns, "is_duplicate")
    )


def last_logged(log: DataFrame, key: list[str] = ALERT_KEY, ts: str = "time_stamp") -> DataFrame:
    """Per alert, the last time the log holds."""
    return log.groupBy(*key).agg(F.max(ts).alias(ts))


def suppress(
    candidates: DataFrame, key: list[str] = ALERT_KEY, ts: str = "time_stamp",
    window_seconds: int = HOUR, log: DataFrame | None = None, fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """Adds ``disposition``: accepted or duplicate.

    ``log`` holds alerts logged before. A candidate with a logged copy less than
    a window earlier is a duplicate and delays nothing; the others are judged
    among themselves. Logged copies of any time count, so candidates of the
    past are judged by the log as it was around them. Rows with a null in the
    key or time equal nothing, so none of them is a duplicate.
    """
    width = window_seconds * MICROS
    comparable = reduce(lambda a, c: a & F.col(c).isNotNull(), [*key, ts], F.lit(True))
    rows = candidates.withColumn("blocked", F.lit(False))
    if log is not None:
        known = join_unique(log, candidates.select(*key).distinct(), key, "left_semi")
        rows = is_duplicate(candidates, known, key, ts, window_seconds).withColumnRenamed("is_duplicate", "blocked")
    rows = rows.withColumn("at", wall_micros(F.col(ts))).withColumn("key_hash", F.xxhash64(*key))
    eligible = comparable & ~F.col("blocked")
    repeated = written(
        rows.filter(eligible).groupBy("key_hash").agg(F.min("at").alias("low"), F.max("at").alias("high"))
        .filter("low < high").select("key_hash", F.lit(True).alias("repeats"))
    )
    marked = join_unique(rows, repeated, "key_hash", "left")
    contested = marked.filter("repeats")
    accepted = accepted_times(contested.filter(eligible).select(*key, "at"), key, width, fold_rows)
    settled = join_unique(contested, accepted.withColumn("is_accepted", F.lit(True)), [*key, "at"], "left")
    alone = marked.filter(F.col("repeats").isNull()).withColumn("is_accepted", F.lit(True))
    passed = ~comparable | (F.coalesce("is_accepted", F.lit(False)) & ~F.col("blocked"))
    return alone.unionByName(settled).withColumn(
        "disposition", F.when(passed, ACCEPTED).otherwise(DUPLICATE)
    ).select(*candidates.columns, "disposition")


def accepted_times(points: DataFrame, key: list[str], width: int, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """The accepted times per key, each once; ``points`` has the key and ``at``."""
    # Most alerts live for less than a window: their first time is all there is.
    spans = written(points.groupBy(*key).agg(F.min("at").alias("at"), F.max("at").alias("last")))
    lasting = F.col("last") - F.col("at") >= width
    result = spans.filter(~lasting).select(*key, "at")
    long_lived = spans.filter(lasting).select(*key)
    if long_lived.isEmpty():
        return result

    points = join_unique(points, long_lived, key, "left_semi")
    chains = written(_chains(points, key, width))
    is_short = F.col("chain_end") - F.col("chain_start") < width
    is_small = F.col("chain_rows") <= fold_rows

    # At most one bucket of a chain starts it.
    starts = F.col("low") == F.col("chain_start")
    short = chains.filter(is_short & starts).select(*key, F.col("chain_start").alias("at"))
    small = _fold(_rows_of(points, chains.filter(~is_short & is_small), key, width), key, width)
    result = result.union(short).union(small)

    large = chains.filter(~is_short & ~is_small)
    span = large.agg(F.max(F.col("chain_end") - F.col("chain_start"))).first()[0]
    if span is not None:
        result = result.union(_follow(_rows_of(points, large, key, width).distinct(), key, width, span))
    return result


def _bucket(width: int) -> Column:
    return F.floor(F.col("at") / width).cast("long")


def _chains(points: DataFrame, key: list[str], width: int) -> DataFrame:
    """Per key and bucket, the bounds and row count of the chain it belongs to.

    The windows run over buckets, of which a key has as many as there are
    window lengths in the time covered, however many rows it has. Their sorts
    compare a hash of the key before its texts.
    """
    buckets = points.groupBy(*key, _bucket(width).alias("bucket")).agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.count("*").alias("bucket_rows")
    )
    own = ["key_hash", *key]
    in_order = Window.partitionBy(*own).orderBy("bucket")
    before = F.lag("high").over(in_order)
    chain = Window.partitionBy(*own, "chain")
    return (
        buckets.withColumn("key_hash", F.xxhash64(*key))
        .withColumn("starts", (before.isNull() | (F.col("low") - before >= width)).cast("int"))
        .withColumn("chain", F.sum("starts").over(in_order))
        .withColumns({
            "chain_start": F.min("low").over(chain),
            "chain_end": F.max("high").over(chain),
            "chain_rows": F.sum("bucket_rows").over(chain),
        })
        .select(*key, "bucket", "low", "chain_start", "chain_end", "chain_rows")
    )


def _rows_of(points: DataFrame, chains: DataFrame, key: list[str], width: int) -> DataFrame:
    return points.withColumn("bucket", _bucket(width)).join(
        chains.select(*key, "bucket", "chain_start"), [*key, "bucket"]
    ).select(*key, "chain_start", "at")


def _fold(points: DataFrame, key: list[str], width: int) -> DataFrame:
    """Walk a short array of times, keeping each that is a window past the last kept."""
    def step(kept: Column, at: Column) -> Column:
        return F.when(at - F.element_at(kept, -1) >= width, F.concat(kept, F.array(at))).otherwise(kept)

    times = F.array_sort(F.collect_set("at"))
    kept = F.aggregate("times", F.array(F.col("chain_start")), step)
    return (
        points.groupBy(*key, "chain_start").agg(times.alias("times"))
        .select(*key, F.explode(kept).alias("at"))
    )


def _follow(points: DataFrame, key: list[str], width: int, span: int) -> DataFrame:
    """Follow long chains from their start by pointer doubling.

    After a round the followed path is twice as long and every pointer spans
    twice as many steps. Times that no pointer reaches and the path does not
    hold can never be accepted and leave the table. Each round ends in a
    written table, which bounds the plan and survives lost executors.
    """
    chain = [*key, "chain_start"]
    jumps = written(_successors(points, key, width))
    path = written(points.select(*chain).distinct().withColumn("at", F.col("chain_start")))
    for _ in range(ceil(log2(span // width + 2)) + 1):
        if jumps.isEmpty():
            break
        reached = path.join(jumps, [*chain, "at"]).select(*chain, F.col("target").alias("at"))
        path = written(path.union(reached))
        useful = path.union(jumps.select(*chain, F.col("target").alias("at"))).distinct()
        onward = jumps.select(*chain, F.col("at").alias("target"), F.col("target").alias("next_target"))
        jumps = written(
            jumps.join(useful, [*chain, "at"], "left_semi")
            .join(onward, [*chain, "target"])
            .select(*chain, "at", F.col("next_target").alias("target"))
        )
    return path.select(*key, "at")


def _successors(points: DataFrame, key: list[str], width: int) -> DataFrame:
    """For each time of a chain, the first time at least a window later.

    The search runs in three levels - seconds, buckets, chain - so that no
    window sorts more than one second of distinct times, one bucket of seconds
    or one chain of buckets.
    """
    chain = [*key, "chain_start"]
    none = F.lit(None).cast("long")
    found = F.when(F.col("origin").isNull(), F.col("at"))
    slotted = (
        points.withColumn("origin", none)
        .union(points.select(*chain, (F.col("at") + width).alias("at"), F.col("at").alias("origin")))
        .withColumn("bucket", _bucket(width))
        .withColumn("slot", F.floor(F.col("at") / MICROS).cast("long"))
    )
    rest_of_slot = (
        Window.partitionBy(*chain, "bucket", "slot").orderBy(F.desc("at"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before_me = (Window.unboundedPreceding, -1)
    later_slots = Window.partitionBy(*chain, "bucket").orderBy(F.desc("slot")).rowsBetween(*before_me)
    later_buckets = Window.partitionBy(*chain).orderBy(F.desc("bucket")).rowsBetween(*before_me)

    slots = slotted.groupBy(*chain, "bucket", "slot").agg(F.min(found).alias("slot_low"))
    buckets = (
        slots.groupBy(*chain, "bucket").agg(F.min("slot_low").alias("bucket_low"))
        .withColumn("next_bucket_low", F.min("bucket_low").over(later_buckets))
        .drop("bucket_low")
    )
    beyond = (
        slots.withColumn("next_slot_low", F.min("slot_low").over(later_slots))
        .join(buckets, [*chain, "bucket"])
        .select(*chain, "bucket", "slot", F.coalesce("next_slot_low", "next_bucket_low").alias("beyond"))
    )
    return (
        slotted.withColumn("in_slot", F.min(found).over(rest_of_slot))
        .filter(F.col("origin").isNotNull())
        .join(beyond, [*chain, "bucket", "slot"])
        .select(*chain, F.col("origin").alias("at"), F.coalesce("in_slot", "beyond").alias("target"))
        .filter(F.col("target").isNotNull())
    )
