"""Labelled training rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.functions.frames import join_unique


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(-1)).cast("int")


# Bytes of training texts, besides the bound on their number.
MOST_BYTES = 64 << 20


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int,
                  keep: tuple[str, ...] = (), most_bytes: int = MOST_BYTES) -> DataFrame:
    """Labelled rows ``text, label`` and ``keep`` outside the held-out fold, in one partition.

    At most ``most`` rows, of at most ``most_bytes`` in all, in the order of a hash of
    their id, so that re-runs agree; of several labels of an id the smallest counts.
    Labels meet the documents first, so that labels of other documents take no
    place. Only ids and sizes are put in order, before the texts are fetched.
    """
    named = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), folds) != held_out))
    labelled = named.groupBy(F.col("doc_id").alias("id")).agg(F.min(label).cast("int").alias("label"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("id"), text.alias("text"), *keep)
    sizes = rows.select("id", F.octet_length("text").alias("size"), F.xxhash64("id").alias("place"), F.xxhash64("text").alias("version"))
    order = ["place", "id", "version"]
    # The first ``most`` rows by an order that all tasks know; the running sum covers no others.
    first = join_unique(sizes, labelled, "id").orderBy(*order).limit(most)
    upto = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chosen = first.withColumn("upto", upto).filter(F.col("upto") <= most_bytes).groupBy("id").agg(F.min("label").alias("label"))
    return (
        rows.join(F.broadcast(chosen), "id").select("id", "text", "label", *keep)
        .orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).limit(most)
    )
