"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns they came with; the last adds ``copies``. Between stages the
documents lie as Parquet in the shared folder, so that a lost executor repeats
one stage at most.

Null ids and repeated rows: the quality, decontamination and secret stages judge
every row by its own text. The near-duplicate stage does so too: it groups texts,
whatever their ids, and keeps one row of each group, so that different texts of one
id, or without one, stay. Null and empty texts have too few words and leave at the
first stage. Columns of any name and type are passed on; a
column named ``copies`` is replaced in the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwire.functions.frames import tune, written
from tripwire.llm import circulant_minhash, decontamination, mixing, quality_rules, secret_scan
from tripwire.llm.common import pack, table, text_of


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior probability of being good is high enough.

    The documents are written with their measures, as the estimation and the
    verdicts both need those; a filter on unwritten measures would be pushed
    below them and compute them over and over.
    """
    measured = written(quality_rules.measure(pack(docs, docs["text"]), ["doc"]))
    return quality_rules.judge(measured, quality_rules.fit(measured)).filter("kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, similarity 0.8.

    Rows are known by their id and a hash of their text, the smallest of which leads
    a group; rows that share both are copies, of which one stays. Texts without a
    word are in no group.
    """
    version = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("version"))
    found = circulant_minhash.near_duplicates(docs.select(version.alias("doc_id"), "text"), width=5, percent=80)
    kept = found.filter("kept").select("doc_id.*").distinct().withColumn("key", F.xxhash64("id", "version"))
    rows = pack(docs, docs["doc_id"].alias("id"), F.xxhash64("text").alias("version")).withColumn("key", F.xxhash64("id", "version"))
    leading = rows.join(kept.select("key"), "key", "left_semi").withColumn(
        "nth", F.row_number().over(Window.partitionBy("key").orderBy("key")))
    return leading.filter("nth = 1").select("doc.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets blotted out of their texts."""
    found = secret_scan.find_secrets(pack(docs, docs["doc_id"], docs["text"]), ["doc"])
    clean = secret_scan.redact(F.col("text"), F.col("spans"))
    hit = F.size("spans") > 0
    marked = found.select("doc", hit.alias("hit"), F.when(hit, clean).alias("clean"))
    new = {"text": F.col("clean"), "n_chars": F.length("clean")}
    return marked.select(*[
        (F.when(F.col("hit"), new[c].cast(kind)).otherwise(F.col(f"doc.`{c}`")) if c in new else F.col(f"doc.`{c}`")).alias(c)
        for c, kind in docs.dtypes])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, and how many ``copies`` of each.

    Only ids, sources and sizes are queued. Their rows meet the documents again
    by hashes of the row; equal rows are numbered, as they are interchangeable.
    """
    row, version = F.xxhash64("doc_id", "source"), F.xxhash64("text")
    numbered = F.row_number().over(Window.partitionBy("row", "version").orderBy("row"))
    light = docs.select("doc_id", F.col("source").cast("string"), mixing.size_of(text_of()).alias("size"),
                        row.alias("row"), version.alias("version"))
    taken = mixing.mix(light, ["doc_id", "source", "size", "row", "version"]).select(
        "row", "version", F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int").alias("copies"),
    ).withColumn("nth", numbered).filter("copies > 0")
    whole = pack(docs, row.alias("row"), version.alias("version")).withColumn("nth", numbered)
    names = [c for c in docs.columns if c != "copies"]
    return whole.join(taken, ["row", "version", "nth"]).select(*[F.col(f"doc.`{c}`").alias(c) for c in names], "copies")


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("mixing", mix),
]

# Posterior probabilities, signatures and alignments are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
