"""One query per corpus operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.functions.frames import tune, written
from tripwire.llm import (
    byte_bpe, circulant_minhash, conversation_repair, decontamination, hyperplane_tree, license_spans, mixing, quality_machine,
    quality_rules, secret_scan, toxicity, url_ratio, warc_chunks,
)
from tripwire.llm.common import table, text_of
from tripwire.llm.oracle import oracle_sql

__all__ = ["oracle_sql", "queries"]

Query = Callable[[SparkSession, str], DataFrame]


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_ratio.judge_urls(table(tune(spark), sf_dir, "pages").select("page_id", "url"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    rows = docs.select("doc_id", F.col("source").cast("string"), mixing.size_of(text_of()).alias("size"))
    mixed = mixing.mix(rows, ["doc_id", "source", "size"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc_chunks.archive_pages(table(tune(spark), sf_dir, "pages"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return warc_chunks.page_totals(warc_chunks.read_chunks(files.repartition(tasks, "file"), keep_data=False))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents").select("doc_id", "text", *quality_machine.META)
    return quality_machine.score(docs, quality_machine.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of four words, as the query's contract says; the operator's own default is five."""
    docs = table(tune(spark), sf_dir, "documents").select("doc_id", "text")
    return circulant_minhash.near_duplicates(docs, width=4, percent=80)


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(tune(spark), sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    kinds = [r.kind for r in secret_scan.RULES if r.base]
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin(kinds))
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(secret_scan.written_out(base), 256).alias("base_sha256"),
        secret_scan.written_out(F.col("spans")).alias("spans"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents").select("doc_id", "text")
    measured = written(quality_rules.measure(docs, ["doc_id"]))
    judged = quality_rules.judge(measured, quality_rules.fit(measured))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", F.round("posterior", 6).alias("posterior"))


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents").select("doc_id", "text")
    return decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_spans.scan(table(tune(spark), sf_dir, "documents").select("doc_id", "text"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    codec = byte_bpe.Codec(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    encoded = byte_bpe.encode(table(tune(spark), sf_dir, "documents"), ["doc_id"], codec)
    decoded = byte_bpe.decode(encoded, ["doc_id", "n_tokens", "ids"], codec)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(table(tune(spark), sf_dir, "conversations")))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = hyperplane_tree.prepared(table(tune(spark), sf_dir, "embeddings"))
    moved = rows.withColumn("label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return hyperplane_tree.mine(moved, vec_id % 50 == 0)


def queries() -> dict[str, Query]:
    return {
        "op1_url_ratio": url_filter,
        "op2_toxicity": toxic,
        "op3_mix_sources": mix_sources,
        "op4_warc_chunks": archives,
        "op5_quality_machine": quality_scores,
        "op6_circulant_minhash": near_duplicates,
        "op7_secret_scan": secrets,
        "op8_quality_rules": quality,
        "op9_decontamination": leaks,
        "op10_license_spans": licenses,
        "op11_byte_bpe": tokens,
        "op12_conversation_repair": repairs,
        "op13_hyperplane_tree": hard_negatives,
        "pipeline": pipeline,
    }

