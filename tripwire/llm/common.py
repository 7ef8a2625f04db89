"""What several corpus operators share: table access, word patterns, the order of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; all other letters stay."""
    return F.translate(text, UPPER, LOWER)


def pack(docs: DataFrame, *columns: Column) -> DataFrame:
    """Keep whole rows in one column ``doc``, so that no name of theirs can clash with ours."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), *columns)
