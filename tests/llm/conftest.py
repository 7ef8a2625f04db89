import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DATA = "/root/testdata/sf0.001"

# Nulls in every column, an empty text, white space only, repeated rows, a very long text.
ODD = [
    (1, "one two three four five six seven eight nine ten eleven twelve.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n ", "en", None),
    (None, "a text without an id, which has enough words to be kept in most places here.", "en", "b"),
    (5, "same row twice, with words enough to count as a text of its own.", None, "b"),
    (5, "same row twice, with words enough to count as a text of its own.", None, "b"),
    (6, "Éa ñ ü 漢字 😀 token = \"Aa0123456789\" " * 3, "de", "c"),
    (7, "word " * 40_000, "en", "a"),
    (8, "x" * 300_000, "en", "c"),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns that are named as operators name theirs."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    clash = ["words", "doc", "found", "size", "n_words", "rank", "copies", "score", "id", "version", "spans", "kept",
             "component_id", "bucket", "taken", "label"]
    rows = [(i, t, lang, s, None if t is None else len(t), *["?"] * len(clash)) for i, t, lang, s in ODD]
    return spark.createDataFrame(rows, schema + ", ".join(f"{c} string" for c in clash))
