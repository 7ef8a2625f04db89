"""URL filter: the ratio of two character language models.

Path rules judge the URLs they fit and thereby label them. From the accepted
and from the rejected URLs a Markov model of characters is learnt, of variable
order: each order is smoothed by the next shorter one in proportion to how many
different characters followed a context (Witten and Bell), down to an even
spread over all characters. A URL without a rule is blocked if the difference
of its log-likelihoods, divided by its length, is above a threshold calibrated
on labelled URLs that the models have not seen.

Everything is counted over all URLs. Equal URLs are counted together first, so
a hot URL or host costs no more than another, and joins on character runs can
be split. Only the calibration histogram (at most 2 * LIMIT / STEP + 1 rows)
reaches the driver.

Defined results: a null URL or one without "://" has empty host and path, fits
no rule and scores 0; a score of exactly the threshold is allowed; without
labels of both kinds the threshold is 0; an empty table gives no rows; repeated
rows are judged alike; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.functions.frames import join_unique, scratch, written
from tripwire.llm.common import lower_ascii

ORDER = 4
SYMBOLS = 256
LIMIT, STEP = 8.0, 0.02
FOLDS = 4


@dataclass(frozen=True)
class PathRule:
    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (
    PathRule("net/", "block"), PathRule("example.net/en/", "allow"),
    PathRule("example.com/de/", "block"), PathRule("org/fr/", "allow"),
)

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"


def _part(url: Column, k: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, k), F.lit(""))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path."""
    return lower_ascii(_part(url, 1)), _part(url, 2)


def rule_of(host: Column, path: Column, rules: tuple[PathRule, ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    def first(value):
        found = F.lit(None).cast("string")
        for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
            fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
            found = F.when(fits, value(r)).otherwise(found)
        return found

    return first(lambda r: r.text), first(lambda r: r.verdict)


def grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """A row for each character of ``text``, with the ``order`` characters before it."""
    padded = F.concat(F.lit("\x01" * order), F.col("text"))
    return texts.filter(F.length("text") > 0).withColumn("at", F.explode(F.sequence(F.lit(1), F.length("text")))).select(
        *texts.columns, F.substr(padded, F.col("at"), F.lit(order + 1)).alias("gram"))


def language_models(counts: DataFrame, order: int = ORDER, symbols: int = SYMBOLS) -> DataFrame:
    """``gram, p_a, p_b`` for ``counts(gram, a, b)`` with a row for each gram.

    ``a`` and ``b`` count the gram in the two sets of texts; grams in neither
    have a row with zeros and get what shorter contexts say.
    """
    model = None
    for k in range(order + 1):
        gram = F.substring("gram", order + 1 - k, k + 1)
        seen = counts.groupBy(gram.alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        context = F.substring("gram", 1, k)
        after = seen.groupBy(context.alias("context")).agg(
            *[F.sum(x).alias(f"n_{x}") for x in "ab"],
            *[F.sum(F.when(F.col(x) > 0, 1).otherwise(0)).alias(f"kinds_{x}") for x in "ab"],
        )
        rows = join_unique(seen.withColumn("context", context), after, "context")
        if model is None:
            rows = rows.withColumns({"q_a": F.lit(1 / symbols), "q_b": F.lit(1 / symbols)})
        else:
            shorter = model.select(F.col("gram").alias("tail"), F.col("p_a").alias("q_a"), F.col("p_b").alias("q_b"))
            rows = join_unique(rows.withColumn("tail", F.substring("gram", 2, k)), shorter, "tail")
        smooth = lambda x: F.when(
            F.col(f"n_{x}") == 0, F.col(f"q_{x}"),
        ).otherwise((F.col(x) + F.col(f"kinds_{x}") * F.col(f"q_{x}")) / (F.col(f"n_{x}") + F.col(f"kinds_{x}")))
        model = rows.select("gram", smooth("a").alias("p_a"), smooth("b").alias("p_b"))
    return model


def score_texts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``text, score`` for ``texts(text, a, b)``, unique by text.

    ``a`` and ``b`` say how often the text was accepted and rejected in the
    training rows. Scores are bits per character in favour of rejection.
    """
    runs = grams(texts, order)
    counts = written(runs.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    ratios = written(language_models(counts, order).select("gram", F.log2(F.col("p_b") / F.col("p_a")).alias("bits")))
    return join_unique(runs.select("text", "gram"), ratios, "gram").groupBy("text").agg(F.avg("bits").alias("score"))


def threshold(scored: DataFrame) -> float:
    """The score that best tells ``rejected`` from ``accepted`` counts; the nearest to 0 of equals."""
    near = F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("score")))
    bins = scored.groupBy(F.floor(near / STEP).alias("bin")).agg(
        F.sum("accepted").alias("a"), F.sum("rejected").alias("b")).orderBy("bin").collect()
    all_a, all_b = sum(r["a"] for r in bins), sum(r["b"] for r in bins)
    if not all_a or not all_b:
        return 0.0
    best, below_a, below_b = (-1.0, 0.0), 0, 0
    for r in bins:
        below_a, below_b = below_a + r["a"], below_b + r["b"]
        edge = (r["bin"] + 1) * STEP
        best = max(best, (round(below_a / all_a + 1 - below_b / all_b, 12), -abs(edge), edge))
    return best[-1]


def judge_urls(pages: DataFrame, rules: tuple[PathRule, ...] = RULES, order: int = ORDER) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages(page_id, url)``."""
    host, path = split_url(F.col("url"))
    parts = pages.select(
        "page_id", "url", host.alias("host"), path.alias("path"),
        F.concat(host, path, _part(F.col("url"), 3)).alias("text"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.select("page_id", "host", "path", "text", rule.alias("rule"), verdict.alias("said"))

    with scratch(pages.sparkSession) as keep:
        scores = keep(_scored(ruled, order))
    limit = threshold(scores)
    score = F.coalesce(F.col("score"), F.lit(0.0))
    return join_unique(ruled, scores.select("text", "score"), "text", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(score > limit, "block").otherwise("allow")).alias("verdict"),
        score.alias("score"))


def _scored(ruled: DataFrame, order: int) -> DataFrame:
    """``text, accepted, rejected, score``: each text once, with its labels in the calibration fold."""
    held = F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(FOLDS)) == 0
    count = lambda want, when: F.sum(F.when((F.col("said") == want) & when, 1).otherwise(0))
    texts = written(ruled.groupBy("text").agg(
        count("allow", ~held).alias("a"), count("block", ~held).alias("b"),
        count("allow", held).alias("accepted"), count("block", held).alias("rejected")))
    scored = score_texts(texts.select("text", "a", "b"), order)
    return join_unique(texts.select("text", "accepted", "rejected"), scored, "text")
