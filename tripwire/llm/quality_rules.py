"""Quality rules under weak supervision.

Every rule votes good or bad on a text, or abstains. How reliable each rule is,
is learnt without labels: expectation-maximisation over the vote patterns of the
whole corpus estimates the share of good texts and, for every rule, how often it
casts which vote on good and on bad texts. A text's posterior probability of
being good then replaces "all rules must pass": a rule that calls good and bad
texts bad alike loses its say, and a bad vote can be outvoted.

The measures are array functions inside one row, so no word is ever shuffled.
What the estimation needs is the number of texts for each vote pattern, at most
3 to the power of the rules whatever the size of the corpus; that count is
combined before its shuffle, and only it reaches the driver.

Defined results: a null text counts as empty, has no words and fails the base
rule; the verdict depends on the text alone, so repeated rows and null or
repeated ids are judged alike; a posterior of exactly the threshold is kept;
texts of any length are measured whole, by shares that do not change with
length; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm.common import NOT_SPACE, text_of, words_of

WINDOW = 5
STRETCH = 1_000  # words; variety is the mean share of distinct words in stretches of so many
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_caps", "n_marks", "n_stops", "n_varied",
    "n_symbol_runs", "n_letter_runs",
]


@dataclass(frozen=True)
class Rule:
    """Votes bad if ``bad`` holds, else good if ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str


# Shares of words or lines; between the two bounds a rule abstains.
RULES = (
    Rule("symbols", "n_symbols > 0.3 * n_words", "n_symbols < 0.02 * n_words"),
    Rule("symbol_words", "n_symbol_runs > 0.2 * n_words", "n_symbol_runs < 0.02 * n_words"),
    Rule("letters", "n_letter_runs < 0.7 * n_words", "n_letter_runs > 0.9 * n_words"),
    Rule("line_repeats", "n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0"),
    Rule("window_repeats", "n_repeat_words > 0.2 * n_words", "n_repeat_words < 0.02 * n_words"),
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words",
         "word_chars > 4 * n_words and word_chars < 6.5 * n_words"),
    Rule("capitals", "n_caps > 0.3 * n_words", "n_caps < 0.05 * n_words"),
    Rule("marks", "n_marks > 0.3 * n_words", "n_marks < 0.05 * n_words"),
    Rule("variety", "n_varied < 0.15 * n_words", "n_varied > 0.35 * n_words"),
    Rule("prose", "n_words >= 50 and n_stops < 0.01 * n_words", "n_stops > 0.05 * n_words"),
)

# What is believed before a text is seen, in numbers of texts for each class and vote: good texts
# hardly ever get a bad vote, and bad texts look fine to most rules. Some hundred texts outweigh it.
BELIEF = {
    ("good", "g"): 75.0, ("good", "-"): 22.5, ("good", "b"): 2.5,
    ("bad", "g"): 50.0, ("bad", "-"): 20.0, ("bad", "b"): 30.0,
}
SHARE_BELIEF = 1.0
ROUNDS = 30


def measure(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the MEASURES of column ``text``.

    Functions of array elements look at their element only, never at another
    column, which Spark might compute anew for each element.
    """
    split = rows.select(*keep, text_of().alias("body")).select(
        *keep, words_of(F.col("body")).alias("words"),
        F.filter(F.split("body", "\n"), lambda line: line.rlike(NOT_SPACE)).alias("lines"),
        F.regexp_count("body", F.lit("[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count("body", F.lit("[#*$%&|<>]+")).alias("n_symbol_runs"),
        F.regexp_count("body", F.lit(r"\p{L}+")).alias("n_letter_runs"),
        F.regexp_count("body", F.lit("[A-Z]{2,}")).alias("n_caps"),
        F.regexp_count("body", F.lit("[!?]")).alias("n_marks"),
        F.regexp_count("body", F.lit(r"\p{Ll}[.,;:?](?:[\x20\n]|\z)")).alias("n_stops"),
    )
    n = F.size("words")
    hashed = split.select(
        *keep, "n_symbols", "n_symbol_runs", "n_letter_runs", "n_caps", "n_marks", "n_stops", n.alias("n_words"),
        F.char_length(F.array_join("words", "")).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("word_hashes"),
    )
    m, shift = F.size("word_hashes"), lambda k: F.slice("word_hashes", k + 1, F.greatest(m - k, F.lit(0)))
    rows_of = F.arrays_zip(*[shift(k).alias(f"w{k}") for k in range(WINDOW)])
    windows = hashed.withColumn("hashes", F.when(
        m >= WINDOW, F.slice(F.transform(rows_of, lambda x: F.xxhash64(x)), 1, m - (WINDOW - 1))))
    # Equal windows become neighbours; texts without any are spared the sort.
    sorted_ = windows.withColumn("sorted", F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    n_sorted, none = F.size("sorted"), F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    neighbours = F.arrays_zip(
        F.col("sorted").alias("own"),
        F.concat(none, F.slice("sorted", 1, n_sorted - 1)).alias("before"),
        F.concat(F.slice("sorted", 2, n_sorted), none).alias("after"))
    starts = sorted_.withColumn("starts", F.when(n_sorted > 0, F.sort_array(F.transform(
        F.filter(neighbours, lambda x: x["own"]["h"].eqNullSafe(x["before"]["h"]) | x["own"]["h"].eqNullSafe(x["after"]["h"])),
        lambda x: x["own"]["i"],
    ))))
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")),
        lambda acc, s: F.struct(
            (acc["sum"] + F.least(F.lit(WINDOW), s - acc["last"])).alias("sum"), s.alias("last")),
        lambda acc: acc["sum"],
    )
    done = starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0))).withColumn("n_varied", F.size(F.array_distinct(
        F.transform("word_hashes", lambda h, i: F.xxhash64(h, F.floor(i / STRETCH))))))
    return done.select(*keep, *[F.col(m).cast("long").alias(m) for m in MEASURES])


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """One character per rule: b, g or - for abstaining."""
    return F.concat(*[
        F.when(F.expr(r.bad), "b").when(F.expr(r.good), "g").otherwise("-") for r in rules
    ])


@dataclass(frozen=True)
class VoteModel:
    """``start``: the log odds of good before any vote; ``weights[rule][vote]``: what a vote adds."""

    start: float
    weights: tuple[dict[str, float], ...]

    def odds(self, pattern: str) -> float:
        return self.start + sum(w[v] for w, v in zip(self.weights, pattern, strict=True))

    def posterior(self, pattern: Column) -> Column:
        odds = F.lit(self.start)
        for k, weight in enumerate(self.weights):
            vote = F.substring(pattern, k + 1, 1)
            odds = odds + F.when(vote == "b", weight["b"]).when(vote == "g", weight["g"]).otherwise(weight["-"])
        return 1 / (1 + F.exp(-odds))


def _logistic(odds: float) -> float:
    return 1 / (1 + math.exp(-odds)) if odds > 0 else math.exp(odds) / (1 + math.exp(odds))


def estimate(patterns: list[tuple[str, int]], n_rules: int, rounds: int = ROUNDS) -> VoteModel:
    """Expectation-maximisation over vote patterns and their counts.

    Starts from the share of good votes, where a bad one counts three times and
    one of each is added; other starts end at the same rates. Each round takes the
    expected numbers of good and bad texts behind each vote, adds the belief, and
    takes the rates anew.
    """
    good = {p: (p.count("g") + 1) / (p.count("g") + 3 * p.count("b") + 2) for p, _ in patterns}

    def rates(k: int, kind: str) -> dict[str, float]:
        cast = {v: BELIEF[kind, v] for v in "gb-"}
        for p, n in patterns:
            cast[p[k]] += n * (good[p] if kind == "good" else 1 - good[p])
        return {v: c / sum(cast.values()) for v, c in cast.items()}

    model = VoteModel(0.0, ())
    for _ in range(rounds):
        n_good = SHARE_BELIEF + sum(n * good[p] for p, n in patterns)
        n_bad = SHARE_BELIEF + sum(n * (1 - good[p]) for p, n in patterns)
        sides = [(rates(k, "good"), rates(k, "bad")) for k in range(n_rules)]
        model = VoteModel(math.log(n_good / n_bad), tuple({v: math.log(g[v] / b[v]) for v in "gb-"} for g, b in sides))
        good = {p: _logistic(model.odds(p)) for p, _ in patterns}
    return model


def fit(measured: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = ROUNDS) -> VoteModel:
    """Estimate the rules' rates from the vote patterns of all ``measured`` texts."""
    found = measured.groupBy(votes(rules).alias("pattern")).count().orderBy("pattern").collect()
    return estimate([(r["pattern"], r["count"]) for r in found], len(rules), rounds)


def judge(measured: DataFrame, model: VoteModel, rules: tuple[Rule, ...] = RULES, least: float = 0.5) -> DataFrame:
    """Adds ``votes``, ``posterior``, ``base_failed`` and ``kept``.

    Hand in a written table of measures where the result is to be filtered.
    """
    return (
        measured.withColumn("votes", votes(rules))
        .withColumn("posterior", model.posterior(F.col("votes")))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))
    )
