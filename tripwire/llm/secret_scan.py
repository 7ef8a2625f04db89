"""Secret scan over a trigram inverted index.

From each rule's pattern a Boolean trigram query is derived: every text that
matches holds all trigrams of at least one alternative. The index lists, for
each trigram that some rule asks for, the documents that hold it (in lower
case). Intersecting the postings of an alternative gives its candidates, and
only those are searched with the pattern itself. A pattern without a mandatory
trigram is searched in every text.

Postings move as (id, alternative, bits) and are combined before the shuffle,
so a document costs a few small rows and no trigram's list is ever in one task.

Defined results: a null text counts as empty and has no spans; ids need not be
unique or non-null: candidates are found per id and every row is then searched
in its own text; an empty table gives no rows; spans of different kinds may
overlap and are all reported; other columns are not looked at.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.llm.common import text_of

# Alternatives kept apart at most; beyond, a run of literals is broken off, which only weakens the query.
MOST_ALTERNATIVES = 32


@dataclass(frozen=True)
class SecretRule:
    """A match counts if group ``group`` has ``least`` characters; ``fold`` ignores the case of a-z."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    fold: bool = False
    base: bool = False

    @property
    def regex(self) -> str:
        return "(?i)" * self.fold + self.pattern


# Patterns of the three base kinds and of those this scan adds.
# Runs of 20 and 24 are written as such: a maximal run matches either way.
# A private key reaches to its END line if no other marker comes first; with END cut off, over header
# lines and what can only be base64: long runs, ends of lines or of the text, runs that are no plain word.
_GAP = r"""(?:[\x20\x09-\x0D"',;>#*+]|\\[nrt])*+"""
_BASE64 = (r"""(?:[A-Za-z0-9+/=]{16,}+|(?=[A-Za-z]*+[0-9+/=]|[A-Za-z]*[a-z][A-Z])[A-Za-z0-9+/=]++"""
           r"""|[A-Za-z]++(?=[\x20\x09"',;+]*+(?:[\r\n]|\\[nr]|(?![\s\S]))))""")
_KEY = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-{1,4}+[^-]++)*+-----END [A-Z ]*PRIVATE KEY-----"
        rf"|(?:{_GAP}(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:{_GAP}{_BASE64})*+)")
RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               least=6, group=2, fold=True, base=True),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    SecretRule("hex", r"[0-9a-f]{24,}", base=True),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    SecretRule("private_key", _KEY),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)


def _joined(left: list[tuple[str, ...]], right: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """Alternatives for one part of a pattern followed by another; the runs at the seam grow together."""
    if len(left) * len(right) > MOST_ALTERNATIVES:
        return [(*a, "") for a in left]
    return list(dict.fromkeys((*a[:-1], a[-1] + b[0], *b[1:]) for a, b in product(left, right)))


def _runs(parsed) -> list[tuple[str, ...]]:
    """For each alternative its runs of literal characters; what can be anything lies between two runs."""
    anything, found = [("", "")], [("",)]
    for kind, value in parsed:
        if kind is sre.LITERAL:
            part = [(chr(value),)]
        elif kind is sre.IN and len(value) <= 8 and all(k is sre.LITERAL for k, _ in value):
            part = [(chr(v),) for _, v in value]
        elif kind is sre.BRANCH:
            part = [a for branch in value[1] for a in _runs(branch)]
        elif kind is sre.SUBPATTERN:
            part = _runs(value[3])
        elif kind is sre.MAX_REPEAT and value[:2] == (0, 1):
            part = [("",), *_runs(value[2])]
        elif kind is sre.MAX_REPEAT and value[0] >= 1:
            part = _joined(_runs(value[2]), anything)
        else:
            part = anything
        found = _joined(found, part)
    return found


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Trigram sets of which a matching text holds at least one, in lower case; empty if none is mandatory."""
    sets = {
        frozenset(run[i:i + 3].lower() for run in runs for i in range(len(run) - 2))
        for runs in _runs(sre_parser.parse(pattern))
    }
    least = [s for s in sets if not any(other < s for other in sets)]
    return [] if frozenset() in sets else sorted(least, key=sorted)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram, doc_id``: the inverted index of ``docs`` for these trigrams."""
    lower = docs.select("doc_id", F.lower(text_of()).alias("lower"))
    present = F.array_compact(F.array(*[F.when(F.contains("lower", F.lit(t)), t) for t in trigrams]))
    return lower.select("doc_id", F.explode(present).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """``doc_id, found``: bit k is set if rule k's trigram query holds for the document."""
    alternatives = [(k, q) for k, r in enumerate(rules) for q in trigram_query(r.pattern)]
    trigrams = sorted({t for _, q in alternatives for t in q})
    if not trigrams:
        return docs.select("doc_id", F.lit(0).cast("long").alias("found")).limit(0)
    terms = docs.sparkSession.createDataFrame(
        [(t, 1 << k, a, 1 << i, (1 << len(q)) - 1)
         for a, (k, q) in enumerate(alternatives) for i, t in enumerate(sorted(q))],
        "trigram string, rule long, alternative int, bit long, every long")
    return (
        postings(docs, trigrams).join(F.broadcast(terms), "trigram")
        .groupBy("doc_id", "rule", "alternative").agg(F.bit_or("bit").alias("bits"), F.max("every").alias("every"))
        .filter("bits = every")
        .groupBy("doc_id").agg(F.bit_or("rule").alias("found"))
    )


def spans(text: Column, rule: SecretRule, at: int) -> Column:
    """Structs (start, order, end, kind) in code points, leftmost and non-overlapping.

    The text between the matches tells how far along each of them is.
    """
    regex = F.lit(rule.regex)
    matches = F.regexp_extract_all(text, regex, F.lit(0))
    values = F.regexp_extract_all(text, regex, F.lit(rule.group)) if rule.group else matches
    between = F.split(text, rule.regex, -1)
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,value:int>>")
    zipped = F.arrays_zip(between.alias("between"), matches.alias("match"), values.alias("value"))
    walked = F.aggregate(
        F.filter(zipped, lambda x: x["match"].isNotNull()),
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.char_length(x["between"]) + F.char_length(x["match"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + F.char_length(x["between"])).alias("start"), F.lit(at).alias("order"),
                (acc["at"] + F.char_length(x["between"]) + F.char_length(x["match"])).alias("end"),
                F.lit(rule.kind).alias("kind"), F.char_length(x["value"]).alias("value")))).alias("out")),
        lambda acc: acc["out"])
    return F.when(text.rlike(rule.regex), F.filter(walked, lambda x: x["value"] >= rule.least)).otherwise(none)


def find_secrets(docs: DataFrame, keep: list[str], rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Rows of ``docs`` with the columns ``keep``, ``text`` (never null) and ``spans``, sorted by place."""
    indexed = sum(1 << k for k, r in enumerate(rules) if trigram_query(r.pattern))
    everywhere = (1 << len(rules)) - 1 - indexed
    found = candidates(docs, rules).withColumnRenamed("doc_id", "candidate")
    extra = [c for c in keep if c != "doc_id"]
    checked = docs.join(found, docs["doc_id"].eqNullSafe(found["candidate"]), "left").select(
        "doc_id", *extra, text_of().alias("text"),
        F.coalesce("found", F.lit(0)).bitwiseOR(F.lit(everywhere)).alias("found"))
    each = checked.withColumns({
        f"spans_{k}": F.when(F.col("found").bitwiseAND(F.lit(1 << k)) != 0, spans(F.col("text"), r, k))
        for k, r in enumerate(rules)})
    every = F.array_compact(F.concat(*[F.coalesce(f"spans_{k}", F.array()) for k in range(len(rules))]))
    return each.select("doc_id", *extra, "text", F.sort_array(every).alias("spans"))


def written_out(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """The text with every stretch that spans cover replaced by ``mark``."""
    done = F.aggregate(
        found, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, x: F.when(x["end"] <= acc["at"], acc).otherwise(F.struct(
            F.when(x["start"] < acc["at"], acc["out"]).otherwise(F.concat(
                acc["out"], F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))).alias("out"),
            x["end"].alias("at"))),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, done).otherwise(text)
