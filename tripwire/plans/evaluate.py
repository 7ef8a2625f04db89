"""Evaluate the rules of a changed table in one pass over its changes."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.functions.frames import written
from tripwire.operators.counted import as_of_facts
from tripwire.operators.payload import encode_payload
from tripwire.plans.rules import CATALOGUE
from tripwire.plans.rules.base import Fact, Rule, attach_facts

Tables = Mapping[str, DataFrame]


def evaluate(
    changes: DataFrame, table: str, tables: Tables,
    alerts: list[str] | None = None, facts: dict[str, Fact] | None = None,
    history: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The alerts raised by ``changes`` of ``table``.

    Returns rule_no, alert, ref_type, reference, app_name, commit_ts,
    change_seq. One change can raise several alerts; ``rule_no`` gives their
    order. Only the facts that the chosen rules read are joined. ``alerts``
    limits the rules; ``facts`` replaces facts of the catalogue by name.

    ``history`` has change feeds of tables that facts read, for the time of the
    batch. The facts that counts can give (``counted.BY_FACT``) are then as they
    were at each change; the others are as ``tables`` has them, after the batch.
    """
    all_rules, known_facts = CATALOGUE[table]
    known_facts = {**known_facts, **as_of_facts(known_facts, table, history or {})}
    rules = [r for r in all_rules if alerts is None or r.alert in alerts]
    known_facts = {**known_facts, **(facts or {})}

    # Changes no rule is about never enter a join.
    rows = changes.filter(reduce(lambda a, b: a | b, [r.concerns() for r in rules]))
    needed = list(dict.fromkeys(name for r in rules for name in r.facts))
    rows = attach_facts(rows, [known_facts[name] for name in needed], tables)
    raised = F.filter(F.array(*[_raise(r) for r in rules]), lambda a: a.isNotNull())
    found = rows.select(F.inline(raised), "app_name", "commit_ts", "change_seq", *_txn(changes))
    return _once_per_transaction(found)


def _raise(rule: Rule):
    return F.when(rule.fires(), F.struct(
        F.lit(rule.number).alias("rule_no"),
        F.lit(rule.alert).alias("alert"),
        F.lit(rule.ref).alias("ref_type"),
        F.col(f"new.{rule.ref}").cast("string").alias("reference"),
    ))


def _txn(changes: DataFrame) -> list[str]:
    return ["txn_id"] if "txn_id" in changes.columns else []


def _once_per_transaction(alerts: DataFrame) -> DataFrame:
    """Equal alerts of one transaction count once, where the feed names transactions.

    The first of them stands; a change without a transaction is one of its own.
    """
    if "txn_id" not in alerts.columns:
        return alerts
    same = ["txn_id", "alert", "ref_type", "reference", "app_name"]
    rest = [c for c in alerts.columns if c not in same]
    first = alerts.filter(F.col("txn_id").isNotNull()).groupBy(*same).agg(
        F.min(F.struct("change_seq", *[c for c in rest if c != "change_seq"])).alias("first")
    ).select(*same, "first.*")
    alone = alerts.filter(F.col("txn_id").isNull())
    return first.unionByName(alone).select(*[c for c in alerts.columns if c != "txn_id"])


def evaluate_all(
    changes: dict[str, DataFrame], tables: Tables, history: Mapping[str, DataFrame] | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda alerts: alerts,
) -> DataFrame:
    """The alerts of every changed table; ``history`` as in ``evaluate``.

    Each table's alerts are written before the next table is looked at, so the
    driver holds the plan of one at a time. ``finish`` adds to them before that.
    """
    found = [written(finish(evaluate(feed, table, tables, history=history))) for table, feed in changes.items()]
    return reduce(DataFrame.unionByName, found)


def with_payload(alerts: DataFrame) -> DataFrame:
    """Adds the one-string form of each alert."""
    return alerts.withColumn(
        "payload",
        encode_payload(F.col("ref_type"), F.col("reference"), F.col("alert"), F.col("app_name")),
    )
