"""What a rule is, and the facts rules can ask for."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.functions.frames import join_unique, merge_by_key, written

Tables = Mapping[str, DataFrame]

INSERT, UPDATE = "INSERT", "UPDATE"


def new(name: str) -> Column:
    return F.col(f"new.{name}")


def old(name: str) -> Column:
    return F.col(f"old.{name}")


def becomes(name: str, value: object) -> Column:
    """The column was something else before and is ``value`` now."""
    return (old(name) != value) & (new(name) == value)


def commit_date() -> Column:
    """The day of the change, which is "today" for the rules."""
    return F.to_date("commit_ts")


@dataclass(frozen=True)
class Rule:
    """Raise ``alert`` for a changed row that meets ``row`` and then ``test``.

    ``row`` reads only the two row images, so it filters changes before any
    join. ``test`` reads the fact tables named in ``facts``. A condition that
    comes out null raises nothing.
    """

    number: int
    alert: str
    ref: str
    row: Callable[[], Column]
    test: Callable[[], Column] | None = None
    facts: tuple[str, ...] = ()
    ops: tuple[str, ...] = (UPDATE,)

    def concerns(self) -> Column:
        return F.col("op").isin(list(self.ops)) & self.row()

    def fires(self) -> Column:
        return self.concerns() & self.test() if self.test else self.concerns()


@dataclass(frozen=True)
class Fact:
    """A table with one row per key, joined to the changes on ``on``.

    ``on`` maps the fact's key columns to columns of the change row. The key
    columns do not survive the join; all others do. ``build`` gets the tables
    and the keys asked about, one row each.
    """

    build: Callable[[Tables, DataFrame | None], DataFrame]
    on: dict[str, str]

    def attach(self, changes: DataFrame, tables: Tables) -> DataFrame:
        return join_fact(changes, self.build(tables, asked_keys(changes, self.on)), self.on)


def asked_keys(changes: DataFrame, on: dict[str, str]) -> DataFrame:
    """The keys that the changes ask about, combined before the shuffle."""
    return changes.select(*[F.col(source).alias(key) for key, source in on.items()]).distinct()


def join_fact(changes: DataFrame, fact: DataFrame, on: dict[str, str]) -> DataFrame:
    """Left join; many changes may share a key, the fact has one row for it."""
    names = {key: f"fact_{key}" for key in on}
    keyed = changes.withColumns({names[key]: F.col(source) for key, source in on.items()})
    renamed = fact.withColumnsRenamed(names)
    return join_unique(keyed, renamed, list(names.values()), "left").drop(*names.values())


# The most facts that are computed in one plan. Each brings up to ten stages, and the driver
# plans, compiles and starts all stages of a plan together.
FACTS_AT_ONCE = 2


def attach_facts(changes: DataFrame, facts: list[Fact], tables: Tables) -> DataFrame:
    """Join facts to the changes, those with the same key in one join.

    Changes are the wide side. Facts of a key are merged first, so the changes
    move once per kind of key and not once per fact. Where there are many facts
    each is written by itself, so that no plan grows with their number.
    """
    many = len(facts) > FACTS_AT_ONCE
    for fact in facts:
        alike = [f for f in facts if type(f) is Fact and f.on == fact.on]
        if type(fact) is not Fact:
            changes = fact.attach(changes, tables)
        elif alike[0] is fact:
            keys = asked_keys(changes, fact.on)
            keys = written(keys) if many else keys
            found = [f.build(tables, keys) for f in alike]
            merged = merge_by_key([written(f) for f in found] if many else found, keys)
            changes = join_fact(changes, merged, fact.on)
    return changes
