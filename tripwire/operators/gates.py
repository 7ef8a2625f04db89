"""Gates between the alert log and the outbox."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.functions.frames import join_unique, written
from tripwire.operators.kits import confirmed_multiplier_orders
from tripwire.operators.suppress import ACCEPTED
from tripwire.plans.templates import HANDLED

Tables = Mapping[str, DataFrame]

GATED, UNHANDLED = "gated", "unhandled"

# The word in a purchase reference that asks for a message, and
# the part number that stands for parts bought once.
REQUEST_WORD = "ALERT"
ONE_TIME_PART = "SPECIAL"

MULTIPLIER = "COMPONENT MULTIPLIER"


def reception_wanted() -> Column:
    return F.coalesce(F.col("po_reference").contains(REQUEST_WORD), F.lit(False))


def supplier_expected() -> Column:
    return F.coalesce(F.rtrim("part_no") != ONE_TIME_PART, F.lit(True))


def gate_by_columns(enriched: DataFrame) -> DataFrame:
    """Adds ``disposition`` from the alert's own columns."""
    alert = F.col("alert")
    return enriched.withColumn(
        "disposition",
        F.when(~alert.isin(HANDLED), UNHANDLED)
        .when((alert == "RECEPTION") & ~reception_wanted(), GATED)
        .when((alert == "MISSING SUPPLIER") & ~supplier_expected(), GATED)
        .otherwise(ACCEPTED),
    )


def gate_multipliers(enriched: DataFrame, tables: Tables) -> DataFrame:
    """Adds ``disposition`` to component-multiplier alerts: only confirmed orders pass."""
    confirmed = confirmed_multiplier_orders(tables, enriched.select("ord_no")).withColumn(
        "is_confirmed", F.lit(True)
    )
    return (
        join_unique(enriched, confirmed, "ord_no", "left")
        .withColumn("disposition", F.when(F.col("is_confirmed"), ACCEPTED).otherwise(GATED))
        .select(*enriched.columns, "disposition")
    )


def confirm_multipliers(gated: DataFrame, tables: Tables, names: set[str] | None = None) -> DataFrame:
    """Judge component-multiplier alerts again, by their order's lines; written, as several readers follow."""
    if names is not None and MULTIPLIER not in names:
        return gated
    is_multiplier = F.coalesce(F.col("alert") == MULTIPLIER, F.lit(False))
    judged = written(gate_multipliers(gated.filter(is_multiplier).drop("disposition"), tables))
    return gated.filter(~is_multiplier).unionByName(judged)


def gate(enriched: DataFrame, tables: Tables, names: set[str] | None = None) -> DataFrame:
    """Adds ``disposition``: accepted, gated or unhandled.

    ``names`` holds the alerts that can occur, where the caller knows.
    """
    return confirm_multipliers(gate_by_columns(enriched), tables, names)
