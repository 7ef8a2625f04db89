"""Kits on orders, blankets of a client, and the reports built from them.

Every function takes a set of orders and answers for all of them at once.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.functions.columns import any_true
from tripwire.functions.frames import join_unique, written

Tables = Mapping[str, DataFrame]


def kit_sizes(tables: Tables) -> DataFrame:
    """Per kit master, how many different components the kit has."""
    return tables["part_kit"].filter(F.col("pkt_master_prt_id").isNotNull()).groupBy(
        F.col("pkt_master_prt_id").alias("master")
    ).agg(F.count_distinct("prt_id").alias("components"))


def _lines_of(tables: Tables, orders: DataFrame | None) -> DataFrame:
    lines = tables["order_line"]
    return lines if orders is None else join_unique(
        lines, orders.select("ord_no").distinct(), "ord_no", "left_semi"
    )


# The columns of order lines that reports read.
LINE_COLUMNS = ["ord_no", "orl_id", "orl_sort_idx", "orl_kitmaster_id", "prt_id", "prt_no", "orl_quantity"]


def with_lines_of(tables: Tables, orders: DataFrame) -> Tables:
    """The same tables with the lines cut to some orders and to what reports read of them, written once.

    The reports of an order read its lines many times and no others.
    """
    lines = {"order_line": tables["order_line"].select(*LINE_COLUMNS)}
    return ChainMap({"order_line": written(_lines_of(lines, orders))}, tables)


def kit_parents(tables: Tables, orders: DataFrame | None = None) -> DataFrame:
    """The lines whose part is a kit: ord_no, orl_sort_idx, prt_no, orl_id."""
    masters = tables["part_kit"].select(F.col("pkt_master_prt_id").alias("prt_id"))
    return (
        _lines_of(tables, orders).join(masters, "prt_id", "left_semi")
        .select("ord_no", "orl_sort_idx", "prt_no", "orl_id")
    )


def kit_child_lines(tables: Tables, orders: DataFrame | None = None) -> DataFrame:
    """The component lines present under each kit line of an order."""
    parents = kit_parents(tables, orders).select("ord_no", F.col("orl_id").alias("parent_id"))
    children = _lines_of(tables, orders).filter(F.col("orl_kitmaster_id") != 0).select(
        "ord_no", F.col("orl_kitmaster_id").alias("parent_id"), "orl_sort_idx", "prt_no"
    )
    return children.distinct().join(parents, ["ord_no", "parent_id"], "left_semi")


def kit_quantity_errors(tables: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Component lines whose quantity is off against their own kit line.

    ``fixed_qty`` is the quantity the kit asks for, as a whole number.
    """
    lines = _lines_of(tables, orders)
    kit = tables["part_kit"].select(
        F.col("pkt_master_prt_id").alias("master"), "prt_id", "pkt_qty"
    ).distinct()
    masters = kit.select("master").distinct()
    parents = join_unique(lines.select(
        "ord_no", F.col("orl_id").alias("parent_id"), F.col("prt_id").alias("master"),
        F.col("orl_quantity").alias("parent_qty"),
    ), masters, "master", "left_semi")
    children = lines.filter(F.col("orl_kitmaster_id") != 0).select(
        "ord_no", F.col("orl_kitmaster_id").alias("parent_id"), "orl_sort_idx", "prt_id", "prt_no",
        "orl_quantity",
    )
    asked = F.col("pkt_qty") * F.col("parent_qty")
    return (
        children.join(parents, ["ord_no", "parent_id"])
        .join(kit, ["master", "prt_id"])
        .filter(asked != F.col("orl_quantity"))
        .select("ord_no", "parent_id", "orl_sort_idx", "prt_no", F.round(asked).cast("long").alias("fixed_qty"))
        .distinct()
    )


def existing_blankets(tables: Tables, orders: DataFrame) -> DataFrame:
    """Per order, the blanket orders of its client that hold one of its parts.

    ``orders`` are those the question was raised for. One row per row of
    ``blanket_orders``: the result is as large as the answer.
    """
    header = join_unique(
        tables["order_header"].select("ord_no", "cli_id"), orders.select("ord_no").distinct(), "ord_no", "left_semi"
    )
    clients = tables["client"].select("cli_id", "cli_no").distinct()
    wanted = (
        _lines_of(tables, orders).select("ord_no", "prt_no").distinct()
        .join(header, "ord_no")
        .join(clients, "cli_id")
        .select("ord_no", "prt_no", "cli_no").distinct()
    )
    blankets = tables["blanket_orders"].select("prt_no", "cli_no", F.col("ord_no").alias("blanket_ord_no"))
    return wanted.join(blankets, ["cli_no", "prt_no"]).select("ord_no", "prt_no", "blanket_ord_no")


def _report_rows(parents: DataFrame, lines: DataFrame, line_cols: list[str]) -> DataFrame:
    """Each kit line once without a report line, and once with each it has.

    The lines are the side that Spark may split: one kit line can have many.
    """
    head = parents.select(
        "ord_no", F.col("orl_sort_idx").alias("parent_idx"), F.col("prt_no").alias("parent_prt_no"),
        F.col("orl_id").alias("parent_id"),
    )
    body = lines.select("ord_no", "parent_id", F.struct("orl_sort_idx", *line_cols).alias("line"))
    told = join_unique(body, head, ["ord_no", "parent_id"])
    return told.unionByName(head, allowMissingColumns=True)


def missing_component_rows(tables: Tables, orders: DataFrame | None = None) -> DataFrame:
    return _report_rows(kit_parents(tables, orders), kit_child_lines(tables, orders), ["prt_no"])


def multiplier_rows(tables: Tables, orders: DataFrame | None = None) -> DataFrame:
    return _report_rows(
        kit_parents(tables, orders), kit_quantity_errors(tables, orders), ["prt_no", "fixed_qty"]
    )


def kit_report(rows: DataFrame) -> DataFrame:
    """Nest report rows: ord_no, kits array<struct<.., lines array>>.

    An order's report is one value, as a message needs it. ``outbox.list_lines``
    has the same lines as rows, for orders of any size.
    """
    kits = rows.groupBy("ord_no", "parent_idx", "parent_prt_no", "parent_id").agg(
        F.array_sort(F.collect_list("line")).alias("lines")
    )
    kit = F.struct(
        F.col("parent_idx").alias("orl_sort_idx"), F.col("parent_id").alias("orl_id"),
        F.col("parent_prt_no").alias("prt_no"), "lines",
    )
    return kits.groupBy("ord_no").agg(F.array_sort(F.collect_list(kit)).alias("kits"))


def missing_component_report(tables: Tables, orders: DataFrame | None = None) -> DataFrame:
    return kit_report(missing_component_rows(tables, orders))


def multiplier_report(tables: Tables, orders: DataFrame | None = None) -> DataFrame:
    return kit_report(multiplier_rows(tables, orders))


def confirmed_multiplier_orders(tables: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Orders whose first kit line, in line order, has a quantity to fix."""
    first = F.min_by("has_line", F.struct("parent_idx", "parent_id"))
    per_parent = (
        multiplier_rows(tables, orders)
        .groupBy("ord_no", "parent_idx", "parent_id")
        .agg(any_true(F.col("line").isNotNull()).alias("has_line"))
    )
    return (
        per_parent.groupBy("ord_no").agg(first.alias("confirmed")).filter("confirmed").select("ord_no")
    )
