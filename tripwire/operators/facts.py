"""Facts the rules test, one row per key.

Each fact is an aggregate that Spark combines before its shuffle, so an order,
part or client that holds a large share of the rows still reaches the shuffle
as one row per task. Rules then join to a side that is unique on the join key.

``keys`` holds the keys that the changes ask about, without repeats. Few keys are
broadcast and drop all other rows at the scan (``only``), so a small batch of
changes aggregates its own orders and not the whole table. Many keys cut the
finished facts (``cut``): those lie by key as the keys do, so that each table is
shuffled once, after its rows were combined, and not a second time to drop rows.
Without ``keys`` a fact is computed for every key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.functions.columns import (
    ORDER_TYPE_BLANKET,
    ORDER_TYPE_ORDER,
    any_true,
    has_part,
    is_live,
)
from tripwire.functions.frames import cut, join_unique, only
from tripwire.operators.kits import kit_sizes

Tables = Mapping[str, DataFrame]

# Part groups whose lines may be due in less than the lead time.
SHORT_LEAD_GROUPS = (
    "002 003 004 005 006 007 008 009 010 011 012 013 014 015 016 017 018 019 020 021 "
    "050 085 086 087 088 090 093 094 095 096 097 099 100 107 120 "
    "200 203 224 226 228 230 232 237 240 244 385 387 393 395 396 398 990"
).split()
# Part groups whose stock may go below zero.
NEGATIVE_STOCK_GROUPS = "002 004 085 094 097 100 120 226 230".split()
# Fixed value: the accessory that certain finished parts need.
REQUIRED_ACCESSORY = "AE750"
LEAD_DAYS = 14


Keys = DataFrame | None


def line_tests() -> dict[str, Column]:
    """What is asked of a single line."""
    qty, reserved = F.col("orl_quantity"), F.col("orl_reserved_qty")
    shipped, ready = F.col("orl_ship_qty"), F.col("orl_qty_ready")
    named = has_part(F.col("prt_no"))
    return {
        "unready": qty - ready != 0,
        "zero": (qty == 0) & named,
        "named": named,
        "named_zero": named & (qty == 0),
        "unreserved": (qty != reserved) & (
            (qty != shipped) | (qty != ready + shipped + reserved) | (qty != shipped + reserved)
        ),
        "accessory": F.col("prt_no") == REQUIRED_ACCESSORY,
    }


def line_facts(tables: Tables, keys: Keys = None) -> DataFrame:
    """Per order, what its lines say: one pass over the lines, one shuffle."""
    tests = line_tests()
    found = only(tables["order_line"], keys, "ord_no").groupBy("ord_no").agg(
        any_true(tests["unready"]).alias("has_unready_line"),
        any_true(tests["zero"]).alias("has_zero_line"),
        F.count_if(tests["named"]).alias("named_lines"),
        F.count_if(tests["named_zero"]).alias("named_zero_lines"),
        any_true(tests["unreserved"]).alias("has_unreserved_line"),
        F.min("orl_req_dt").alias("first_req_dt"),
        F.max("orl_req_dt").alias("last_req_dt"),
        any_true(tests["accessory"]).alias("has_accessory"),
    )
    return cut(found, keys, "ord_no").withColumn("dates_differ", F.col("first_req_dt") != F.col("last_req_dt"))


def part_flags(tables: Tables) -> DataFrame:
    """The part numbers that need the accessory (``asv``) or a truck."""
    sort = F.col("prt_sort")
    return (
        tables["part"]
        .select(
            "prt_no",
            (sort.ilike("ASV%") & (sort != "ASV Tabl") & (F.col("prt_type") == "F")).alias("asv"),
            F.col("prt_usr_flag1").alias("truck"),
        )
        .filter(F.col("asv") | F.col("truck"))
        .groupBy("prt_no")
        .agg(any_true(F.col("asv")).alias("asv"), any_true(F.col("truck")).alias("truck"))
    )


def part_facts(tables: Tables, keys: Keys = None) -> DataFrame:
    """Per order, whether its part numbers need the accessory or a truck.

    Only the part numbers that carry a flag enter the join, and only two line
    columns are read.
    """
    lines = only(tables["order_line"].select("ord_no", "prt_no"), keys, "ord_no")
    return cut(join_unique(lines, part_flags(tables), "prt_no").groupBy("ord_no").agg(
        any_true(F.col("asv")).alias("needs_accessory"),
        any_true(F.col("truck")).alias("needs_truck"),
    ), keys, "ord_no")


def order_facts(tables: Tables) -> DataFrame:
    """Line facts and part facts side by side, one row per order with lines."""
    return line_facts(tables).join(part_facts(tables), "ord_no", "left")


def short_lead_orders(
    tables: Tables, keys: Keys = None, exempt: list[str] | None = None, lead_days: int = LEAD_DAYS
) -> DataFrame:
    """Live orders with a line due before the lead time is over.

    Only the earliest due line of an order matters, so lines shrink to one row
    per order before they meet the header. Lines and headers match on ``ord_id``.
    """
    exempt = SHORT_LEAD_GROUPS if exempt is None else exempt
    bound_parts = tables["part"].select("prt_id", "pgr_id").join(
        tables["part_group"].filter(~F.col("pgr_no").isin(exempt)).select("pgr_id"), "pgr_id", "left_semi"
    )
    header = only(
        tables["order_header"].filter(is_live(F.col("ord_status"))).select("ord_id", "ord_no", "ord_date"),
        keys, "ord_no",
    )
    touched = None if keys is None else header.select("ord_id").distinct()
    lines = tables["order_line"].filter(F.col("orl_req_dt").isNotNull()).select("ord_id", "prt_id", "orl_req_dt")
    earliest = (
        only(lines, touched, "ord_id")
        .join(bound_parts.select("prt_id"), "prt_id", "left_semi")
        .groupBy("ord_id").agg(F.min("orl_req_dt").alias("earliest"))
    )
    found = (
        header.join(earliest, "ord_id")
        .filter(F.col("earliest") < F.date_add("ord_date", lead_days))
        .select("ord_no").distinct()
    )
    return cut(found, keys, "ord_no").withColumn("has_short_lead", F.lit(True))


def blanket_part_orders(tables: Tables, keys: Keys = None, blanket_live_only: bool = True) -> DataFrame:
    """Plain orders, and their client, with a part that another, blanket order of the client holds.

    "Another order" needs no pairing of orders: per client and part the lowest
    and highest blanket number tell whether one differs from the order's own.
    Besides the orders asked about, only blankets of their clients are read.
    """
    header = tables["order_header"].select("ord_no", "cli_id", "ord_type", "ord_status")
    orders = only(header, keys, "ord_no").filter(F.col("ord_type") == ORDER_TYPE_ORDER).select("ord_no", "cli_id")
    blankets = header.filter(F.col("ord_type") == ORDER_TYPE_BLANKET)
    if blanket_live_only:
        blankets = blankets.filter(is_live(F.col("ord_status")))
    if keys is not None:
        blankets = only(blankets, orders.select("cli_id").distinct(), "cli_id")
    # Both kinds of order meet their lines in one join; no order is both.
    headers = orders.withColumn("is_blanket", F.lit(False)).unionByName(
        blankets.select("ord_no", "cli_id", F.lit(True).alias("is_blanket")))
    lines = tables["order_line"].filter(has_part(F.col("prt_no"))).select("ord_no", "prt_no")
    if keys is not None:
        lines = only(lines, headers.select("ord_no").distinct(), "ord_no")
    held_by = join_unique(lines, headers, "ord_no")
    held = held_by.filter("is_blanket").groupBy("cli_id", "prt_no").agg(F.min("ord_no").alias("low"), F.max("ord_no").alias("high"))
    found = (
        join_unique(held_by.filter("not is_blanket"), held, ["cli_id", "prt_no"])
        .filter(other_than(F.col("ord_no")))
        .groupBy("ord_no").agg(F.min("cli_id").alias("blanket_cli_id"))
    )
    return cut(found, keys, "ord_no")


def client_po_numbers(tables: Tables, keys: Keys = None) -> DataFrame:
    """Per invoiced client and client order number, the lowest and highest order."""
    on = ["inv_cli_id", "ord_cli_ord_no"]
    numbered = only(tables["order_header"].filter(F.col("ord_cli_ord_no") != ""), keys, *on)
    return cut(numbered.groupBy(*on).agg(F.min("ord_no").alias("low"), F.max("ord_no").alias("high")), keys, *on)


def other_than(own: Column) -> Column:
    """Whether a low/high pair of order numbers holds an order besides ``own``."""
    return (F.col("low") != own) | (F.col("high") != own)


def missing_component_orders(tables: Tables, keys: Keys = None) -> DataFrame:
    """Orders with a top-level kit line that lacks one of the kit's components.

    The lines under a kit line are counted against the size of the kit; kit
    contents are never multiplied out. A line without a part under the kit line
    leaves the answer unknown there, which raises nothing; a kit line with no
    lines under it lacks everything. Under one kit line a part counts once, so
    no kit line brings more rows to a join than there are parts. The lines under
    a kit line are found by its id, whatever order they are on.
    """
    lines = tables["order_line"]
    kit_parts = tables["part_kit"].select(
        F.col("pkt_master_prt_id").alias("master"), F.col("prt_id").alias("under_prt_id")
    ).distinct().withColumn("in_kit", F.lit(True))
    top_level = only(lines.filter(F.col("orl_kitmaster_id") == 0), keys, "ord_no").select(
        "ord_no", F.col("orl_id").alias("parent_id"), F.col("prt_id").alias("master")
    )
    parents = join_unique(top_level, kit_sizes(tables), "master")
    asked = None if keys is None else parents.select("parent_id").distinct()
    below = lines.filter(F.col("orl_kitmaster_id") != 0).select(
        F.col("orl_kitmaster_id").alias("parent_id"), F.col("prt_id").alias("under_prt_id")
    )
    under = only(below, asked, "parent_id").distinct().withColumn("is_line", F.lit(True))
    lacking = (
        join_unique(parents.join(under, "parent_id", "left"), kit_parts, ["master", "under_prt_id"], "left")
        .groupBy("parent_id", "ord_no", "components")
        .agg(
            F.count("is_line").alias("lines_under"),
            F.count("in_kit").alias("present"),
            any_true(F.col("is_line") & F.col("under_prt_id").isNull()).alias("has_unknown"),
        )
        .filter(
            (F.col("lines_under") == 0)
            | (~F.col("has_unknown") & (F.col("present") < F.col("components")))
        )
        .select("ord_no").distinct()
    )
    return cut(lacking, keys, "ord_no").withColumn("lacks_component", F.lit(True))


def off_ratio_orders(tables: Tables, keys: Keys = None) -> DataFrame:
    """Orders with a component whose quantity is off against a kit on the order.

    The kit may be the part of *any* line of the order. Of all kits on an order
    only the lowest and highest ratio of a component matter: if both give the
    line's quantity, every one between does. So the contents of the kits on an
    order shrink to one row per component, combined before the shuffle.
    """
    lines = only(
        tables["order_line"].select("ord_no", "orl_id", "prt_id", "orl_quantity", "orl_kitmaster_id"),
        keys, "ord_no",
    )
    contents = (
        tables["part_kit"].groupBy(F.col("pkt_master_prt_id").alias("master"), "prt_id")
        .agg(F.min("pkt_qty").alias("low"), F.max("pkt_qty").alias("high"))
    )
    kits_on_order = lines.select("ord_no", F.col("prt_id").alias("master")).distinct()
    ratios = (
        kits_on_order.join(contents, "master")
        .groupBy("ord_no", "prt_id").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    parents = lines.select(
        "ord_no", F.col("orl_id").alias("orl_kitmaster_id"), F.col("orl_quantity").alias("parent_qty")
    )
    components = lines.filter(F.col("orl_kitmaster_id") != 0).join(parents, ["ord_no", "orl_kitmaster_id"])
    qty, parent_qty = F.col("orl_quantity"), F.col("parent_qty")
    found = (
        join_unique(components.select("ord_no", "prt_id", "orl_quantity", "parent_qty"), ratios, ["ord_no", "prt_id"])
        .filter((F.col("low") * parent_qty != qty) | (F.col("high") * parent_qty != qty))
        .select("ord_no").distinct()
    )
    return cut(found, keys, "ord_no").withColumn("has_off_ratio", F.lit(True))


def unrun_lots(tables: Tables, keys: Keys = None) -> DataFrame:
    """Order lines with a planning lot that is not adjusted yet."""
    unrun = only(tables["planning_lot_quantity"], keys, "orl_id").filter(~F.col("plq_adj_flag")).select("orl_id").distinct()
    return cut(unrun, keys, "orl_id").withColumn("has_unrun_lot", F.lit(True))


def manufactured_stock(tables: Tables, keys: Keys = None) -> DataFrame:
    """Per manufactured part, its stock and what open lots have reserved.

    A part without an open row has no sum, hence no row here.
    """
    reserved = (
        only(tables["planning_lot_detailed"].filter(~F.col("pld_adj_flag")), keys, "prt_id")
        .groupBy("prt_id").agg(F.sum("pld_qty_res").alias("open_reserved"))
    )
    masters = tables["bill_of_materials_mat"].select(F.col("prt_master_id").alias("prt_id"))
    stock = only(tables["part_quantity"], keys, "prt_id").groupBy("prt_id").agg(F.min("pqt_real_qty").alias("stock"))
    return cut(stock.join(masters, "prt_id", "left_semi").join(reserved, "prt_id"), keys, "prt_id")


def lot_flags(tables: Tables, keys: Keys = None) -> DataFrame:
    return cut(only(tables["planning_lot_quantity"], keys, "plq_id").groupBy("plq_id").agg(
        F.min("plq_adj_flag").alias("lot_adjusted")
    ), keys, "plq_id")


def lots_with_components(tables: Tables, keys: Keys = None) -> DataFrame:
    lots = only(tables["planning_lot_detailed"], keys, "plq_lot_no").filter(F.col("pld_lvl") > 0).select("plq_lot_no").distinct()
    return cut(lots, keys, "plq_lot_no").withColumn("lot_has_components", F.lit(True))


def purchase_suppliers(tables: Tables, keys: Keys = None) -> DataFrame:
    return cut(only(tables["purchase_order_header"], keys, "puh_id").groupBy("puh_id").agg(
        F.min("sup_id").alias("sup_id")), keys, "puh_id")


def known_suppliers(tables: Tables, keys: Keys = None) -> DataFrame:
    """The suppliers set up for each part number."""
    asked = None if keys is None else keys.select("prt_no").distinct()
    parts = only(tables["part"].select("prt_id", "prt_no"), asked, "prt_no")
    suppliers = tables["part_supplier"].select("prt_id", "sup_id")
    if keys is not None:
        suppliers = only(suppliers, parts.select("prt_id").distinct(), "prt_id")
    known = suppliers.join(parts, "prt_id").select("prt_no", "sup_id").distinct()
    return cut(known, keys, "prt_no", "sup_id").withColumn("supplier_known", F.lit(True))
