"""Rules on order headers. Their line conditions are tested when the header changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripwire.functions.columns import (
    ORDER_TYPE_BLANKET,
    ORDER_TYPE_ORDER,
    ORDER_TYPE_RELEASE,
    is_live,
)
from tripwire.operators import facts
from tripwire.plans.rules.base import Fact, Rule, becomes, commit_date, new, old

FACTS = {
    "lines": Fact(facts.line_facts, {"ord_no": "new.ord_no"}),
    "parts": Fact(facts.part_facts, {"ord_no": "new.ord_no"}),
    "blankets": Fact(facts.blanket_part_orders, {"ord_no": "new.ord_no"}),
    "lead_times": Fact(facts.short_lead_orders, {"ord_no": "new.ord_no"}),
    "po_numbers": Fact(
        facts.client_po_numbers,
        {"inv_cli_id": "new.inv_cli_id", "ord_cli_ord_no": "new.ord_cli_ord_no"},
    ),
    "components": Fact(facts.missing_component_orders, {"ord_no": "new.ord_no"}),
    "ratios": Fact(facts.off_ratio_orders, {"ord_no": "new.ord_no"}),
}


def _live() -> Column:
    return is_live(new("ord_status"))


def _no_project() -> Column:
    return new("prj_no").isNull()


def _neither_blanket_nor_release() -> Column:
    return ~new("ord_type").isin(ORDER_TYPE_BLANKET, ORDER_TYPE_RELEASE)


def _firm_order() -> Column:
    firm = (new("ord_status") != "E") & (old("ord_status") != "E")
    return _no_project() & firm & _neither_blanket_nor_release()


def _ships_whole() -> Column:
    return (new("ord_status") == "A") | ((new("ord_status") == "B") & ~new("ord_bo_accptd"))


def _transfer_without_fee() -> Column:
    open_order = new("ord_status").isin("A", "B", "D", "E") & (new("ord_type") == ORDER_TYPE_ORDER)
    return open_order & (new("ord_pmt_term") == 4) & (new("ord_pkg_cost") == 0)


def _converted_on_another_day() -> Column:
    converted = old("ord_status").isin("D", "E") & new("ord_status").isin("A", "B")
    return converted & (new("ord_date") != commit_date())


def _all_named_lines_zero() -> Column:
    return (F.col("named_lines") > 0) & (F.col("named_lines") == F.col("named_zero_lines"))


def _lacks_accessory() -> Column:
    return F.col("needs_accessory") & ~F.coalesce("has_accessory", F.lit(False))


RULES = [
    Rule(
        6, "ZERO QUANTITY", "ord_no",
        lambda: _no_project() & _live() & _neither_blanket_nor_release(),
        lambda: F.col("has_zero_line"), ("lines",),
    ),
    Rule(
        7, "COMPLETED BLANKET", "ord_no",
        lambda: _no_project() & _live() & (new("ord_type") == ORDER_TYPE_BLANKET),
        _all_named_lines_zero, ("lines",),
    ),
    Rule(8, "NOT RESERVED", "ord_no", _firm_order, lambda: F.col("has_unreserved_line"), ("lines",)),
    Rule(
        9, "ORDER CANCELLED", "ord_no",
        lambda: _no_project() & old("ord_status").isin("A", "B") & (new("ord_status") == "C"),
    ),
    Rule(
        10, "LINE DATES", "ord_no",
        lambda: _no_project() & _ships_whole(),
        lambda: F.col("dates_differ"), ("lines",),
    ),
    Rule(11, "MISSING AE750", "ord_no", _no_project, _lacks_accessory, ("lines", "parts")),
    Rule(12, "ZERO BANK FEES", "ord_no", lambda: _no_project() & _transfer_without_fee()),
    Rule(
        13, "EXISTING BLANKET", "ord_no",
        lambda: _no_project() & _live(),
        lambda: F.col("blanket_cli_id") == new("cli_id"), ("blankets",),
    ),
    Rule(14, "UNIT DATES", "ord_no", _no_project, lambda: F.col("has_short_lead"), ("lead_times",)),
    Rule(
        15, "DUPLICATE PO", "ord_no",
        lambda: _no_project() & (new("ord_cli_ord_no") != "") & (new("ord_status") != "C"),
        lambda: facts.other_than(new("ord_no")), ("po_numbers",),
    ),
    Rule(16, "NEW BLANKET", "ord_no", lambda: becomes("ord_type", ORDER_TYPE_BLANKET)),
    Rule(17, "NEW RELEASE", "ord_no", lambda: becomes("ord_type", ORDER_TYPE_RELEASE)),
    Rule(18, "CONVERTED DATE", "ord_no", _converted_on_another_day),
    Rule(19, "MISSING COMPONENT", "ord_no", _live, lambda: F.col("lacks_component"), ("components",)),
    Rule(20, "COMPONENT MULTIPLIER", "ord_no", _live, lambda: F.col("has_off_ratio"), ("ratios",)),
    Rule(
        21, "TRUCK SHIPMENT", "ord_no",
        lambda: F.lower(new("car_name")).contains("ups"),
        lambda: F.col("needs_truck"), ("parts",),
    ),
]
