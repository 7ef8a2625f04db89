"""Rules on invoices and invoice lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripwire.functions.frames import cut, one_row_per_key, only
from tripwire.operators import facts
from tripwire.plans.rules.base import INSERT, Fact, Rule, Tables, becomes, new


def _back_order_flags(tables: Tables, keys: facts.Keys = None):
    return cut(one_row_per_key(only(tables["order_header"], keys, "ord_no"), "ord_no", ["ord_bo_accptd"]), keys, "ord_no")


FACTS = {
    "lines": Fact(facts.line_facts, {"ord_no": "new.ord_no"}),
    "back_orders": Fact(_back_order_flags, {"ord_no": "new.ord_no"}),
}

LINE_FACTS = {"unrun_lots": Fact(facts.unrun_lots, {"orl_id": "new.orl_id"})}


def _billed() -> Column:
    return (new("inv_no") != 0) & (new("inv_subtotal") >= 0)


def _shipped_free() -> Column:
    free = (new("inv_ship_amnt") == 0) & (new("inv_ship_term") == 0)
    return (new("inv_status") == "F") & free & _billed()


def _invoiced() -> Column:
    return becomes("inl_status", "F") & (new("orl_id") != 0) & (new("inl_ship_qty") != 0)


RULES = [
    Rule(
        1, "BO NOT ALLOWED", "ord_no",
        lambda: new("inv_orig_inv_no") == 0,
        lambda: ~F.col("ord_bo_accptd") & F.col("has_unready_line"),
        ("lines", "back_orders"), (INSERT,),
    ),
    Rule(2, "SHIPPING COST MISSING", "inv_no", _shipped_free),
    Rule(3, "UNSENT INVOICE EMAIL", "inv_no", lambda: ~new("inv_inv_email_sent") & _billed()),
]

LINE_RULES = [
    Rule(4, "CANCELLED PACKING SLIP", "inv_pckslp_no", lambda: becomes("inl_status", "A")),
    Rule(
        5, "INVOICED PRODUCTION", "orl_id", _invoiced, lambda: F.col("has_unrun_lot"), ("unrun_lots",)
    ),
]
