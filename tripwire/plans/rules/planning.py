"""Rules on planning lots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripwire.operators import facts
from tripwire.plans.rules.base import INSERT, UPDATE, Fact, Rule, new

FACTS = {
    "stock": Fact(facts.manufactured_stock, {"prt_id": "new.prt_id"}),
    "lots": Fact(facts.lot_flags, {"plq_id": "new.plq_id"}),
    "components": Fact(facts.lots_with_components, {"plq_lot_no": "new.plq_lot_no"}),
}


def _stock_covers_need() -> Column:
    return (F.col("stock") >= F.col("open_reserved") + new("pld_qty_for")) & ~F.col("lot_adjusted")


RULES = [
    Rule(
        24, "UNCHECKED NEED CALCULATION", "plq_lot_no",
        lambda: (new("pld_lvl") != 0) & (new("pld_qty_res") == 0),
        _stock_covers_need, ("stock", "lots"), (INSERT, UPDATE),
    ),
    Rule(
        25, "EMPTY BOM PRODUCTION", "plq_lot_no",
        lambda: new("pld_lvl") == 0,
        lambda: F.col("lot_has_components").isNull(), ("components",),
    ),
]
