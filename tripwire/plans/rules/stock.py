"""Rules on stock movements and stock levels."""

from __future__ import annotations

from pyspark.sql import Column

from tripwire.operators.facts import NEGATIVE_STOCK_GROUPS
from tripwire.plans.rules.base import INSERT, Rule, new, old


def negative_quantity() -> Column:
    watched = (new("prt_type") == "A") & ~new("pgr_no").isin(NEGATIVE_STOCK_GROUPS)
    return watched & (new("ptn_qty_after") < 0)


def changed_quantity() -> Column:
    return new("pqt_real_qty") != old("pqt_real_qty")


TRANSACTION_RULES = [Rule(23, "NEGATIVE QUANTITY", "ptn_id", negative_quantity, ops=(INSERT,))]

QUANTITY_RULES = [Rule(29, "CHANGED PART QUANTITY", "prt_id", changed_quantity)]
