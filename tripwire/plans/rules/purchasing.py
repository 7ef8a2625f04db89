"""Rules on purchase order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.functions.columns import has_part
from tripwire.operators import facts
from tripwire.plans.rules.base import Fact, Rule, Tables, new, old


class SupplierFact(Fact):
    """Two lookups in a row: the order's supplier, then whether the part has it."""

    def attach(self, changes: DataFrame, tables: Tables) -> DataFrame:
        with_supplier = super().attach(changes, tables)
        known = Fact(facts.known_suppliers, {"prt_no": "new.prt_no", "sup_id": "sup_id"})
        return known.attach(with_supplier, tables).drop("sup_id")


FACTS = {"suppliers": SupplierFact(facts.purchase_suppliers, {"puh_id": "new.puh_id"})}


RULES = [
    Rule(26, "RECEPTION", "pul_id", lambda: new("pul_rcvd_qty") != old("pul_rcvd_qty")),
    Rule(27, "OVER RECEPTION", "pul_id", lambda: new("pul_rcvd_qty") > new("pul_prch_qty")),
    Rule(
        28, "MISSING SUPPLIER", "pul_id",
        lambda: has_part(new("prt_no")),
        lambda: F.col("supplier_known").isNull(), ("suppliers",),
    ),
]
