"""Lookups that add attributes to alerts, each a left join to one row per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.functions.frames import join_unique, one_row_per_key, written

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Lookup:
    """Fetch ``attrs`` (output name -> column) of ``table`` by ``key``.

    ``source`` is the column of the alerts that holds the key. Where the key is
    not the table's primary key, ``order`` picks the row of a key that has
    several: the one with its smallest value. Primary keys are joined as they
    are, which lets Spark prune the scan by the alerts' keys at run time; other
    tables are cut to the alerts' keys before a row per key is chosen.
    """

    source: str
    table: str
    key: str
    attrs: dict[str, str]
    order: str | None = None

    def __call__(self, alerts: DataFrame, tables: Tables) -> DataFrame:
        rows = tables[self.table]
        if self.order:
            asked = alerts.select(F.col(self.source).cast(rows.schema[self.key].dataType).alias(self.key)).distinct()
            rows = join_unique(rows, asked, self.key, "left_semi")
            rows = one_row_per_key(rows, self.key, list(self.attrs.values()), self.order)
        renamed = rows.select(
            F.col(self.key).alias("lookup_key"),
            *[F.col(column).alias(name) for name, column in self.attrs.items()],
        )
        keyed = alerts.withColumn("lookup_key", F.col(self.source))
        return join_unique(keyed, renamed, "lookup_key", "left").drop("lookup_key")


ORDER_CLIENT = Lookup("ord_no", "order_header", "ord_no", {"cli_id": "cli_id"})
LINE_ORDER = Lookup("orl_id", "order_line", "orl_id", {"ord_no": "ord_no"})
CLIENT_NAME = Lookup("cli_id", "client", "cli_id", {"client_name": "cli_name1"})
PACKING_SLIP_ORDER = Lookup("inv_pckslp_no", "invoicing", "inv_pckslp_no", {"ord_no": "ord_no"}, "inv_no")
INVOICE_ORDER = Lookup("inv_no", "invoicing", "inv_no", {"ord_no": "ord_no"}, "inv_pckslp_no")
TRANSACTION_PART = Lookup("ptn_id", "part_transaction", "ptn_id", {"part_no": "prt_no"})
TRANSACTION_TEXT = Lookup("ptn_id", "part_transaction", "ptn_id", {"description": "ptn_desc"})
LOT_PART = Lookup("plq_lot_no", "planning_lot_quantity", "plq_lot_no", {"part_no": "prt_no"}, "plq_id")
PO_LINE_ORDER = Lookup("pul_id", "purchase_order_line", "pul_id", {"puh_id": "puh_id"})
PO_NUMBER = Lookup("puh_id", "purchase_order_header", "puh_id", {"puh_no": "puh_no"})
PO_LINE_PART = Lookup("pul_id", "purchase_order_line", "pul_id", {"part_no": "prt_no"})
PO_REFERENCE = Lookup("puh_no", "purchase_order_header", "puh_no", {"po_reference": "puh_reference"}, "puh_id")
PO_SUPPLIER_ID = Lookup("puh_no", "purchase_order_header", "puh_no", {"sup_id": "sup_id"}, "puh_id")
SUPPLIER_NAME = Lookup("sup_id", "supplier", "sup_id", {"supplier_name": "sup_name1"})
PO_CREATOR = Lookup("puh_no", "purchase_order_header", "puh_no", {"creator": "usr_no"}, "puh_id")

# Lookups by a key that is trusted to be unique in its table.
BY_PRIMARY_KEY = [ORDER_CLIENT, LINE_ORDER, CLIENT_NAME, TRANSACTION_PART, PO_LINE_ORDER, PO_NUMBER, SUPPLIER_NAME]


def repeated_keys(tables: Tables) -> DataFrame:
    """``table, key, repeated``: how many values of each trusted key stand in several rows."""
    found = [
        tables[x.table].filter(F.col(x.key).isNotNull()).groupBy(x.key).count().filter("count > 1")
        .agg(F.count("*").alias("repeated"))
        .select(F.lit(x.table).alias("table"), F.lit(x.key).alias("key"), "repeated")
        for x in BY_PRIMARY_KEY
    ]
    return reduce(DataFrame.union, found)


# What each kind of reference leads to, in the order the lookups build on each other.
BY_REFERENCE: dict[str, list[Lookup]] = {
    "ord_no": [ORDER_CLIENT, CLIENT_NAME],
    "orl_id": [LINE_ORDER],
    "inv_no": [INVOICE_ORDER],
    "inv_pckslp_no": [PACKING_SLIP_ORDER],
    "ptn_id": [
        Lookup("ptn_id", "part_transaction", "ptn_id", {"part_no": "prt_no", "description": "ptn_desc"})
    ],
    "pul_id": [
        Lookup("pul_id", "purchase_order_line", "pul_id", {"puh_id": "puh_id", "part_no": "prt_no"}),
        PO_NUMBER,
        Lookup(
            "puh_no", "purchase_order_header", "puh_no",
            {"po_reference": "puh_reference", "creator": "usr_no", "sup_id": "sup_id"}, "puh_id",
        ),
        SUPPLIER_NAME,
    ],
}

# The attributes every enriched alert has; null where its reference has none.
CONTEXT: dict[str, str] = {
    "ord_no": "long",
    "client_name": "string",
    "part_no": "string",
    "description": "string",
    "puh_no": "long",
    "po_reference": "string",
    "supplier_name": "string",
    "creator": "string",
}


def look_up(alerts: DataFrame, tables: Tables, *lookups: Lookup) -> DataFrame:
    return reduce(lambda df, lookup: lookup(df, tables), lookups, alerts)


def look_up_references(alerts: DataFrame, tables: Tables, ref: str, *lookups: Lookup) -> DataFrame:
    """The lookups of one kind of reference.

    Where one leads to the next, the references alone go from table to table, each
    once, and the alerts, which are wide and repeat them, are moved once. What the
    references lead to is written, so the shuffles behind it are gone by then.
    """
    if len(lookups) == 1:
        return look_up(alerts, tables, *lookups)
    asked = alerts.select(ref).filter(F.col(ref).isNotNull()).distinct()
    return join_unique(alerts, written(look_up(asked, tables, *lookups)), ref, "left")


def enrich(
    alerts: DataFrame, tables: Tables, refs: set[str] | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda part: part,
) -> DataFrame:
    """Adds the ``CONTEXT`` columns.

    Alerts part by kind of reference, so that no join sees the null keys of
    alerts it has nothing to say about. Callers hand in a written or
    otherwise stored table, since each kind reads it. ``refs`` names the kinds that
    can occur, where the caller knows; others get no lookups. ``finish`` takes each
    kind's alerts before they meet, such as to write them, so that no plan holds the
    lookups of all kinds.
    """
    def complete(df: DataFrame) -> DataFrame:
        have = df.columns
        return finish(df.select(*alerts.columns, *[
            (F.col(c) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in CONTEXT.items()
        ]))

    kind = F.col("ref_type")
    chosen = {r: lookups for r, lookups in BY_REFERENCE.items() if refs is None or r in refs}
    parts = [
        complete(look_up_references(
            alerts.filter(kind == ref).withColumn(ref, F.col("reference").try_cast("long")),
            tables, ref, *lookups,
        ))
        for ref, lookups in chosen.items()
    ]
    rest = complete(alerts.filter(~F.coalesce(kind.isin(list(chosen)), F.lit(False))))
    return reduce(DataFrame.union, parts, rest)
