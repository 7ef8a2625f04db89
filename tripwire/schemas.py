"""Input schemas: the business tables, the change row that wraps them, the alert log.

The part-number columns are blank padded in most ERP exports and flags often
come as text; ``sources.snapshots.normalise`` brings both to these types.
"""

from __future__ import annotations

from pyspark.sql import types as T

QTY = "decimal(15,4)"
MONEY = "decimal(12,2)"

TABLES: dict[str, str] = {
    "order_header": (
        "ord_id long, ord_no long, cli_id long, inv_cli_id long, ord_status string, ord_type int, "
        "ord_date date, ord_bo_accptd boolean, prj_no long, ord_pmt_term int, "
        f"ord_pkg_cost {MONEY}, ord_cli_ord_no string, car_name string"
    ),
    "order_line": (
        "orl_id long, ord_no long, ord_id long, orl_sort_idx long, prt_id long, prt_no string, "
        f"orl_quantity {QTY}, orl_reserved_qty {QTY}, orl_ship_qty {QTY}, orl_qty_ready {QTY}, "
        "orl_req_dt date, orl_kitmaster_id long"
    ),
    "client": (
        "cli_id long, cli_no string, cli_name1 string, cli_bo_accptd boolean, "
        "cli_active boolean, cli_creation_dt date"
    ),
    "part": (
        "prt_id long, prt_no string, prt_sort string, prt_type string, "
        "prt_usr_flag1 boolean, pgr_id long"
    ),
    "part_group": "pgr_id long, pgr_no string",
    "part_kit": f"pkt_master_prt_id long, prt_id long, pkt_qty {QTY}",
    "invoicing": (
        "inv_no long, inv_pckslp_no long, ord_no long, inv_orig_inv_no long, inv_status string, "
        f"inv_ship_amnt {MONEY}, inv_ship_term int, inv_subtotal {MONEY}, inv_inv_email_sent boolean"
    ),
    "invoicing_line": (
        f"inl_id long, inv_pckslp_no long, orl_id long, inl_status string, inl_ship_qty {QTY}"
    ),
    "planning_lot_quantity": (
        "plq_id long, orl_id long, plq_lot_no string, prt_no string, plq_adj_flag boolean"
    ),
    "planning_lot_detailed": (
        "pld_id long, plq_id long, plq_lot_no string, prt_id long, pld_lvl int, "
        f"pld_qty_res {QTY}, pld_qty_for {QTY}, pld_adj_flag boolean"
    ),
    "bill_of_materials_mat": "prt_master_id long",
    "part_quantity": f"prt_id long, pqt_real_qty {QTY}",
    "part_transaction": (
        "ptn_id long, prt_no string, ptn_desc string, prt_type string, "
        f"ptn_qty_after {QTY}, pgr_no string"
    ),
    "part_supplier": "prt_id long, sup_id long",
    "supplier": "sup_id long, sup_name1 string",
    "purchase_order_header": (
        "puh_id long, puh_no long, sup_id long, usr_no string, puh_reference string"
    ),
    "purchase_order_line": (
        f"pul_id long, puh_id long, prt_no string, pul_prch_qty {QTY}, pul_rcvd_qty {QTY}"
    ),
    "blanket_orders": "prt_no string, ord_no long, cli_no string",
}

# Tables whose row changes are watched, with the key that identifies a row.
CHANGE_KEYS: dict[str, list[str]] = {
    "order_header": ["ord_no"],
    "invoicing": ["inv_pckslp_no"],
    "invoicing_line": ["inl_id"],
    "client": ["cli_id"],
    "part_transaction": ["ptn_id"],
    "planning_lot_detailed": ["pld_id"],
    "purchase_order_line": ["pul_id"],
    "part_quantity": ["prt_id"],
}

# The five fields that make two alerts the same alert.
ALERT_KEY = ["alert", "ref_type", "reference", "user_name", "station"]

ALERT_LOG = T.StructType(
    [T.StructField("time_stamp", T.TimestampNTZType())]
    + [T.StructField(name, T.StringType()) for name in ALERT_KEY]
)


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def change_schema(name: str) -> T.StructType:
    """One change row: the operation, when, by whom and in which transaction, and both row images."""
    row = table_schema(name)
    return (
        T.StructType()
        .add("op", "string")
        .add("commit_ts", T.TimestampNTZType())
        .add("change_seq", "long")
        .add("app_name", "string")
        .add("txn_id", "long")
        .add("old", row)
        .add("new", row)
    )
