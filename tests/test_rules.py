"""Each rule on hand-written rows: a hit, a miss per condition, and nulls."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from tests.builders import changes, table, tables
from tripwire.plans.evaluate import evaluate
from tripwire.plans.rules.base import Fact
from tripwire.operators import facts


def raised(spark, source, rows, tabs=None, only=None):
    """Sets of alerts per change, by sequence number."""
    found = evaluate(changes(spark, source, *rows), source, tabs or tables(spark), only)
    out = {i: set() for i in range(len(rows))}
    for r in found.collect():
        out[r.change_seq].add(r.alert)
    return [out[i] for i in range(len(rows))]


def fires(spark, source, alert, rows, tabs=None):
    return [bool(a) for a in raised(spark, source, rows, tabs, [alert])]


def line(ord_no=1, orl_id=10, **values):
    base = dict(
        ord_no=ord_no, ord_id=ord_no, orl_id=orl_id, orl_sort_idx=orl_id, prt_id=100, prt_no="P1",
        orl_quantity=5, orl_reserved_qty=5, orl_ship_qty=0, orl_qty_ready=5, orl_kitmaster_id=0,
    )
    return {**base, **values}


def header(**values):
    base = dict(
        ord_no=1, ord_id=1, cli_id=7, inv_cli_id=7, ord_status="A", ord_type=1, ord_date=date(2024, 1, 15),
        ord_bo_accptd=True, ord_pmt_term=1, ord_pkg_cost=10, ord_cli_ord_no="", car_name="Truck",
    )
    return {**base, **values}


def update(**values):
    """A header update with equal images, but for ``old_*`` values."""
    old = {k[4:]: v for k, v in values.items() if k.startswith("old_")}
    new = {k: v for k, v in values.items() if not k.startswith("old_")}
    return ("UPDATE", header(**new), header(**{**new, **old}))


def test_back_order_not_allowed(spark):
    tabs = tables(
        spark,
        order_header=[header(ord_no=n, ord_id=n, ord_bo_accptd=b) for n, b in [(1, False), (2, True), (3, False), (4, None)]],
        order_line=[
            line(1, 10, orl_qty_ready=2), line(2, 20, orl_qty_ready=2), line(3, 30),
            line(4, 40, orl_qty_ready=2),
        ],
    )
    rows = [("INSERT", dict(ord_no=n, inv_orig_inv_no=o), None) for n, o in [(1, 0), (2, 0), (3, 0), (4, 0), (1, 5), (1, None), (9, 0)]]
    rows.append(("UPDATE", dict(ord_no=1, inv_orig_inv_no=0), dict(ord_no=1)))
    assert fires(spark, "invoicing", "BO NOT ALLOWED", rows, tabs) == [True] + [False] * 7


def test_invoice_filters(spark):
    base = dict(inv_no=5, inv_status="F", inv_ship_amnt=0, inv_ship_term=0, inv_subtotal=1, inv_inv_email_sent=True)
    variants = [
        {}, {"inv_status": "A"}, {"inv_ship_amnt": 1}, {"inv_ship_term": 2}, {"inv_no": 0},
        {"inv_subtotal": -1}, {"inv_subtotal": None}, {"inv_subtotal": 0},
    ]
    rows = [("UPDATE", {**base, **v}, base) for v in variants] + [("INSERT", base, None)]
    assert fires(spark, "invoicing", "SHIPPING COST MISSING", rows) == [True] + [False] * 6 + [True, False]

    mail = {**base, "inv_inv_email_sent": False}
    variants = [{}, {"inv_inv_email_sent": True}, {"inv_inv_email_sent": None}, {"inv_no": 0}, {"inv_subtotal": -1}]
    rows = [("UPDATE", {**mail, **v}, base) for v in variants]
    assert fires(spark, "invoicing", "UNSENT INVOICE EMAIL", rows) == [True, False, False, False, False]


def test_invoice_line_transitions(spark):
    def row(before, after, orl_id=10, qty=1):
        new = dict(inl_id=1, inv_pckslp_no=3, orl_id=orl_id, inl_status=after, inl_ship_qty=qty)
        return ("UPDATE", new, {**new, "inl_status": before})

    rows = [row("F", "A"), row("A", "A"), row(None, "A"), row("F", None)]
    assert fires(spark, "invoicing_line", "CANCELLED PACKING SLIP", rows) == [True, False, False, False]

    tabs = tables(spark, planning_lot_quantity=[
        dict(plq_id=1, orl_id=10, plq_adj_flag=False), dict(plq_id=2, orl_id=10, plq_adj_flag=False),
        dict(plq_id=3, orl_id=20, plq_adj_flag=True), dict(plq_id=4, orl_id=0, plq_adj_flag=False),
    ])
    rows = [
        row("A", "F"), row("F", "F"), row(None, "F"), row("A", "F", 20), row("A", "F", 0), row("A", "F", 30),
        row("A", "F", 10, 0),
    ]
    assert fires(spark, "invoicing_line", "INVOICED PRODUCTION", rows, tabs) == [True] + [False] * 6


def test_zero_quantity(spark):
    tabs = tables(spark, order_line=[
        line(1, 10, orl_quantity=0), line(1, 11), line(2, 20, orl_quantity=0, prt_no=""),
        line(3, 30, orl_quantity=0, prt_no=None),
    ])
    rows = [update(), update(ord_no=2), update(ord_no=3), update(ord_status="C"), update(ord_type=9),
            update(ord_type=10), update(prj_no=4), update(ord_status=None), update(ord_no=8)]
    assert fires(spark, "order_header", "ZERO QUANTITY", rows, tabs) == [True] + [False] * 8


def test_completed_blanket(spark):
    tabs = tables(spark, order_line=[
        line(1, 10, orl_quantity=0), line(1, 11, orl_quantity=0), line(1, 12, orl_quantity=3, prt_no=""),
        line(2, 20, orl_quantity=0), line(2, 21), line(3, 30, orl_quantity=0, prt_no=""),
    ])
    rows = [update(ord_type=9), update(ord_type=9, ord_no=2), update(ord_type=9, ord_no=3),
            update(ord_type=9, ord_no=8), update(), update(ord_type=9, ord_status="F")]
    assert fires(spark, "order_header", "COMPLETED BLANKET", rows, tabs) == [True] + [False] * 5


def test_not_reserved(spark):
    tabs = tables(spark, order_line=[
        line(1, 10, orl_reserved_qty=2), line(2, 20),
        line(3, 30, orl_reserved_qty=0, orl_ship_qty=5, orl_qty_ready=0),
        line(4, 40, orl_reserved_qty=None),
        line(5, 50, orl_reserved_qty=2, orl_ship_qty=3, orl_qty_ready=0),
    ])
    rows = [update(), update(ord_no=2), update(ord_no=3), update(ord_no=4), update(ord_status="E"),
            update(old_ord_status="E"), update(ord_type=9), update(ord_status="F"), update(ord_no=5)]
    # 3 is shipped in full; a closed order still counts; in 5 the shipped quantity differs
    assert fires(spark, "order_header", "NOT RESERVED", rows, tabs) == [
        True, False, False, False, False, False, False, True, True]


def test_header_transitions(spark):
    def one(alert, *rows):
        return fires(spark, "order_header", alert, list(rows))

    assert one(
        "ORDER CANCELLED", update(old_ord_status="A", ord_status="C"), update(old_ord_status="B", ord_status="C"),
        update(old_ord_status="D", ord_status="C"), update(ord_status="C"), update(old_ord_status=None, ord_status="C"),
        update(old_ord_status="A", ord_status="C", prj_no=3),
    ) == [True, True, False, False, False, False]
    assert one(
        "NEW BLANKET", update(old_ord_type=1, ord_type=9), update(ord_type=9), update(old_ord_type=None, ord_type=9),
        update(old_ord_type=1, ord_type=9, prj_no=3),
    ) == [True, False, False, True]
    assert one("NEW RELEASE", update(old_ord_type=9, ord_type=10), update(ord_type=10)) == [True, False]
    earlier = date(2024, 1, 14)
    assert one(
        "CONVERTED DATE", update(old_ord_status="D", ord_date=earlier), update(old_ord_status="E", ord_date=earlier),
        update(old_ord_status="D"), update(ord_date=earlier), update(old_ord_status="D", ord_date=None),
    ) == [True, True, False, False, False]
    assert one(
        "ZERO BANK FEES", update(ord_pmt_term=4, ord_pkg_cost=0), update(ord_pmt_term=4), update(ord_pkg_cost=0),
        update(ord_pmt_term=4, ord_pkg_cost=0, ord_type=2), update(ord_pmt_term=4, ord_pkg_cost=0, ord_status="F"),
        update(ord_pmt_term=4, ord_pkg_cost=None),
    ) == [True] + [False] * 5


def test_line_dates(spark):
    d1, d2 = date(2024, 2, 1), date(2024, 2, 2)
    tabs = tables(spark, order_line=[
        line(1, 10, orl_req_dt=d1), line(1, 11, orl_req_dt=d2), line(2, 20), line(2, 21),
        line(3, 30, orl_req_dt=d1), line(3, 31, orl_req_dt=d1), line(4, 40, orl_req_dt=d1), line(4, 41),
    ])
    rows = [update(), update(ord_no=2), update(ord_no=3), update(ord_no=4),
            update(ord_status="B"), update(ord_status="B", ord_bo_accptd=False), update(ord_status="B", ord_bo_accptd=None),
            update(ord_status="D")]
    assert fires(spark, "order_header", "LINE DATES", rows, tabs) == [
        True, False, False, False, False, True, False, False]


def test_accessory_and_truck(spark):
    tabs = tables(
        spark,
        order_line=[
            line(1, 10, prt_no="HOOD"), line(2, 20, prt_no="HOOD"), line(2, 21, prt_no="AE750"),
            line(3, 30, prt_no="TABLE"), line(4, 40, prt_no="RAW"),
        ],
        part=[
            dict(prt_id=1, prt_no="HOOD", prt_sort="asv x", prt_type="F", prt_usr_flag1=True),
            dict(prt_id=2, prt_no="HOOD", prt_sort="other", prt_type="A", prt_usr_flag1=False),
            dict(prt_id=3, prt_no="TABLE", prt_sort="ASV Tabl", prt_type="F"),
            dict(prt_id=4, prt_no="RAW", prt_sort="ASV 1", prt_type="A"),
        ],
    )
    rows = [update(ord_no=n, car_name="UPS Ground") for n in (1, 2, 3, 4, 9)] + [update(car_name=None)]
    assert fires(spark, "order_header", "MISSING AE750", rows, tabs) == [True, False, False, False, False, True]
    assert fires(spark, "order_header", "TRUCK SHIPMENT", rows, tabs) == [True, True, False, False, False, False]


def test_existing_blanket(spark):
    heads = [header(), header(ord_no=2, ord_type=9, ord_status="A"), header(ord_no=3, ord_type=9, ord_status="C", cli_id=8),
             header(ord_no=4, cli_id=8), header(ord_no=5, cli_id=9), header(ord_no=6, ord_type=9, cli_id=10),
             header(ord_no=7, cli_id=9, ord_type=2)]
    tabs = tables(
        spark, order_header=heads,
        order_line=[line(n, n * 10) for n in range(1, 8)] + [line(1, 11, prt_no="")],
    )
    # 4: only a cancelled blanket; 5: blanket of another client; 6: the blanket itself
    rows = [update(), update(ord_no=4, cli_id=8), update(ord_no=5, cli_id=9), update(ord_no=6, ord_type=9, cli_id=10),
            update(cli_id=8), update(ord_status="I")]
    assert fires(spark, "order_header", "EXISTING BLANKET", rows, tabs) == [True] + [False] * 5

    found = evaluate(
        changes(spark, "order_header", update(ord_no=4, cli_id=8)), "order_header", tabs, ["EXISTING BLANKET"],
        {"blankets": Fact(
            lambda t, keys: facts.blanket_part_orders(t, keys, blanket_live_only=False),
            {"ord_no": "new.ord_no"},
        )},
    )
    assert found.count() == 1


def test_unit_dates(spark):
    tabs = tables(
        spark,
        order_header=[header(ord_no=n, ord_id=n + 1000) for n in range(1, 7)] + [header(ord_no=7, ord_id=1007, ord_status="F")],
        order_line=[
            line(1, 10, ord_id=1001, orl_req_dt=date(2024, 1, 28)),
            line(2, 20, ord_id=1002, orl_req_dt=date(2024, 1, 29)),
            line(3, 30, ord_id=1003, orl_req_dt=date(2024, 1, 16), prt_id=101),
            line(4, 40, ord_id=1004), line(5, 50, ord_id=1099, orl_req_dt=date(2024, 1, 16)),
            line(6, 60, ord_id=1006, orl_req_dt=date(2024, 1, 16), prt_id=102),
            line(7, 70, ord_id=1007, orl_req_dt=date(2024, 1, 16)),
        ],
        part=[dict(prt_id=100, pgr_id=1), dict(prt_id=101, pgr_id=2), dict(prt_id=102, pgr_id=3)],
        part_group=[dict(pgr_id=1, pgr_no="001"), dict(pgr_id=2, pgr_no="990"), dict(pgr_id=3)],
    )
    rows = [update(ord_no=n) for n in range(1, 8)] + [update(ord_no=1, prj_no=1)]
    assert fires(spark, "order_header", "UNIT DATES", rows, tabs) == [True] + [False] * 7


def test_duplicate_po(spark):
    tabs = tables(spark, order_header=[
        header(ord_no=1, ord_cli_ord_no="X"), header(ord_no=2, ord_cli_ord_no="X", ord_status="C"),
        header(ord_no=3, ord_cli_ord_no=""), header(ord_no=4, ord_cli_ord_no=""),
        header(ord_no=5, ord_cli_ord_no="Y"), header(ord_no=6, ord_cli_ord_no="Y", inv_cli_id=8),
    ])
    rows = [update(ord_cli_ord_no="X"), update(ord_no=3), update(ord_no=5, ord_cli_ord_no="Y"),
            update(ord_cli_ord_no="X", ord_status="C"), update(ord_cli_ord_no=None),
            update(ord_no=9, ord_cli_ord_no="Y")]
    assert fires(spark, "order_header", "DUPLICATE PO", rows, tabs) == [True, False, False, False, False, True]


KIT = [dict(pkt_master_prt_id=500, prt_id=1, pkt_qty=2), dict(pkt_master_prt_id=500, prt_id=2, pkt_qty=1),
       dict(pkt_master_prt_id=600, prt_id=1, pkt_qty=5)]


def test_missing_component(spark):
    def kit(n, *children, kind=500):
        rows = [line(n, n * 10, prt_id=kind)]
        return rows + [line(n, n * 10 + 1 + i, prt_id=c, orl_kitmaster_id=n * 10) for i, c in enumerate(children)]

    tabs = tables(spark, part_kit=KIT, order_line=[
        *kit(1, 1), *kit(2, 1, 2), *kit(3), *kit(4, 1, None), *kit(5, 1, 2, 3), *kit(6, kind=999),
        # a component under another kit line does not count
        *kit(7, 1), line(7, 75, prt_id=500), line(7, 76, prt_id=1, orl_kitmaster_id=75), line(7, 77, prt_id=2, orl_kitmaster_id=75),
        # a kit that is itself under a kit line is not looked at
        line(8, 80, prt_id=500, orl_kitmaster_id=5),
    ])
    rows = [update(ord_no=n) for n in range(1, 9)] + [update(ord_status="C")]
    assert fires(spark, "order_header", "MISSING COMPONENT", rows, tabs) == [
        True, False, True, False, False, False, True, False, False]


@pytest.mark.parametrize("many_kits", [False, True])
def test_component_multiplier(spark, many_kits):
    kit = KIT + ([dict(pkt_master_prt_id=m, prt_id=1, pkt_qty=9) for m in range(700, 720)] if many_kits else [])
    def order(n, qty, parent=500, *extra):
        return [line(n, n * 10, prt_id=parent, orl_quantity=3),
                line(n, n * 10 + 1, prt_id=1, orl_quantity=qty, orl_kitmaster_id=n * 10)] + [
                line(n, n * 10 + 2 + i, prt_id=e) for i, e in enumerate(extra)]

    tabs = tables(spark, part_kit=kit, order_line=[
        *order(1, 6), *order(2, 7), *order(3, 6, 500, 600), *order(4, 7, 900), *order(5, 7, 900, 500),
        *order(6, 15, 900, 600), *order(7, None),
        line(8, 80, prt_id=500, orl_quantity=0), line(8, 81, prt_id=1, orl_quantity=0, orl_kitmaster_id=80),
        line(9, 90, prt_id=500, orl_quantity=3), line(9, 91, prt_id=1, orl_quantity=7, orl_kitmaster_id=80),
    ])
    # 3: another kit on the order asks for more; 4: no kit with the part; 5: a kit on another
    # line; 6: that kit's quantity fits; 9: the kit line is on another order
    rows = [update(ord_no=n) for n in range(1, 10)] + [update(ord_no=2, ord_status="I")]
    assert fires(spark, "order_header", "COMPONENT MULTIPLIER", rows, tabs) == [
        False, True, True, False, True, False, False, False, False, False]


def test_clients_and_stock(spark):
    base = dict(cli_id=1, cli_no="C1", cli_bo_accptd=True, cli_active=True, cli_creation_dt=date(2020, 1, 1))
    def row(old=None, **new):
        return ("UPDATE", {**base, **new}, {**base, **(old or {})})
    today = date(2024, 1, 15)
    rows = [row(cli_creation_dt=today), row({"cli_active": False}), row(cli_active=False), row(),
            row(cli_creation_dt=today, cli_bo_accptd=False), row(cli_creation_dt=None),
            row({"cli_active": None}), row(cli_creation_dt=today, cli_bo_accptd=None)]
    assert fires(spark, "client", "BO ALLOWED", rows) == [True, True, True, False, False, False, False, False]

    base = dict(ptn_id=1, prt_type="A", ptn_qty_after=-1, pgr_no="001")
    rows = [("INSERT", {**base, **v}, None) for v in [{}, {"prt_type": "F"}, {"ptn_qty_after": 0}, {"pgr_no": "230"}, {"pgr_no": None}]]
    rows.append(("UPDATE", base, base))
    assert fires(spark, "part_transaction", "NEGATIVE QUANTITY", rows) == [True] + [False] * 5

    rows = [("UPDATE", dict(prt_id=1, pqt_real_qty=a), dict(prt_id=1, pqt_real_qty=b)) for a, b in [(1, 2), (1, 1), (1, None)]]
    rows.append(("DELETE", None, dict(prt_id=1, pqt_real_qty=2)))
    assert fires(spark, "part_quantity", "CHANGED PART QUANTITY", rows) == [True, False, False, False]


def test_planning(spark):
    def lot(prt_id, res, adj=False, lvl=1, lot_no="L9"):
        return dict(pld_id=1, plq_id=1, plq_lot_no=lot_no, prt_id=prt_id, pld_lvl=lvl, pld_qty_res=res, pld_qty_for=1, pld_adj_flag=adj)

    tabs = tables(
        spark,
        planning_lot_detailed=[lot(1, 3), lot(1, 1), lot(1, 50, True), lot(2, 4), lot(3, 4, True), lot(4, 4, lvl=0, lot_no="L1")],
        bill_of_materials_mat=[dict(prt_master_id=p) for p in (1, 1, 2, 3)],
        part_quantity=[dict(prt_id=1, pqt_real_qty=6), dict(prt_id=2, pqt_real_qty=5), dict(prt_id=3, pqt_real_qty=90), dict(prt_id=4, pqt_real_qty=90)],
        planning_lot_quantity=[dict(plq_id=1, plq_adj_flag=False), dict(plq_id=2, plq_adj_flag=True)],
    )
    base = dict(pld_id=1, plq_id=1, plq_lot_no="L1", prt_id=1, pld_lvl=1, pld_qty_res=0, pld_qty_for=2)
    variants = [{}, {"pld_qty_for": 3}, {"prt_id": 2}, {"prt_id": 3}, {"prt_id": 4}, {"pld_lvl": 0},
                {"pld_qty_res": 1}, {"plq_id": 2}, {"plq_id": 3}, {"pld_qty_for": None}]
    rows = [("INSERT" if i % 2 else "UPDATE", {**base, **v}, base if i % 2 == 0 else None) for i, v in enumerate(variants)]
    # 3: no open row, so no sum to compare with
    assert fires(spark, "planning_lot_detailed", "UNCHECKED NEED CALCULATION", rows, tabs) == [True] + [False] * 9

    rows = [("UPDATE", {**base, "pld_lvl": 0, "plq_lot_no": n}, base) for n in ("L1", "L9", "L7", None)]
    rows += [("INSERT", {**base, "pld_lvl": 0}, None), ("UPDATE", base, base)]
    assert fires(spark, "planning_lot_detailed", "EMPTY BOM PRODUCTION", rows, tabs) == [True, False, True, True, False, False]


def test_purchasing(spark):
    def row(rcvd, before=1, bought=5):
        new = dict(pul_id=1, puh_id=1, prt_no="P1", pul_prch_qty=bought, pul_rcvd_qty=rcvd)
        return ("UPDATE", new, {**new, "pul_rcvd_qty": before})

    rows = [row(2), row(1), row(6), row(5, 5), row(None), row(2, None)]
    assert fires(spark, "purchase_order_line", "RECEPTION", rows) == [True, False, True, False, False, False]
    assert fires(spark, "purchase_order_line", "OVER RECEPTION", rows) == [False, False, True, False, False, False]

    tabs = tables(
        spark,
        purchase_order_header=[dict(puh_id=1, sup_id=10), dict(puh_id=2, sup_id=None), dict(puh_id=4, sup_id=20)],
        part=[dict(prt_id=1, prt_no="P1"), dict(prt_id=2, prt_no="P1"), dict(prt_id=3, prt_no="P3")],
        part_supplier=[dict(prt_id=2, sup_id=10), dict(prt_id=3, sup_id=20)],
    )
    rows = [("UPDATE", dict(pul_id=1, puh_id=h, prt_no=p), dict(pul_id=1)) for h, p in
            [(1, "P1"), (2, "P1"), (3, "P1"), (4, "P1"), (4, "P3"), (4, ""), (4, None), (None, "P1")]]
    assert fires(spark, "purchase_order_line", "MISSING SUPPLIER", rows, tabs) == [
        False, True, True, True, False, False, False, True]


def test_one_change_raises_alerts_in_rule_order(spark):
    rows = [update(old_ord_type=1, ord_type=9, old_ord_status="A", ord_status="C"), update()]
    found = evaluate(changes(spark, "order_header", *rows), "order_header", tables(spark)).collect()
    assert [(r.rule_no, r.alert, r.change_seq) for r in found] == [(9, "ORDER CANCELLED", 0), (16, "NEW BLANKET", 0)]
    assert (found[0].ref_type, found[0].reference, found[0].commit_ts) == ("ord_no", "1", datetime(2024, 1, 15, 12))


def test_deletes_raise_nothing(spark):
    rows = [("DELETE", None, header())]
    assert raised(spark, "order_header", rows) == [set()]


def test_equal_alerts_of_a_transaction_count_once(spark):
    from pyspark.sql import functions as F

    feed = changes(spark, "order_header", *[update(old_ord_type=1, ord_type=9)] * 3)
    feed = feed.withColumn("txn_id", F.when(F.col("change_seq") < 2, 1).otherwise(2))
    assert evaluate(feed, "order_header", tables(spark), ["NEW BLANKET"]).count() == 2


def test_padded_part_numbers_and_text_flags(spark):
    from tripwire.sources.snapshots import normalise

    rows = spark.createDataFrame(
        [("AE750          ", "T"), ("   ", "false"), (None, "x")], "prt_no string, prt_usr_flag1 string"
    )
    assert [tuple(r) for r in normalise(rows, "part").collect()] == [("AE750", True), ("", False), (None, None)]
    assert table(spark, "part", dict(prt_no="x")).count() == 1
