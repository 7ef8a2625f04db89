"""Kit and blanket functions and their reports."""

from tests.builders import tables
from tripwire.operators import kits


def line(orl_id, prt_id, qty, parent=0, ord_no=1, prt_no=None, idx=None):
    return dict(ord_no=ord_no, orl_id=orl_id, orl_sort_idx=orl_id if idx is None else idx, prt_id=prt_id,
                prt_no=prt_no or f"P{prt_id}", orl_quantity=qty, orl_kitmaster_id=parent)


def shop(spark):
    return tables(
        spark,
        part_kit=[dict(pkt_master_prt_id=500, prt_id=1, pkt_qty=2.5), dict(pkt_master_prt_id=500, prt_id=2, pkt_qty=1),
                  dict(pkt_master_prt_id=600, prt_id=2, pkt_qty=4)],
        order_line=[
            line(10, 500, 3), line(11, 1, 9, 10), line(12, 2, 3, 10), line(20, 600, 1), line(30, 7, 1),
            line(40, 500, 1, ord_no=2), line(41, 1, 2, 40, ord_no=2),
            line(50, 600, 1, ord_no=3),
        ],
    )


def test_functions(spark):
    tabs = shop(spark)
    rows = {tuple(r) for r in kits.kit_parents(tabs).collect()}
    assert rows == {(1, 10, "P500", 10), (1, 20, "P600", 20), (2, 40, "P500", 40), (3, 50, "P600", 50)}
    rows = {tuple(r) for r in kits.kit_child_lines(tabs).collect()}
    assert rows == {(1, 10, 11, "P1"), (1, 10, 12, "P2"), (2, 40, 41, "P1")}
    # 2.5 * 3 = 7.5 and 2.5 * 1 = 2.5 round half away from zero
    rows = {tuple(r) for r in kits.kit_quantity_errors(tabs).collect()}
    assert rows == {(1, 10, 11, "P1", 8), (2, 40, 41, "P1", 3)}


def test_only_asked_orders(spark):
    tabs = shop(spark)
    orders = spark.createDataFrame([(2,), (2,)], "ord_no long")
    assert [r.ord_no for r in kits.kit_parents(tabs, orders).collect()] == [2]
    assert [r.ord_no for r in kits.kit_quantity_errors(tabs, orders).collect()] == [2]


def as_lists(report):
    return {
        r.ord_no: [(k.orl_sort_idx, k.prt_no, [tuple(x) for x in k.lines]) for k in r.kits]
        for r in report.collect()
    }


def test_reports_nest_lines_in_order(spark):
    tabs = shop(spark)
    assert as_lists(kits.missing_component_report(tabs)) == {
        1: [(10, "P500", [(11, "P1"), (12, "P2")]), (20, "P600", [])],
        2: [(40, "P500", [(41, "P1")])],
        3: [(50, "P600", [])],
    }
    assert as_lists(kits.multiplier_report(tabs))[1] == [(10, "P500", [(11, "P1", 8)]), (20, "P600", [])]
    assert {r.ord_no for r in kits.confirmed_multiplier_orders(tabs).collect()} == {1, 2}


def test_first_kit_line_decides(spark):
    tabs = tables(
        spark,
        part_kit=[dict(pkt_master_prt_id=500, prt_id=1, pkt_qty=2)],
        order_line=[
            line(10, 500, 1, idx=2), line(11, 1, 5, 10, idx=3), line(20, 500, 1, idx=1), line(21, 1, 2, 20, idx=4),
        ],
    )
    assert kits.confirmed_multiplier_orders(tabs).count() == 0


def test_existing_blankets_keep_every_row(spark):
    tabs = tables(
        spark,
        client=[dict(cli_id=7, cli_no="C7"), dict(cli_id=8, cli_no="C8")],
        order_header=[dict(ord_no=1, cli_id=7), dict(ord_no=2, cli_id=8)],
        order_line=[line(1, 1, 1, prt_no="A"), line(2, 1, 1, prt_no="A"), line(3, 1, 1, ord_no=2, prt_no="A")],
        blanket_orders=[dict(prt_no="A", ord_no=9, cli_no="C7"), dict(prt_no="A", ord_no=9, cli_no="C7"),
                        dict(prt_no="B", ord_no=9, cli_no="C7"), dict(prt_no="A", ord_no=5, cli_no="C6")],
    )
    assert [tuple(r) for r in kits.existing_blankets(tabs, tabs["order_header"]).collect()] == [(1, "A", 9), (1, "A", 9)]


def test_quantities_of_a_long_kit_line(spark):
    lines = [line(1, 500, 1, ord_no=1)] + [line(i, 1, 5, 1, ord_no=1) for i in range(2, 502)]
    tabs = tables(spark, part_kit=[dict(pkt_master_prt_id=500, prt_id=1, pkt_qty=2)], order_line=lines)
    [report] = kits.multiplier_report(tabs).collect()
    assert [x.orl_sort_idx for k in report.kits for x in k.lines] == list(range(2, 502))
    assert [k.prt_no for k in report.kits] == ["P500"]
