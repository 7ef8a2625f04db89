"""Lookups, gates, routes, text and envelopes."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.builders import SESSION, tables
from tripwire.operators import enrich, gates, outbox
from tripwire.plans import pipeline
from tripwire.plans.rules import CATALOGUE
from tripwire.plans.templates import HANDLED, as_format
from tripwire.sources.notifications import stream_payloads
from tripwire.streaming import live

NOW = datetime(2024, 1, 15, 9)


def logged(spark, *rows):
    """Rows of (alert, ref_type, reference[, user])."""
    data = [(NOW, r[0], r[1], r[2], r[3] if len(r) > 3 else "JOE", "ST", i) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data, "time_stamp timestamp_ntz, alert string, ref_type string, reference string, user_name string, "
        "station string, change_seq long",
    )


def shop(spark):
    return tables(
        spark,
        order_header=[dict(ord_no=1, ord_id=1, cli_id=7), dict(ord_no=2, ord_id=2, cli_id=99)],
        client=[dict(cli_id=7, cli_no="C7", cli_name1="Acme {user}")],
        order_line=[
            dict(ord_no=1, orl_id=10, orl_sort_idx=1, prt_id=500, prt_no="KIT", orl_quantity=1, orl_kitmaster_id=0),
            dict(ord_no=1, orl_id=11, orl_sort_idx=2, prt_id=1, prt_no="P1", orl_quantity=7, orl_kitmaster_id=10),
        ],
        part_kit=[dict(pkt_master_prt_id=500, prt_id=1, pkt_qty=2)],
        invoicing=[dict(inv_no=5, inv_pckslp_no=50, ord_no=1)],
        part_transaction=[dict(ptn_id=3, prt_no="P1", ptn_desc="count")],
        purchase_order_header=[
            dict(puh_id=1, puh_no=100, sup_id=9, usr_no="U1", puh_reference="ALERT AA/BB"),
            dict(puh_id=2, puh_no=200, usr_no="U9", puh_reference="alert"), dict(puh_id=3, puh_no=300),
            dict(puh_id=4, puh_no=400, usr_no=None, puh_reference="ALERT"),
        ],
        purchase_order_line=[dict(pul_id=n, puh_id=n, prt_no="SPECIAL" if n == 2 else "P1") for n in (1, 2, 3, 4)],
        supplier=[dict(sup_id=9, sup_name1="Steel Co")],
        blanket_orders=[dict(prt_no="P1", ord_no=8, cli_no="C7"), dict(prt_no="KIT", ord_no=9, cli_no="C7")],
    )


ROUTING = outbox.Routing(
    users={"JOE": "joe"}, creators={"U1": "ann"}, initials={"AA": "aa", "BB": "bb", "CC": "cc"},
    addresses={"sales": "sales@example.org"},
)


def messages(spark, *rows, routing=ROUTING):
    tabs = shop(spark)
    _, out = pipeline.deliver(logged(spark, *rows), tabs, routing)
    return {(r.alert, r.reference): r for r in out.collect()}


def test_lookups_by_reference(spark):
    rows = logged(
        spark, ("A", "ord_no", "1"), ("A", "ord_no", "2"), ("A", "orl_id", "11"), ("A", "inv_no", "5"),
        ("A", "inv_pckslp_no", "50"), ("A", "ptn_id", "3"), ("A", "pul_id", "1"), ("A", "cli_no", "C7"),
        ("A", "ord_no", "no number"), ("A", None, "1"),
    )
    out = {r.change_seq: r for r in enrich.enrich(rows, shop(spark)).collect()}
    assert len(out) == 10
    assert (out[0].ord_no, out[0].client_name) == (1, "Acme {user}")
    assert (out[1].ord_no, out[1].client_name) == (2, None)
    assert [out[i].ord_no for i in (2, 3, 4)] == [1, 1, 1]
    assert (out[5].part_no, out[5].description) == ("P1", "count")
    assert (out[6].puh_no, out[6].supplier_name, out[6].creator, out[6].po_reference) == (
        100, "Steel Co", "U1", "ALERT AA/BB")
    assert out[7].ord_no is None and out[8].client_name is None and out[9].ord_no is None


def test_lookup_takes_one_row_of_a_key(spark):
    tabs = tables(spark, planning_lot_quantity=[
        dict(plq_id=2, plq_lot_no="L1", prt_no="B"), dict(plq_id=1, plq_lot_no="L1", prt_no="C")])
    rows = spark.createDataFrame([("L1",), ("L2",)], "plq_lot_no string")
    assert {tuple(r) for r in enrich.LOT_PART(rows, tabs).collect()} == {("L1", "C"), ("L2", None)}


def test_gates(spark):
    rows = logged(
        spark, ("RECEPTION", "pul_id", "1"), ("RECEPTION", "pul_id", "2"), ("RECEPTION", "pul_id", "3"),
        ("MISSING SUPPLIER", "pul_id", "1"), ("MISSING SUPPLIER", "pul_id", "2"), ("MISSING SUPPLIER", "pul_id", "77"),
        ("COMPONENT MULTIPLIER", "ord_no", "1"), ("COMPONENT MULTIPLIER", "ord_no", "2"),
        ("MISSING AE750", "ord_no", "1"), ("MISSING TAX ID", "ord_no", "1"),
    )
    tabs = shop(spark)
    out = {r.change_seq: r.disposition for r in gates.gate(enrich.enrich(rows, tabs), tabs).collect()}
    assert [out[i] for i in range(10)] == [
        "accepted", "gated", "gated", "accepted", "gated", "accepted", "accepted", "gated", "unhandled", "accepted"]


def test_handled_alerts(spark):
    raised = {r.alert for rules, _ in CATALOGUE.values() for r in rules}
    assert len(raised) == 29 and len(HANDLED) == 27
    assert raised - set(HANDLED) == {"MISSING AE750", "EMPTY BOM PRODUCTION", "CHANGED PART QUANTITY"}
    assert set(HANDLED) - raised == {"MISSING TAX ID"}


def test_routes(spark):
    out = messages(
        spark, ("NOT RESERVED", "ord_no", "1"), ("UNCHECKED NEED CALCULATION", "plq_lot_no", "L1"),
        ("UNCHECKED NEED CALCULATION", "plq_lot_no", "L2", "SUE"), ("MISSING SUPPLIER", "pul_id", "1", "SUE"),
        ("RECEPTION", "pul_id", "1"), ("RECEPTION", "pul_id", "4"), ("ORDER CANCELLED", "ord_no", "1"),
    )
    def who(*key):
        return out[key].to_header, out[key].cc_header
    assert who("NOT RESERVED", "1") == ("sales@example.org", "billing")
    assert who("UNCHECKED NEED CALCULATION", "L1") == ("joe", "")
    assert who("UNCHECKED NEED CALCULATION", "L2") == ("planning_lead", "")
    assert who("MISSING SUPPLIER", "1") == ("purchasing_lead", "")
    assert who("RECEPTION", "1") == ("ann", "aa, bb")
    assert who("RECEPTION", "4") == ("purchasing_lead", "")
    assert who("ORDER CANCELLED", "1") == ("sales@example.org", "shipping, warehouse")
    assert out["RECEPTION", "1"].recipients == ["ann", "aa", "bb", "admin"]
    assert out["RECEPTION", "1"].from_header == "noreply"


def test_dev_sends_everything_to_the_admin(spark):
    routing = outbox.Routing(users={"JOE": "joe"}, admin="root", dev=True)
    out = messages(spark, ("RECEPTION", "pul_id", "1"), ("BO ALLOWED", "cli_no", "C7"), routing=routing)
    assert {(r.to_header, r.cc_header) for r in out.values()} == {("root", "root")}


def test_text_is_filled_once(spark):
    out = messages(
        spark, ("ORDER CANCELLED", "ord_no", "1"), ("NEW BLANKET", "ord_no", "1"),
        ("NEGATIVE QUANTITY", "ptn_id", "3"), ("NEW RELEASE", "ord_no", "2"),
    )
    assert "hand the packing slip to JOE." in out["ORDER CANCELLED", "1"].body
    # the client's name looks like a placeholder and stays as it is
    assert "Blanket order 1 was created for Acme {user}." in out["NEW BLANKET", "1"].body
    assert out["NEGATIVE QUANTITY", "3"].subject == "Part P1: negative quantity"
    assert "Blanket release 2 was created for ." in out["NEW RELEASE", "2"].body


def test_lists(spark):
    out = messages(
        spark, ("EXISTING BLANKET", "ord_no", "1"), ("MISSING COMPONENT", "ord_no", "1"),
        ("COMPONENT MULTIPLIER", "ord_no", "1"), ("EXISTING BLANKET", "ord_no", "2"),
    )
    assert "\n\nPart KIT in blanket order 9\nPart P1 in blanket order 8\n" in out["EXISTING BLANKET", "1"].body
    assert "Kit line 1, part KIT\n  line 2, part P1\n" in out["MISSING COMPONENT", "1"].body
    body = out["COMPONENT MULTIPLIER", "1"].body
    assert "has a component with a wrong quantity" in body
    assert "  line 2, part P1: suggested quantity 2\n" in body
    assert ("EXISTING BLANKET", "2") in out


def long_list(spark):
    tabs = shop(spark)
    tabs["blanket_orders"] = spark.range(900).select(
        F.lit("P1").alias("prt_no"), (F.col("id") % 450 * 10_000).alias("ord_no"), F.lit("C7").alias("cli_no"))
    return tabs, enrich.enrich(logged(spark, ("EXISTING BLANKET", "ord_no", "1"), ("NEW BLANKET", "ord_no", "1")), tabs)


def test_a_long_list_is_one_message(spark):
    tabs, rows = long_list(spark)
    out = {r.alert: r for r in outbox.outbox(rows, tabs, ROUTING).collect()}
    assert len(out) == 2 and out["EXISTING BLANKET"].body.count("in blanket order") == 900
    apart = {r.alert: r for r in outbox.outbox(rows, tabs, ROUTING, inline_lists=False).collect()}
    assert "outbox lines of order 1." in apart["EXISTING BLANKET"].body and len(apart) == 2


def test_lines_are_numbered_across_partitions(spark):
    tabs, rows = long_list(spark)
    lines = outbox.list_lines(rows, tabs).orderBy("line_no").collect()
    assert [r.line_no for r in lines] == list(range(1, 901)) and {(r.alert, r.ord_no) for r in lines} == {("EXISTING BLANKET", 1)}
    numbers = [int(r.text.rsplit(" ", 1)[1]) for r in lines]
    assert numbers == sorted(numbers) and len(set(numbers)) == 450


def test_lists_kept_apart_reach_the_outbox_of_a_stream(spark, tmp_path):
    tabs, _ = long_list(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("".join(
        f"2024-01-15 00:0{k}:00\tord_no, {n}, {alert}, {SESSION}\n"
        for k, (alert, n) in enumerate([("EXISTING BLANKET", 1), ("NEW BLANKET", 2), ("EXISTING BLANKET", 1)])))
    root = str(tmp_path / "out")
    query = live.start_payloads(
        stream_payloads(spark, str(tmp_path / "in")), lambda: tabs, ROUTING, root, str(tmp_path / "cp"), inline_lists=False)
    query.awaitTermination()
    assert query.exception() is None
    found = {r.alert: r for r in spark.read.parquet(f"{root}/outbox").collect()}
    assert set(found) == {"EXISTING BLANKET", "NEW BLANKET"}
    assert "outbox lines of order 1." in found["EXISTING BLANKET"].body
    lines = spark.read.parquet(f"{root}/outbox_lines").collect()
    assert sorted(r.line_no for r in lines) == list(range(1, 901))
    assert {(r.alert, r.ord_no) for r in lines} == {("EXISTING BLANKET", 1)}


def test_no_rule_with_a_list_gives_no_lines(spark):
    tabs, rows = long_list(spark)
    assert outbox.list_lines(rows, tabs, {"NEW BLANKET"}).collect() == []


def test_a_repeated_packing_slip_gives_one_message(spark):
    tabs = shop(spark)
    tabs["invoicing"] = tables(spark, invoicing=[
        dict(inv_no=6, inv_pckslp_no=50, ord_no=2), dict(inv_no=5, inv_pckslp_no=50, ord_no=1)])["invoicing"]
    out = enrich.enrich(logged(spark, ("CANCELLED PACKING SLIP", "inv_pckslp_no", "50")), tabs).collect()
    assert [r.ord_no for r in out] == [1]


def test_repeated_keys_are_counted(spark):
    tabs = {**tables(spark, **{x.table: [] for x in enrich.BY_PRIMARY_KEY}), **{
        "client": tables(spark, client=[dict(cli_id=1), dict(cli_id=1), dict(cli_id=2), dict(cli_id=None)])["client"]}}
    found = {(r.table, r.key): r.repeated for r in enrich.repeated_keys(tabs).collect()}
    assert found.pop(("client", "cli_id")) == 1 and set(found.values()) == {0}


@pytest.mark.parametrize("text, want", [
    ("a{ref}b{ref}", "a%1$sb%1$s"), ("{X} y 5%", "{X} y 5%%"), ("{noun}", "%10$s"),
])
def test_formats(text, want):
    assert as_format(text) == want
