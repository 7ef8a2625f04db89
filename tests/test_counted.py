"""Facts as of each change and facts kept up to date, against a replay of the log row by row."""

from __future__ import annotations

import random
from datetime import date, timedelta
from uuid import uuid4

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.builders import NOON, SESSION, _row, table, tables
from tripwire.functions.frames import shared_folder
from tripwire.operators import counted, facts
from tripwire.operators.outbox import Routing
from tripwire.plans import pipeline
from tripwire.plans.evaluate import evaluate
from tripwire.schemas import TABLES, change_schema, table_schema

LINE = {"orl_reserved_qty": 5, "orl_ship_qty": 0, "orl_qty_ready": 5, "prt_no": "P1", "orl_kitmaster_id": 0}


def feed(spark, name, *rows):
    """Changes (change_seq, old, new) of any table."""
    schema = table_schema(name)
    row = lambda values: _row(schema, values)
    op = lambda old, new: "UPDATE" if old and new else "INSERT" if new else "DELETE"
    kind = f"op string, commit_ts timestamp_ntz, change_seq long, app_name string, old {schema.simpleString()}, new {schema.simpleString()}"
    return spark.createDataFrame([(op(o, n), NOON, seq, SESSION, row(o), row(n)) for seq, o, n in rows], kind)


def alerts(df):
    return sorted((r.change_seq, r.alert) for r in df.collect())


ORDER = {"ord_no": 1, "ord_id": 1, "cli_id": 7, "inv_cli_id": 7, "ord_status": "A", "ord_type": 1, "ord_date": date(2024, 1, 15),
         "ord_bo_accptd": True, "ord_pmt_term": 1, "ord_pkg_cost": 1, "ord_cli_ord_no": "", "car_name": "x"}


def test_a_line_changes_between_two_changes_of_its_order(spark):
    """The order is changed, a line gets and loses quantity zero, the order is changed in between and after."""
    full, empty = ({**LINE, "orl_id": 1, "ord_no": 1, "orl_quantity": q} for q in (5, 0))
    tabs = tables(spark, order_header=[ORDER], order_line=[full])
    changes = feed(spark, "order_header", *[(seq, ORDER, ORDER) for seq in (1, 3, 5)])
    lines = feed(spark, "order_line", (2, full, empty), (4, empty, full))
    assert alerts(evaluate(changes, "order_header", tabs, ["ZERO QUANTITY"])) == []
    found = evaluate(changes, "order_header", tabs, ["ZERO QUANTITY", "NOT RESERVED"], history={"order_line": lines})
    assert alerts(found) == [(3, "NOT RESERVED"), (3, "ZERO QUANTITY")]
    outcome = pipeline.run({"order_header": changes}, tabs, Routing(), history={"order_line": lines})
    assert {"ZERO QUANTITY"} <= {r.alert for r in outcome.alerts.collect()}


def test_lines_that_come_and_go(spark):
    zero = {**LINE, "orl_id": 1, "ord_no": 1, "orl_quantity": 0}
    changes = feed(spark, "order_header", *[(seq, ORDER, ORDER) for seq in (1, 3, 5)])
    gone = evaluate(changes, "order_header", tables(spark, order_header=[ORDER]), ["ZERO QUANTITY"],
                    history={"order_line": feed(spark, "order_line", (2, None, zero), (4, zero, None))})
    assert alerts(gone) == [(3, "ZERO QUANTITY")]
    moved = evaluate(changes, "order_header", tables(spark, order_header=[ORDER], order_line=[{**zero, "ord_no": 2}]), ["ZERO QUANTITY"],
                     history={"order_line": feed(spark, "order_line", (4, zero, {**zero, "ord_no": 2}))})
    assert alerts(moved) == [(1, "ZERO QUANTITY"), (3, "ZERO QUANTITY")]


def test_order_numbers_and_flags_of_the_moment(spark):
    other = {**ORDER, "ord_no": 2, "ord_id": 2, "ord_cli_ord_no": "PO9"}
    mine = {**ORDER, "ord_cli_ord_no": "PO9"}
    log = feed(spark, "order_header", (1, mine, mine), (2, other, {**other, "ord_cli_ord_no": "PO8"}), (3, mine, mine))
    tabs = tables(spark, order_header=[mine, {**other, "ord_cli_ord_no": "PO8"}])
    found = evaluate(log, "order_header", tabs, ["DUPLICATE PO"], history={"order_header": log})
    assert alerts(found) == [(1, "DUPLICATE PO")]

    invoice = {"inv_no": 1, "inv_pckslp_no": 1, "ord_no": 1, "inv_orig_inv_no": 0}
    invoices = feed(spark, "invoicing", (1, None, invoice), (3, None, invoice))
    header = feed(spark, "order_header", (2, {**ORDER, "ord_bo_accptd": False}, ORDER))
    line = {**LINE, "orl_id": 1, "ord_no": 1, "orl_quantity": 9}
    tabs = tables(spark, order_header=[ORDER], order_line=[line])
    assert alerts(evaluate(invoices, "invoicing", tabs, ["BO NOT ALLOWED"])) == []
    assert alerts(evaluate(invoices, "invoicing", tabs, ["BO NOT ALLOWED"], history={"order_header": header})) == [(1, "BO NOT ALLOWED")]


def test_lots_of_the_moment(spark):
    flag = lambda done: {"plq_id": 5, "orl_id": 9, "plq_lot_no": "L1", "plq_adj_flag": done}
    sold = {"inl_id": 1, "orl_id": 9, "inl_status": "F", "inl_ship_qty": 1}
    changes = feed(spark, "invoicing_line", *[(seq, {**sold, "inl_status": "A"}, sold) for seq in (1, 3)])
    tabs = tables(spark, planning_lot_quantity=[flag(True)])
    lots = feed(spark, "planning_lot_quantity", (2, flag(False), flag(True)))
    assert alerts(evaluate(changes, "invoicing_line", tabs, ["INVOICED PRODUCTION"], history={"planning_lot_quantity": lots})) == [
        (1, "INVOICED PRODUCTION")]
    top, part = ({"pld_id": n, "plq_id": 5, "plq_lot_no": "L1", "pld_lvl": n} for n in (0, 1))
    log = feed(spark, "planning_lot_detailed", (1, top, top), (2, None, part), (3, top, top))
    found = evaluate(log, "planning_lot_detailed", tables(spark, planning_lot_detailed=[top, part]), ["EMPTY BOM PRODUCTION"],
                     history={"planning_lot_detailed": log})
    assert alerts(found) == [(1, "EMPTY BOM PRODUCTION")]


def random_log(seed, orders, steps):
    """Lines before, (change_seq, old, new) and the lines after; order 1 has a third of all."""
    rnd = random.Random(seed)
    number = lambda: 1 if rnd.random() < 0.33 else rnd.randrange(2, orders)

    def line(orl_id):
        return {"orl_id": orl_id, "ord_no": number(), "prt_no": rnd.choice(["", "P1", "AE750", None]),
                "orl_quantity": rnd.choice([0, 5, None]), "orl_reserved_qty": rnd.choice([0, 5]), "orl_ship_qty": 0,
                "orl_qty_ready": rnd.choice([0, 5]), "orl_kitmaster_id": 0,
                "orl_req_dt": rnd.choice([None, date(1960, 1, 1) + timedelta(days=rnd.randrange(3) * 9_000)])}

    now = {i: line(i) for i in range(60)}
    before, log = dict(now), []
    for seq in range(1, steps):
        i = rnd.randrange(90)
        old, new = now.get(i), (None if rnd.random() < 0.2 else line(i))
        if old or new:
            log.append((seq, old, new))
            now[i] = new
            if new is None:
                del now[i]
    return before, log, now


def replay(before, log, upto):
    now = dict(before)
    for seq, old, new in log:
        if seq <= upto:
            i = (old or new)["orl_id"]
            now.pop(i, None)
            if new:
                now[i] = new
    return list(now.values())


@pytest.mark.parametrize("per_bucket", [7, 100_000])
def test_counts_as_of_every_position(spark, per_bucket):
    before, log, now = random_log(per_bucket, 6, 200)
    tabs = tables(spark, order_line=list(now.values()))
    asks = [(seq, number) for seq in range(0, 210, 3) for number in range(1, 7)]
    changes = spark.createDataFrame([(seq, (number,)) for seq, number in asks], "change_seq long, new struct<ord_no: long>")
    as_of = counted.AsOf(counted.LINES, {"ord_no": "new.ord_no"}, feed(spark, "order_line", *log), per_bucket)
    got = {(r.change_seq, r.new.ord_no): r for r in as_of.attach(changes, tabs).collect()}
    assert len(got) == len(asks)
    for seq in range(0, 210, 3):
        held = pd.DataFrame(replay(before, log, seq))
        for number in range(1, 7):
            mine, r = held[held.ord_no == number], got[seq, number]
            named = mine[mine.prt_no.fillna("") != ""]
            assert r.named_lines == len(named) and r.named_zero_lines == (named.orl_quantity == 0).sum()
            assert r.has_accessory == (mine.prt_no == "AE750").any()
            assert r.dates_differ == (mine.orl_req_dt.nunique() > 1)


def test_store_follows_its_batches(spark):
    before, log, now = random_log(3, 8, 300)
    tabs = tables(spark, order_line=list(before.values()))
    store = counted.Store(spark, f"{shared_folder(spark)}/counts-{uuid4().hex}", counted.LINES)
    store.begin(tabs)

    def check(upto):
        held = {"order_line": table(spark, "order_line", *replay(before, log, upto))}
        columns = ["ord_no", *counted.LINES.facts]
        want = facts.line_facts(held).select("ord_no", *[
            F.coalesce(c, F.lit(False)).alias(c) if c.startswith(("has", "dates")) else F.col(c) for c in counted.LINES.facts])
        assert sorted(map(tuple, store.facts().select(columns).collect())) == sorted(map(tuple, want.collect()))

    check(0)
    for batch, (low, high) in enumerate([(0, 100), (100, 101), (101, 200)], 1):
        part = feed(spark, "order_line", *[x for x in log if low < x[0] <= high]) if batch != 2 else feed(
            spark, "order_line", *[x for x in log if x[0] == 101])
        store.apply(part, tabs, batch)
        store.apply(part, tabs, batch)  # a batch that runs again replaces itself
        check(high)
    store.compact()
    check(200)
    store.apply(feed(spark, "order_line", *[x for x in log if x[0] > 200]), tabs, 4)
    check(300)
    keys = spark.createDataFrame([(1,), (99,)], "ord_no long")
    assert [r.ord_no for r in store.facts(keys).collect()] == [1]
    # A batch is as large as what it touched.
    moved = spark.read.parquet(f"{store.path}/batch=4")
    assert moved.count() <= len({n["ord_no"] for x in log if x[0] > 200 for n in x[1:] if n})
    assert held_before_is_before(spark, before, log, now)


def held_before_is_before(spark, before, log, now):
    tabs = tables(spark, order_line=list(now.values()))
    found = counted.held_before(tabs, "order_line", ["orl_id"], feed(spark, "order_line", *log))
    return sorted(map(str, found.collect())) == sorted(map(str, table(spark, "order_line", *before.values()).collect()))


def test_windows_hold_one_bucket_of_a_key(spark):
    moves = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("change_seq"), F.lit(1).cast("decimal(38,0)").alias("n"))
    asks = spark.range(0, 1000, 10).select(F.lit(1).alias("k"), F.col("id").alias("change_seq"))
    found = counted.later(asks, moves, ["k"], ["n"], per_bucket=10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert {r.change_seq: int(r.n) for r in found.collect()} == {i: 999 - i for i in range(0, 1000, 10)}
    assert plan.count("Window [") == 2 and "windowspecdefinition(k#" in plan and "bucket#" in plan


def test_all_history_names_are_known():
    for changed, by_fact in counted.BY_FACT.items():
        assert changed in TABLES and change_schema(changed)
        assert all(c.table in TABLES for c in by_fact.values())
