"""Plans and skew: no nested loops, no cross joins, hot keys split, columns pruned."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import SNAPSHOTS, line_feed, open_tables
from tests.builders import SESSION, tables
from tripwire.functions.frames import tune
from tripwire.operators import enrich, facts, kits
from tripwire.operators.outbox import Routing
from tripwire.operators.suppress import _chains, accepted_times
from tripwire.plans.evaluate import evaluate, evaluate_all
from tripwire.plans.pipeline import deliver, raise_alerts
from tripwire.plans.rules import CATALOGUE

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def explained(spark, df):
    jvm = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return jvm.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("source", CATALOGUE)
def test_rules_plan_without_nested_loops(spark, no_broadcast, source):
    star, tabs = open_tables(spark, SF)
    plan = plan_of(evaluate(star.changes(source), source, tabs))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("source", CATALOGUE)
def test_rules_broadcast_only_by_size(spark, source):
    star, tabs = open_tables(spark, SF)
    plan = plan_of(evaluate(star.changes(source), source, tabs))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scans_read_only_what_a_rule_needs(spark):
    star, tabs = open_tables(spark, SF)
    df = evaluate(star.changes("order_header"), "order_header", tabs, ["NEW BLANKET"])
    plan = explained(spark, df)
    [schema] = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert "car_name" not in schema and "ord_date" not in schema
    assert "PushedFilters: [" in plan and "EqualTo(ord_type,9)" in plan
    assert "orl_quantity" not in explained(spark, facts.part_facts(tabs))


def test_line_facts_take_one_shuffle(spark, no_broadcast):
    _, tabs = open_tables(spark, SF)
    plan = plan_of(facts.line_facts(tabs))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_" in plan


@pytest.mark.parametrize("build, table, on", [
    (facts.line_facts, "order_line", ["ord_no"]), (facts.client_po_numbers, "order_header", ["inv_cli_id", "ord_cli_ord_no"]),
    (facts.unrun_lots, "planning_lot_quantity", ["orl_id"]), (facts.purchase_suppliers, "purchase_order_header", ["puh_id"])])
def test_many_keys_cut_a_fact_without_another_shuffle(spark, no_broadcast, build, table, on):
    """Keys too many to broadcast meet the combined rows where they lie: one shuffle of the table, one of the keys."""
    _, tabs = open_tables(spark, SF)
    keys = tabs[table].select(*on).distinct()
    plan = plan_of(build(tabs, keys))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("HashAggregate") >= 3 and "LeftSemi" in plan


def test_all_order_rules_shuffle_less_than_once_per_rule_and_table(spark, no_broadcast):
    star, tabs = open_tables(spark, SF)
    plan = plan_of(evaluate(star.changes("order_header"), "order_header", tabs))
    assert plan.count("Exchange hashpartitioning") <= 60


def test_no_plan_holds_the_stages_of_many_facts(spark, no_broadcast):
    """Of seven facts each is computed by itself; what is left is to join their rows. There were 55 shuffles in one plan."""
    star, tabs = open_tables(spark, SF)
    plan = plan_of(evaluate(star.changes("order_header"), "order_header", tabs))
    assert plan.count("Exchange hashpartitioning") <= 16


@pytest.mark.parametrize("build", [evaluate_all, raise_alerts])
def test_no_plan_holds_the_rules_of_several_tables(spark, no_broadcast, build):
    """The alerts of each table are there before the next table is looked at."""
    star, tabs = open_tables(spark, SF)
    feeds = {name: star.changes(name) for name in ("order_header", "invoicing", "planning_lot_detailed")}
    found = build(feeds, tabs)
    assert "Exchange" not in plan_of(found) and found.count() > 0


def test_the_pipeline_s_steps_plan_one_at_a_time(spark, no_broadcast):
    """Alerts with their details are written by kind of reference; messages join written lists."""
    star, tabs = open_tables(spark, SF)
    logged = raise_alerts({"order_header": star.changes("order_header")}, tabs).drop("malformed")
    gated, messages = deliver(logged, tabs, Routing())
    assert "Exchange" not in plan_of(gated)
    assert plan_of(messages).count("Exchange hashpartitioning") <= 6


def test_references_are_followed_before_alerts_move(spark, no_broadcast):
    """The shuffles of four lookups are over when the alerts meet what they found."""
    star, tabs = open_tables(spark, SF)
    alerts = star.changes("purchase_order_line").select(F.col("new.pul_id").alias("pul_id"), "app_name")
    plan = plan_of(enrich.look_up_references(alerts, tabs, "pul_id", *enrich.BY_REFERENCE["pul_id"]))
    assert plan.count("Exchange hashpartitioning") <= 2


def test_counts_as_of_a_change_are_written_step_by_step(spark, no_broadcast):
    star, tabs = open_tables(spark, SF)
    feed = star.changes("order_header")
    plan = plan_of(evaluate(feed, "order_header", tabs, ["NOT RESERVED", "TRUCK SHIPMENT"], history={"order_line": line_feed(star)}))
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") <= 8


def test_shuffles_go_with_their_query(spark):
    assert tune(spark).conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def skewed_shop(spark, n):
    """A shop where one order, client, part and kit line hold a third of all lines."""
    tabs = tables(spark)
    hot = F.col("id") % 3 == 0
    tabs["order_line"] = spark.range(n).select(
        (F.col("id") + 1).alias("orl_id"),
        F.when(hot, 1).otherwise(F.col("id")).cast("long").alias("ord_no"),
        F.when(hot, 1).otherwise(F.col("id")).cast("long").alias("ord_id"),
        F.col("id").alias("orl_sort_idx"),
        F.when(hot, 10).otherwise(F.col("id") % 500).cast("long").alias("prt_id"),
        F.when(hot, "P10").otherwise(F.concat(F.lit("P"), F.col("id") % 500)).alias("prt_no"),
        *[F.lit(v).cast("decimal(15,4)").alias(c) for c, v in [
            ("orl_quantity", 4), ("orl_reserved_qty", 3), ("orl_ship_qty", 0), ("orl_qty_ready", 2)]],
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("orl_req_dt"),
        F.when(hot & (F.col("id") > 0), 1).otherwise(0).cast("long").alias("orl_kitmaster_id"),
    )
    tabs["order_header"] = spark.range(n).select(
        F.col("id").alias("ord_no"), F.col("id").alias("ord_id"),
        F.when(F.col("id") % 3 == 1, 5).otherwise(F.col("id") % 900).cast("long").alias("cli_id"),
        F.when(hot, 5).otherwise(F.col("id") % 900).cast("long").alias("inv_cli_id"),
        F.lit("A").alias("ord_status"), F.when(F.col("id") % 7 == 0, 9).otherwise(1).alias("ord_type"),
        F.lit("2024-01-01").cast("date").alias("ord_date"), F.lit(False).alias("ord_bo_accptd"),
        F.lit(None).cast("long").alias("prj_no"), F.lit(1).alias("ord_pmt_term"),
        F.lit(1).cast("decimal(12,2)").alias("ord_pkg_cost"),
        F.when(hot, "VERBAL").otherwise(F.concat(F.lit("PO"), F.col("id"))).alias("ord_cli_ord_no"),
        F.lit("UPS").alias("car_name"),
    )
    tabs["part"] = spark.range(500).select(
        F.col("id").alias("prt_id"), F.concat(F.lit("P"), F.col("id")).alias("prt_no"), F.lit("ASV 1").alias("prt_sort"),
        F.lit("F").alias("prt_type"), (F.col("id") % 2 == 0).alias("prt_usr_flag1"), F.lit(1).cast("long").alias("pgr_id"))
    tabs["part_group"] = spark.range(1).select(F.lit(1).cast("long").alias("pgr_id"), F.lit("001").alias("pgr_no"))
    # one component is in a third of all kits
    tabs["part_kit"] = spark.range(900).select(
        (F.col("id") % 300).alias("pkt_master_prt_id"),
        F.when(F.col("id") % 3 == 0, 10).otherwise(F.col("id") % 450).cast("long").alias("prt_id"),
        (F.col("id") % 4 + 1).cast("decimal(15,4)").alias("pkt_qty"))
    return tabs


def test_skewed_order_rules_agree_with_sql(spark, no_broadcast):
    """Every order rule on skewed tables, against nested SQL on the same tables."""
    import duckdb

    from checks.oracle import _rules

    tabs = skewed_shop(spark, 3000)
    headers = tabs["order_header"]
    feed = headers.select(
        F.lit("UPDATE").alias("op"), F.lit("2024-01-15").cast("timestamp_ntz").alias("commit_ts"),
        F.col("ord_no").alias("change_seq"), F.lit(SESSION).alias("app_name"),
        F.struct(*headers.columns).alias("old"), F.struct(*headers.columns).alias("new"),
    )
    got = {(r.alert, r.reference) for r in evaluate(feed, "order_header", tabs).collect()}

    con = duckdb.connect()
    for name in ["order_header", "order_line", "part", "part_group", "part_kit"]:
        frame = tabs[name].toPandas()
        if name == "order_header":
            frame = frame.assign(
                op="UPDATE", commit_ts="2024-01-15", change_seq=frame.ord_no, app_name=SESSION,
                old_ord_status=frame.ord_status, old_ord_type=frame.ord_type, prj_no=None)
        con.register("view_" + name, frame)
        con.execute(f"create table erp_{name} as select * from view_{name}")
    for column, kind in [("ord_date", "date"), ("commit_ts", "timestamp")]:
        con.execute(f"alter table erp_order_header alter {column} type {kind}")
    con.execute("alter table erp_order_line alter orl_req_dt type date")
    _, sql = _rules(tables=["order_header"])
    want = {(r[1], r[3]) for r in con.execute(sql).fetchall()}
    assert got == want
    assert {a for a, _ in got} >= {
        "NOT RESERVED", "MISSING AE750", "EXISTING BLANKET", "UNIT DATES", "DUPLICATE PO", "MISSING COMPONENT",
        "COMPONENT MULTIPLIER", "TRUCK SHIPMENT"}


def test_a_hot_join_key_is_split(spark, no_broadcast):
    """Changes of one order fill a third of the feed; the join to its facts splits them."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        tabs = skewed_shop(spark, 3000)
        feed = spark.range(0, 60000, 1, 8).select(
            F.lit("INSERT").alias("op"), F.lit("2024-01-15").cast("timestamp_ntz").alias("commit_ts"),
            F.col("id").alias("change_seq"), F.concat(F.lit(SESSION), F.col("id")).alias("app_name"),
            F.struct(
                F.lit(0).cast("long").alias("inv_orig_inv_no"),
                F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 3000).cast("long").alias("ord_no"),
                F.lit("A").alias("inv_status"), F.lit(1).alias("inv_ship_amnt"), F.lit(1).alias("inv_ship_term"),
                F.col("id").alias("inv_no"), F.lit(1).alias("inv_subtotal"), F.lit(True).alias("inv_inv_email_sent"),
            ).alias("new"),
        ).withColumn("old", F.col("new"))
        df = evaluate(feed, "invoicing", tabs, ["BO NOT ALLOWED"])
        rows = df.collect()
        assert len(rows) == sum(1 for i in range(60000) if i % 3 == 0 or (i % 3000) % 3 != 0)
        assert "skew=true" in plan_of(df)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_suppression_never_sorts_a_key_s_rows(spark):
    """The windows of the batch path run over buckets, which were counted first, not over rows."""
    points = spark.range(1000).select(F.lit("x").alias("k"), (F.col("id") * 60_000_000).alias("at"))
    plan = explained(spark, _chains(points, ["k"], 3_600_000_000))
    tree = plan.split("\n\n")[0]
    assert tree.index("Window") < tree.index("HashAggregate") < tree.index("Range")
    assert "bucket" in re.search(r"Window\b.*?orderBy|windowspecdefinition\(.*?\)", plan, re.S)[0]
    assert [r.at for r in accepted_times(points, ["k"], 3_600_000_000, fold_rows=10).orderBy("at").collect()] == [
        h * 3_600_000_000 for h in range(17)]


def leaves(plan, cut=False):
    """(columns of a scan, whether a semi-join cuts it) for each scan below a logical plan."""
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    if not children:
        yield plan.output().mkString(","), cut
    semi = plan.nodeName() == "Join" and "LeftSemi" in plan.joinType().toString()
    for i, child in enumerate(children):
        yield from leaves(child, cut or (semi and i == 0))


@pytest.mark.parametrize("table, alert, column", [
    ("order_header", r.alert, "orl_") for r in CATALOGUE["order_header"][0] if r.facts and r.alert != "DUPLICATE PO"
] + [("order_header", "DUPLICATE PO", "ord_cli_ord_no"), ("invoicing", "BO NOT ALLOWED", "orl_"),
     ("invoicing_line", "INVOICED PRODUCTION", "plq_"), ("planning_lot_detailed", "UNCHECKED NEED CALCULATION", "plq_adj_flag"),
     ("planning_lot_detailed", "EMPTY BOM PRODUCTION", "pld_lvl"), ("purchase_order_line", "MISSING SUPPLIER", "puh_id")])
def test_facts_read_only_keys_that_changed(spark, table, alert, column):
    """Every scan of a fact's table is cut by a semi-join before it is aggregated."""
    star, tabs = open_tables(spark, SF)
    feed = spark.createDataFrame(star.changes(table).limit(1).collect(), star.changes(table).schema)
    plan = evaluate(feed, table, tabs, [alert])._jdf.queryExecution().optimizedPlan()
    scans = [cut for columns, cut in leaves(plan) if column in columns]
    assert scans and all(scans)


@pytest.mark.parametrize("lookup", [
    enrich.PACKING_SLIP_ORDER, enrich.INVOICE_ORDER, enrich.LOT_PART, enrich.PO_REFERENCE, enrich.PO_SUPPLIER_ID, enrich.PO_CREATOR])
def test_lookups_read_only_keys_asked_for(spark, lookup):
    _, tabs = open_tables(spark, SF)
    keys = spark.createDataFrame([(None,)], f"{lookup.source} {dict(tabs[lookup.table].dtypes)[lookup.key]}")
    plan = lookup(keys, tabs)._jdf.queryExecution().optimizedPlan()
    scans = [cut for columns, cut in leaves(plan) if next(iter(lookup.attrs.values())) in columns]
    assert all(scans)


def test_all_snapshots_are_mapped(spark):
    star, tabs = open_tables(spark, SF)
    assert all(tabs[name].columns for name in SNAPSHOTS)


def test_kit_errors_of_a_hot_kit_line(spark, no_broadcast):
    tabs = skewed_shop(spark, 3000)
    line, kit = ([r.asDict() for r in tabs[t].collect()] for t in ("order_line", "part_kit"))
    parent = {(x["ord_no"], x["orl_id"]): x for x in line}
    ratios = {}
    for k in kit:
        ratios.setdefault((k["pkt_master_prt_id"], k["prt_id"]), set()).add(k["pkt_qty"])
    want = set()
    for x in line:
        p = parent.get((x["ord_no"], x["orl_kitmaster_id"])) if x["orl_kitmaster_id"] else None
        for ratio in ratios.get((p["prt_id"], x["prt_id"]), ()) if p else ():
            if ratio * p["orl_quantity"] != x["orl_quantity"]:
                want.add((x["ord_no"], x["orl_kitmaster_id"], x["orl_sort_idx"], x["prt_no"], round(ratio * p["orl_quantity"])))
    assert {tuple(r) for r in kits.kit_quantity_errors(tabs).collect()} == want
    report = kits.missing_component_report(tabs)
    lines = report.select(F.explode("kits").alias("k")).select(F.explode("k.lines"))
    assert lines.count() == kits.kit_child_lines(tabs).count() > 900


def test_ratios_on_a_hot_order_form_no_pairs(spark, no_broadcast):
    """A third of all lines on one order: its lines meet one row per component."""
    tabs = skewed_shop(spark, 3000)
    found = facts.off_ratio_orders(tabs, spark.createDataFrame([(1,)], "ord_no long"))
    assert [r.ord_no for r in found.collect()] == [1]
    plan = plan_of(found)
    joined = [int(n) for n in re.findall(r"rowCount=(\d+)", plan)]
    assert max(joined, default=0) < 100_000 and "NestedLoop" not in plan and "Cartesian" not in plan
