"""How much is written and shuffled: tables that are views, references looked up alone, lone alerts told by a hash."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.star_mapping import MAPPING, VIEWS, StarTables
from tests.builders import table
from tripwire.functions.frames import TASK_BYTES, shared_folder, tune, written
from tripwire.operators import counted, enrich, suppress
from tripwire.operators.kits import LINE_COLUMNS, with_lines_of


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Forty orders of seven lines, and ten parts."""
    folder = str(tmp_path_factory.mktemp("star"))
    made = {
        "orders": "id o_orderkey, id % 5 o_custkey, 'O' o_orderstatus, 10.5D o_totalprice, timestamp_ntz'2024-01-01 00:00:00' o_orderdate, '2-HIGH' o_orderpriority",
        "part": "id p_partkey, 'PROMO' p_type, 3 p_size",
        "lineitem": "id div 7 l_orderkey, id % 7 + 1 l_linenumber, id % 10 l_partkey, id % 3 l_suppkey, 2.0D l_quantity, timestamp_ntz'2024-02-01 00:00:00' l_shipdate",
    }
    for name, size in (("orders", 40), ("part", 10), ("lineitem", 280)):
        # Dealt out over files, so that an order's lines do not lie together by chance.
        spark.range(size).selectExpr(made[name].split(", ")).repartition(4, F.rand(7)).write.parquet(f"{folder}/{name}.parquet")
    return StarTables(spark, folder)


def _kept_tables(spark) -> set[str]:
    return {p.name for p in Path(shared_folder(spark).removeprefix("file:")).rglob("erp_*")}


def test_tables_derived_row_by_row_are_not_written_again(spark, star):
    before = _kept_tables(spark)
    billed, invoices = star.flat("erp_invoicing_line"), star.flat("erp_invoicing")
    assert invoices.count() == 40 and billed.count() == star.flat("erp_order_line").count() > 280
    assert billed.inputFiles() and set(billed.inputFiles()) == set(star.flat("erp_order_line").inputFiles())
    assert _kept_tables(spark) - before <= set(MAPPING) - VIEWS


def test_lines_lie_by_order(spark, star):
    lines = star.flat("erp_base_line")
    places = lines.select("ord_no", F.input_file_name().alias("place")).distinct()
    files = places.select("place").distinct().count()
    # Each range shares at most its first order with the one before.
    assert lines.count() == 280 and places.count() <= 40 + files - 1


def test_written_tables_are_packed_and_tasks_are_small_unless_the_session_says(spark):
    assert all(".zstd." in f for f in written(spark.range(5)).inputFiles())
    key, value = TASK_BYTES
    was = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert tune(spark).conf.get(key) == value
        spark.conf.set(key, "3m")
        assert tune(spark).conf.get(key) == "3m"
    finally:
        spark.conf.set(key, was or value)


def test_references_go_through_tables_alone_and_once(spark, monkeypatch):
    asked = []

    def spy(self, alerts, tables, call=enrich.Lookup.__call__):
        asked.append(alerts)
        return call(self, alerts, tables)

    monkeypatch.setattr(enrich.Lookup, "__call__", spy)
    tables = {
        "order_header": spark.createDataFrame([(1, 7), (2, 8), (2, 9)], "ord_no long, cli_id long"),
        "client": spark.createDataFrame([(7, "seven"), (8, "eight"), (9, "nine")], "cli_id long, cli_name1 string"),
    }
    alerts = spark.createDataFrame(
        [("ord_no", "1", "a"), ("ord_no", "1", "b"), ("ord_no", "2", "a"), ("ord_no", "3", "a"), ("ord_no", "no number", "a"), (None, "1", "a")],
        "ref_type string, reference string, alert string")
    got = enrich.enrich(alerts, tables, {"ord_no"}).select("reference", "alert", "ord_no", "client_name")
    # A key that stands twice in its table gives two rows, as a join does.
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("1", "a", 1, "seven"), ("1", "b", 1, "seven"), ("2", "a", 2, "eight"), ("2", "a", 2, "nine"), ("3", "a", 3, None),
        ("no number", "a", None, None), ("1", "a", None, None)], key=str)
    assert asked[0].columns == ["ord_no"] and sorted(r.ord_no for r in asked[0].collect()) == [1, 2, 3]


def test_lone_alerts_meet_no_key(spark, monkeypatch):
    met = []

    def spy(points, *args, call=suppress.accepted_times):
        met.append(points.count())
        return call(points, *args)

    monkeypatch.setattr(suppress, "accepted_times", spy)
    noon = datetime(2024, 1, 1, 12)
    events = [(n, f"lone{n}", noon) for n in range(50)] + [(50, "twin", noon), (51, "twin", noon), (52, None, noon), (53, None, noon + timedelta(minutes=1))]
    events += [(60 + n, "again", noon + timedelta(minutes=40 * n)) for n in range(4)]
    frame = spark.createDataFrame(events, "n int, k string, t timestamp_ntz")
    got = {r.n: r.disposition for r in suppress.suppress(frame, key=["k"], ts="t").collect()}
    assert len(got) == len(events) and {n for n, d in got.items() if d != "accepted"} == {61, 63}
    assert met == [4]
    log = spark.createDataFrame([("lone3", noon - timedelta(minutes=5)), ("again", noon - timedelta(minutes=30))], "k string, t timestamp_ntz")
    got = {r.n: r.disposition for r in suppress.suppress(frame, key=["k"], ts="t", log=log).collect()}
    assert {n for n, d in got.items() if d != "accepted"} == {3, 60, 62}


def test_reports_get_the_lines_they_read(spark):
    lines = table(spark, "order_line", {"ord_no": 1, "orl_id": 10}, {"ord_no": 2, "orl_id": 20})
    cut = with_lines_of({"order_line": lines}, spark.createDataFrame([(1,)], "ord_no long"))["order_line"]
    assert cut.columns == LINE_COLUMNS and [r.orl_id for r in cut.collect()] == [10]


def test_conditions_count_in_longs_and_numbers_add_up_in_decimals(spark):
    lines = table(spark, "order_line", *[{"ord_no": 1, "orl_id": 10 + n, "orl_req_dt": date(9999, 12, 31)} for n in range(3)])
    state = counted.LINES.state({"order_line": lines})
    kinds = dict(state.dtypes)
    assert kinds["lines"] == kinds["zero"] == "bigint" and kinds["days"] == kinds["days_squared"] == "decimal(38,0)"
    assert [r.dates_differ for r in counted.LINES.as_facts(state).collect()] == [False]
