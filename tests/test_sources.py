"""Feeds, snapshots, payload files, sinks, and the streamed pipeline."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.builders import SESSION, changes, table, tables
from tripwire.functions.frames import own_folder, shared_folder
from tripwire.operators.outbox import Routing
from tripwire.operators.suppress import suppress
from tripwire.plans import pipeline
from tripwire.plans.evaluate import evaluate
from tripwire.schemas import ALERT_KEY, TABLES
from tripwire.sources.changes import conform, diff, read_changes, stream_changes
from tripwire.sources.notifications import read_payloads, stream_payloads
from tripwire.sources.sinks import append_alerts, read_log, write_batch
from tripwire.sources.snapshots import read_snapshots
from tripwire.streaming import live
from tripwire.streaming.suppress_stream import suppress_stream

DAY = datetime(2024, 1, 15)


def header(ord_no, status, **more):
    return dict(ord_no=ord_no, ord_id=ord_no, ord_status=status, ord_type=1, cli_id=1, **more)


def cancelled(ord_no, at):
    return ("UPDATE", header(ord_no, "C"), header(ord_no, "A"), at)


def test_read_changes_strips_padding_in_both_images(spark, tmp_path):
    row = dict(pul_id=1, prt_no="AE750     ")
    changes(spark, "purchase_order_line", ("UPDATE", row, row), ("INSERT", row, None)).write.parquet(str(tmp_path / "f"))
    out = read_changes(spark, str(tmp_path / "f")).orderBy("change_seq").collect()
    assert (out[0].old.prt_no, out[0].new.prt_no, out[1].old) == ("AE750", "AE750", None)


def test_conform_casts_both_images(spark):
    loose = changes(spark, "part_quantity", ("INSERT", dict(prt_id=1, pqt_real_qty=2), None)).withColumn(
        "new", F.struct(F.lit("7").alias("prt_id"), F.lit(2.5).alias("pqt_real_qty")))
    [r] = conform(loose, "part_quantity").collect()
    assert (r.new.prt_id, str(r.new.pqt_real_qty), r.old) == (7, "2.5000", None)


def test_a_feed_with_flags_as_text(spark, tmp_path):
    path = str(tmp_path / "f")
    feed = changes(spark, "client", ("UPDATE", dict(cli_id=1, cli_active=True), dict(cli_id=1, cli_active=False)))
    for image, text in (("old", "f"), ("new", " True")):
        feed = feed.withColumn(image, F.col(image).withField("cli_active", F.lit(text)))
    feed.withColumn("txn_id", F.lit(9).cast("long")).drop("app_name").write.json(path)
    batch = read_changes(spark, path, "json", table="client")
    query = stream_changes(spark, path, "client", "json").writeStream.format("memory").queryName("text_flags").start()
    query.processAllAvailable()
    query.stop()
    for rows in (batch.collect(), spark.table("text_flags").collect()):
        [r] = rows
        assert (r.old.cli_active, r.new.cli_active, r.new.cli_id, r.txn_id, r.app_name) == (False, True, 1, 9, None)


def test_equal_alerts_of_a_transaction_count_once(spark):
    feed = changes(spark, "order_header", cancelled(1, DAY), cancelled(1, DAY), cancelled(1, DAY), cancelled(1, DAY))
    feed = feed.withColumn("txn_id", F.when(F.col("change_seq") < 2, 5))
    tabs = tables(spark, order_header=[header(1, "C")])
    out = evaluate(feed, "order_header", tabs, ["ORDER CANCELLED"]).collect()
    assert sorted(r.change_seq for r in out) == [0, 2, 3]


def test_a_rewritten_batch_leaves_no_day_of_its_first_attempt(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame(
        [(DAY + timedelta(days=i), *["x"] * 5) for i in range(3)],
        "time_stamp timestamp_ntz, " + ", ".join(f"{c} string" for c in ALERT_KEY))
    append_alerts(rows, path, "client", 0)
    append_alerts(rows, path, "client", 1)
    append_alerts(rows.limit(1), path, "client", 0)
    assert read_log(spark, path).count() == 4
    append_alerts(rows.limit(0), path, "client", 1)
    assert read_log(spark, path).count() == 1


def test_live_run_from_payloads_leaves_no_tables(spark, tmp_path):
    (tmp_path / "p").mkdir()
    lines = [f"2024-01-15 00:{m:02d}:00\tord_no, {n}, NEW BLANKET, {SESSION}" for m, n in ((0, 1), (5, 1), (9, 2))]
    (tmp_path / "p" / "a.txt").write_text("\n".join([*lines, f"soon\tord_no, 1, NEW BLANKET, {SESSION}", "bad"]) + "\n")
    tabs = tables(spark, order_header=[header(1, "A"), header(2, "A")])
    root, before = str(tmp_path / "out"), set(Path(shared_folder(spark).removeprefix("file:")).glob("**/*.parquet"))
    stream = stream_payloads(spark, str(tmp_path / "p"))
    query = live.start_payloads(stream, lambda: tabs, Routing(), root, str(tmp_path / "cp"))
    query.awaitTermination()
    assert query.exception() is None
    found = sorted(r.disposition for r in spark.read.parquet(f"{root}/dispositions").collect())
    assert found == ["accepted", "accepted", "duplicate", "malformed", "malformed"]
    assert sorted(r.subject for r in spark.read.parquet(f"{root}/outbox").collect()) == ["New blanket order 1", "New blanket order 2"]
    assert set(Path(shared_folder(spark).removeprefix("file:")).glob("**/*.parquet")) == before


def test_sources_of_one_root_ask_each_others_log(spark, tmp_path):
    """The same alert from two sources is logged and mailed once; a repeated batch comes to the same result."""
    at = {"mail": [(0, 1), (70, 1), (0, 3)], "desk": [(5, 1), (75, 1), (6, 2)]}
    tabs = tables(spark, order_header=[header(n, "A") for n in (1, 2, 3)])
    root = str(tmp_path / "out")
    for source, rows in at.items():
        (tmp_path / source).mkdir()
        lines = [f"{DAY + timedelta(minutes=m)}\tord_no, {n}, NEW BLANKET, {SESSION}" for m, n in rows]
        (tmp_path / source / "a.txt").write_text("\n".join(lines) + "\n")

    def run(source):
        live.process_payloads(read_payloads(spark, str(tmp_path / source)), 0, source, tabs, Routing(), root)

    def logged():
        rows = read_log(spark, f"{root}/alerts").collect()
        return sorted(((r.time_stamp - DAY).seconds // 60, r.reference) for r in rows)

    run("mail")
    run("desk")
    assert logged() == [(0, "1"), (0, "3"), (6, "2"), (70, "1")]
    assert sorted(r.subject for r in spark.read.parquet(f"{root}/outbox").collect()) == [
        "New blanket order 1", "New blanket order 1", "New blanket order 2", "New blanket order 3"]
    run("desk")
    assert len(logged()) == 4


def test_a_session_without_a_shared_folder_is_told(spark):
    class Context:
        master = "spark://somewhere"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(own_folder(Session))


def test_diff(spark):
    before = table(spark, "part_quantity", *[dict(prt_id=i, pqt_real_qty=1) for i in (1, 2, 3)], dict(prt_id=4))
    after = table(spark, "part_quantity", dict(prt_id=1, pqt_real_qty=1), dict(prt_id=2, pqt_real_qty=9),
                  dict(prt_id=4), dict(prt_id=5, pqt_real_qty=1))
    out = diff(before, after, ["prt_id"], F.lit(DAY).cast("timestamp_ntz"), F.lit(SESSION)).collect()
    assert {(r.op, (r.new or r.old).prt_id) for r in out} == {("UPDATE", 2), ("DELETE", 3), ("INSERT", 5)}


def test_snapshots_by_name(spark, tmp_path):
    for name in TABLES:
        table(spark, name).write.parquet(str(tmp_path / name))
    assert set(read_snapshots(spark, str(tmp_path))) == set(TABLES)


def test_payload_files(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.txt").write_text(f"2024-01-15 00:00:01.5\tord_no, 1, NEW BLANKET, {SESSION}\nbad\n")
    rows = read_payloads(spark, str(tmp_path / "p")).collect()
    assert rows[0].time_stamp == datetime(2024, 1, 15, 0, 0, 1, 500000) and rows[0].payload.startswith("ord_no, 1")
    assert (rows[1].time_stamp, rows[1].payload) == (None, None)

    query = stream_payloads(spark, str(tmp_path / "p"), 1).writeStream.format("memory").queryName("payloads").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("payloads").count() == 2

    tabs = tables(spark, order_header=[header(1, "A")])
    outcome = pipeline.run_payloads(read_payloads(spark, str(tmp_path / "p")), tabs, Routing())
    assert sorted(r.disposition for r in outcome.alerts.collect()) == ["accepted", "malformed"]
    assert [r.subject for r in outcome.messages.collect()] == ["New blanket order 1"]


def test_log_is_partitioned_and_rewriting_a_batch_replaces_it(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_log(spark, path).count() == 0
    rows = spark.createDataFrame(
        [(DAY + timedelta(hours=13 * i), *["x"] * 5) for i in range(4)],
        "time_stamp timestamp_ntz, " + ", ".join(f"{c} string" for c in ALERT_KEY),
    )
    append_alerts(rows, path, "client", 0)
    append_alerts(rows.limit(1), path, "client", 1)
    append_alerts(rows, path, "invoicing", 1)
    append_alerts(rows, path, "client", 0)
    assert read_log(spark, path).count() == 9
    assert read_log(spark, path, "client").count() == 5
    assert read_log(spark, path, "client", before_batch=1).count() == 4
    late = read_log(spark, path, "client", 1, DAY + timedelta(hours=20))
    assert late.count() == 2
    assert "alert_date" in late._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def feed_dir(spark, path, *batches):
    for i, rows in enumerate(batches):
        changes(spark, "order_header", *rows).withColumn(
            "change_seq", F.col("change_seq") + 100 * i).coalesce(1).write.parquet(f"{path}/batch={i}")


BATCHES = [
    [cancelled(1, DAY), cancelled(2, DAY), cancelled(1, DAY + timedelta(minutes=40))],
    [cancelled(1, DAY + timedelta(minutes=50)), cancelled(1, DAY + timedelta(minutes=80)), cancelled(3, DAY)],
    [cancelled(1, DAY + timedelta(minutes=130)), cancelled(1, DAY + timedelta(minutes=141))],
]


def test_streamed_pipeline_equals_the_batch_and_survives_a_repeat(spark, tmp_path):
    feeds = str(tmp_path / "feed")
    feed_dir(spark, feeds, *BATCHES)
    tabs = tables(spark, order_header=[header(n, "C") for n in (1, 2, 3)])
    root = str(tmp_path / "out")
    stream = stream_changes(spark, f"{feeds}/*", "order_header", files_per_trigger=1)
    query = live.start(stream, "order_header", lambda: tabs, Routing(), root, str(tmp_path / "cp"))
    query.awaitTermination()
    assert query.exception() is None

    def written(name, *columns):
        return sorted(tuple(r) for r in spark.read.parquet(f"{root}/{name}").select(*columns).collect())

    columns = ["time_stamp", "reference", "disposition"]
    whole = pipeline.run({"order_header": read_changes(spark, f"{feeds}/*")}, tabs, Routing())
    assert written("dispositions", *columns) == sorted(tuple(r) for r in whole.alerts.select(*columns).collect())
    log = written("alerts", "time_stamp", "reference")
    assert log == sorted((t, r) for t, r, d in written("dispositions", *columns) if d == "accepted")
    assert len(written("outbox", "subject")) == len(log) == 5

    # the last batch once more, as after a failure before its commit
    last = spark.read.parquet(f"{feeds}/batch=2")
    ids = sorted({r.batch_id for r in spark.read.parquet(f"{root}/alerts").select("batch_id").collect()})
    live.process(last, ids[-1], "order_header", tabs, Routing(), root)
    assert written("alerts", "time_stamp", "reference") == log


def test_stateful_suppression_asks_the_log_across_restarts(spark, tmp_path):
    """Micro-batches out of order and a restart after each: every row is judged, by what was logged before it came."""
    columns = "n long, time_stamp timestamp, " + ", ".join(f"{c} string" for c in ALERT_KEY)
    minutes = [[("A", 0), ("A", 40), ("B", 0), ("A", 0)], [("A", 80), ("A", 59), ("B", 59), (None, 1), (None, 2), ("C", -9000)],
               [("A", 139), ("A", 140), ("A", 70), ("B", 60), ("A", -30), ("A", 0), ("C", -9001), ("C", -9000)]]
    source, target, state = (str(tmp_path / d) for d in ("in", "out", "cp"))

    def add(batch):
        rows = [(100 * batch + i, DAY + timedelta(minutes=m), k, "t", "1", "u", "s") for i, (k, m) in enumerate(minutes[batch])]
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(columns).parquet(source)
        query = suppress_stream(stream).writeStream.format("parquet").outputMode("append").option(
            "checkpointLocation", state).trigger(availableNow=True).start(target)
        query.awaitTermination()
        assert query.exception() is None

    for batch in range(3):
        add(batch)
        run()
    out = {r.n: r.disposition for r in spark.read.parquet(target).collect()}
    log, want = [], {}
    for batch, rows in enumerate(minutes):
        for i, (k, m) in sorted(enumerate(rows), key=lambda x: x[1][1]):
            blocked = any(k == key and m - 60 < at < m for key, at in log)
            want[100 * batch + i] = "duplicate" if k is not None and blocked else "accepted"
            log += [] if blocked or k is None else [(k, m)]
    assert out == want and {want[204], want[202], want[205]} == {"accepted", "duplicate"}


def test_whole_pipeline_dispositions(spark):
    feed = changes(
        spark, "order_header", cancelled(1, DAY), cancelled(1, DAY + timedelta(minutes=1)), cancelled(2, DAY),
        ("UPDATE", header(3, "A", prj_no=1), header(3, "A"), DAY),
    ).withColumn("app_name", F.when(F.col("change_seq") == 2, "psql").otherwise(F.col("app_name")))
    stock = changes(spark, "part_quantity", ("UPDATE", dict(prt_id=1, pqt_real_qty=2), dict(prt_id=1, pqt_real_qty=1), DAY))
    lines = changes(spark, "purchase_order_line", (
        "UPDATE", dict(pul_id=1, puh_id=1, prt_no="", pul_rcvd_qty=2), dict(pul_id=1, pul_rcvd_qty=1), DAY))
    tabs = tables(
        spark, order_header=[header(n, "C", ord_date=date(2024, 1, 1)) for n in (1, 2, 3)],
        purchase_order_line=[dict(pul_id=1, puh_id=1)], purchase_order_header=[dict(puh_id=1, puh_no=5, puh_reference="no")],
    )
    outcome = pipeline.run({"order_header": feed, "part_quantity": stock, "purchase_order_line": lines}, tabs, Routing())
    assert sorted((r.alert, r.reference, r.disposition) for r in outcome.alerts.collect()) == [
        ("CHANGED PART QUANTITY", "1", "unhandled"), ("ORDER CANCELLED", "1", "accepted"),
        ("ORDER CANCELLED", "1", "duplicate"), ("ORDER CANCELLED", "2", "malformed"), ("RECEPTION", "1", "gated"),
    ]
    # gated and unhandled alerts are logged, so they suppress their repeats
    assert outcome.log.count() == 3
    assert [r.subject for r in outcome.messages.collect()] == ["Order 1: cancelled"]


def test_write_batch_without_rows(spark, tmp_path):
    empty = table(spark, "part").select(F.lit(DAY).cast("timestamp_ntz").alias("time_stamp"), "prt_no")
    write_batch(empty, str(tmp_path / "o"), "part", 0)
