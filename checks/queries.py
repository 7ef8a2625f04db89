"""One query per operator, over the mapped tables of a testdata directory."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.star_mapping import StarTables
from tripwire.functions.frames import shared_folder, tune, written
from tripwire.operators import counted, enrich, facts, kits, outbox, payload, suppress
from tripwire.plans import evaluate, pipeline
from tripwire.plans.rules import CATALOGUE
from tripwire.schemas import table_schema
from tripwire.sources import changes, notifications, sinks
from tripwire.sources.changes import diff
from tripwire.sources.snapshots import normalise, text_flag
from tripwire.streaming.suppress_stream import suppress_stream

Query = Callable[[SparkSession, str], DataFrame]

SNAPSHOTS = [
    "order_header", "order_line", "client", "part", "part_group", "part_kit", "invoicing",
    "planning_lot_quantity", "planning_lot_detailed", "bill_of_materials_mat", "part_quantity",
    "part_transaction", "part_supplier", "supplier", "purchase_order_header",
    "purchase_order_line", "blanket_orders",
]

ROUTING = outbox.Routing(
    users={"USR1": "planner_one", "USR2": "buyer_two"},
    creators={"U0": "planner_one", "U1": "front_desk"},
    initials={"AA": "purchasing_lead", "BB": "planner_one", "CC": "buyer_two"},
    addresses={"sales": "sales@example.org", "admin": "admin@example.org"},
)


class Tables(dict):
    """Snapshots by name, built when first asked for."""

    def __init__(self, star: StarTables):
        super().__init__()
        self.star = star

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.star.snapshot(name)
        return self[name]


def open_tables(spark: SparkSession, sf_dir: str) -> tuple[StarTables, Tables]:
    star = StarTables(tune(spark), sf_dir)
    return star, Tables(star)


def _on_tables(build: Callable[[StarTables, Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(*open_tables(spark, sf_dir))


def _rule(table: str, alert: str) -> Query:
    return _on_tables(lambda star, t: evaluate.evaluate(star.changes(table), table, t, [alert]))


def order_alerts(star: StarTables, tables: Tables) -> DataFrame:
    """The flagship: all sixteen order rules in one pass over the order changes."""
    return evaluate.evaluate(star.changes("order_header"), "order_header", tables)


def line_feed(star: StarTables) -> DataFrame:
    """The changes of order lines that led to the mapped lines."""
    flat = normalise(star.flat("erp_line_feed"), "order_line").withColumn("old_prt_no", F.rtrim("old_prt_no"))
    columns = table_schema("order_line").names
    image = lambda before: F.struct(*[
        F.col(f"old_{c}" if before and f"old_{c}" in flat.columns else c).alias(c) for c in columns])
    return flat.select(
        "op", F.col("change_seq").cast("long").alias("change_seq"),
        F.when(F.col("op") != "INSERT", image(True)).alias("old"), F.when(F.col("op") != "DELETE", image(False)).alias("new"))


ASOF_ALERTS = ["ZERO QUANTITY", "COMPLETED BLANKET", "NOT RESERVED", "LINE DATES", "MISSING AE750", "TRUCK SHIPMENT"]


def _asof_order_alerts(star: StarTables, tables: Tables) -> DataFrame:
    """Each order changes before, among and after the changes of its lines; rules see the lines of that moment."""
    header = star.changes("order_header")
    feed = header.withColumn("change_seq", F.explode(F.array(*[F.col("change_seq") * 1000 + n for n in (1, 450, 900)])))
    return evaluate.evaluate(feed, "order_header", tables, ASOF_ALERTS, history={"order_line": line_feed(star)})


def _facts_incremental(star: StarTables, tables: Tables) -> DataFrame:
    """Facts of the lines as they were, moved by three batches of changes; folded into one table after the second."""
    feed = line_feed(star)
    before = {**tables, "order_line": counted.held_before(tables, "order_line", ["orl_id"], feed)}
    store = counted.Store(star.spark, f"{shared_folder(star.spark)}/counts-{uuid4().hex}", counted.LINES)
    store.begin(before)
    place = F.col("change_seq") % 1000
    store.apply(feed.filter(place < 300), tables, 1)
    store.apply(feed.filter((place >= 300) & (place < 600)), tables, 2)
    store.compact()
    store.apply(feed.filter(place >= 600), tables, 3)
    return store.facts()


def candidates(star: StarTables) -> DataFrame:
    """The repeating alerts of the event stream, with user and station; null where unreadable."""
    flat = star.flat("erp_alert_candidates").withColumnRenamed("commit_ts", "time_stamp")
    return payload.read_session(flat).drop("malformed", "app_name")


def payloads(star: StarTables) -> DataFrame:
    """The same alerts as payload texts; some have a field too few or too many."""
    a = star.flat("erp_alert_candidates")
    text = payload.encode_payload(F.col("ref_type"), F.col("reference"), F.col("alert"), F.col("app_name"))
    seq = F.col("change_seq")
    return a.select(
        "change_seq",
        F.when(seq % 40 == 7, F.concat("ref_type", F.lit(", "), "reference"))
        .when(seq % 40 == 8, F.concat(text, F.lit(", more")))
        .otherwise(text).alias("payload"),
    )


def _suppressed(fold_rows: int) -> Query:
    return _on_tables(lambda star, t: suppress.suppress(
        star.flat("erp_alert_candidates").select("change_seq", "commit_ts", "alert", "reference"),
        key=["alert", "reference"], ts="commit_ts", fold_rows=fold_rows,
    ).select("change_seq", "disposition"))


def _suppress_seeded(star: StarTables, tables: Tables) -> DataFrame:
    log = star.flat("erp_prior_log")
    return suppress.suppress(candidates(star), log=log).select("change_seq", "disposition")


def _duplicate_probe(star: StarTables, tables: Tables) -> DataFrame:
    rows = candidates(star)
    return suppress.is_duplicate(rows, rows.drop("change_seq")).select("change_seq", "is_duplicate")


def _last_logged(star: StarTables, tables: Tables) -> DataFrame:
    return suppress.last_logged(candidates(star))


def _payload_encode(star: StarTables, tables: Tables) -> DataFrame:
    return payloads(star)


def _payload_parse(star: StarTables, tables: Tables) -> DataFrame:
    return payload.parse_payload(payloads(star)).drop("payload")


def _snapshot_diff(star: StarTables, tables: Tables) -> DataFrame:
    """The open orders before and after: some close, some reopen, some change."""
    flat = star.flat("erp_order_header")
    before = flat.select("ord_no", F.col("old_ord_status").alias("ord_status"), F.col("old_ord_type").alias("ord_type"))
    after = flat.select("ord_no", "ord_status", "ord_type")
    open_order = F.col("ord_status") != "C"
    changes = diff(
        before.filter(open_order), after.filter(open_order), ["ord_no"],
        F.lit(None).cast("timestamp_ntz"), F.lit(""),
    )
    return changes.select(
        "op", F.coalesce("new.ord_no", "old.ord_no").alias("ord_no"),
        F.col("old.ord_status").alias("old_status"), F.col("new.ord_status").alias("new_status"),
    )


def _order_facts(star: StarTables, tables: Tables) -> DataFrame:
    flags = [
        "has_unready_line", "has_zero_line", "has_unreserved_line", "has_accessory",
        "needs_accessory", "needs_truck",
    ]
    found = facts.order_facts(tables)
    return found.select(
        "ord_no", "named_lines", "named_zero_lines",
        F.coalesce("dates_differ", F.lit(False)).alias("dates_differ"),
        *[F.coalesce(f, F.lit(False)).alias(f) for f in flags],
    )


def _report(report: Callable, line_text: Callable) -> Query:
    def build(star: StarTables, tables: Tables) -> DataFrame:
        def kit_text(k):
            lines = F.array_join(F.transform(k.lines, line_text), ",")
            return F.concat(k.orl_sort_idx, F.lit("/"), k.prt_no, F.lit("["), lines, F.lit("]"))

        return report(tables).select(
            "ord_no", F.array_join(F.transform("kits", kit_text), " ").alias("report")
        )

    return _on_tables(build)


def _lookup(table: str, key: str, out: str, *lookups: enrich.Lookup) -> Query:
    """Looks an attribute up for every key of a table."""
    def build(star: StarTables, tables: Tables) -> DataFrame:
        keys = tables[table].select(key).distinct()
        return enrich.look_up(keys, tables, *lookups).select(key, out)

    return _on_tables(build)


def _raised_blankets(star: StarTables, tables: Tables) -> DataFrame:
    """The orders for which an existing blanket was raised."""
    raised = evaluate.evaluate(star.changes("order_header"), "order_header", tables, ["EXISTING BLANKET"])
    return written(raised.select(F.col("reference").cast("long").alias("ord_no")).distinct())


def _existing_blankets(star: StarTables, tables: Tables) -> DataFrame:
    return kits.existing_blankets(tables, _raised_blankets(star, tables))


def _order_blankets(star: StarTables, tables: Tables) -> DataFrame:
    return outbox.blanket_listing(tables, _raised_blankets(star, tables)).select("ord_no", "listing")


def _outbox_lines(star: StarTables, tables: Tables) -> DataFrame:
    names = list(outbox.LISTINGS)
    gated, _ = _delivered(star, tables, "order_header", names)
    return outbox.list_lines(gated.filter("disposition = 'accepted'"), tables, set(names))


def _repeated_keys(star: StarTables, tables: Tables) -> DataFrame:
    return enrich.repeated_keys({lookup.table: tables[lookup.table] for lookup in enrich.BY_PRIMARY_KEY})


def _stored(star: StarTables, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(star.spark)}/{name}-{uuid4().hex}"


def _read_changes(star: StarTables, tables: Tables) -> DataFrame:
    """A feed as another system writes it: flags as text, padded part numbers, a transaction per ten orders."""
    path, feed = _stored(star, "feed"), star.changes("order_header")
    texts = [f.name for f in table_schema("order_header") if f.dataType.simpleString() == "boolean"]
    for image in ("old", "new"):
        feed = feed.withColumn(image, F.col(image).withField(
            texts[0], F.when(F.col(f"{image}.{texts[0]}"), "t").otherwise("f")))
    feed.withColumn("txn_id", F.col("change_seq") % 10).write.json(path)
    read = changes.read_changes(star.spark, path, "json", table="order_header")
    return read.select("change_seq", "op", "txn_id", F.col("new.ord_no"), F.col("new.ord_bo_accptd"),
                       F.col("old.ord_status").alias("old_status"), F.col("new.ord_date").cast("string").alias("ord_date"))


def _read_payloads(star: StarTables, tables: Tables) -> DataFrame:
    """Notification lines with their time; every fiftieth time is unreadable."""
    path = _stored(star, "payloads")
    texts = payloads(star).join(star.flat("erp_alert_candidates").select("change_seq", "commit_ts"), "change_seq")
    time = F.when(F.col("change_seq") % 50 == 3, "soon").otherwise(F.col("commit_ts").cast("string"))
    texts.select(F.concat(time, F.lit("\t"), F.coalesce("payload", F.lit("")))).write.text(path)
    parsed = payload.parse_payload(notifications.read_payloads(star.spark, path))
    return parsed.select("time_stamp", "ref_type", "reference", "alert", "user_name", "station", "malformed")


def _alert_log(star: StarTables, tables: Tables) -> DataFrame:
    """Two batches into the log; the first is repeated with other rows and replaced as a whole."""
    path, rows = _stored(star, "log"), candidates(star)
    early = F.col("change_seq") % 2 == 0
    sinks.append_alerts(rows, path, "events", 1)
    sinks.append_alerts(rows.filter(early), path, "events", 1)
    sinks.append_alerts(rows.filter(~early), path, "events", 2)
    return sinks.read_log(star.spark, path)


def _outbox_table(star: StarTables, tables: Tables) -> DataFrame:
    path = _stored(star, "outbox")
    _, messages = _delivered(star, tables, "invoicing", ["SHIPPING COST MISSING"])
    sinks.write_batch(messages, path, "invoicing", 1)
    return star.spark.read.parquet(path).select("time_stamp", "alert", "reference", "to_header", "subject", "body")


def _suppress_stream(star: StarTables, tables: Tables) -> DataFrame:
    """The event stream's alerts, null keys among them, through the stateful operator in one run."""
    source, target = _stored(star, "stream"), _stored(star, "judged")
    candidates(star).withColumn("time_stamp", F.col("time_stamp").cast("timestamp")).write.parquet(source)
    stream = star.spark.readStream.schema(star.spark.read.parquet(source).schema).parquet(source)
    query = suppress_stream(stream).writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", _stored(star, "state")).trigger(availableNow=True).start(target)
    query.awaitTermination()
    return star.spark.read.parquet(target).select("change_seq", "disposition")


def _suppress_out_of_order(star: StarTables, tables: Tables) -> DataFrame:
    """The same alerts in three micro-batches, each of which spans the whole time."""
    source, target = _stored(star, "batches"), _stored(star, "judged")
    rows = candidates(star).withColumn("time_stamp", F.col("time_stamp").cast("timestamp"))
    for batch in range(3):
        rows.filter(F.col("change_seq") % 3 == batch).coalesce(1).write.mode("append").parquet(source)
    stream = star.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = suppress_stream(stream).writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", _stored(star, "state")).trigger(availableNow=True).start(target)
    query.awaitTermination()
    return star.spark.read.parquet(target).select("change_seq", "disposition")


def _alerts_of(star: StarTables, tables: Tables, table: str, *names: str) -> DataFrame:
    raised = evaluate.evaluate(star.changes(table), table, tables, list(names))
    alerts = payload.read_session(raised).withColumnRenamed("commit_ts", "time_stamp")
    return written(alerts.filter(~F.col("malformed")).select(*pipeline.ALERT_COLUMNS))


def _enrich_orders(star: StarTables, tables: Tables) -> DataFrame:
    alerts = _alerts_of(star, tables, "order_header", "ORDER CANCELLED", "NEW BLANKET", "ZERO BANK FEES")
    return enrich.enrich(alerts, tables, {"ord_no"}).select("alert", "reference", "ord_no", "client_name")


def _delivered(star: StarTables, tables: Tables, table: str, names: list[str], routing: outbox.Routing = ROUTING):
    """Unsuppressed alerts through lookups, gates and rendering."""
    return pipeline.deliver(
        _alerts_of(star, tables, table, *names), tables, routing, *pipeline.kinds(names)
    )


def _gate(table: str, alert: str) -> Query:
    def build(star: StarTables, tables: Tables) -> DataFrame:
        gated, _ = _delivered(star, tables, table, [alert])
        return gated.select("reference", "change_seq", "disposition")

    return _on_tables(build)


def _messages(table: str, *names: str, routing: outbox.Routing = ROUTING) -> Query:
    return _on_tables(lambda star, t: _flat_messages(_delivered(star, t, table, list(names), routing)[1]))


def _flat_messages(messages: DataFrame) -> DataFrame:
    return messages.withColumn("recipients", F.array_join("recipients", ";"))


def _handled(star: StarTables, tables: Tables) -> pipeline.Outcome:
    return pipeline.run({name: star.changes(name) for name in CATALOGUE}, tables, ROUTING)


def _text_flags(star: StarTables, tables: Tables) -> DataFrame:
    """Order statuses read as flags: F is one, the others are none."""
    return star.raw("orders").select("o_orderkey", text_flag(F.col("o_orderstatus")).alias("flag"))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for table, (rules, _) in CATALOGUE.items():
        for rule in rules:
            name = f"r{rule.number:02d}_{rule.alert.lower().replace(' ', '_')}"
            found[name] = _rule(table, rule.alert)
    found = dict(sorted(found.items()))
    found.update({
        "order_alerts": _on_tables(order_alerts),
        "asof_order_alerts": _on_tables(_asof_order_alerts),
        "facts_incremental": _on_tables(_facts_incremental),
        "all_alerts": _on_tables(lambda star, t: evaluate.evaluate_all(
            {name: star.changes(name) for name in CATALOGUE}, t)),
        "order_facts": _on_tables(_order_facts),
        "normalise_part": _on_tables(lambda star, t: t["part"]),
        "normalise_flags": _on_tables(_text_flags),
        "kit_parents": _on_tables(lambda star, t: kits.kit_parents(t)),
        "kit_child_lines": _on_tables(lambda star, t: kits.kit_child_lines(t)),
        "kit_quantity_errors": _on_tables(lambda star, t: kits.kit_quantity_errors(t)),
        "existing_blankets": _on_tables(_existing_blankets),
        "missing_component_report": _report(
            kits.missing_component_report, lambda l: F.concat(l.orl_sort_idx, F.lit(":"), l.prt_no)
        ),
        "multiplier_report": _report(
            kits.multiplier_report,
            lambda l: F.concat(l.orl_sort_idx, F.lit(":"), l.prt_no, F.lit("="), l.fixed_qty),
        ),
        "suppress_greedy": _suppressed(suppress.FOLD_ROWS),
        "suppress_hot_alerts": _suppressed(4),
        "suppress_seeded": _on_tables(_suppress_seeded),
        "duplicate_probe": _on_tables(_duplicate_probe),
        "last_logged": _on_tables(_last_logged),
        "payload_encode": _on_tables(_payload_encode),
        "payload_parse": _on_tables(_payload_parse),
        "snapshot_diff": _on_tables(_snapshot_diff),
        "lookup_order_client": _lookup("order_line", "ord_no", "cli_id", enrich.ORDER_CLIENT),
        "lookup_line_order": _lookup("planning_lot_quantity", "orl_id", "ord_no", enrich.LINE_ORDER),
        "lookup_client_name": _lookup("order_header", "cli_id", "client_name", enrich.CLIENT_NAME),
        "lookup_packing_slip_order": _lookup("invoicing", "inv_pckslp_no", "ord_no", enrich.PACKING_SLIP_ORDER),
        "lookup_invoice_order": _lookup("invoicing", "inv_no", "ord_no", enrich.INVOICE_ORDER),
        "lookup_transaction_part": _lookup("part_transaction", "ptn_id", "part_no", enrich.TRANSACTION_PART),
        "lookup_transaction_text": _lookup("part_transaction", "ptn_id", "description", enrich.TRANSACTION_TEXT),
        "lookup_lot_part": _lookup("planning_lot_detailed", "plq_lot_no", "part_no", enrich.LOT_PART),
        "lookup_order_blankets": _on_tables(_order_blankets),
        "lookup_po_number": _lookup(
            "purchase_order_line", "pul_id", "puh_no", enrich.PO_LINE_ORDER, enrich.PO_NUMBER
        ),
        "lookup_po_line_part": _lookup("purchase_order_line", "pul_id", "part_no", enrich.PO_LINE_PART),
        "lookup_po_reference": _lookup("purchase_order_header", "puh_no", "po_reference", enrich.PO_REFERENCE),
        "lookup_po_supplier": _lookup(
            "purchase_order_header", "puh_no", "supplier_name", enrich.PO_SUPPLIER_ID, enrich.SUPPLIER_NAME
        ),
        "lookup_po_creator": _lookup("purchase_order_header", "puh_no", "creator", enrich.PO_CREATOR),
        "enrich_order_context": _on_tables(_enrich_orders),
        "gate_multiplier": _gate("order_header", "COMPONENT MULTIPLIER"),
        "gate_reception": _gate("purchase_order_line", "RECEPTION"),
        "gate_missing_supplier": _gate("purchase_order_line", "MISSING SUPPLIER"),
        "gate_unhandled": _gate("part_quantity", "CHANGED PART QUANTITY"),
        "outbox_orders": _messages(
            "order_header", "ZERO QUANTITY", "NOT RESERVED", "ORDER CANCELLED", "NEW BLANKET", "LINE DATES"
        ),
        "outbox_invoices": _messages("invoicing", "SHIPPING COST MISSING", "UNSENT INVOICE EMAIL"),
        "outbox_blankets": _messages("order_header", "EXISTING BLANKET"),
        "outbox_components": _messages("order_header", "MISSING COMPONENT"),
        "outbox_multipliers": _messages("order_header", "COMPONENT MULTIPLIER"),
        "outbox_purchasing": _messages(
            "purchase_order_line", "RECEPTION", "MISSING SUPPLIER", "OVER RECEPTION"
        ),
        "outbox_user_route": _messages("planning_lot_detailed", "UNCHECKED NEED CALCULATION"),
        "outbox_dev_override": _messages(
            "part_transaction", "NEGATIVE QUANTITY", routing=outbox.Routing(dev=True)
        ),
        "outbox_lines": _on_tables(_outbox_lines),
        "repeated_keys": _on_tables(_repeated_keys),
        "read_changes": _on_tables(_read_changes),
        "read_payloads": _on_tables(_read_payloads),
        "alert_log": _on_tables(_alert_log),
        "outbox_table": _on_tables(_outbox_table),
        "suppress_stream": _on_tables(_suppress_stream),
        "suppress_out_of_order": _on_tables(_suppress_out_of_order),
        "pipeline_dispositions": _on_tables(lambda star, t: _handled(star, t).alerts),
        "pipeline_messages": _on_tables(lambda star, t: _flat_messages(_handled(star, t).messages)),
    })
    return found
