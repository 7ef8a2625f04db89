"""Messages for accepted alerts: recipients, text, envelope."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.functions.frames import join_unique, written
from tripwire.operators import kits
from tripwire.plans.templates import NOUN_MANY, NOUN_ONE, PLACEHOLDERS, template_table

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Routing:
    """Who gets what. All values are the deployment's own; roles stand in for people.

    ``users`` and ``creators`` map user codes to roles; ``initials`` maps
    initials found in a purchase reference to the roles that get a copy.
    Every mapping is configuration of fixed size.
    """

    users: dict[str, str] = field(default_factory=dict)
    creators: dict[str, str] = field(default_factory=dict)
    initials: dict[str, str] = field(default_factory=dict)
    addresses: dict[str, str] = field(default_factory=dict)
    sender: str = "noreply"
    admin: str = "admin"
    dev: bool = False

    def address(self, role: Column) -> Column:
        """The address of a role; the role's own name where none is set."""
        return F.coalesce(_choose(role, self.addresses), role)


def _choose(value: Column, mapping: dict[str, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for key, result in mapping.items():
        chosen = F.when(value == key, result).otherwise(chosen)
    return chosen


def route(messages: DataFrame, routing: Routing) -> DataFrame:
    """Adds ``to`` and ``cc``, arrays of addresses."""
    to_roles, cc_roles, how = F.col("to_roles"), F.col("cc_roles"), F.col("route")
    user = _choose(F.col("user_name"), routing.users)
    creator = _choose(F.col("creator"), routing.creators)
    to = (
        F.when((how == "user") & user.isNotNull(), F.array(user))
        .when((how == "creator") & creator.isNotNull(), F.array(creator))
        .otherwise(to_roles)
    )
    copies = F.filter(
        F.array(*[
            F.when(F.col("po_reference").contains(text), F.lit(role))
            for text, role in routing.initials.items()
        ]).cast("array<string>"),
        lambda role: role.isNotNull(),
    )
    cc = F.when(how == "creator", F.concat(cc_roles, copies)).otherwise(cc_roles)
    if routing.dev:
        to = cc = F.array(F.lit(routing.admin))
    return messages.withColumns({
        "to": F.transform(to, routing.address), "cc": F.transform(cc, routing.address)
    })


def render(messages: DataFrame) -> DataFrame:
    """Adds ``subject`` and ``body``. Values are never read as placeholders."""
    values = {
        "ref": F.col("reference"), "user": F.col("user_name"), "client": F.col("client_name"),
        "order": F.col("ord_no").cast("string"), "part": F.col("part_no"),
        "description": F.col("description"), "po": F.col("puh_no").cast("string"),
        "supplier": F.col("supplier_name"), "list": F.col("listing"), "noun": F.col("noun"),
    }
    texts = [F.coalesce(values[name], F.lit("")) for name in PLACEHOLDERS]

    def filled(text_format: str) -> Column:
        return F.call_function("format_string", F.col(text_format), *texts)

    return messages.withColumns({"subject": filled("subject_format"), "body": filled("body_format")})


def envelope(messages: DataFrame, routing: Routing) -> DataFrame:
    """Adds the header texts and ``recipients``, everyone the message goes to."""
    bcc = F.array(routing.address(F.lit(routing.admin)))
    return messages.withColumns({
        "from_header": routing.address(F.lit(routing.sender)),
        "to_header": F.array_join("to", ", "),
        "cc_header": F.array_join("cc", ", "),
        "bcc": bcc,
        "recipients": F.concat("to", "cc", bcc),
    })


def _blanket_text(line: Column) -> Column:
    return F.concat(F.lit("Part "), line.prt_no, F.lit(" in blanket order "), line.blanket_ord_no)


def _component_text(line: Column) -> Column:
    return F.concat(F.lit("  line "), line.orl_sort_idx, F.lit(", part "), line.prt_no)


def _multiplier_text(line: Column) -> Column:
    return F.concat(_component_text(line), F.lit(": suggested quantity "), line.fixed_qty)


def _kit_heading(idx: Column, prt_no: Column) -> Column:
    return F.concat(F.lit("Kit line "), idx, F.lit(", part "), prt_no)


def blanket_listing(tables: Tables, orders: DataFrame) -> DataFrame:
    """Per order, the text that lists its parts on blanket orders."""
    text = F.transform(F.array_sort(F.collect_list(F.struct("prt_no", "blanket_ord_no"))), _blanket_text)
    return kits.existing_blankets(tables, orders).groupBy("ord_no").agg(
        F.array_join(text, "\n").alias("listing")
    ).withColumn("noun", F.lit(None).cast("string"))


def _kit_listing(report: DataFrame, line_text) -> DataFrame:
    def section(kit: Column) -> Column:
        heading = _kit_heading(kit.orl_sort_idx, kit.prt_no)
        return F.array_join(F.concat(F.array(heading), F.transform(kit.lines, line_text)), "\n")

    return report.select(
        "ord_no",
        F.array_join(F.transform("kits", section), "\n\n").alias("listing"),
        F.when(F.size("kits") == 1, NOUN_ONE).otherwise(NOUN_MANY).alias("noun"),
    )


def component_listing(tables: Tables, orders: DataFrame) -> DataFrame:
    return _kit_listing(kits.missing_component_report(tables, orders), _component_text)


def multiplier_listing(tables: Tables, orders: DataFrame) -> DataFrame:
    return _kit_listing(kits.multiplier_report(tables, orders), _multiplier_text)


LISTINGS = {
    "EXISTING BLANKET": blanket_listing,
    "MISSING COMPONENT": component_listing,
    "COMPONENT MULTIPLIER": multiplier_listing,
}

# What a message says in place of its list where lists are kept apart.
SEE_LINES = "The list is in the outbox lines of order %s."


def with_listings(
    alerts: DataFrame, tables: Tables, names: set[str] | None = None, inline: bool = True
) -> DataFrame:
    """Adds ``listing`` and ``noun``; one row per alert.

    With ``inline`` a list becomes one text, so an order's list must fit into
    a row; without, the text points to ``list_lines``. Each kind of list is
    written before the next is looked at.
    """
    none = F.lit(None).cast("string")
    listings = {a: build for a, build in LISTINGS.items() if names is None or a in names}
    if not inline:
        listed = F.col("alert").isin(list(listings))
        return alerts.withColumns({
            "listing": F.when(listed, F.format_string(SEE_LINES, F.col("ord_no").cast("string"))),
            "noun": F.when(listed, NOUN_MANY),
        })
    found = alerts.filter(~F.col("alert").isin(list(listings))).withColumns({"listing": none, "noun": none})
    for alert, build in listings.items():
        own = alerts.filter(F.col("alert") == alert)
        listed = join_unique(own, written(build(tables, own.select("ord_no"))), "ord_no", "left")
        found = found.union(listed.select(*alerts.columns, "listing", "noun"))
    return found


# The order of lines in a list: by part for blankets, by place in the order for kits.
LINE_SORT = ["by_part", "by_number", "by_id", "by_line", "by_line_part"]


def _blanket_lines(tables: Tables, orders: DataFrame) -> DataFrame:
    return kits.existing_blankets(tables, orders).select(
        "ord_no", F.col("prt_no").alias("by_part"), F.col("blanket_ord_no").alias("by_number"),
        _blanket_text(F.struct("prt_no", "blanket_ord_no")).alias("text"),
    )


def _kit_lines(rows: DataFrame, line_text) -> DataFrame:
    heading = _kit_heading(F.col("parent_idx"), F.col("parent_prt_no"))
    return rows.select(
        "ord_no", F.col("parent_idx").cast("long").alias("by_number"), F.col("parent_id").alias("by_id"),
        F.col("line.orl_sort_idx").cast("long").alias("by_line"), F.col("line.prt_no").alias("by_line_part"),
        F.when(F.col("line").isNull(), heading).otherwise(line_text(F.col("line"))).alias("text"),
    )


LINES = {
    "EXISTING BLANKET": _blanket_lines,
    "MISSING COMPONENT": lambda t, o: _kit_lines(kits.missing_component_rows(t, o), _component_text),
    "COMPONENT MULTIPLIER": lambda t, o: _kit_lines(kits.multiplier_rows(t, o), _multiplier_text),
}


def list_lines(alerts: DataFrame, tables: Tables, names: set[str] | None = None) -> DataFrame:
    """The lists of ``alerts`` as rows: alert, ord_no, line_no, text.

    Lines are dealt out by ranges of their place, so that a long list lies in
    several partitions. A line's number is its rank there plus the lines of the
    list in the partitions before; no window holds a whole list.
    """
    found = []
    for alert, build in LINES.items():
        if names is None or alert in names:
            orders = alerts.filter(F.col("alert") == alert).select("ord_no")
            found.append(build(tables, orders).withColumn("alert", F.lit(alert)))
    if not found:
        return alerts.sparkSession.createDataFrame([], "alert string, ord_no long, line_no long, text string")
    empty = {c: F.lit(None).cast("string" if "part" in c else "long") for c in LINE_SORT}
    filled = [f.withColumns({c: e for c, e in empty.items() if c not in f.columns}).select(
        "alert", "ord_no", *LINE_SORT, "text") for f in found]
    rows = reduce(DataFrame.unionByName, filled)
    # Written, so that every reader sees a line in the same partition.
    dealt = written(rows.repartitionByRange("alert", "ord_no", *LINE_SORT).withColumn("part", F.spark_partition_id()))
    key = ["alert", "ord_no", "part"]
    counts = dealt.groupBy(*key).agg(F.count("*").alias("lines"))
    before = counts.withColumn("before", F.sum("lines").over(
        Window.partitionBy("alert", "ord_no").orderBy("part")) - F.col("lines")).drop("lines")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*LINE_SORT, "text"))
    return dealt.join(before, key).select("alert", "ord_no", (F.col("before") + rank).alias("line_no"), "text")


OUTBOX = [
    "time_stamp", "alert", "ref_type", "reference", "user_name", "station",
    "from_header", "to_header", "cc_header", "recipients", "subject", "body",
]


def outbox(
    accepted: DataFrame, tables: Tables, routing: Routing,
    names: set[str] | None = None, inline_lists: bool = True,
) -> DataFrame:
    """One ready-to-send message per accepted alert."""
    templates = F.broadcast(template_table(accepted.sparkSession))  # a row per template: 27
    listed = with_listings(accepted, tables, names, inline_lists).join(templates, "alert")
    return envelope(render(route(listed, routing)), routing).select(*OUTBOX)
