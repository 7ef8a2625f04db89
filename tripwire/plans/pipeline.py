"""From change feeds to outbox, as one batch."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.functions.frames import written
from tripwire.operators.enrich import enrich
from tripwire.operators.gates import confirm_multipliers, gate_by_columns
from tripwire.operators.kits import with_lines_of
from tripwire.operators.outbox import LISTINGS, Routing, list_lines, outbox
from tripwire.operators.payload import parse_payload, read_session
from tripwire.operators.suppress import ACCEPTED, suppress
from tripwire.plans.evaluate import evaluate_all
from tripwire.plans.rules import CATALOGUE

Tables = Mapping[str, DataFrame]

MALFORMED = "malformed"
ALERT_COLUMNS = ["time_stamp", "alert", "ref_type", "reference", "user_name", "station", "change_seq"]


@dataclass
class Outcome:
    """``alerts`` holds every alert with its disposition; ``log`` those to log.

    ``lines`` holds the messages' lists as rows where these are kept apart, and
    is None where each list is a text inside its message.
    """

    alerts: DataFrame
    log: DataFrame
    messages: DataFrame
    lines: DataFrame | None = None


def raise_alerts(
    changes: dict[str, DataFrame], tables: Tables, history: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Alerts of all feeds with user, station and ``malformed``, as written tables."""
    def finish(alerts: DataFrame) -> DataFrame:
        return read_session(alerts).withColumnRenamed("commit_ts", "time_stamp").select(*ALERT_COLUMNS, "malformed")

    return evaluate_all(changes, tables, history, finish)


def kinds(alerts: list[str] | None = None, tables: list[str] | None = None) -> tuple[set[str], set[str]]:
    """The alerts that given rules or changed tables can raise, and their kinds of reference."""
    rules = [
        r for table, (found, _) in CATALOGUE.items() for r in found
        if (tables is None or table in tables) and (alerts is None or r.alert in alerts)
    ]
    return {r.alert for r in rules}, {r.ref for r in rules}


def deliver(
    logged: DataFrame, tables: Tables, routing: Routing,
    names: set[str] | None = None, refs: set[str] | None = None, inline_lists: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Enriched alerts with the disposition their gates give them, and the messages.

    Each kind of reference, the multipliers' gate and each kind of list are written by themselves, so that
    the driver plans one at a time.
    """
    enriched = enrich(logged, tables, refs, lambda part: written(gate_by_columns(part)))
    if names is None or names & set(LISTINGS):
        listed = enriched.filter(F.col("alert").isin(list(LISTINGS)))
        tables = with_lines_of(tables, listed.select("ord_no"))
    gated = confirm_multipliers(enriched, tables, names)
    return gated, outbox(gated.filter(F.col("disposition") == ACCEPTED), tables, routing, names, inline_lists)


def lists(gated: DataFrame, tables: Tables, names: set[str] | None = None) -> DataFrame:
    """The lists of the accepted alerts, as rows, whatever their length."""
    listed = gated.filter((F.col("disposition") == ACCEPTED) & F.col("alert").isin(list(LISTINGS)))
    if names is None or names & set(LISTINGS):
        tables = with_lines_of(tables, listed.select("ord_no"))
    return list_lines(listed, tables, names)


def handle(
    alerts: DataFrame, tables: Tables, routing: Routing, log: DataFrame | None = None,
    names: set[str] | None = None, refs: set[str] | None = None, inline_lists: bool = True, stored: bool = False,
) -> Outcome:
    """Suppress, enrich, gate and render alerts.

    An alert is logged before the gates: a gated one still suppresses its
    repeats. The judged alerts are written once, as the log, the dispositions
    and the messages all read them. ``names`` and ``refs`` hold what can occur;
    leave them out for alerts of unknown origin. ``stored`` alerts are written already.
    """
    if not stored:
        alerts = written(alerts.select(*ALERT_COLUMNS, "malformed"))
    unreadable = alerts.filter("malformed").drop("malformed").withColumn("disposition", F.lit(MALFORMED))
    judged = written(suppress(alerts.filter(~F.col("malformed")).drop("malformed"), log=log))
    logged = judged.filter(F.col("disposition") == ACCEPTED).drop("disposition")
    gated, messages = deliver(logged, tables, routing, names, refs, inline_lists)
    refused = judged.filter(F.col("disposition") != ACCEPTED)
    return Outcome(
        alerts=unreadable.unionByName(refused).unionByName(gated.select(*ALERT_COLUMNS, "disposition")),
        log=logged,
        messages=messages,
        lines=None if inline_lists else lists(gated, tables, names),
    )


def run(
    changes: dict[str, DataFrame], tables: Tables, routing: Routing, log: DataFrame | None = None,
    history: Mapping[str, DataFrame] | None = None, inline_lists: bool = True,
) -> Outcome:
    """The whole pipeline over change feeds and snapshots; ``history`` as in ``evaluate``.

    Without ``inline_lists`` no list has to fit into one row: see ``Outcome.lines``.
    """
    names, refs = kinds(tables=list(changes))
    return handle(raise_alerts(changes, tables, history), tables, routing, log, names, refs, inline_lists, stored=True)


def run_payloads(
    payloads: DataFrame, tables: Tables, routing: Routing, log: DataFrame | None = None,
    inline_lists: bool = True,
) -> Outcome:
    """The pipeline from notification payloads: columns time_stamp and payload."""
    alerts = parse_payload(payloads)
    if "change_seq" not in alerts.columns:
        alerts = alerts.withColumn("change_seq", F.lit(None).cast("long"))
    return handle(alerts, tables, routing, log, inline_lists=inline_lists)
