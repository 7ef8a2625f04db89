"""The pipeline over a streamed change feed, one micro-batch at a time.

Each watched table or source of notifications has its own query. All queries of
a root share its log: an alert that any source logged within the hour before is a
duplicate. The queries of one driver take turns from reading the log to writing
it, so that two of them cannot accept the same alert at once. Sources that share
a root therefore belong into one driver.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping
from datetime import timedelta
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripwire.functions.frames import scratch
from tripwire.operators.outbox import Routing
from tripwire.operators.suppress import HOUR
from tripwire.plans.pipeline import Outcome, run, run_payloads
from tripwire.sources.sinks import append_alerts, read_log, write_batch, write_lines

Tables = Mapping[str, DataFrame]

# One turn at a time for each root.
_TURNS: defaultdict[str, Lock] = defaultdict(Lock)


def process(
    feed: DataFrame, batch_id: int, table: str, tables: Tables, routing: Routing, root: str,
    inline_lists: bool = True,
) -> None:
    """One batch of changes into the log, the dispositions and the outbox.

    Suppression resumes from what earlier batches logged, so a batch that runs
    again after a failure comes to the same result and replaces its own rows.
    Tables written on the way are removed at the end.
    """
    with _TURNS[root], scratch(feed.sparkSession):
        log = _log_since(feed, "commit_ts", batch_id, table, root)
        _store(run({table: feed}, tables, routing, log, inline_lists=inline_lists), batch_id, table, root)


def process_payloads(
    payloads: DataFrame, batch_id: int, source: str, tables: Tables, routing: Routing, root: str,
    inline_lists: bool = True,
) -> None:
    """The same for a batch of notification texts."""
    with _TURNS[root], scratch(payloads.sparkSession):
        log = _log_since(payloads, "time_stamp", batch_id, source, root)
        _store(run_payloads(payloads, tables, routing, log, inline_lists), batch_id, source, root)


def _log_since(rows: DataFrame, time: str, batch_id: int, source: str, root: str) -> DataFrame:
    """What all sources logged from a window before the batch on, but for this batch's own earlier attempts.

    All rows without a time stand alone.
    """
    first = rows.agg(F.min(time)).first()[0]
    since = None if first is None else first - timedelta(seconds=HOUR)
    return read_log(rows.sparkSession, f"{root}/alerts", source=source, before_batch=batch_id, since=since, every_source=True)


def _store(outcome: Outcome, batch_id: int, source: str, root: str) -> None:
    append_alerts(outcome.log, f"{root}/alerts", source, batch_id)
    write_batch(outcome.alerts, f"{root}/dispositions", source, batch_id)
    if outcome.lines is not None:
        write_lines(outcome.lines, f"{root}/outbox_lines", source, batch_id)
    write_batch(outcome.messages, f"{root}/outbox", source, batch_id)


def start(
    feed: DataFrame, table: str, snapshots: Callable[[], Tables], routing: Routing,
    root: str, checkpoint: str, trigger: dict | None = None, inline_lists: bool = True,
) -> StreamingQuery:
    """Run the pipeline on a streamed feed.

    ``snapshots`` is called per batch, so each batch reads the tables as they
    are then. The log, dispositions and outbox go below ``root``; without
    ``inline_lists`` the messages' lists too, as rows of ``outbox_lines``, which
    are there before the messages that point to them.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        process(batch, batch_id, table, snapshots(), routing, root, inline_lists)

    return _started(feed, table, on_batch, checkpoint, trigger)


def start_payloads(
    payloads: DataFrame, snapshots: Callable[[], Tables], routing: Routing,
    root: str, checkpoint: str, source: str = "notifications", trigger: dict | None = None, inline_lists: bool = True,
) -> StreamingQuery:
    """Run the pipeline on streamed notification texts, as ``stream_payloads`` reads them."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        process_payloads(batch, batch_id, source, snapshots(), routing, root, inline_lists)

    return _started(payloads, source, on_batch, checkpoint, trigger)


def _started(
    feed: DataFrame, name: str, on_batch: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    return (
        feed.writeStream.queryName(f"alerts_{name}").foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
