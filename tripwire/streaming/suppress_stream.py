"""Suppression as a stateful streaming operator.

Rows are judged as they arrive, like a log that is asked before each entry: a
copy is a duplicate where the log holds an accepted copy from less than a window
before it. A row that comes late is asked about the time before it, whatever was
accepted after it, and is itself logged at its own time. So the state of an alert
is its accepted times, a few for each window of time: a map from the number of
the window to its accepted times, of which a row reads two.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from datetime import timedelta
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tripwire.operators.suppress import ACCEPTED, DUPLICATE, HOUR
from tripwire.schemas import ALERT_KEY

# The state keeps several values for an alert, which takes this store.
STORE = "spark.sql.streaming.stateStore.providerClass"
STORE_CLASS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Accepted:
    """The accepted times of an alert, by window; ``load`` gives the times of a window that the state holds."""

    def __init__(self, width: int, load=lambda window: []):
        self.width, self.load = width, load
        self.known: dict[int, list[int]] = {}
        self.changed: set[int] = set()

    def _times(self, window: int) -> list[int]:
        if window not in self.known:
            self.known[window] = list(self.load(window))
        return self.known[window]

    def blocks(self, at: int) -> bool:
        """Whether a copy was accepted less than a window before ``at``."""
        for window in (at // self.width, at // self.width - 1):
            times = self._times(window)
            place = bisect_left(times, at)
            if place:
                return times[place - 1] > at - self.width
        return False

    def add(self, at: int) -> None:
        window = at // self.width
        times = self._times(window)
        place = bisect_left(times, at)
        if place == len(times) or times[place] != at:
            insort(times, at)
            self.changed.add(window)


def judge(times: np.ndarray, accepted: Accepted) -> np.ndarray:
    """Dispositions of times, which are taken in ascending order; equal ones are judged alike."""
    distinct, place = np.unique(times, return_inverse=True)
    verdicts = np.empty(len(distinct), dtype=object)
    for i, at in enumerate(distinct.tolist()):
        verdicts[i] = DUPLICATE if accepted.blocks(at) else ACCEPTED
        if verdicts[i] == ACCEPTED:
            accepted.add(at)
    return verdicts[place]


class Suppressor(StatefulProcessor):
    """Judges the rows of one alert, an Arrow batch of a micro-batch at a time."""

    def __init__(self, columns: list[str], ts: str, width: int, keep_ms: int | None):
        self.columns, self.ts, self.width, self.keep_ms = columns, ts, width, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("accepted", "window long", "times array<long>", self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        def load(window: int) -> list[int]:
            held = self.state.getValue((window,)) if self.state.containsKey((window,)) else None
            return held[0] if held else []

        accepted = Accepted(self.width, load)
        for chunk in rows:
            micros = chunk[self.ts].astype("datetime64[us]").to_numpy().astype(np.int64)
            yield chunk[self.columns].assign(disposition=judge(micros, accepted))
        for window in sorted(accepted.changed):
            self.state.updateValue((window,), (accepted.known[window],))

    def close(self) -> None:
        pass


def suppress_stream(
    alerts: DataFrame, key: list[str] = ALERT_KEY, ts: str = "time_stamp",
    window_seconds: int = HOUR, idle: timedelta | None = None,
) -> DataFrame:
    """Adds ``disposition`` to a stream of alerts; every row comes out once, late ones too.

    Within an Arrow batch of an alert's rows the earliest come first; batches and
    micro-batches are taken as they come, and none is held whole. No watermark is
    set, as Spark drops rows behind it. With ``idle`` the accepted times of a window
    go when so much wall-clock time has passed since one was added; later rows
    are then judged without them. Rows with a null in the key or time equal nothing
    and pass by the state. The query needs the state store ``STORE_CLASS``, which
    this sets for the session.
    """
    alerts.sparkSession.conf.set(STORE, STORE_CLASS)
    schema = T.StructType(list(alerts.schema.fields) + [T.StructField("disposition", T.StringType())])
    keep_ms = int(idle.total_seconds() * 1000) if idle else None
    processor = Suppressor(alerts.columns, ts, window_seconds * 1_000_000, keep_ms)
    comparable = reduce(lambda a, c: a & F.col(c).isNotNull(), [*key, ts], F.lit(True))
    judged = alerts.filter(comparable).groupBy(*key).transformWithStateInPandas(
        processor, schema, "append", "ProcessingTime" if idle else "None")
    return judged.unionByName(alerts.filter(~comparable).withColumn("disposition", F.lit(ACCEPTED)))
