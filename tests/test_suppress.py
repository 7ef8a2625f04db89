"""Suppression against a plain fold, on ties, exact gaps, hot alerts and seeds."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripwire.operators.suppress import accepted_times, is_duplicate, suppress
from tripwire.schemas import ALERT_KEY
from tripwire.streaming.suppress_stream import Accepted, judge

HOUR = timedelta(hours=1)
START = datetime(2024, 1, 1)


def fold(events, seed=None):
    """Positions accepted, by the definition: one event after the other."""
    last = dict(seed or {})
    kept = set()
    for i, (key, ts) in sorted(enumerate(events), key=lambda e: (e[1][1], e[0])):
        seen = last.get(key)
        if seen is None or ts == seen or ts - seen >= HOUR:
            last[key] = ts
            kept.add(i)
    return kept


def alerts(spark, events):
    rows = [(i, ts, key, "ord_no", "1", "JOE", "ST") for i, (key, ts) in enumerate(events)]
    return spark.createDataFrame(
        rows, "n long, time_stamp timestamp_ntz, " + ", ".join(f"{c} string" for c in ALERT_KEY)
    )


def kept_by_spark(spark, events, **options):
    out = suppress(alerts(spark, events), **options)
    return {r.n for r in out.filter("disposition = 'accepted'").select("n").collect()}


CHAIN = [
    ("A", START), ("A", START), ("A", START + timedelta(minutes=40)),
    ("A", START + timedelta(minutes=59, seconds=59)), ("A", START + HOUR),
    ("A", START + timedelta(minutes=80)), ("A", START + timedelta(hours=2, seconds=1)),
    ("B", START), ("B", START + timedelta(minutes=40)), ("B", START + timedelta(minutes=80)),
    ("C", START + timedelta(microseconds=1)), ("C", START + HOUR), ("C", START + HOUR + timedelta(microseconds=1)),
]


@pytest.mark.parametrize("fold_rows", [5_000, 0])
def test_chains(spark, fold_rows):
    assert kept_by_spark(spark, CHAIN, fold_rows=fold_rows) == {0, 1, 4, 6, 7, 9, 10, 12} == fold(CHAIN)


def test_the_key_is_all_five_fields(spark):
    base = alerts(spark, [("A", START)] * 3)
    other = F.when(F.col("n") == 1, "ANN").otherwise(F.col("user_name"))
    station = F.when(F.col("n") == 2, "ST 2").otherwise(F.col("station"))
    rows = base.withColumns({"user_name": other, "station": station}).withColumn(
        "time_stamp", F.col("time_stamp") + F.col("n").cast("int") * F.expr("interval 1 minute")
    )
    assert suppress(rows).filter("disposition = 'accepted'").count() == 3


def test_null_key_or_time_is_never_a_duplicate(spark):
    rows = alerts(spark, [("A", START), ("A", START + timedelta(minutes=1)), (None, START), (None, START + timedelta(minutes=1)), ("A", None)])
    out = {r.n: r.disposition for r in suppress(rows).collect()}
    assert out == {0: "accepted", 1: "duplicate", 2: "accepted", 3: "accepted", 4: "accepted"}


def test_against_a_log(spark):
    log = alerts(spark, [("A", START), ("A", START - HOUR), ("Z", START)])
    events = [("A", START - timedelta(minutes=5)), ("A", START), ("A", START + timedelta(minutes=59)), ("A", START + HOUR), ("B", START)]
    out = {r.n: r.disposition for r in suppress(alerts(spark, events), log=log).collect()}
    assert out == {0: "duplicate", 1: "accepted", 2: "duplicate", 3: "accepted", 4: "accepted"}


def test_a_log_of_later_dates_blocks_nothing_before_it(spark):
    log = alerts(spark, [("A", START + timedelta(hours=5)), (None, START)])
    events = [("A", START), ("A", START + timedelta(minutes=30)), ("A", START + timedelta(hours=5, minutes=30)), (None, START)]
    out = {r.n: r.disposition for r in suppress(alerts(spark, events), log=log).collect()}
    assert out == {0: "accepted", 1: "duplicate", 2: "duplicate", 3: "accepted"}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 40)), min_size=1, max_size=40),
       st.lists(st.tuples(st.sampled_from("ABC"), st.integers(0, 40)), min_size=1, max_size=10))
def test_random_events_against_a_log(spark, raw, logged):
    events, log = ([(k, START + timedelta(minutes=10 * t)) for k, t in x] for x in (raw, logged))
    kept, want = list(log), set()
    for i, (key, ts) in sorted(enumerate(events), key=lambda e: (e[1][1], e[0])):
        if not any(k == key and ts - HOUR < t < ts for k, t in kept):
            kept.append((key, ts))
            want.add(i)
    assert kept_by_spark(spark, events, log=alerts(spark, log)) == want


def test_probe(spark):
    log = alerts(spark, [("A", START), ("A", START + timedelta(minutes=90)), ("B", START + timedelta(minutes=59))])
    minutes = [("A", 0), ("A", 1), ("A", 59), ("A", 60), ("A", 90), ("A", 91), ("A", -1), ("B", 60), ("B", 119), ("C", 1)]
    rows = alerts(spark, [(k, START + timedelta(minutes=m)) for k, m in minutes])
    got = [r.is_duplicate for r in is_duplicate(rows, log).orderBy("n").collect()]
    logged = [(r.alert, r.time_stamp) for r in log.collect()]
    want = [
        any(k == a and t + HOUR > START + timedelta(minutes=m) and t < START + timedelta(minutes=m) for a, t in logged)
        for k, m in minutes
    ]
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 60)), min_size=1, max_size=60))
def test_random_events_on_a_coarse_clock(spark, raw):
    events = [(k, START + timedelta(minutes=10 * t)) for k, t in raw]
    want = fold(events)
    assert kept_by_spark(spark, events) == want
    assert kept_by_spark(spark, events, fold_rows=0) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 500), max_size=20), max_size=6))
def test_stream_judge(batches):
    """Batches as they arrive, late rows among them, against a log that is asked before each entry."""
    state: dict[int, list[int]] = {}
    log: set[int] = set()
    for raw in batches:
        times = np.array(raw, dtype=np.int64) * 10
        accepted = Accepted(300, lambda window: state.get(window, []))
        got = judge(times, accepted)
        state.update({w: accepted.known[w] for w in accepted.changed})
        verdicts = {}
        for t in sorted(set(times.tolist())):
            verdicts[t] = "duplicate" if any(t - 300 < a < t for a in log) else "accepted"
            log |= {t} if verdicts[t] == "accepted" else set()
        assert list(got) == [verdicts[t] for t in times.tolist()]
    assert sorted(log) == sorted(t for times in state.values() for t in times)


def test_hot_alert_is_followed_exactly(spark):
    """A third of all rows is one alert without a gap; it takes the pointer path."""
    n = 30_000
    width = 3_600_000_000
    points = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(400 * width))).alias("at"),
    )
    rows = points.collect()
    want = set()
    for key in {r.k for r in rows}:
        last = None
        for at in sorted(r.at for r in rows if r.k == key):
            if last is None or at - last >= width:
                want.add((key, at))
                last = at
    got = accepted_times(points, ["k"], width, fold_rows=1000).collect()
    assert len(got) == len(want)
    assert {(r.k, r.at) for r in got} == want


def test_dense_hot_alert_does_not_merge_paths(spark):
    """Regular times keep every path apart, the worst case for pruning."""
    points = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 1_000_000).alias("at"))
    got = {r.at for r in accepted_times(points, ["k"], 7 * 1_000_000, fold_rows=10).collect()}
    assert got == set(range(0, 20_000_000_000, 7_000_000))
