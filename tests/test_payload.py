from pyspark.sql import functions as F

from tests.builders import SESSION
from tripwire.operators.payload import encode_payload, parse_payload, read_session


def parsed(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, payload string")
    return [r.asDict() for r in parse_payload(rows).orderBy("n").collect()]


def test_fields_user_and_station(spark):
    a, b, c, d = parsed(
        spark, f"ord_no, 12, ZERO QUANTITY, {SESSION}", f"ord_no, 12, ZERO QUANTITY, {SESSION}, more, still more",
        "ord_no, 12, X, aSIGMWIN.EXE uJOE m12 x m9 wST 7", "ord_no, 12, X, aSIGMWIN.EXE uJOE mPC w1 wST 7",
    )
    assert (a["ref_type"], a["reference"], a["alert"], a["user_name"], a["station"], a["malformed"]) == (
        "ord_no", "12", "ZERO QUANTITY", "JOE", "ST 7", False)
    assert {k: v for k, v in a.items() if k not in ("n", "payload")} == {
        k: v for k, v in b.items() if k not in ("n", "payload")}
    assert c["user_name"] == "JOE m12 x"
    assert d["station"] == "1 wST 7"


def test_malformed(spark):
    rows = parsed(
        spark, "ord_no, 12, X", "ord_no, 12, X, psql", "ord_no, 12, X, aSIGMWIN.EXE uJOE mPC",
        "ord_no, 12, X, other uJOE mPC wST", "", None, "ord_no, 12, X, aSIGMWIN.EXE u m w",
    )
    assert [r["malformed"] for r in rows] == [True] * 6 + [False]
    assert (rows[6]["user_name"], rows[6]["station"]) == ("", "")


def test_line_breaks_end_a_match_as_they_do_in_the_feed(spark):
    [r] = parsed(spark, "ord_no, 12, X, aSIGMWIN.EXE uJO\rE mPC wST\r7")
    assert (r["user_name"], r["station"]) == ("JO\rE", "ST\r7")


def test_encode_then_parse(spark):
    rows = spark.createDataFrame(
        [("ord_no", 7, "LINE DATES", SESSION), ("ord_no", 7, "LINE DATES", None)],
        "ref_type string, reference long, alert string, app_name string",
    )
    texts = rows.withColumn("payload", encode_payload(*[F.col(c) for c in rows.columns]))
    good, bad = texts.select("payload").collect()
    assert good.payload == f"ord_no, 7, LINE DATES, {SESSION}"
    assert bad.payload is None
    direct = read_session(rows.withColumn("reference", F.col("reference").cast("string"))).collect()
    assert [r.malformed for r in direct] == [False, True]
    again = parse_payload(texts.select("payload")).collect()[0]
    assert (again.user_name, again.station) == (direct[0].user_name, direct[0].station)
