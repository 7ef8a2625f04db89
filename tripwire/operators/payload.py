"""Notification payloads: four fields in one string, and the session text inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.functions.columns import session_station, session_user

SEPARATOR = ", "


def encode_payload(ref_type: Column, reference: Column, alert: Column, app_name: Column) -> Column:
    """The payload text. ``concat`` is null as soon as one field is null."""
    return F.concat(
        ref_type, F.lit(SEPARATOR), reference.cast("string"), F.lit(SEPARATOR),
        alert, F.lit(SEPARATOR), app_name,
    )


def parse_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds ref_type, reference, alert, user_name, station and ``malformed``.

    Fields after the fourth are ignored. A payload with fewer fields, or whose
    session text names no user or no station, is marked malformed, and so is one
    without a readable ``time_stamp``: it could never be told from its repeats.
    """
    fields = F.split(F.col(payload), SEPARATOR)
    session = F.get(fields, F.lit(3))
    parsed = df.withColumns({
        "ref_type": F.get(fields, F.lit(0)),
        "reference": F.get(fields, F.lit(1)),
        "alert": F.get(fields, F.lit(2)),
        "user_name": session_user(session),
        "station": session_station(session),
    })
    timeless = F.col("time_stamp").isNull() if "time_stamp" in df.columns else F.lit(False)
    return parsed.withColumn("malformed", _unreadable() | timeless)


def read_session(alerts: DataFrame) -> DataFrame:
    """The same user, station and ``malformed`` columns for structured alerts."""
    return alerts.withColumns({
        "user_name": session_user(F.col("app_name")),
        "station": session_station(F.col("app_name")),
    }).withColumn("malformed", _unreadable())


def _unreadable() -> Column:
    needed = ["ref_type", "reference", "alert", "user_name", "station"]
    return F.array_contains(F.array(*[F.col(c).isNull() for c in needed]), True)
