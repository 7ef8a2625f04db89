"""Column expressions shared by the rules and operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order status and type codes.
CLOSED_STATUSES = ["C", "F", "I"]
ORDER_TYPE_ORDER = 1
ORDER_TYPE_BLANKET = 9
ORDER_TYPE_RELEASE = 10

# How the ERP client writes its session text.
USER_PATTERN = r"(?d)(?<=aSIGMWIN\.EXE u)(.*)(?= m)"
STATION_PATTERN = r"(?d)(?<= w)(.*)$"

MICROS = 1_000_000


def is_live(status: Column) -> Column:
    return ~status.isin(*CLOSED_STATUSES)


def has_part(prt_no: Column) -> Column:
    return prt_no != ""


def any_true(flag: Column) -> Column:
    """Whether a condition holds on some row of the group; null when it never could."""
    return F.bool_or(flag)


def session_user(app_name: Column) -> Column:
    """Between the program name and the last `` m``; null when there is no such text."""
    return F.when(app_name.rlike(USER_PATTERN), F.regexp_extract(app_name, USER_PATTERN, 1))


def session_station(app_name: Column) -> Column:
    """From the first `` w`` to the end; null when there is no such text."""
    return F.when(app_name.rlike(STATION_PATTERN), F.regexp_extract(app_name, STATION_PATTERN, 1))


def wall_micros(ts: Column) -> Column:
    """Microseconds of a zone-less timestamp, whatever the session time zone."""
    seconds = F.unix_date(ts.cast("date")).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * MICROS + (F.date_part(F.lit("SECOND"), ts) * MICROS).cast("long")
