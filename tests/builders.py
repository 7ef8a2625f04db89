"""Tiny tables for tests: rows as dicts, missing columns null."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

from tripwire.schemas import TABLES, change_schema, table_schema

SESSION = "C:/ERP/aSIGMWIN.EXE uJOE mPC9 wST 7"
NOON = datetime(2024, 1, 15, 12)


def _row(schema: T.StructType, values: dict | None):
    if values is None:
        return None
    unknown = set(values) - set(schema.names)
    assert not unknown, unknown
    out = []
    for field in schema:
        value = values.get(field.name)
        if value is not None and isinstance(field.dataType, T.DecimalType):
            value = Decimal(str(value))
        out.append(value)
    return tuple(out)


def table(spark, name: str, *rows: dict):
    schema = table_schema(name)
    return spark.createDataFrame([_row(schema, r) for r in rows], schema)


def tables(spark, **rows: list[dict]):
    """All business tables; those not named are empty."""
    return {name: table(spark, name, *rows.get(name, [])) for name in TABLES}


def changes(spark, name: str, *rows: tuple):
    """Rows of (op, new, old) or (op, new, old, commit_ts); sequence numbers in order."""
    row = table_schema(name)
    data = [
        (r[0], r[3] if len(r) > 3 else NOON, i, SESSION, None, _row(row, r[2]), _row(row, r[1]))
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, change_schema(name))
