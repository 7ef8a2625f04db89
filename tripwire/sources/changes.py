"""Change feeds: read them, stream them, or derive them from two snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.schemas import change_schema, table_schema
from tripwire.sources.snapshots import text_flag


def read_changes(spark: SparkSession, path: str, fmt: str = "parquet", table: str | None = None) -> DataFrame:
    """A stored change feed: op, commit_ts, change_seq, app_name, old, new, and txn_id where it has one.

    With ``table`` both images are brought to that table's columns and types,
    which formats without types need, and flags may be written as text.
    """
    reader = spark.read.format(fmt)
    if table and fmt != "parquet":
        reader = reader.schema(_as_text(change_schema(table)))
    changes = reader.load(path)
    return conform(changes, table) if table else _clean(changes)


def stream_changes(
    spark: SparkSession, path: str, table: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """The same feed as a stream. The schema is the table's, as streams do not infer one."""
    schema = change_schema(table)
    reader = spark.readStream.schema(schema if fmt == "parquet" else _as_text(schema)).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return conform(reader.load(path), table)


def _as_text(schema: T.StructType) -> T.StructType:
    """The same fields with flags as text, so that every spelling can be read."""
    def kind(field: T.StructField) -> T.DataType:
        if isinstance(field.dataType, T.StructType):
            return _as_text(field.dataType)
        return T.StringType() if isinstance(field.dataType, T.BooleanType) else field.dataType

    return T.StructType([T.StructField(f.name, kind(f)) for f in schema])


def _clean(changes: DataFrame) -> DataFrame:
    """Strip part-number padding inside both images."""
    for image in ("old", "new"):
        if "prt_no" in changes.select(f"{image}.*").columns:
            changes = changes.withColumn(image, F.col(image).withField("prt_no", F.rtrim(f"{image}.prt_no")))
    return changes


def diff(
    before: DataFrame, after: DataFrame, key: list[str], commit_ts, app_name, change_seq=None
) -> DataFrame:
    """The changes between two snapshots of a table.

    For users without a change feed. Rows equal in both snapshots give no
    change, so updates that altered nothing do not appear. ``commit_ts``,
    ``app_name`` and ``change_seq`` are columns or expressions for the rows.
    """
    columns = before.columns
    old = before.select(*[F.col(k).alias(f"key_{k}") for k in key], F.struct(*columns).alias("old"))
    new = after.select(*[F.col(k).alias(f"key_{k}") for k in key], F.struct(*columns).alias("new"))
    keys = [f"key_{k}" for k in key]
    op = F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "DELETE").otherwise("UPDATE")
    return (
        old.join(new, keys, "full_outer")
        .filter(~F.col("old").eqNullSafe(F.col("new")))
        .select(
            op.alias("op"), commit_ts.alias("commit_ts"),
            (change_seq if change_seq is not None else F.lit(None).cast("long")).alias("change_seq"),
            app_name.alias("app_name"), "old", "new",
        )
    )


def conform(changes: DataFrame, table: str) -> DataFrame:
    """Bring both images to the table's schema, for feeds with looser types or fewer columns."""
    def image(name: str):
        given = {f.name: f.dataType for f in changes.schema[name].dataType}

        def value(field: T.StructField):
            if field.name not in given:
                return F.lit(None).cast(field.dataType)
            column = F.col(f"{name}.{field.name}")
            if isinstance(field.dataType, T.BooleanType) and isinstance(given[field.name], T.StringType):
                return text_flag(column)
            return (F.rtrim(column) if field.name == "prt_no" else column).cast(field.dataType)

        shaped = F.struct(*[value(f).alias(f.name) for f in table_schema(table)])
        return F.when(F.col(name).isNotNull(), shaped)

    return reduce(lambda df, name: df.withColumn(name, image(name)), ("old", "new"), changes)
