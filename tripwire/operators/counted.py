"""Facts as counts that changes move: facts as of each change, and facts kept up to date.

Most facts ask whether a key has rows of some kind. Such a fact is a sum over
the key's rows, and a change moves it by what its new row counts less what its
old row counted. Two things follow.

*As of a change.* A trigger asks inside the writer's transaction, so it sees the
other tables as they were at that change and not as the batch left them. What a
fact was at a change is what it is after the batch less all moves of its key that
came later in the log. Positions in the log are dealt into buckets of some
PER_BUCKET moves; sums per key and bucket are combined before the shuffle, a
window over those gives what later buckets move, and one over the moves of a key
within a bucket the rest. No change meets the rows of its key one by one, and no
window holds more of a hot key than a bucket has.

*Kept up to date.* A batch of changes is a table of moves with one row for each
key it touched. Sums of such tables are the facts; see ``Store``.

``change_seq`` is the position in the log, over all tables: an earlier one was
there before, in the same transaction or another.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwire.functions.frames import cut, join_unique, only, written
from tripwire.operators import facts
from tripwire.plans.rules.base import Fact, asked_keys, join_fact

Tables = Mapping[str, DataFrame]

PER_BUCKET = 100_000  # moves of all keys in one bucket of the log


@dataclass(frozen=True)
class Counted:
    """What is counted, and the facts it gives.

    ``counts`` has sums over the rows of ``table`` by ``keys``: of conditions,
    which count 1 where they hold, or of numbers. ``facts`` makes columns of them.
    ``extend`` adds columns to rows before they are counted.
    """

    table: str
    keys: tuple[str, ...]
    counts: dict[str, Callable[[], Column]]
    facts: dict[str, Callable[[], Column]]
    extend: Callable[[DataFrame, Tables], DataFrame] = field(default=lambda rows, tables: rows)

    def weighed(self, rows: DataFrame, tables: Tables, *also: str) -> DataFrame:
        """The keys and counts of each row, times its ``sign``.

        Conditions count in longs, which add up to no more than there are rows; sums of numbers need decimals.
        """
        sign = F.col("sign")
        kind = dict(self.extend(rows, tables).select(*[c().alias(n) for n, c in self.counts.items()]).dtypes)

        def weight(name: str) -> Column:
            value = self.counts[name]()
            if kind[name] == "boolean":
                return F.when(value, sign).otherwise(0).cast("long")
            return F.coalesce(value * sign, F.lit(0)).cast("decimal(38,0)")

        known = F.lit(True)
        for key in self.keys:
            known = known & F.col(key).isNotNull()
        return self.extend(rows, tables).filter(known).select(
            *self.keys, *also, *[weight(n).alias(n) for n in self.counts])

    def total(self, weighed: DataFrame, *by: str) -> DataFrame:
        kind = dict(weighed.dtypes)
        return weighed.groupBy(*self.keys, *by).agg(*[F.sum(n).cast(kind[n]).alias(n) for n in self.counts])

    def state(self, tables: Tables, keys: DataFrame | None = None) -> DataFrame:
        """The counts of the table as it is."""
        rows = only(tables[self.table], keys, *self.keys).withColumn("sign", F.lit(1))
        return cut(self.total(self.weighed(rows, tables)), keys, *self.keys)

    def moves(self, feed: DataFrame, tables: Tables) -> DataFrame:
        """The keys, ``change_seq`` and signed counts of each row image in a feed of ``table``."""
        image = F.explode(F.array(
            F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row"))))
        rows = feed.select("change_seq", image.alias("image")).filter("image.row is not null").select(
            "change_seq", "image.sign", "image.row.*")
        return self.weighed(rows, tables, "change_seq")

    def as_facts(self, counts: DataFrame, *also: str) -> DataFrame:
        return counts.select(*also, *[f().alias(n) for n, f in self.facts.items()])


def positive(name: str) -> Callable[[], Column]:
    return lambda: F.col(name) > 0


def _line_test(name: str) -> Callable[[], Column]:
    return lambda: facts.line_tests()[name]


LINES = Counted(
    "order_line", ("ord_no",),
    {
        **{name: _line_test(name) for name in ("unready", "zero", "named", "named_zero", "unreserved", "accessory")},
        "lines": lambda: F.lit(True),
        "dated": lambda: F.col("orl_req_dt").isNotNull(),
        "days": lambda: F.unix_date("orl_req_dt").cast("decimal(20,0)"),
        "days_squared": lambda: (F.unix_date("orl_req_dt").cast("long") * F.unix_date("orl_req_dt")).cast("decimal(20,0)"),
    },
    {
        "has_unready_line": positive("unready"), "has_zero_line": positive("zero"), "has_unreserved_line": positive("unreserved"),
        "has_accessory": positive("accessory"),
        "named_lines": lambda: F.col("named").cast("long"), "named_zero_lines": lambda: F.col("named_zero").cast("long"),
        # Numbers are all equal where their squares add up to the square of their sum over their number.
        "dates_differ": lambda: F.col("dated") * F.col("days_squared") != F.col("days") * F.col("days"),
    },
)


def _with_part_flags(lines: DataFrame, tables: Tables) -> DataFrame:
    return join_unique(lines, facts.part_flags(tables), "prt_no", "left")


PARTS = Counted(
    "order_line", ("ord_no",), {"asv": lambda: F.col("asv"), "truck": lambda: F.col("truck")},
    {"needs_accessory": positive("asv"), "needs_truck": positive("truck")}, _with_part_flags,
)


def _least_flag(name: str) -> dict[str, Callable[[], Column]]:
    """The smallest of the flags that ``_flag_counts`` counts."""
    return {name: lambda: F.when(F.col("no") > 0, False).when(F.col("yes") > 0, True)}


def _flag_counts(flag: str) -> dict[str, Callable[[], Column]]:
    return {"yes": lambda: F.col(flag), "no": lambda: ~F.col(flag)}


BACK_ORDERS = Counted(
    "order_header", ("ord_no",), _flag_counts("ord_bo_accptd"), _least_flag("ord_bo_accptd"))
LOT_FLAGS = Counted(
    "planning_lot_quantity", ("plq_id",), _flag_counts("plq_adj_flag"), _least_flag("lot_adjusted"))
UNRUN_LOTS = Counted(
    "planning_lot_quantity", ("orl_id",), {"unrun": lambda: ~F.col("plq_adj_flag")}, {"has_unrun_lot": positive("unrun")})
LOT_COMPONENTS = Counted(
    "planning_lot_detailed", ("plq_lot_no",), {"components": lambda: F.col("pld_lvl") > 0}, {"lot_has_components": lambda: F.when(
        F.col("components") > 0, True)})
PO_NUMBERS = Counted(
    "order_header", ("inv_cli_id", "ord_cli_ord_no"),
    {"orders": lambda: F.col("ord_cli_ord_no") != "",
     "order_sum": lambda: F.when(F.col("ord_cli_ord_no") != "", F.col("ord_no")).cast("decimal(20,0)")},
    # One order is the lowest and the highest; of several all that matters is that they differ.
    {"low": lambda: F.when(F.col("orders") == 1, F.col("order_sum")).when(F.col("orders") > 1, F.lit(-2)).cast("long"),
     "high": lambda: F.when(F.col("orders") == 1, F.col("order_sum")).when(F.col("orders") > 1, F.lit(-1)).cast("long")},
)

# By changed table and fact: what replaces a fact of the catalogue to have it as of each change.
BY_FACT: dict[str, dict[str, Counted]] = {
    "order_header": {"lines": LINES, "parts": PARTS, "po_numbers": PO_NUMBERS},
    "invoicing": {"lines": LINES, "back_orders": BACK_ORDERS},
    "invoicing_line": {"unrun_lots": UNRUN_LOTS},
    "planning_lot_detailed": {"lots": LOT_FLAGS, "components": LOT_COMPONENTS},
}


# As of a change


def later(asks: DataFrame, moves: DataFrame, keys: list[str], names: list[str], per_bucket: int = PER_BUCKET) -> DataFrame | None:
    """For each of ``asks`` (keys, change_seq; no repeats) the sums of its key's moves behind that position.

    Asks without a later move may be missing. None where there are no moves.
    """
    n, low, high = moves.agg(F.count("*"), F.min("change_seq"), F.max("change_seq")).first()
    if not n:
        return None
    kind = dict(moves.dtypes)
    buckets = -(-n // per_bucket)
    place = F.floor((F.col("change_seq") - low).cast("double") * buckets / (high - low + 1))
    bucket = F.least(F.greatest(place, F.lit(0)), F.lit(buckets - 1)).alias("bucket")
    events = moves.select(*keys, "change_seq", bucket, *names, F.lit(0).alias("asks"))
    asked = join_unique(asks, moves.select(*keys).distinct(), keys, "left_semi").select(
        *keys, "change_seq", bucket, *[F.lit(0).cast(kind[c]).alias(c) for c in names], F.lit(1).alias("asks"))
    rows = events.unionByName(asked)

    behind = Window.partitionBy(*keys).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.groupBy(*keys, "bucket").agg(*[F.sum(c).alias(c) for c in names])
    other = whole.select(*keys, "bucket", *[F.coalesce(F.sum(c).over(behind), F.lit(0)).alias(f"other_{c}") for c in names])
    # From the last position to the first; an ask stands before the moves of its own position.
    line = Window.partitionBy(*keys, "bucket").orderBy(F.desc("change_seq"), F.desc("asks"))
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = rows.select(*keys, "bucket", "change_seq", "asks", *[F.sum(c).over(so_far).alias(c) for c in names]).filter("asks = 1")
    return join_unique(within, other, [*keys, "bucket"]).select(
        *keys, "change_seq", *[(F.col(c) + F.col(f"other_{c}")).cast(kind[c]).alias(c) for c in names])


@dataclass(frozen=True)
class AsOf:
    """A fact as of each change, from the table after the batch and its feed during the batch.

    The moves, the counts after the batch and what later moves sum to are written one
    after the other, so the shuffles of one are gone when the next begins.
    """

    counted: Counted
    on: dict[str, str]
    feed: DataFrame
    per_bucket: int = PER_BUCKET

    def attach(self, changes: DataFrame, tables: Tables) -> DataFrame:
        counted, keys = self.counted, list(self.on)
        names = list(counted.counts)
        after = written(counted.state(tables, asked_keys(changes, self.on)))
        place = {**self.on, "change_seq": "change_seq"}
        moves = written(counted.moves(self.feed, tables))
        kind = dict(moves.dtypes)
        found = later(asked_keys(changes, place), moves, keys, names, self.per_bucket)
        now = join_fact(changes, after.withColumnsRenamed({n: f"after_{n}" for n in names}), self.on)
        value = lambda n: F.coalesce(f"after_{n}", F.lit(0).cast(kind[n]))
        if found is not None:
            now = join_fact(now, written(found).withColumnsRenamed({n: f"later_{n}" for n in names}), place)
            rest = lambda n: value(n) - F.coalesce(f"later_{n}", F.lit(0).cast(kind[n]))
        else:
            rest = value
        return counted.as_facts(now.withColumns({n: rest(n).cast(kind[n]) for n in names}), *changes.columns)


def as_of_facts(known: dict[str, Fact], table: str, history: Mapping[str, DataFrame]) -> dict[str, AsOf]:
    """The facts of a changed table that can be had as of each change, for the tables whose feeds are in ``history``."""
    return {
        name: AsOf(counted, known[name].on, history[counted.table])
        for name, counted in BY_FACT.get(table, {}).items() if counted.table in history and name in known
    }


# Kept up to date


class Store:
    """Counts of a table in a folder, moved by batches of its changes.

    The folder has a table of counts to begin with and one of moves for each
    batch, with a row for each key that the batch touched; so a batch costs what
    it changes. A batch that is written again replaces itself. ``compact`` folds
    all into one table under a new number, which readers take from then on.
    """

    def __init__(self, spark: SparkSession, path: str, counted: Counted):
        self.spark, self.path, self.counted = spark, path, counted

    def begin(self, tables: Tables) -> None:
        self._write(self.counted.state(tables), "base=0")

    def apply(self, feed: DataFrame, tables: Tables, batch: int) -> None:
        """Move the counts by a batch of changes; batches are numbered from 1."""
        moved = self.counted.total(self.counted.moves(feed, tables))
        still = reduce(lambda a, b: a & b, [F.col(n) == 0 for n in self.counted.counts])
        self._write(moved.filter(~still), f"batch={batch}")

    def counts(self, keys: DataFrame | None = None, upto: int | None = None) -> DataFrame:
        """The counts, of ``keys`` only if given; ``upto`` is the last batch to take."""
        base, batches = self._parts(upto)
        parts = [self.spark.read.parquet(f"{self.path}/{p}") for p in (f"base={base}", *[f"batch={b}" for b in batches])]
        on = list(self.counted.keys)
        every = reduce(DataFrame.unionByName, [only(p, keys, *on) for p in parts])
        present = reduce(lambda a, b: a | b, [F.col(n) != 0 for n in self.counted.counts])
        return cut(self.counted.total(every).filter(present), keys, *on)

    def facts(self, keys: DataFrame | None = None) -> DataFrame:
        return self.counted.as_facts(self.counts(keys), *self.counted.keys)

    def compact(self) -> None:
        """Fold the batches so far into one table; those it holds are removed."""
        base, batches = self._parts(None)
        if batches:
            self._write(self.counts(upto=batches[-1]), f"base={batches[-1]}")
            for old in (f"base={base}", *[f"batch={b}" for b in batches]):
                self._files().delete(self._place(old), True)

    def _parts(self, upto: int | None) -> tuple[int, list[int]]:
        names = [str(s.getPath().getName()) for s in self._files().listStatus(self._place(""))]
        done = [n for n in names if self._files().exists(self._place(f"{n}/_SUCCESS"))]
        number = lambda kind: sorted(int(n.split("=")[1]) for n in done if n.startswith(kind))
        base = number("base=")[-1]
        return base, [b for b in number("batch=") if b > base and (upto is None or b <= upto)]

    def _write(self, counts: DataFrame, part: str) -> None:
        counts.write.mode("overwrite").parquet(f"{self.path}/{part}")

    def _place(self, part: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}" if part else self.path)

    def _files(self):
        return self._place("").getFileSystem(self.spark._jsc.hadoopConfiguration())


def held_before(tables: Tables, table: str, key: list[str], feed: DataFrame) -> DataFrame:
    """A table as it was before a feed: its rows now, but for changed keys the first old row."""
    first = feed.groupBy(*[F.coalesce(f"new.{k}", f"old.{k}").alias(k) for k in key]).agg(
        F.min(F.struct("change_seq", "old")).alias("first"))
    now = tables[table]
    rest = join_unique(now, first.select(*key), key, "left_anti")
    return rest.unionByName(first.filter("first.old is not null").select("first.old.*").select(*now.columns))
