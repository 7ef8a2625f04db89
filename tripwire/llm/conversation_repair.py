"""Repair of conversations at least cost, by a Viterbi search that runs over chunks at once.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. It
is repaired by keeping, re-roling and deleting its rows and inserting empty turns.
The cheapest repair is a shortest path through four states: nothing yet (START),
after a system turn (SYSTEM), a user turn (USER) or an assistant turn (ASSISTANT).

*Chunks.* Rows are sorted over all tasks by conversation and turn, and each task
cuts what it has of a conversation into chunks of bounded rows and bytes, so that
a conversation of any length is spread over many tasks. Conversations that lie
within one chunk, which are nearly all, are repaired where they are read.

*Speculative vectors and fix-up passes.* For the others, what a task has of a
conversation (a lane) is walked from its last row to its first, with the costs of
finishing from each state, beginning with a guess of the costs behind it: those of
the conversation's end. A fix-up pass then hands each lane the vector that its
successor arrived at. Vectors that differ by a constant only lead to the same
choices, so lanes whose successor's vector did so rest, and only the others are
walked again, until none is left. A few rows that can be kept make all vectors
parallel, so two passes are the rule; rows without any known role need more.

*Tracing.* With the costs right, the least audit is read forwards: at each place the
ASCII-least letter that is on a cheapest path. Each chunk tells for each state in
which it may be entered the state in which it is left; those maps, a row for each
chunk, are followed along a conversation, and each chunk then traces its part.

The repaired text is hashed in order, as any SHA-256 is: the chunks' texts of one
conversation stream through one task, a chunk at a time.

Defined results: a null role, text or turn reads as one space where it is text;
null turns come first; rows of equal turn are sorted by role, the first hundred
characters of the text and its MD5; equal rows are rows of their own (all but the
first are duplicates); a row with an empty role has no initial and cannot be kept;
initials are case-sensitive and a kept row keeps its role and text; an id of null is
a conversation like any other; a very long text is moved whole and chunks are cut
behind it; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwire.functions.frames import scratch, written
from tripwire.llm.common import NOT_SPACE

CHUNK_ROWS, CHUNK_BYTES = 1 << 14, 4 << 20

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ROLE = {USER: "user", ASSISTANT: "assistant"}
# The state behind an inserted or re-roled turn, and the state behind a kept one by its initial.
MADE = (USER, USER, ASSISTANT, USER)
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
LEGAL = {"su", "ua", "au"}

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Costs at the end of a conversation: it may end in START and ASSISTANT, else turns are inserted.
END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]
# A row as the search sees it: its initial, whether it must go, and what it costs to leave it truncated.
Step = tuple[str, bool, int]


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows as a faulty export would leave them.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (``gone``), 1 empties
    its text, 2 removes ``.!?``, 3 repeats it, 4 makes it a user's.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    gone = kind == 0
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(plain("role")).alias("role"),
                       F.when(~gone, text).otherwise("").alias("text"), gone.alias("gone"), copies.alias("copy")).drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """Rows sorted by conversation and turn over all tasks, with ``blank`` and ``truncated``.

    The last key is the place of the row in the input. It splits any number of
    equal rows between tasks.
    """
    text = F.col("text")
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("head"), F.asc("digest"), F.asc("place")]
    keyed = rows.select(
        "conv_id", "turn", "role", "text", "gone", (~text.rlike(NOT_SPACE)).alias("blank"),
        (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"), F.left(text, F.lit(100)).alias("head"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"), F.monotonically_increasing_id().alias("place"))
    return keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("head", "place")


# The search


def before(step: Step, after: Vector) -> Vector:
    """The costs of finishing from each state before a row, from those behind it."""
    initial, must_go, truncated = step
    own = []
    for state in STATES:
        cost = DELETE + after[state]
        if not must_go:
            cost = min(cost, REROLE + truncated + after[MADE[state]])
            kept = KEPT.get((initial, state))
            if kept is not None:
                cost = min(cost, truncated + after[kept])
        own.append(cost)
    user = min(own[USER], INSERT + own[ASSISTANT])
    assistant = min(own[ASSISTANT], INSERT + own[USER])
    return min(own[START], INSERT + user), min(own[SYSTEM], INSERT + user), user, assistant


def backward(steps: list[Step], end: Vector) -> list[Vector]:
    """The costs before each row, and ``end`` behind the last."""
    out = [end]
    for step in reversed(steps):
        out.append(before(step, out[-1]))
    return out[::-1]


def parallel(vector: Vector) -> Vector:
    """The same vector for all that differ by a constant."""
    least = min(vector)
    return tuple(x - least for x in vector)


def trace(steps: list[Step], costs: list[Vector], state: int, last: bool) -> tuple[str, int]:
    """The least audit from ``state`` on, and the state behind it; the last chunk also ends the conversation."""
    audit = []
    for at, step in enumerate(steps):
        initial, must_go, truncated = step
        after = costs[at + 1]
        while True:
            now, kept = costs[at][state], KEPT.get((initial, state))
            if now == DELETE + after[state]:
                audit.append("D")
            elif now == INSERT + costs[at][MADE[state]]:
                audit.append("I")
                state = MADE[state]
                continue
            elif not must_go and kept is not None and now == truncated + after[kept]:
                audit.append("K")
                state = kept
            else:
                audit.append("R")
                state = MADE[state]
            break
    while last and END[state]:
        audit.append("I")
        state = MADE[state]
    return "".join(audit), state


def apply_audit(roles: list[str], texts: list[str], audit: str, state: int) -> tuple[str, int]:
    """The repaired rows as lines ``role:text``, and what the edits cost but for truncated rows."""
    lines, at, cost = [], 0, 0
    for letter in audit:
        if letter == "I":
            state, cost = MADE[state], cost + INSERT
            lines.append(f"{ROLE[state]}:")
            continue
        if letter == "D":
            cost += DELETE
        elif letter == "K":
            state = KEPT[roles[at][:1], state]
            lines.append(f"{roles[at]}:{texts[at]}")
        else:
            state, cost = MADE[state], cost + REROLE
            lines.append(f"{ROLE[state]}:{texts[at]}")
        at += 1
    return "\n".join(lines), cost


# Chunks


@dataclass
class Chunk:
    """Rows of one conversation that follow one another."""

    conv_id: object
    lane: int = 0  # which conversation of its task
    seq: int = 0  # which chunk of its lane
    turns: list = field(default_factory=list)  # without null ones
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    digests: list[bytes] = field(default_factory=list)
    faults: list[str] = field(default_factory=list)  # of each row: blank, duplicate, truncated or nothing
    size: int = 0

    def add(self, turn: object, role: str, text: str, digest: bytes, fault: str) -> None:
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.digests.append(digest)
        self.faults.append(fault)
        self.size += len(text) + 100

    def mark_duplicates(self) -> None:
        seen = set()
        for at, key in enumerate(zip(self.roles, self.digests, strict=True)):
            if self.faults[at] != "blank":
                if key in seen:
                    self.faults[at] = "duplicate"
                seen.add(key)

    def steps(self) -> list[Step]:
        return steps(self.roles, self.faults)

    def illegal(self) -> int:
        return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(self.roles, self.roles[1:]))


def steps(roles: list[str], faults: list[str]) -> list[Step]:
    return [(r[:1], f in ("blank", "duplicate"), TRUNCATED if f == "truncated" else 0) for r, f in zip(roles, faults, strict=True)]


KEY = ["part", "lane", "seq"]
FAULTS = ("blank", "duplicate", "truncated")
# Chunks as rows: those that are a whole conversation carry its result, the others what they hold.
DONE = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
HELD = ("first_turn long, last_turn long, n_turns long, illegal_inside long, "
        "roles array<string>, texts array<string>, digests array<binary>, faults array<string>")


def whole_result(chunk: Chunk) -> dict:
    """The result of a conversation that is one chunk."""
    chunk.mark_duplicates()
    todo = chunk.steps()
    costs = backward(todo, END)
    audit, _ = trace(todo, costs, START, True)
    repaired, _ = apply_audit(chunk.roles, chunk.texts, audit, START)
    turns = chunk.turns
    return {
        "gaps": turns[-1] - turns[0] + 1 - len(turns) if turns else 0,
        **{fault: chunk.faults.count(fault) for fault in FAULTS},
        "illegal": chunk.illegal(), "cost": costs[0][START], "audit": audit,
        "repaired_sha256": hashlib.sha256(repaired.encode()).hexdigest(),
    }


def held_rows(chunk: Chunk) -> dict:
    chunk.mark_duplicates()
    turns = chunk.turns
    return {
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "n_turns": len(turns),
        "illegal_inside": chunk.illegal(), "roles": chunk.roles, "texts": chunk.texts,
        "digests": chunk.digests, "faults": chunk.faults,
    }


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield from zip(*[column.to_pylist() for column in batch.slice(at, 1024).columns], strict=True)


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 512, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches that are bounded in rows and, by what their ``size`` says, in bytes."""
    some, held = [], 0
    for row in rows:
        held += row.pop("size", 0)
        some.append(row)
        if len(some) >= most or held >= size:
            yield pa.RecordBatch.from_pylist(some, schema)
            some, held = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def _arrow(conv_type: str, rest: str) -> tuple[str, pa.Schema]:
    """A schema for Spark and the same for Arrow."""
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(),
             "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()), "array<int>": pa.list_(pa.int32()),
             "bigint": pa.int64(), "smallint": pa.int16(), "tinyint": pa.int8()}
    text = f"conv_id {conv_type}, {rest}" if conv_type else rest
    return text, pa.schema([(name, kinds[kind]) for name, kind in (part.split(" ", 1) for part in text.split(", "))])


def cut(rows: DataFrame, most: int = CHUNK_ROWS) -> DataFrame:
    """Sorted rows as chunks: ``conv_id, part, seq, whole``, the columns of DONE where whole, else those of HELD."""
    kind = dict(rows.dtypes)["conv_id"]
    spark_schema, schema = _arrow(kind, f"part int, lane int, seq int, whole boolean, {DONE}, {HELD}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(chunks(_rows(batches)), schema)

    def chunks(source: Iterator[tuple]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        chunk = None

        def told(whole: bool) -> dict:
            found = whole_result(chunk) if whole else held_rows(chunk)
            return {"conv_id": chunk.conv_id, "part": part, "lane": chunk.lane, "seq": chunk.seq, "whole": whole, "size": chunk.size, **found}

        for conv_id, turn, role, text, gone, blank, truncated, digest in source:
            if chunk is None:
                chunk = Chunk(conv_id)
            elif chunk.conv_id != conv_id:
                # The first and the last conversation of a task may go on in its neighbours.
                yield told(chunk.lane > 0 and not chunk.seq)
                chunk = Chunk(conv_id, chunk.lane + 1)
            elif len(chunk.roles) >= most or chunk.size >= CHUNK_BYTES:
                yield told(False)
                chunk = Chunk(conv_id, chunk.lane, chunk.seq + 1)
            if not gone:
                chunk.add(turn, role, text, digest, "blank" if blank else "truncated" if truncated else "")
        if chunk is not None:
            yield told(False)

    columns = ["conv_id", F.col("turn").cast("long"), "role", "text", "gone", "blank", "truncated", "digest"]
    return rows.select(*columns).mapInArrow(run, spark_schema)


# Conversations in several chunks


def mark_later_duplicates(chunks: DataFrame) -> DataFrame:
    """Rows whose role and text an earlier chunk of their conversation has are duplicates."""
    place = F.struct("part", "lane", "seq")
    listed = chunks.select("conv_id", "part", "lane", "seq", F.posexplode(F.arrays_zip("roles", "digests", "faults")).alias("at", "row"))
    fresh = listed.filter(~F.col("row.faults").isin("blank", "duplicate"))
    same = Window.partitionBy("conv_id", "row.roles", "row.digests")
    late = fresh.withColumn("first", F.min(place).over(same)).filter(place > F.col("first"))
    marked = late.groupBy(*KEY).agg(F.collect_list("at").alias("late"))
    joined = chunks.join(marked, KEY, "left")
    fault = lambda f, at: F.when(F.array_contains(F.col("late"), at), "duplicate").otherwise(f)
    faults = F.when(F.col("late").isNull(), F.col("faults")).otherwise(F.transform("faults", fault))
    return joined.withColumn("faults", faults).drop("late", "digests")


def walk(chunks: DataFrame, given: DataFrame) -> DataFrame:
    """The costs around each chunk of the given lanes, walked from the last row to the first.

    ``given`` has ``part, lane, used``: the vector to begin with behind a lane. Gives
    ``part, lane, seq, used, behind, found``: the vectors behind and before each chunk.
    """
    spark_schema, schema = _arrow("", "part int, lane int, seq int, used array<int>, behind array<int>, found array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for (part, lane), rows in groupby(_rows(batches), key=lambda row: row[:2]):
                vector = None
                for _, _, seq, used, roles, faults in rows:
                    behind = vector = tuple(used) if vector is None else vector
                    for step in reversed(steps(roles, faults)):
                        vector = before(step, vector)
                    vector = parallel(vector)
                    yield {"part": part, "lane": lane, "seq": seq, "used": used, "behind": list(behind), "found": list(vector)}

        yield from _batches(found(), schema)

    rows = given.join(chunks.select("part", "lane", "seq", "roles", "faults"), ["part", "lane"])
    return rows.select("part", "lane", "seq", "used", "roles", "faults").repartition("part", "lane").sortWithinPartitions(
        "part", "lane", F.desc("seq")).mapInArrow(run, spark_schema)


def settle(chunks: DataFrame, order: DataFrame) -> DataFrame:
    """``part, lane, seq, behind``: the right vector behind each chunk but for a constant, by fix-up passes.

    A pass walks whole lanes, of which a conversation has one in each task that
    holds rows of it; so there are at most as many passes as tasks.
    """
    end = F.array(*[F.lit(x) for x in END])
    line = Window.partitionBy("conv_id").orderBy("part")
    lanes = written(order.filter("seq = 0").select(
        "part", "lane", F.lead("part").over(line).alias("next_part"), F.lead("lane").over(line).alias("next_lane")))
    state = written(walk(chunks, lanes.select("part", "lane", end.alias("used"))))
    while True:
        ahead = state.filter("seq = 0").select(
            F.col("part").alias("next_part"), F.col("lane").alias("next_lane"), F.col("found").alias("given"))
        handed = lanes.join(ahead, ["next_part", "next_lane"], "left").select("part", "lane", F.coalesce("given", end).alias("given"))
        compared = written(state.join(handed, ["part", "lane"]))
        stale = compared.filter("seq = 0 and used != given")
        if not stale.take(1):
            return compared.select("part", "lane", "seq", "behind")
        again = walk(chunks, stale.select("part", "lane", F.col("given").alias("used")))
        state = written(compared.filter("used = given").drop("given").unionByName(again))


def traced(chunks: DataFrame, order: DataFrame, behind: DataFrame, entered: DataFrame | None = None) -> DataFrame:
    """What each chunk's trace gives.

    Without ``entered`` (part, lane, seq, state): ``leave``, the state behind the chunk for
    each state before it. With it: ``audit, cost, repaired``.
    """
    rest = "leave array<int>" if entered is None else "audit string, cost long, repaired string"
    spark_schema, schema = _arrow("", f"part int, lane int, seq int, {rest}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for part, lane, seq, last, end, roles, faults, *more in _rows(batches):
                todo = steps(roles, faults)
                costs = backward(todo, tuple(end))
                key = {"part": part, "lane": lane, "seq": seq}
                if not more:
                    yield {**key, "leave": [trace(todo, costs, state, last)[1] for state in STATES]}
                    continue
                texts, state = more
                audit, _ = trace(todo, costs, state, last)
                repaired, cost = apply_audit(roles, texts, audit, state)
                told = [letter for letter in audit if letter != "I"]
                cost += sum(step[2] for step, letter in zip(todo, told, strict=True) if letter != "D")
                yield {**key, "audit": audit, "cost": cost, "repaired": repaired, "size": len(repaired)}

        yield from _batches(found(), schema)

    rows = chunks.join(order.select(*KEY, "last"), KEY).join(behind, KEY)
    columns = [*KEY, "last", "behind", "roles", "faults"]
    if entered is not None:
        rows, columns = rows.join(entered, KEY), [*columns, "texts", "state"]
    return rows.select(*columns).mapInArrow(run, spark_schema)


def along(rows: DataFrame) -> DataFrame:
    """All chunks of a conversation one after another in one task, as a stream."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *KEY)


def enter(leaves: DataFrame) -> DataFrame:
    """``part, lane, seq, state``: the state in which each chunk is entered, from its maps ``leave``."""
    spark_schema, schema = _arrow("", "part int, lane int, seq int, state int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for _, rows in groupby(_rows(batches), key=lambda row: row[0]):
                state = START
                for _, part, lane, seq, leave in rows:
                    yield {"part": part, "lane": lane, "seq": seq, "state": state}
                    state = leave[state]

        yield from _batches(found(), schema, 4096)

    return along(leaves.select("conv_id", *KEY, "leave")).mapInArrow(run, spark_schema)


def joined(parts: DataFrame) -> DataFrame:
    """``conv_id, audit, repaired_sha256`` from each chunk's ``audit, repaired``; nothing but the audit is kept."""
    kind = dict(parts.dtypes)["conv_id"]
    spark_schema, schema = _arrow(kind, "audit string, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
                digest, audit, begun = hashlib.sha256(), [], False
                for *_, letters, repaired in rows:
                    audit.append(letters)
                    if repaired:
                        digest.update(("\n" if begun else "").encode() + repaired.encode())
                        begun = True
                yield {"conv_id": conv_id, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

        yield from _batches(found(), schema)

    return along(parts.select("conv_id", *KEY, "audit", "repaired")).mapInArrow(run, spark_schema)


def join_chunks(chunks: DataFrame) -> DataFrame:
    """The results of conversations that lie in several chunks, from their chunks."""
    chunks = written(mark_later_duplicates(chunks))
    line = Window.partitionBy("conv_id").orderBy(*KEY)
    so_far = line.rowsBetween(Window.unboundedPreceding, -1)
    initial = lambda role: F.left(F.get("roles", role), F.lit(1))
    size = F.size("roles")
    ends = chunks.select(
        "conv_id", *KEY, "first_turn", "last_turn", "n_turns", "illegal_inside",
        F.when(size > 0, initial(F.lit(0))).alias("first_role"), F.when(size > 0, initial(size - 1)).alias("last_role"),
        *[(size - F.size(F.array_remove("faults", f))).cast("long").alias(f) for f in FAULTS])
    turn_before, role_before = (F.last(c, ignorenulls=True).over(so_far) for c in ("last_turn", "last_role"))
    order = written(ends.select(
        "*", F.lead("seq").over(line).isNull().alias("last"),
        F.coalesce((turn_before == F.col("first_turn")).cast("long"), F.lit(0)).alias("shared_turns"),
        F.coalesce((~F.concat(role_before, "first_role").isin(*LEGAL)).cast("long"), F.lit(0)).alias("illegal_before")))

    behind = settle(chunks, order)
    of = order.select("conv_id", *KEY)
    leaves = of.join(traced(chunks, order, behind), KEY)
    parts = written(of.join(traced(chunks, order, behind, enter(leaves)), KEY))

    turns = F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("n_turns") - F.col("shared_turns"))
    counted = order.groupBy("conv_id").agg(
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"), *[F.sum(f).alias(f) for f in FAULTS],
        F.sum(F.col("illegal_inside") + F.col("illegal_before")).alias("illegal"))
    cost = parts.groupBy("conv_id").agg(F.sum("cost").alias("cost"))
    by_id = lambda a, b: a.join(b.withColumnRenamed("conv_id", "same"), F.col("conv_id").eqNullSafe(F.col("same"))).drop("same")
    return by_id(by_id(counted, cost), joined(parts))


RESULT = ["conv_id", "gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256"]


def repair(rows: DataFrame, most: int = CHUNK_ROWS) -> DataFrame:
    """The RESULT columns for each conversation of ``rows(conv_id, turn, role, text, gone)``.

    Rows that are ``gone`` only say that their conversation exists. A chunk has
    ``most`` rows at most. The result is a written table; those it is made from are
    removed.
    """
    with scratch(rows.sparkSession) as keep:
        found = written(cut(in_order(rows), most))
        whole = found.filter("whole").select(*RESULT)
        several = join_chunks(found.filter("not whole").select("conv_id", *KEY, *[c.split()[0] for c in HELD.split(", ")]))
        return keep(whole.unionByName(several.select(*RESULT)))
