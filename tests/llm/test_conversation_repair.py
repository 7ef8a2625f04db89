"""Conversation repair against an exhaustive search, in one chunk and in many."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tripwire.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string, seq int, part string"


def damage(rows):
    """The rows of one table after damage, with rows that are gone as None."""
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            out.append((conv, None))
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn, "user" if kind == 4 else role, text)
        out += [(conv, row)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """The least audit of the least cost, by a search that knows no states but the initials so far."""
    legal = re.compile("(s?(ua)*u?)?|s?")
    whole = re.compile("(s?(ua)+)?")
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, tail, lines = heapq.heappop(heap)
        if at == len(rows) and whole.fullmatch(tail):
            return cost, audit, "\n".join(lines)
        # What may follow depends on the start and on the last initial only.
        if (at, tail[-1:]) in done:
            continue
        done.add((at, tail[-1:]))
        step = lambda price, letter, to, initial, line: (
            heapq.heappush(heap, (cost + price, audit + letter, to, tail + initial, lines + line))
            if legal.fullmatch(tail + initial) else None)
        for role in ("user", "assistant"):
            step(2, "I", at, role[0], (f"{role}:",))
        if at == len(rows):
            continue
        role, text, fault = rows[at]
        step(3, "D", at + 1, "", ())
        if fault not in ("blank", "duplicate"):
            more = int(fault == "truncated")
            if role:
                step(more, "K", at + 1, role[0], (f"{role}:{text}",))
            for new in ("user", "assistant"):
                step(2 + more, "R", at + 1, new[0], (f"{new}:{text}",))
    raise AssertionError


def brute(table):
    convs = {}
    for conv, row in damage(table):
        convs.setdefault(conv, [])
        if row:
            convs[conv].append(row)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", ""), 0)
        for _, role, text in rows:
            body = text.strip(" \t\n\v\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            judged.append((role, text, fault))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _, _), (b, _, _) in zip(judged, judged[1:]))
        cost, audit, text = cheapest(judged)
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def compared(spark, table, most):
    frame = spark.createDataFrame([(*row, "?", 1, "?") for row in table], SCHEMA)
    found = repair.repair(repair.damaged(frame.repartition(3)), most).collect()
    assert len(found) == len({r.conv_id for r in found})
    assert {r.conv_id: tuple(r)[1:] for r in found} == brute(table)


def talk(rnd, conv, n, roles):
    texts = ["Yes.", "No", "Well, I think so!", "", " \n", "and then", "Why? ", "ü."]
    return [(conv, rnd.choice([t, t, t, t + 1, None]) if rnd.random() < 0.2 else t, rnd.choice(roles), rnd.choice([*texts, f"row {t}."]))
            for t in range(n)]


@pytest.mark.parametrize("most", [2, 1 << 14])
def test_against_search(spark, most):
    rnd = random.Random(most)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    table = [(None, None, "user", "Hello."), (None, None, "user", "Hello."), (None, 3, None, None)]
    for conv in range(60):
        table += talk(rnd, conv, rnd.randrange(1, 9), roles if conv % 2 else roles[:5])
    # One conversation has a third of all rows, another only rows without a known role.
    table += talk(rnd, 1000, 150, roles[:5]) + talk(rnd, 1001, 40, ["tool"])
    compared(spark, table, most)


def test_equal_rows_lie_in_many_chunks(spark):
    compared(spark, [(1, 5, "user", "The same.")] * 30 + [(1, 6, "assistant", "Yes.")], 3)


def test_all_rows_dropped_and_empty(spark):
    gone = next((conv, 0) for conv in range(1000) if zlib.crc32(f"{conv}:0".encode()) % 20 == 0)
    compared(spark, [(*gone, "user", "x")], 4)
    assert repair.repair(repair.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_long_text(spark):
    compared(spark, [(1, 0, "user", "x" * 6_000_000), (1, 1, "assistant", "y" * 6_000_000 + "."), (1, 2, "user", "z.")], 1 << 14)
