from hashlib import md5

import pytest
from conftest_llm import words
from pyspark.sql import functions as F

from tripwire.llm import mixing as m


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: m.WEIGHTS[i % 3] for i, s in enumerate(names)}
    budget, free, target = 1.5 * sum(sizes.values()), list(names), {}
    while free:
        left = budget - sum(target.values())
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            free.remove(s)
    return target, names


def brute(rows):
    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    target, names = brute_targets(sizes)
    queue = []
    for rank, source in enumerate(names):
        upto, own = 0, [r for r in rows if r[1] == source]
        own.sort(key=lambda r: (md5(b"mix" + ("null" if r[0] is None else str(r[0])).encode()).hexdigest(), r[0] or 0, r[2]))
        for copy in (0, 1):
            for r in own:
                upto += r[2]
                if r[2]:
                    queue.append((upto / target[source], rank, r))
    queue.sort(key=lambda x: x[:2])
    spent, taken, budget = 0, [], 1.5 * sum(sizes.values())
    for _, _, r in queue:
        spent += r[2]
        if spent > budget:
            break
        taken.append(r)
    return target, taken


def sized(table):
    return table.select("doc_id", "source", m.size_of(F.coalesce("text", F.lit(""))).alias("size"))


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_equals_one_queue_in_plain_python(which, request):
    table = request.getfixturevalue(which)
    rows = [(r.doc_id, r.source, len(words(r.text))) for r in table.select("doc_id", "source", "text").collect()]
    target, taken = brute(rows)
    got = m.mix(sized(table), ["doc_id", "source", "size"]).collect()
    assert len(got) == len(rows)
    key = str
    assert sorted((key((r.doc_id, r.source, r.size)), r.taken) for r in got if r.doc_id != 5) == sorted(
        (key(r), taken.count(r) * r[2]) for r in rows if r[0] != 5)
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.taken <= 2 * r.size


def test_a_source_of_a_third_and_a_lone_document(spark):
    rows = [(i, "big", 10) for i in range(400)] + [(1000, "lone", 500)] + [(2000 + i, f"s{i % 4}", 5) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    target, taken = brute(rows)
    got = {r.doc_id: r.taken for r in m.mix(df, ["doc_id", "source", "size"]).collect()}
    assert got == {r[0]: taken.count(r) * r[2] for r in rows}
    assert 0.95 * 1.5 * sum(r[2] for r in rows) <= sum(got.values()) <= 1.5 * sum(r[2] for r in rows)


def test_nothing_to_mix(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert [r.taken for r in m.mix(df, ["doc_id", "source", "size"]).collect()] == [0, 0]
    assert m.mix(df.limit(0), ["doc_id", "source", "size"]).collect() == []
