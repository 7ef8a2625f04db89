import random

import numpy as np
import pytest
from conftest_llm import words

from tripwire.llm import circulant_minhash as c


def sets(rows, width):
    out = []
    for i, text in rows:
        w = words("".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or ""))
        n = min(width, len(w))
        out.append((i, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()))
    return out


def brute(rows, width):
    """Smallest id reachable over all links, by comparing every pair."""
    found = sets(rows, width)
    label = {i: i for i, _ in found if i is not None}
    links = [(a, b) for k, (a, x) in enumerate(found) for b, y in found[:k]
             if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted((str(i), len(s), str(label.get(i))) for i, s in found)


def result(df, width):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in c.near_duplicates(df, width).collect())


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_equals_all_pairs_in_plain_python(which, request):
    table = request.getfixturevalue(which).select("doc_id", "text")
    assert result(table, 4) == brute([(r.doc_id, r.text) for r in table.collect()], 4)


def test_a_large_group_of_near_copies_and_a_chain(spark):
    random.seed(5)
    core = [f"w{random.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(150):
        copy = list(core)
        for _ in range(random.randrange(1, 6)):
            copy[random.randrange(len(copy))] = f"v{random.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(f"c{k}" for k in range(i * 3, i * 3 + 60))) for i in range(40)]
    rows += [(2000 + i, rows[0][1]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, 4) == brute(rows, 4)


def test_two_permutations():
    x = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(c._scatter(x))) == len(x)
    zero = np.zeros(1, int)
    one = c._shifted_minima(np.array([7], np.uint32), zero, 3)[0]
    two = c._shifted_minima(np.array([8], np.uint32), zero, 2)[0]
    assert list(one[1:]) == list(two)  # a shift of the set is a shift of the coordinates
    assert len(np.unique(c._shifted_minima(x, np.arange(len(x)), 1))) == len(x)


def test_signatures_estimate_similarity():
    rng = np.random.Generator(np.random.PCG64(1))
    sets = []
    for n in (800, 80, 40_000):
        shared, a, b = (rng.integers(0, 2**63, k, dtype=np.uint64) for k in (n, n // 8, n // 8))
        sets += [np.concatenate([shared, z]) for z in (a, b)]
    signed = c.signatures(sets, 400)
    for k in (0, 2, 4):
        assert abs((signed[k] == signed[k + 1]).mean() - 0.8) < 0.08
        alone = c.signatures(sets[k:k + 1], 400)
        assert (alone[0] == signed[k]).all()


def test_blocks_find_what_stars_miss(spark, monkeypatch):
    """Copies so far apart that the smallest and largest id of a bucket are linked with few."""
    random.seed(9)
    core = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(120):
        copy = list(core)
        for at in random.sample(range(100), random.choice([1, 2, 3, 4, 5])):
            copy[at] = f"v{random.randrange(60)}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(c, "BLOCK", 20)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, 4) == brute(rows, 4)
    nested = c.near_duplicates(df.selectExpr("struct(doc_id as id, xxhash64(text) as version) as doc_id", "text"), 4, 80).collect()
    groups = {}
    for r in nested:
        groups.setdefault(r.component_id.id, set()).add(r.doc_id.id)
    want = {}
    for r in c.near_duplicates(df, 4, 80).collect():
        want.setdefault(r.component_id, set()).add(r.doc_id)
    assert groups == want and sum(r.kept for r in nested) == len(want)


def test_one_id_in_several_classes(spark):
    rows = [(5, "a b c d e f"), (5, "p q r s t u"), (2, "a b c d e f"), (9, "p q r s t u")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in c.near_duplicates(df).collect()} == {2}


def test_no_documents(spark):
    assert c.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_a_long_chain(spark):
    ids = list(range(300))
    random.Random(3).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long")
    assert {r.component for r in c.components(links).collect()} == {0}


def test_an_id_with_three_texts_joins_all_their_groups(spark):
    """Documents 1, 2 and 3 are no copies of each other; document 10 has the text of each."""
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(3)]
    rows = [(i + 1, texts[i]) for i in range(3)] + [(10, t) for t in texts]
    found = c.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in found} == {1} and [r.doc_id for r in found if r.kept] == [1]
