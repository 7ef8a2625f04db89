"""Hard negatives against brute force, the tree's ranges against all distances."""

import numpy as np
import pyspark.sql.functions as F
import pytest

from tripwire.llm import hyperplane_tree as tree

SCHEMA = "vec_id long, label int, embedding array<double>, leaf string, score string, anchor string, rank string, id string"


def brute(rows, positives=5, negatives=3):
    rows = [(i, label, [int(np.floor(256 * x)) for x in v]) for i, label, v in rows
            if None not in (i, label, v) and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, v in rows:
        if i % 50:
            continue
        scored = sorted((-dot(v, w), j, other) for j, other, w in rows)
        near = [(-s, j) for s, j, other in scored if other == label and j != i][:positives]
        for p, positive in near:
            fit = [(-s, j) for s, j, other in scored if other != label and 50 * p <= -100 * s <= 95 * p][:negatives]
            out += [(i, positive, rank + 1, j, p, s) for rank, (s, j) in enumerate(fit)]
    return sorted(out)


def compared(spark, rows):
    frame = spark.createDataFrame([(i, label, v, *["?"] * 5) for i, label, v in rows], SCHEMA)
    found = tree.mine(tree.prepared(frame.repartition(3)), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows)


def clustered(seed, n, dims, spread, labels=4):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, dims))
    return [(i, int(rnd.integers(labels)), (centres[rnd.integers(12)] + spread * rnd.normal(size=dims)).tolist()) for i in range(n)]


@pytest.mark.parametrize(("dims", "spread"), [(3, 0.05), (32, 1.0)])
def test_against_brute_force(spark, dims, spread):
    compared(spark, clustered(dims, 900, dims, spread))


def test_ties_nulls_and_large_numbers(spark):
    rows = clustered(1, 300, 2, 0.3)
    rows += [(400 + i, i % 2, [1.0, 0.5]) for i in range(200)]  # very many equal rows
    rows += [(50, 0, [1.0, 1.0]), (50, 0, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (700, None, [1.0, 1.0]), (701, 1, None),
             (702, 1, [None, 1.0]), (703, 1, [float("nan"), 1.0]), (704, 1, [float("inf"), 1.0]), (750, 1, [1.0]), (751, 1, [])]
    compared(spark, rows)
    compared(spark, [(i, label, [x * 3e5 for x in v]) for i, label, v in clustered(2, 200, 2, 0.5)])


def test_empty_tables(spark):
    compared(spark, [])
    compared(spark, [(1, 1, [1.0, 2.0])])
    compared(spark, [(0, 1, [0.0]), (1, 1, [0.0]), (2, 2, [0.0])])


def test_ranges_hold_for_every_row_and_eliminate(spark):
    rows = spark.createDataFrame([(i, label, v, *["?"] * 5) for i, label, v in clustered(3, 3000, 3, 0.02)], SCHEMA)
    indexed, grown = tree.index(tree.prepared(rows))
    table = indexed.toArrow()
    x, leaf = tree.matrix(table.column("vector").combine_chunks(), 3), table.column("leaf").to_numpy()
    assert len(grown.paths) > 20 and (grown.leaves(x) == leaf).all()
    heights = grown.heights(x)
    for number, path in enumerate(grown.paths):
        for node, child in path:
            d = grown.distances(x[leaf == number], heights[leaf == number], node)
            assert (d >= node.low[:, child] - grown.slack).all() and (d <= node.high[:, child] + grown.slack).all()
    # An anchor's window reaches the leaves that hold a score of it, and few others.
    anchors, scores = x[:100], x[:100] @ x.T
    base = (anchors ** 2).sum(axis=1) + grown.norm
    near, far = np.zeros(100), np.sqrt(np.maximum(base - 2 * np.sort(scores, axis=1)[:, -20], 0))
    reached = np.stack([grown.reached(number, anchors, near, far + grown.slack) for number in range(len(grown.paths))])
    holds = np.stack([(scores[:, leaf == number] >= np.sort(scores, axis=1)[:, -20:-19]).any(axis=1) for number in range(len(grown.paths))])
    assert (reached | ~holds).all()
    assert reached.mean() < 0.6
