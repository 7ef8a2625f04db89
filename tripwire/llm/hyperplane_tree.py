"""Hard-negative mining with a multiway hyperplane tree in the manner of GNAT.

*Scores as distances.* An inner product is no distance, so each vector x gets one
more component, sqrt(M^2 - |x|^2), where M is the largest norm of all, and an anchor
gets 0 there. Then |a - x|^2 = |a|^2 + M^2 - 2 a.x, and all x whose score with an
anchor lies in a window lie in an annulus around it.

*Tree.* The split points of a node are rows that lie far apart; each row goes to the
nearest. They are chosen on a sample of at most SAMPLE rows, and every row is put
into the tree. Per node the least and largest distance of each split point to the
rows below each of its siblings are taken over all rows. A subtree is out of the
question for an anchor if, for some split point, the distances that the anchor's
annulus allows and those the subtree has do not meet (triangle inequality). What
remains is scanned exactly, by integer inner products.

*Search.* Anchors are taken in groups of about ANCHORS, which are broadcast; their
number does not depend on the table. The rows lie sorted by leaf, dealt evenly over
the tasks, also where a leaf holds very many equal rows. Each task walks its rows
and keeps the best few for each anchor, which narrows the annuli further; tasks
meet in the best of their bests. Nothing but those is shuffled, and no pair that is
not among a task's best becomes a row. Each group reads the rows twice, once for the
positives and once for the negatives.

Defined results: rows with a null id, label or vector, or with a null or non-finite
component take no part; missing components at the end of shorter vectors are zero;
ties go to the smaller id; a row with the anchor's own id is no positive of it; of
rows with equal id each counts (an anchor that is repeated is answered as often);
scores must fit a long; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.functions.frames import scratch, written

SAMPLE = 4096  # rows that split points are chosen from
POINTS, SPLIT, DEPTH = 8, 128, 4  # split points of a node; sampled rows that a node with points has at least; levels
ANCHORS = 16_384  # anchors answered at once
SLAB = 256  # anchors compared with a block of rows at once
NONE = -(1 << 62)  # no score


def prepared(rows: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part; components as whole numbers, floor(scale * x)."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), whole.alias("vector"))


# The tree


@dataclass
class Node:
    """Split points, their children, and ``low[i, j] .. high[i, j]``: how far rows below child j are from point i."""

    number: int
    points: np.ndarray
    heights: np.ndarray
    children: list[Node | int] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


@dataclass
class Tree:
    dims: int
    norm: float  # the square of the largest norm
    root: Node | int = 0
    nodes: list[Node] = field(default_factory=list)
    paths: list[list[tuple[Node, int]]] = field(default_factory=list)  # for each leaf, its nodes and the child taken

    @property
    def slack(self) -> float:
        """What rounding can do to a distance."""
        return float(np.sqrt(self.norm * (self.dims + 8) * 1e-15))

    def kind(self) -> type:
        """A type in which inner products come out exact."""
        return np.float32 if self.norm < 1 << 24 else np.float64 if self.norm < 1 << 53 else np.int64

    def heights(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.norm - np.einsum("ij,ij->i", x, x), 0))

    def distances(self, x: np.ndarray, heights: np.ndarray, node: Node) -> np.ndarray:
        """From each row to each split point of a node, with the additional component."""
        squares = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", node.points, node.points)[None]
        d = squares - 2 * (x @ node.points.T) + (heights[:, None] - node.heights[None]) ** 2
        return np.sqrt(np.maximum(d, 0))

    def leaves(self, x: np.ndarray, visit: Callable[[Node, int, np.ndarray], None] | None = None) -> np.ndarray:
        """The leaf of each row; ``visit`` sees each node, child and the distances of its rows to the points."""
        out = np.zeros(len(x), np.int32)
        todo = [(self.root, np.arange(len(x)), self.heights(x))]
        while todo:
            node, rows, heights = todo.pop()
            if not isinstance(node, Node):
                out[rows] = node
                continue
            d = self.distances(x[rows], heights, node)
            nearest = d.argmin(axis=1)
            for child, below in enumerate(node.children):
                mine = nearest == child
                if mine.any():
                    if visit:
                        visit(node, child, d[mine])
                    todo.append((below, rows[mine], heights[mine]))
        return out

    def reached(self, leaf: int, anchors: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Whether a leaf may hold rows at a distance from ``near`` to ``far`` of each anchor."""
        ok = near <= far
        zero = np.zeros(len(anchors))
        for node, child in self.paths[leaf]:
            d = self.distances(anchors, zero, node)
            least = np.maximum(d - far[:, None], near[:, None] - d) - self.slack
            most = d + far[:, None] + self.slack
            ok &= ((least <= node.high[:, child]) & (most >= node.low[:, child])).all(axis=1)
        return ok


def grow(sample: np.ndarray, dims: int, norm: float) -> Tree:
    """A tree with the split points that a sample gives; its ranges are still open."""
    tree = Tree(dims, norm)
    heights = tree.heights(sample)

    def build(rows: np.ndarray, depth: int, path: list[tuple[Node, int]]) -> Node | int:
        if len(rows) >= SPLIT and depth < DEPTH:
            chosen = spread_out(sample[rows], heights[rows])
            if len(chosen) > 1:
                node = Node(len(tree.nodes), sample[rows[chosen]], heights[rows[chosen]])
                tree.nodes.append(node)
                nearest = tree.distances(sample[rows], heights[rows], node).argmin(axis=1)
                for child in range(len(chosen)):
                    node.children.append(build(rows[nearest == child], depth + 1, [*path, (node, child)]))
                return node
        tree.paths.append(path)
        return len(tree.paths) - 1

    def spread_out(x: np.ndarray, h: np.ndarray) -> list[int]:
        """Rows far apart: each is the one whose nearest chosen row is farthest."""
        chosen, squares = [0], np.einsum("ij,ij->i", x, x)
        nearest = np.full(len(x), np.inf)
        while len(chosen) < POINTS:
            at = chosen[-1]
            nearest = np.minimum(nearest, squares + squares[at] - 2 * (x @ x[at]) + (h - h[at]) ** 2)
            if nearest.max() <= 4 * tree.slack ** 2:
                break
            chosen.append(int(nearest.argmax()))
        return chosen

    tree.root = build(np.arange(len(sample)), 0, [])
    return tree


def matrix(column: pa.Array, dims: int, kind: type = np.float64) -> np.ndarray:
    """List values as rows of a matrix, shorter lists filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(column), dims).astype(kind)
    out = np.zeros((len(column), dims), kind)
    starts = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(starts, sizes)] = flat
    return out


def index(rows: DataFrame) -> tuple[DataFrame, Tree] | None:
    """All rows with their ``leaf``, sorted by it, and the tree; None for an empty table."""
    spark = rows.sparkSession
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    dims, norm = rows.agg(F.max(F.size("vector")), F.max(squares)).first()
    if norm is None:
        return None
    some = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(SAMPLE).select("vector").toArrow()
    tree = grow(matrix(some.column("vector").combine_chunks(), dims), dims, norm)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.leaves(matrix(batch.column("vector"), dims))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", *batch.schema.names])

    placed = rows.mapInArrow(place, "leaf int, vec_id long, label long, vector array<long>")
    spread = ["leaf", F.xxhash64(F.monotonically_increasing_id())]
    indexed = written(placed.select("*", spread[1].alias("spread")).repartitionByRange("leaf", "spread").sortWithinPartitions(
        "leaf", "vec_id").drop("spread"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {n.number: np.full((2, len(n.points), len(n.points)), np.inf) for n in shared.value.nodes}

        def visit(node: Node, child: int, d: np.ndarray) -> None:
            low, high = known[node.number]
            low[:, child] = np.minimum(low[:, child], d.min(axis=0))
            high[:, child] = np.minimum(high[:, child], -d.max(axis=0))

        for batch in batches:
            shared.value.leaves(matrix(batch.column("vector"), dims), visit)
        for number, (low, high) in known.items():
            point, child = np.nonzero(low < np.inf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(point), number, np.int32)), pa.array(point.astype(np.int32)), pa.array(child.astype(np.int32)),
                 pa.array(low[point, child]), pa.array(-high[point, child])], ["node", "point", "child", "low", "high"])

    ranges = indexed.select("vector").mapInArrow(measure, "node int, point int, child int, low double, high double")
    for node in tree.nodes:
        node.low, node.high = np.full((2, len(node.points), len(node.points)), np.inf)
        node.high = -node.high
    for r in ranges.groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        tree.nodes[r.node].low[r.point, r.child], tree.nodes[r.node].high[r.point, r.child] = r.low, r.high
    return indexed, tree


# Search


@dataclass
class Anchors:
    """A group of anchors; ``low`` and ``high`` are windows of scores, one or more for each anchor."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same_label: bool
    best: int  # rows wanted for each window

    def __post_init__(self) -> None:
        self.squares = np.einsum("ij,ij->i", self.x, self.x)


def keys_of(scores: np.ndarray, wrong: np.ndarray) -> np.ndarray:
    """One number for each score and column: larger is better, by score and then by the smaller column."""
    n = scores.shape[1]
    keys = scores.astype(np.int64) * n + np.arange(n - 1, -1, -1)
    keys[wrong] = np.iinfo(np.int64).min
    return keys


def best_below(keys: np.ndarray, n: int, low: np.ndarray, high: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row and window the best keys whose score lies in it, as scores and columns."""
    keys = np.sort(keys, axis=1)
    limits = np.minimum(high, np.iinfo(np.int64).max // n - 1) * n + n - 1
    ends = np.stack([np.searchsorted(row, limit, "right") for row, limit in zip(keys, limits, strict=True)])
    at = ends[:, :, None] - 1 - np.arange(best)
    found = np.take_along_axis(keys, np.maximum(at, 0).reshape(len(keys), -1), axis=1).reshape(at.shape)
    scores, columns = found // n, n - 1 - found % n
    scores[(at < 0) | (found == np.iinfo(np.int64).min) | (scores < low[:, :, None])] = NONE
    return scores, columns


class Best:
    """The best rows of each window so far."""

    def __init__(self, anchors: Anchors):
        shape = (*anchors.low.shape, anchors.best)
        self.scores, self.ids = np.full(shape, NONE), np.zeros(shape, np.int64)

    def take(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[at], scores], axis=2)
        ids = np.concatenate([self.ids[at], ids], axis=2)
        order = np.lexsort((ids, -scores), axis=-1)[:, :, :self.scores.shape[2]]
        self.scores[at], self.ids[at] = np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)


def scan(tree: Tree, anchors: Anchors, best: Best, leaf: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
    """Compare the anchors that may find something in a leaf with some of its rows, which are sorted by id."""
    least = np.maximum(anchors.low, best.scores[:, :, -1]).min(axis=1)
    most = anchors.high.max(axis=1)
    base = anchors.squares + tree.norm
    near, far = (np.sqrt(np.maximum(base - 2.0 * s, 0)) for s in (np.minimum(most, tree.norm + 1), np.maximum(least, -tree.norm - 1)))
    open_ = (anchors.low <= anchors.high).any(axis=1) & tree.reached(leaf, anchors.x, near, far + tree.slack)
    if anchors.same_label:
        open_ &= np.isin(anchors.labels, labels)
    kind = tree.kind()
    for group in np.unique(anchors.labels[open_]) if anchors.same_label else [None]:
        mine = labels == group if anchors.same_label else np.ones(len(ids), bool)
        asked = np.flatnonzero(open_ & (anchors.labels == group) if anchors.same_label else open_)
        columns = np.flatnonzero(mine)
        most_rows = int(max(1, min(len(columns), (1 << 62) // max(tree.norm, 1))))  # keys must fit 64 bits
        for j in range(0, len(columns), most_rows):
            part = columns[j:j + most_rows]
            own, own_ids, own_labels = x[part].astype(kind), ids[part], labels[part]
            for k in range(0, len(asked), SLAB):
                at = asked[k:k + SLAB]
                same = anchors.ids[at][:, None] == own_ids if anchors.same_label else anchors.labels[at][:, None] == own_labels
                keys = keys_of(anchors.x[at].astype(kind) @ own.T, same)
                found, place = best_below(keys, len(part), anchors.low[at], anchors.high[at], anchors.best)
                best.take(at, found, own_ids[place])


def search(indexed: DataFrame, tree: Tree, anchors: Anchors) -> DataFrame:
    """``anchor, window, score, id``: the best rows of each window (places in ``anchors``), with their ``rank``."""
    shared = indexed.sparkSession.sparkContext.broadcast((tree, anchors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, anchors = shared.value
        best = Best(anchors)
        for batch in batches:
            leaf, ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "vec_id", "label"))
            x = matrix(batch.column("vector"), tree.dims)
            edges = [0, *(np.flatnonzero(np.diff(leaf)) + 1), len(leaf)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a < b:
                    order = a + np.argsort(ids[a:b], kind="stable")
                    scan(tree, anchors, best, int(leaf[a]), ids[order], labels[order], x[order])
        anchor, window, place = np.nonzero(best.scores > NONE)
        columns = [anchor.astype(np.int32), window.astype(np.int32), best.scores[anchor, window, place], best.ids[anchor, window, place]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "window", "score", "id"])

    found = indexed.mapInArrow(run, "anchor int, window int, score long, id long")
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= anchors.best)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives for ``rows(vec_id, label, vector)``, see ``prepared``.

    For each anchor its ``positives`` best rows of its own label, and for each of
    those the ``negatives`` best rows of other labels whose score is ``low`` to
    ``high`` per cent of the positive's: ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``. A written table.
    """
    with scratch(rows.sparkSession) as keep:
        return keep(_mine(written(rows), is_anchor, positives, negatives, low, high))


def _mine(rows: DataFrame, is_anchor: Column, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    built = index(rows)
    asked = rows.filter(is_anchor)
    n = asked.count()
    if built is None or not n:
        return spark.createDataFrame([], schema)
    indexed, tree = built
    groups = -(-n // ANCHORS)
    asked = written(asked.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int")))
    parts = [_mine_group(indexed, tree, asked.filter(F.col("group") == g), positives, negatives, low, high) for g in range(groups)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _mine_group(indexed: DataFrame, tree: Tree, asked: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    rows = asked.select("vec_id", "label", "vector").toArrow().combine_chunks()
    ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
    vectors = rows.column("vector").combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int64()))
    x = matrix(vectors, tree.dims)
    every = np.full((len(ids), 1), -(1 << 61)), np.full((len(ids), 1), 1 << 61)
    near = search(indexed, tree, Anchors(ids, labels, x, *every, True, positives))

    # At most ``positives`` scores and ids for each anchor of the group.
    scores, others = np.full((len(ids), positives), NONE), np.zeros((len(ids), positives), np.int64)
    best = near.select("anchor", "rank", "score", "id").toArrow()
    anchor, place = best.column("anchor").to_numpy(), best.column("rank").to_numpy() - 1
    scores[anchor, place], others[anchor, place] = best.column("score").to_numpy(), best.column("id").to_numpy()
    missing = scores == NONE
    floor, ceiling = -(-scores * low // 100), scores * high // 100
    floor[missing], ceiling[missing] = 1, 0
    found = search(indexed, tree, Anchors(ids, labels, x, floor, ceiling, False, negatives))

    names = indexed.sparkSession.createDataFrame(pa.table({
        "anchor": np.repeat(np.arange(len(ids), dtype=np.int32), positives), "window": np.tile(np.arange(positives, dtype=np.int32), len(ids)),
        "anchor_id": np.repeat(ids, positives), "positive_id": others.ravel(), "positive_score": scores.ravel()}))
    return written(found.join(names, ["anchor", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score")))
