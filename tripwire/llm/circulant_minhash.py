"""Near-duplicate detection with circulant MinHash.

All coordinates of a signature come from two permutations of the 32-bit
numbers: the first scatters a document's shingles, the second is applied after
shifting them circularly by the coordinate's number, and the smallest value is
kept. Signatures are cut into bands; documents that share a band are candidates;
every link is confirmed on the full shingle sets.

Copies do not multiply. Documents with equal sets form a class, of which the
one with the smallest id goes on. In a bucket of a band each member is compared
with the bucket's smallest and largest id, which is two pairs a member. Links
found so join documents into components, and a bucket whose members all are in
one component is done. In the others the members outside the largest component
are compared with all members, in blocks of bounded size inside a task, so that
no pair but a link becomes a row, and nothing is left out that could still join
two components.

With 56 bands of 7 rows a pair of similarity 0.8 shares no band in about two
cases of a million; that is the only way to lose a link.

Defined results: null and empty texts have no shingles and are linked with
nothing; rows with equal id count as one document; a null id is linked with
nothing and kept; ties do not occur, the smallest id leads; an empty table gives
no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.functions.frames import join_unique, scratch, written
from tripwire.llm.text_arrays import fold, mix, texts, word_hashes

BANDS, ROWS = 56, 7
BLOCK = 500  # documents of a bucket compared at once, on either side
PART = 1 << 15  # shingles worked on at once
_WEIGHTS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(data: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingles of a text, as sorted 64-bit hashes; fewer words than ``width`` make one."""
    words = word_hashes(fold(data))
    n = min(width, len(words))
    if not n:
        return words
    sums = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        sums += words[k:len(words) - n + 1 + k] * _WEIGHTS[k]
    return np.unique(mix(sums))


def _scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation of the 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def _shifted_minima(x: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """A row per set of ``x``, which begin at ``starts``; coordinate k is the smallest value after a shift by k."""
    out, y, z = np.empty((coordinates, len(starts)), np.uint32), np.empty_like(x), np.empty_like(x)
    for k in range(coordinates):
        np.add(x, np.uint32(k), out=y)
        np.multiply(y, np.uint32(0x85EBCA6B), out=y)
        np.right_shift(y, np.uint32(15), out=z)
        np.bitwise_xor(y, z, out=y)
        np.multiply(y, np.uint32(0xC2B2AE35), out=y)
        np.minimum.reduceat(y, starts, out=out[k])
    return out.T


def signatures(sets: list[np.ndarray], coordinates: int = BANDS * ROWS) -> np.ndarray:
    """A row of coordinates for each set, none of which is empty; worked on in parts that fit the cache."""
    out = np.empty((len(sets), coordinates), np.uint32)
    at = 0
    while at < len(sets):
        end, size = at + 1, len(sets[at])
        while end < len(sets) and size + len(sets[end]) <= PART:
            size += len(sets[end])
            end += 1
        x = _scatter((np.concatenate(sets[at:end]) >> np.uint64(32)).astype(np.uint32))
        sizes = np.array([len(s) for s in sets[at:end]])
        if len(sizes) == 1:
            parts = [_shifted_minima(x[i:i + PART], np.zeros(1, int), coordinates) for i in range(0, len(x), PART)]
            out[at] = np.minimum.reduce(parts)[0]
        else:
            out[at:end] = _shifted_minima(x, np.cumsum(sizes) - sizes, coordinates)
        at = end
    return out


def band_hashes(signed: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each band of each row, different from band to band."""
    n = len(signed)
    cells = signed.reshape(n, -1, ROWS).astype(np.uint64)
    bands = np.arange(cells.shape[1], dtype=np.uint64)
    sums = np.broadcast_to(mix(bands + np.uint64(1)), cells.shape[:2]).copy()
    for k in range(ROWS):
        sums = mix(sums ^ (cells[:, :, k] * _WEIGHTS[k]))
    return sums.view(np.int64)


def sign(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, digest, bands`` for each row; the last two null for empty sets."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(data, width) for data in texts(batch.column("text"))]
            some = [s for s in sets if len(s)]
            hashes = band_hashes(signatures(some)) if some else np.zeros((0, BANDS), np.int64)
            counts = np.array([len(s) for s in sets])
            ends = np.append(0, np.cumsum(np.where(counts > 0, BANDS, 0))).astype(np.int32)
            empty = pa.array(counts == 0)
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.ravel(), pa.int64()), mask=empty)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), bands],
                ["doc_id", "n_shingles", "digest", "bands"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, digest binary, bands array<long>")


def shared_buckets(classes: DataFrame) -> DataFrame:
    """``bucket, id, low, high``: the members of each bucket with several, and its smallest and largest id."""
    bands = classes.select(F.explode("bands").alias("bucket"), "id")
    ends = bands.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    return join_unique(bands, ends, "bucket").select("bucket", "id", "low", "high")


def star_pairs(members: DataFrame) -> DataFrame:
    """``a, b``: each bucket's members with its smallest and its largest id."""
    return members.withColumn("end", F.explode(F.array("low", "high"))).filter("id != end").select(
        F.least("id", "end").alias("a"), F.greatest("id", "end").alias("b")).distinct()


def open_blocks(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``bucket, part, against, asks, id, component``: what is left to compare in each bucket.

    Only buckets with members in several components are left. The members
    outside a bucket's largest component ask (``asks``), and all its members
    are asked. Both are dealt into parts of about BLOCK, and every part of the
    one side meets every part of the other.
    """
    known = join_unique(members.select("bucket", "id"), labels.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    sizes = known.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "component")).alias("largest"), F.sum("n").alias("all"), F.count("*").alias("components"),
    ).filter("components > 1 and all > 2").select(
        "bucket", F.col("largest.component").alias("main"),
        F.ceil(F.col("all") / BLOCK).cast("int").alias("parts"),
        F.ceil((F.col("all") - F.col("largest.n")) / BLOCK).cast("int").alias("asking"))
    rows = join_unique(known, largest, "bucket")
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = rows.select("bucket", part("parts").alias("part"), every("asking").alias("against"), F.lit(False).alias("asks"),
                        "id", "component")
    asks = rows.filter("component != main").select(
        "bucket", every("parts").alias("part"), part("asking").alias("against"), F.lit(True).alias("asks"), "id", "component")
    return asked.unionByName(asks)


def compare_blocks(blocks: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b``: a link from each asking document to each other component of its bucket that it is linked with.

    Shared shingles are counted for all documents of a block at once, from the
    places of a shingle in the block.
    """
    kind = dict(docs.dtypes)["id"]

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        # An id may be a struct, which reads as a dict.
        groups = [tuple(g.values()) if isinstance(g, dict) else g for g in table.column("component").to_pylist()]
        sets = [shingles(data, width) for data in texts(table.column("text"))]
        asked = np.flatnonzero(~asks)
        links: dict[tuple, int] = {}
        if len(asked):
            sizes = np.array([len(sets[i]) for i in asked])
            every = np.concatenate([sets[i] for i in asked])
            order = np.argsort(every, kind="stable")
            every, owner = every[order], np.repeat(np.arange(len(asked)), sizes)[order]
            for q in np.flatnonzero(asks):
                low, high = np.searchsorted(every, sets[q], "left"), np.searchsorted(every, sets[q], "right")
                n = high - low
                at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                shared = np.bincount(owner[at], minlength=len(asked))
                alike = (shared > 0) & (100 * shared >= percent * (len(sets[q]) + sizes - shared))
                for i in np.flatnonzero(alike):
                    other = asked[i]
                    if groups[other] != groups[q]:
                        links.setdefault((q, groups[other]), other)
        ids = table.column("id")
        return pa.table({"a": ids.take(pa.array([q for q, _ in links], pa.int64())),
                         "b": ids.take(pa.array(list(links.values()), pa.int64()))})

    whole = join_unique(blocks, docs, "id")
    return whole.groupBy("bucket", "part", "against").applyInArrow(run, f"a {kind}, b {kind}").distinct()


def confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The ``a, b`` of ``pairs`` whose full shingle sets are similar enough; ``docs`` is unique by id."""
    kind = dict(docs.dtypes)["id"]
    both = join_unique(
        join_unique(pairs, docs.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a"),
        docs.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for one, two in zip(texts(batch.column("text_a")), texts(batch.column("text_b")), strict=True):
                x, y = shingles(one, width), shingles(two, width)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for ``links(a, b)``.

    Each round takes the smallest label around a node and then the label of
    that label, so that long chains shorten by doubling.
    """
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
        "node", F.least("node", "near").alias("component")))
    while True:
        around = join_unique(both, labels.select(F.col("node").alias("b"), "component"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = written(join_unique(labels, around, "node").select(
            "node", F.least("component", "near").alias("via"), F.col("component").alias("was")))
        ahead = step.select(F.col("node").alias("via"), F.col("via").alias("component"))
        labels = written(join_unique(step, ahead, "via").select(
            "node", "component", (F.col("component") != F.col("was")).alias("moved")))
        if not labels.filter("moved").take(1):
            return labels.drop("moved")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs(doc_id, text)``.

    The result is a written table; those it is made from are removed.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(_near_duplicates(docs, width, percent))


def _near_duplicates(docs: DataFrame, width: int, percent: int) -> DataFrame:
    signed = written(sign(docs, width))
    usable = signed.filter("digest is not null and doc_id is not null")
    classes = written(usable.groupBy("digest").agg(F.min(F.struct("doc_id", "bands")).alias("first")).select(
        "digest", F.col("first.doc_id").alias("id"), "first.bands"))
    members = written(shared_buckets(classes))

    # The texts of documents that share a bucket are fetched once.
    ids = members.select("id").distinct()
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").alias("id"), F.col("text").cast("string"))
    needed = written(join_unique(rows, ids, "id"))

    links = written(confirm(star_pairs(members), needed, width, percent))
    member_of = join_unique(usable.select("doc_id", "digest"), classes.select("digest", "id"), "digest")
    # An id that stands on several texts is one document: each of its classes is linked to the least.
    least = member_of.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("most")).filter("a != most")
    several = join_unique(member_of, least, "doc_id").filter("id != a").select("a", F.col("id").alias("b")).distinct()
    first = components(links.unionByName(several))
    late = written(compare_blocks(open_blocks(members, first), needed, width, percent))
    found = written(_joined(first, late))

    placed = join_unique(signed.select("doc_id", "n_shingles", "digest"), classes.select("digest", "id"), "digest", "left")
    labelled = join_unique(placed, found.withColumnRenamed("node", "id"), "id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
    return labelled.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _joined(labels: DataFrame, late: DataFrame) -> DataFrame:
    """The components after some more links, which are few: components are linked, then nodes renamed."""
    of = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}"))
    named = join_unique(join_unique(late, of("a"), "a", "left"), of("b"), "b", "left")
    pairs = named.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    more = components(pairs.filter("a != b").distinct()).select(F.col("node").alias("component"), F.col("component").alias("low"))
    renamed = join_unique(labels, more, "component", "left").select("node", F.coalesce("low", "component").alias("component"))
    alone = more.select(F.col("component").alias("node"), F.col("low").alias("component"))
    return renamed.unionByName(join_unique(alone, labels.select("node"), "node", "left_anti"))
