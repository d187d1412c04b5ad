"""Jaccard self-join on word shingles by chosen paths.

Each distinct set of shingles is a class (copies join it without being compared) and is
embedded as ``COORDINATES`` of its own shingles, each the least under one hash function:
two sets share a coordinate with a chance equal to their Jaccard similarity. A run splits
the sets recursively: a node takes ``BRANCHES`` coordinates, drawn by its own hash, and its
sets part by the shingle each has there. Nodes of at most ``SMALL`` sets are leaves; so is
a node that hardly shrinks when split, since its sets are alike. In a leaf all sets are
compared with their whole shingle sets. Runs are repeated until a pair at the threshold
meets with the chance ``recall``.

A pair that meets in several leaves counts in the first of them: each set carries its list
of leaves. A set is sent to a leaf only if some pair has its first meeting there. Leaves
of many shingles are dealt in blocks, one task for each two blocks, so memory is bounded
and no group meets in one task. Pairs never become rows: a leaf returns for each set the
number of its links and the least set it is connected with, and components of those stars
are the classes. The comparisons inside a group of different near copies still grow with
its square, as each of their links is counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyetos.llm.common import full_text, slices, stored
from hyetos.llm.graph import components

COORDINATES = 128
BRANCHES = 2
SMALL = 48
MAX_DEPTH = 8
BLOCK_SHINGLES = 400_000
BLOCK_SETS = 1_500
#: ASCII letters and digits stay, other ASCII becomes space, the rest stays; in UTF-8.
_KEEP = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_POWERS = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64))
_MULTIPLIERS = _POWERS[1000 : 1000 + COORDINATES] | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of all runs of ``size`` words; of all words if there are fewer."""
    raw = np.frombuffer((text or "").lower().encode().translate(_KEEP), np.uint8)
    inside = np.flatnonzero(raw != 32)
    if not len(inside):
        return np.zeros(0, np.uint64)
    starts = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    place = np.arange(len(inside)) - np.repeat(starts, np.diff(starts, append=len(inside)))
    values = (raw[inside].astype(np.uint64) + np.uint64(1)) * _POWERS[place % len(_POWERS)]
    words = _mix(np.add.reduceat(values, starts))
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total += words[i : i + len(total)] * _POWERS[i + 7]
    return np.unique(_mix(total))


def embed(own: np.ndarray) -> np.ndarray:
    """For each hash function 32 bits of the least shingle hash."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 2048):
        np.minimum(least, (own[at : at + 2048, None] * _MULTIPLIERS).min(axis=0), out=least)
    return (_mix(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def runs_for(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold has met with the chance ``recall``."""
    meet = 1.0
    for _ in range(MAX_DEPTH):
        meet = 1 - (1 - threshold * meet) ** BRANCHES
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def set_rows(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, hash of the text, key and n of the shingle set, and its embedding; n is 0 without words.

    The key is 64 bits of all shingles: two different sets among n share one with a chance
    of about n² / 2^65.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t, size) for t in batch.column(1).to_pylist()]
            keys = [int(_mix(_mix(s).sum(keepdims=True))[0].view(np.int64)) if len(s) else 0 for s in sets]
            flat = np.concatenate([embed(s) for s in sets]) if sets else np.zeros(0, np.int32)
            offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * COORDINATES)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(keys, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.ListArray.from_arrays(offsets, pa.array(flat)),
                ],
                names=["doc_id", "text_hash", "key", "n", "embedding"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), full_text(), F.xxhash64(full_text()))
    ddl = "doc_id long, text_hash long, key long, n int, embedding array<int>"
    return texts.mapInArrow(rows, ddl)


def _children(parents: DataFrame) -> DataFrame:
    """Add ``children``, the nodes that a set goes to from its node, one per branch."""
    first = F.pmod(F.xxhash64("node", F.lit(0)), F.lit(COORDINATES))
    spots = [first]
    for j in range(1, BRANCHES):
        step = F.pmod(F.xxhash64("node", F.lit(j)), F.lit(COORDINATES - 1)) + 1
        spots.append(F.pmod(first + step, F.lit(COORDINATES)))
    children = [F.xxhash64("node", s, F.element_at("embedding", s.cast("int") + 1)) for s in spots]
    return parents.withColumn("children", F.array(*children)).drop("embedding")


def leaves(sets: DataFrame, threshold: float, recall: float) -> DataFrame:
    """node, key, blocks of every set in a leaf of two sets or more."""
    runs = runs_for(threshold, recall)
    if runs * BRANCHES > COORDINATES:
        raise ValueError("the recall asks for more coordinates than there are")
    tops = [
        F.xxhash64(F.lit(r), F.lit(j), F.col("embedding")[r * BRANCHES + j])
        for r in range(runs)
        for j in range(BRANCHES)
    ]
    rows = sets.select(F.explode(F.array(*tops)).alias("node"), "key", "n")
    found = []
    for depth in range(MAX_DEPTH + 1):
        sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.sum("n").alias("total"))
        kept = stored(rows.join(sizes.where("size > 1"), "node"), "paths")
        ends = depth == MAX_DEPTH
        found.append(kept if ends else kept.where(F.col("size") <= SMALL))
        big = kept.where(F.col("size") > SMALL)
        if ends or big.isEmpty():
            break
        parents = stored(_children(big.join(sets.select("key", "embedding"), "key")), "parents")
        branch = parents.groupBy("node", "size", F.col("children")[0]).count()
        dense = branch.where("count * 2 >= size").select("node").distinct()
        dense = stored(dense, "dense")  # sets much alike: not split, a leaf as it is
        found.append(parents.join(dense, "node").drop("children"))
        split = parents.join(dense, "node", "left_anti")
        rows = split.select(F.explode("children").alias("node"), "key", "n")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    blocks = F.ceil(F.greatest(F.col("total") / BLOCK_SHINGLES, F.col("size") / BLOCK_SETS))
    return stored(result.select("node", "key", blocks.cast("int").alias("blocks")), "leaves")


def _groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[tuple[tuple, list[list]]]:
    """Rows that share their first ``by`` columns and follow each other."""
    label, held = None, []
    for batch in batches:
        for part in slices([batch], 512):
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if row[:by] != label and held:
                    yield label, held
                    held = []
                label = row[:by]
                held.append(row[by:])
    if held:
        yield label, held


def _meet_before(lists: list[list[int]], node: int) -> np.ndarray:
    """Which two sets share a leaf before ``node`` in the order of node numbers."""
    earlier = [[x for x in own if x < node] for own in lists]
    names = {x: i for i, x in enumerate(sorted({x for own in earlier for x in own}))}
    matrix = np.zeros((len(lists), len(names)), np.float32)
    for row, own in enumerate(earlier):
        matrix[row, [names[x] for x in own]] = 1
    return matrix @ matrix.T > 0


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (node, key, lists, blocks) in order of node those with a first meeting."""
    for (node,), rows in _groups(batches, 1):
        if rows[0][2] == 1:
            open_pairs = ~_meet_before([r[1] for r in rows], node)
            np.fill_diagonal(open_pairs, False)
            rows = [r for r, needs in zip(rows, open_pairs.any(axis=1), strict=True) if needs]
        for at in range(0, len(rows), 1000):
            part = rows[at : at + 1000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([node] * len(part), pa.int64()),
                    pa.array([r[0] for r in part], pa.int64()),
                    pa.array([r[1] for r in part], pa.list_(pa.int64())),
                    pa.array([r[2] for r in part], pa.int32()),
                ],
                names=["node", "key", "nodes", "blocks"],
            )


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    m = len(sets)
    if m == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), shared], [shared, len(sets[1])]], np.int64)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, token, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[token] > 1  # what one set has alone meets nothing
    owner, token = owner[shared], token[shared]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    token = np.cumsum(np.diff(token, prepend=token[:1]) > 0)
    total = np.zeros((m, m), np.float32)
    width = max(256, (1 << 22) // m)
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, [low, low + width])
        matrix = np.zeros((m, width), np.float32)
        matrix[owner[a:b], token[a:b] - low] = 1
        total += matrix @ matrix.T
    return total.astype(np.int64)


def compare(
    sets: list[np.ndarray], threshold: float, sides: np.ndarray | None = None
) -> np.ndarray:
    """Which pairs have the similarity; with ``sides`` only pairs of different sides."""
    sizes = np.array([len(s) for s in sets])
    shared = overlaps(sets)
    union = sizes[:, None] + sizes[None, :] - shared
    alike = shared * 1_000_000 >= round(threshold * 1_000_000) * union
    np.fill_diagonal(alike, False)
    if sides is not None:
        alike &= sides[:, None] != sides[None, :]
    return alike


def _roots(alike: np.ndarray) -> np.ndarray:
    """The least member of each connected group."""
    label = np.arange(len(alike))
    while True:
        near = np.where(alike, label[None, :], len(label)).min(axis=1)
        fresh = np.minimum(label, near)
        fresh = np.minimum(fresh, fresh[fresh])
        if (fresh == label).all():
            return label
        label = fresh


def _matcher(threshold: float, size: int):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (node, low, high), rows in _groups(batches, 3):
            rows = sorted({r[0]: r for r in rows}.values(), key=lambda r: r[0])  # repeated rows bring a set twice
            sides = None if low == high else np.array([r[1] for r in rows])
            alike = compare([shingles(r[4], size) for r in rows], threshold, sides)
            linked = np.flatnonzero(alike.any(axis=1))
            if not len(linked):
                continue
            rows, alike = [rows[i] for i in linked], alike[np.ix_(linked, linked)]
            first = alike & ~_meet_before([r[2] for r in rows], node)
            weights = np.array([r[3] for r in rows], np.int64)
            roots = _roots(alike)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array(first @ weights, pa.int64()),
                    pa.array([rows[i][0] for i in roots], pa.int64()),
                ],
                names=["key", "links", "root"],
            )

    return match


def join(
    docs: DataFrame, threshold: float = 0.8, size: int = 5, recall: float = 0.99999
) -> DataFrame:
    """doc_id, class_id and n_links for every row of ``docs`` (doc_id, text).

    Two documents are linked if their sets of ``size``-word shingles have a Jaccard
    similarity of at least ``threshold``; words are lower-cased, ASCII marks part them,
    and a text of fewer words is one shingle. ``n_links`` counts linked rows, copies and
    repeated rows among them. ``class_id`` is the least doc_id of those connected by links
    (NULL if they have none). Texts without words, NULL ones too, have no links and are a
    class of their own.
    """
    members = stored(set_rows(docs, size), "sets")
    sets = stored(
        members.where("n > 0").groupBy("key").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "text_hash")).alias("one"), F.max("n").alias("n"), F.min("embedding").alias("embedding"),
        ),
        "classes",
    )
    found = leaves(sets, threshold, recall)
    lists = found.groupBy("key").agg(F.sort_array(F.collect_set("node")).alias("nodes"))
    listed = found.join(lists.where("size(nodes) > 0"), "key").select("node", "key", "nodes", "blocks")
    places = F.when(F.col("blocks") == 1, F.lit(0)).otherwise(
        F.pmod(F.xxhash64("key", F.lit("slot")), F.col("blocks") * 4)
    )  # large leaves are taken over as they are, so their rows need not meet here
    ordered = listed.repartition("node", places).sortWithinPartitions("node")
    ddl = "node long, key long, nodes array<long>, blocks int"
    needed = stored(ordered.mapInArrow(_needed, ddl), "meetings")
    block = F.pmod(F.xxhash64("key", F.lit("block")), F.col("blocks")).cast("int")
    wanted = needed.select("key").distinct().join(sets.select("key", "copies", "one"), "key")
    texts = docs.select("doc_id", full_text().alias("text"))
    same = wanted.one.doc_id.eqNullSafe(texts.doc_id.cast("long"))
    same &= wanted.one.text_hash == F.xxhash64(texts.text)
    dealt = (
        needed.join(wanted.join(texts, same).select("key", "copies", "text"), "key")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "key", "block", "nodes", "copies", "text",
        )
    )
    dealt = dealt.repartition("node", "low", "high").sortWithinPartitions("node", "low", "high")
    matched = stored(
        dealt.mapInArrow(_matcher(threshold, size), "key long, links long, root long"), "matches"
    )
    links = matched.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(matched.select(F.col("key").alias("a"), F.col("root").alias("b")))
    classed = (
        sets.select("key", "copies", "least")
        .join(links, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    named = classed.join(classed.groupBy("root").agg(F.min("least").alias("class_id")), "root")
    return members.join(named.select("key", "links", "copies", "class_id"), "key", "left").select(
        "doc_id",
        F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("n") > 0, F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
        .otherwise(0).cast("long").alias("n_links"),
    )
