"""A Merkle manifest of a dataset: digests, inclusion proofs and their verification.

Every row is a leaf. Leaves get ranks in the order of (group, key, digest), and every node
carries the interval of leaf ranks it covers, its nested-interval label. The tree of a group
joins every two neighbours; the roots of the groups are the leaves of one more tree.

Levels are built ``STRIDE`` at a time: one shuffle brings the at most 2^STRIDE nodes of a
bucket together and makes all levels above them. Proofs go the other way. Within a stride
the members are joined to the families (a parent with its children) of each level by level
and bucket, and the parent is their ancestor if its interval contains theirs. What the
parent covers and the member's side does not is the interval of the sibling. Members then
take over the path of their topmost ancestor, so the work of upper strides is done once
and not for every leaf. No step gathers a group: buckets hold 2^STRIDE nodes, ranks come
from a range sort and one count for each run of a group in a partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hyetos.llm.common import stored

STRIDE = 8
ROW_BITS = 33  # monotonically_increasing_id: the partition, then 33 bits for its rows

_PATH = "array<struct<up: int, left: boolean, digest: string>>"
_NODE = ["tree", "height", "level", "lo", "hi", "digest"]


def row_digest(columns: list[Column]) -> Column:
    """Hex SHA-256 of the values, each ``-`` if NULL, else its UTF-8 length, ``:``, itself."""
    parts = []
    for column in columns:
        value = column.cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def ranked(leaves: DataFrame, group: str, key: str) -> DataFrame:
    """``leaves`` with ``lo``, its rank, and ``tree`` and ``height`` of its group.

    ``tree`` is the first rank of the group, ``height`` the levels above its leaves.

    NULL groups and NULL keys come first, equal keys are ordered by ``digest``. Rows that are equal
    in all three get neighbouring ranks. A group may span any number of partitions.
    """
    order = [F.asc_nulls_first(group), F.asc_nulls_first(key), F.asc("digest"), F.asc("row")]
    # the row number parts rows that repeat one another, so no range is hot
    numbered = leaves.withColumn("row", F.monotonically_increasing_id())
    spread = numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    number = F.monotonically_increasing_id()
    placed = spread.select(
        "*",
        F.shiftright(number, ROW_BITS).alias("part"),
        number.bitwiseAND((1 << ROW_BITS) - 1).alias("place"),
    )
    placed = stored(placed, "merkle-order")
    runs = stored(
        placed.groupBy("part", F.col(group).alias("run_group")).agg(
            F.min("place").alias("first"), F.count("*").alias("n")
        ),
        "merkle-runs",
    )
    sizes = runs.groupBy("part").agg(F.sum("n").alias("n")).collect()
    starts, total = [], 0
    for row in sorted(sizes):  # one number for each partition
        starts.append((row.part, total))
        total += row.n
    spark = leaves.sparkSession
    runs = runs.join(spark.createDataFrame(starts, "part long, start long"), "part")
    runs = runs.withColumn("start", F.col("start") + F.col("first"))
    size = F.sum("n")
    groups = runs.groupBy(F.col("run_group").alias("g")).agg(
        F.min("start").alias("tree"),
        F.when(size == 1, 0).otherwise(F.length(F.bin(size - 1))).alias("height"),
    )
    runs = runs.join(groups, F.col("run_group").eqNullSafe(F.col("g"))).select(
        F.col("part").alias("run_part"), "run_group", "first", "start", "tree", "height"
    )
    same = (F.col("part") == F.col("run_part")) & F.col(group).eqNullSafe(F.col("run_group"))
    joined = placed.join(runs, same)
    rank = F.col("start") + F.col("place") - F.col("first")
    return joined.select(*leaves.columns, rank.alias("lo"), "tree", "height")


def _bucket(level: int | str) -> Column:
    """The place, within its level, of the node that covers rank ``lo``."""
    return F.expr(f"shiftright(lo - tree, {level})")


def _grown(members: DataFrame, base: int) -> DataFrame:
    """All nodes of levels ``base`` to ``base + STRIDE`` above nodes of level ``base``."""
    packed = members.groupBy("tree", "height", _bucket(base + STRIDE).alias("bucket")).agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("level_0")
    )
    for step in range(STRIDE):
        below = f"level_{step}"
        pairs = (
            f"transform(sequence(0, (size({below}) - 1) div 2), i -> named_struct("
            f"'lo', {below}[2 * i].lo, "
            f"'hi', {below}[least(2 * i + 1, size({below}) - 1)].hi, "
            f"'digest', sha2(concat({below}[2 * i].digest, "
            f"coalesce(get({below}, 2 * i + 1).digest, '')), 256)))"
        )
        packed = packed.withColumn(f"level_{step + 1}", F.expr(pairs))
    levels = F.array(
        *[
            F.struct(F.lit(base + step).alias("level"), F.col(f"level_{step}").alias("nodes"))
            for step in range(STRIDE + 1)
        ]
    )
    rows = packed.select("tree", "height", F.explode(levels).alias("at"))
    rows = rows.where(F.col("at.level") <= F.col("height"))
    return rows.select("tree", "height", "at.level", F.inline("at.nodes")).select(*_NODE)


def strides(members: DataFrame) -> list[DataFrame]:
    """All nodes of the trees over ``members`` (tree, height, lo, digest), by stride.

    Nodes at the border of two strides are in both. A leaf covers its own rank; nodes cover ``lo``
    up to, but not including, ``hi``.
    """
    most = members.agg(F.max(F.col("height"))).first()[0]
    current = members.select(
        "tree", "height", F.lit(0).alias("level"), "lo", (F.col("lo") + 1).alias("hi"), "digest"
    )
    found = []
    base = 0
    while most is not None and (base < most or base == 0):
        nodes = stored(_grown(current, base), "merkle-nodes")
        found.append(nodes)
        base += STRIDE
        current = nodes.where((F.col("level") == base) & (F.col("height") > base))
    return found


def roots(nodes: list[DataFrame]) -> DataFrame:
    """tree, height, lo, hi and digest of the root of every tree."""
    tops = [n.where(F.col("level") == F.col("height")) for n in nodes]
    union = tops[0]
    for top in tops[1:]:
        union = union.union(top)
    # a root at a border is in one stride only: the next one starts from lower nodes
    return union.select("tree", "height", "lo", "hi", "digest")


def _steps(nodes: DataFrame, base: int) -> DataFrame:
    """Each node of level ``base`` below its root with its steps up to the next stride."""
    children = nodes.where((F.col("level") < base + STRIDE) & (F.col("level") < F.col("height")))
    families = children.groupBy(
        "tree", (F.col("level") + 1).alias("up"), _bucket("level + 1").alias("bucket")
    ).agg(F.collect_list(F.struct("lo", "hi", "digest")).alias("children"))
    parents = nodes.where(F.col("level") > base).select(
        "tree",
        F.col("level").alias("up"),
        _bucket("level").alias("bucket"),
        F.col("lo").alias("from"),
        F.col("hi").alias("to"),
    )
    families = families.join(parents, ["tree", "up", "bucket"])
    members = nodes.where((F.col("level") == base) & (F.col("height") > base))
    last = F.least(F.lit(base + STRIDE), F.col("height"))
    climbing = members.select(
        "tree", "height", "lo", "hi", F.explode(F.sequence(F.lit(base + 1), last)).alias("up")
    )
    climbing = climbing.withColumn("bucket", _bucket("up"))
    above = climbing.join(families, ["tree", "up", "bucket"]).where("from <= lo and hi <= to")
    sibling = F.expr("get(filter(children, c -> not (c.lo <= lo and hi <= c.hi)), 0)")
    step = F.struct("up", (sibling["lo"] < F.col("lo")).alias("left"), sibling["digest"].alias("digest"))
    return above.groupBy("tree", "height", "lo", "hi").agg(
        F.array_sort(F.collect_list(step)).alias("path")
    )


def paths(nodes: list[DataFrame], ends: DataFrame) -> DataFrame:
    """``lo`` of every leaf, its path to the end of ``ends``, and the subroot.

    ``ends`` has one row for every tree: tree, height, lo, hi, subroot and the path that goes on
    from its root. A path lists, level by level, the sibling's digest and whether it stands left;
    the digest is NULL where a node has no sibling.
    """
    tops = ends.select(
        "tree", "height", "lo", F.col("height").alias("level"), F.lit(0).cast("long").alias("bucket"), "path", "subroot"
    )
    known = tops
    for number in reversed(range(len(nodes))):
        base = number * STRIDE
        last = F.least(F.lit(base + STRIDE), F.col("height"))
        steps = _steps(nodes[number], base).withColumn("level", last)
        steps = steps.withColumn("bucket", _bucket("level"))
        upper = known.select("tree", "level", "bucket", F.col("path").alias("rest"), "subroot")
        joined = steps.join(upper, ["tree", "level", "bucket"])
        members = joined.select(
            "tree", "height", "lo", F.lit(base).alias("level"), _bucket(base).alias("bucket"),
            F.concat("path", "rest").alias("path"), "subroot",
        )
        known = members.union(tops)
        if number:
            known = stored(known, "merkle-paths")
    return known.where("level = 0").select("lo", "path", "subroot")


@dataclass
class Manifest:
    """``root`` (NULL if there are no rows), all nodes, and the leaves with their proofs."""

    root: str | None
    nodes: list[DataFrame]
    top_nodes: list[DataFrame]
    leaves: DataFrame


def manifest(leaves: DataFrame, group: str, key: str) -> Manifest:
    """The manifest of rows with the columns ``digest``, ``group`` and ``key``.

    The leaves keep all their columns and get ``path`` and ``subroot``; columns of these names, and
    ``lo``, ``tree`` and ``height``, must not be among theirs. Repeated rows are leaves of their
    own. An empty table has no root and no leaves.
    """
    placed = stored(ranked(leaves, group, key), "merkle-leaves")
    nodes = strides(placed.select("tree", "height", "lo", "digest"))
    if not nodes:
        empty = placed.withColumn("path", F.lit(None).cast(_PATH))
        empty = empty.withColumn("subroot", F.lit(None).cast("string"))
        return Manifest(None, [], [], empty)
    tree_roots = stored(roots(nodes), "merkle-roots")
    # trees are numbered by their first rank, so their order is that of the groups
    tops = ranked(tree_roots.select("digest", F.col("tree").alias("of"), F.lit(0).alias("g")), "g", "of")
    tops = stored(tops, "merkle-tops")
    top_nodes = strides(tops.select("tree", "height", "lo", "digest"))
    root = roots(top_nodes).first().digest
    start = roots(top_nodes).select(
        "tree", "height", "lo", "hi",
        F.array().cast(_PATH).alias("path"), F.lit("").alias("subroot"),
    )
    onward = paths(top_nodes, start).join(tops.select("lo", "of"), "lo").select("of", "path")
    ends = tree_roots.join(onward, F.col("tree") == F.col("of")).select(
        "tree", "height", "lo", "hi", "path", F.col("digest").alias("subroot")
    )
    proofs = paths(nodes, stored(ends, "merkle-ends"))
    return Manifest(root, nodes, top_nodes, placed.join(proofs, "lo").drop("tree", "height", "lo"))


def proof_digest(path: str = "path") -> Column:
    """Hex SHA-256 of the siblings' digests along a path."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: step["digest"])), 256)


def folded(digest: Column, path: str = "path") -> Column:
    """The root that a leaf digest and a path lead to."""

    def up(below: Column, step: Column) -> Column:
        other = F.coalesce(step["digest"], F.lit(""))
        joined = F.when(step["left"], F.concat(other, below)).otherwise(F.concat(below, other))
        return F.sha2(joined, 256)

    return F.aggregate(path, digest, up)


def audit(docs: DataFrame) -> DataFrame:
    """Digests, proofs and their check for every row of documents.

    The leaf digest covers doc_id, source, lang, n_chars and text; groups are the values of
    ``lang``. Rows where 7 divides the CRC-32 of the decimal doc_id are checked with n_chars one higher, so they fail unless
    it is NULL; a NULL doc_id is never changed. Other columns are ignored. Rows without doc_id
    come first in their group, equal doc_ids are ordered by digest.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [*fields[:3], F.col("n_chars") + 1, fields[4]]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    leaves = docs.select(
        "doc_id", "lang", row_digest(fields).alias("digest"),
        F.when(tampered & F.col("n_chars").isNotNull(), row_digest(changed)).alias("changed"),
    )
    found = manifest(leaves, "lang", "doc_id")
    root = F.lit(found.root).cast("string")
    presented = F.coalesce("changed", "digest")
    rows = found.leaves.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"),
        proof_digest().alias("proof_sha256"), folded(presented).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
