"""Fuzzy line deduplication: one line of every group of near-equal lines stays.

All work is done by Spark's own expressions. Lines that are equal after trimming and
lower-casing are one node. A node's signature has ``HASHES`` minima: every character
shingle is hashed once, and each minimum is taken after an exclusive-or with its own
constant, so it belongs to the shingle whose hash lies nearest to that constant. Signatures
are combined before their shuffle, together with the repeated lines. Bands of
``ROWS`` minima find candidates; exact Jaccard similarities of the shingle sets decide; the
components of the links are the groups.

In a band's bucket of at most ``SMALL`` lines all pairs are compared. In larger ones no
pairs are listed: all lines are compared with the most frequent line, the pivot. As Jaccard distance is a metric, a line beyond twice the allowed
distance from the pivot has no link to a line within it. Those in between are compared with
lines of the bucket that no other link has connected them to, if both distances and a bound
from bit maps of their shingles leave a link possible; the bound never excludes one. The lines far away form a bucket of their
own with a second pivot. What is then left of at most ``MIDDLE`` lines is compared in that
way too; more is parted by its lines' rarest shingles, so many of each line that no pair at
the threshold is parted, and the parts get pivots of their own.

Nodes are 64-bit hashes: among n different lines two share one with a chance of about
n² / 2^65. Bit maps of bounded size (``MOST_BITS``) are broadcast to thin out the rows of
large shuffles; they let all wanted rows pass, so they change no result.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hyetos.llm.common import stored
from hyetos.llm.graph import components

SHINGLE = 10
HASHES = 32
ROWS = 4
BANDS = 12
STRIDE = 4
PART = 8  # shingles hashed in one row
SMALL = 12
MIDDLE = 1024
TRIES = 16
WORDS = 16  # of 64 bits in the map of a line's shingles
MOST_BITS = 1 << 26


def _constants() -> list[int]:
    """One constant in each of ``HASHES`` equal ranges of 64-bit numbers, in mixed order."""
    source = random.Random(7)
    width = (1 << 64) // HASHES
    values = [i * width + source.randrange(width) - (1 << 63) for i in range(HASHES)]
    source.shuffle(values)
    return values


def _bands(columns: list[Column]) -> Column:
    """Hashes of ``BANDS`` groups of minima; from the second turn on the groups differ."""
    per_turn = HASHES // ROWS
    keys = []
    for band in range(BANDS):
        turn, at = divmod(band, per_turn)
        members = [(at + i * (per_turn + turn)) % HASHES if turn else at * ROWS + i
                   for i in range(ROWS)]
        keys.append(F.xxhash64(F.lit(band), *[columns[m] for m in members]))
    return F.array(*keys)


def split_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no and line of all lines of ``docs``; a NULL text has none."""
    return docs.where("text is not null").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )


def _normal() -> Column:
    return F.lower(F.trim("line"))


def nodes(lines: DataFrame) -> DataFrame:
    """doc_id, line_no, normal line and node of the lines that are not blank."""
    normal = lines.select("doc_id", "line_no", _normal().alias("normal")).where("normal <> ''")
    return normal.withColumn("node", F.xxhash64("normal"))


def signatures(lines: DataFrame) -> DataFrame:
    """node, first_doc, copies and band hashes of every different line."""
    units = F.encode("normal", "UTF-16BE")  # two bytes for each unit: constant-time pieces
    ready = nodes(lines).select("doc_id", "node", units.alias("units")).withColumn(
        "last", F.expr(f"greatest(length(units) div 2 - {SHINGLE}, 0)")
    )
    spread = ready.select(
        "doc_id", "node", "units", "last", F.expr(f"explode(sequence(0, last, {STRIDE}))").alias("at")
    )
    hashed = spread.select(
        "doc_id", "node", (F.col("at") == 0).cast("long").alias("starts"),
        *[
            F.xxhash64(F.expr(f"substring(units, 2 * least(at + {i}, last) + 1, {2 * SHINGLE})")).alias(f"h{i}")
            for i in range(STRIDE)
        ],
    )
    minima = []
    for number, constant in enumerate(_constants()):
        near = F.least(*[F.col(f"h{i}").bitwiseXOR(F.lit(constant)) for i in range(STRIDE)])
        minima.append(F.min(F.shiftright(near, 32)).alias(f"m{number}"))
    signed = hashed.groupBy("node").agg(
        F.min("doc_id").alias("first_doc"), F.sum("starts").alias("copies"), *minima
    )
    columns = [F.col(f"m{i}") for i in range(HASHES)]
    return signed.select("node", "first_doc", "copies", _bands(columns).alias("bands"))


def thinned(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``column`` may be a value of ``wanted``; all that are pass."""
    return marked(rows, column, wanted).where("may").drop("may")


def marked(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows and ``may``: false only if ``column`` is certainly no value of ``wanted``.

    The broadcast bit map has at most ``MOST_BITS`` bits whatever the input.
    """
    count = max(1, wanted.count())
    bits = min(MOST_BITS, max(1 << 12, 1 << (count * 12).bit_length()))
    slot = F.pmod(F.xxhash64(column, F.lit("slot")), F.lit(bits))
    words = (
        wanted.select(slot.alias("slot"))
        .select(F.expr("slot div 64").alias("word"), F.expr("shiftleft(1L, int(slot % 64))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("mask"))
    )
    slotted = rows.withColumn("slot", slot).withColumn("word", F.expr("slot div 64"))
    may = F.expr("coalesce(bit_get(mask, int(slot % 64)) = 1, false)").alias("may")
    return slotted.join(F.broadcast(words), "word", "left").select(*rows.columns, may)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """node and pieces, the distinct shingle hashes, of every text (node, normal).

    Pieces are made ``PART`` at a time, which is compiled code, not a lambda for each. Texts dealt
    by node meet again without a shuffle of their pieces.
    """
    ready = texts.select("node", F.encode("normal", "UTF-16BE").alias("units")).withColumn(
        "last", F.expr(f"greatest(length(units) div 2 - {SHINGLE}, 0)")
    )
    spread = ready.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(PART))))
    hashes = [
        F.xxhash64(F.expr(f"substring(units, 2 * least(at + {i}, last) + 1, {2 * SHINGLE})"))
        for i in range(PART)
    ]
    parts = spread.select("node", F.array(*hashes).alias("part"))
    whole = parts.groupBy("node").agg(F.collect_list("part").alias("parts"))
    return whole.select("node", F.array_distinct(F.flatten("parts")).alias("pieces"))


def _pieces(text: str) -> str:
    """The shingle hashes of a column of normal lines, without rows for them; some may come twice."""
    # the outer transform makes the units once for all places
    return (
        f"transform(array(encode({text}, 'UTF-16BE')), u -> transform("
        f"sequence(1, 2 * greatest(length(u) div 2 - {SHINGLE}, 0) + 1, 2), "
        f"i -> xxhash64(substring(u, i, {2 * SHINGLE}))))[0]"
    )


def bit_maps(texts: DataFrame) -> DataFrame:
    """node, size (distinct shingles) and map (a bit for each shingle's hash) of every text."""
    pieces = shingle_sets(texts.repartition("node"))
    spread = pieces.select("node", F.size("pieces").alias("size"), F.explode("pieces").alias("piece"))
    slot = F.pmod("piece", F.lit(64 * WORDS))
    slotted = spread.select(
        "node", "size", (slot / 64).cast("int").alias("word"),
        F.expr(f"shiftleft(1L, int(pmod(piece, {64 * WORDS}) % 64))").alias("bit"),
    )
    words = [
        F.bit_or(F.when(F.col("word") == i, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(f"w{i}")
        for i in range(WORDS)
    ]
    return slotted.groupBy("node", "size").agg(*words).select(
        "node", "size", F.array(*[f"w{i}" for i in range(WORDS)]).alias("map")
    )


def _most_shared(words: int = WORDS) -> str:
    """The most shingles that lines a and b can share, by the first ``words`` of their maps.

    A bit of one map only is one that differs.
    """
    def alone(one: str, other: str) -> str:
        return " + ".join(f"bit_count(map_{one}[{i}] & ~map_{other}[{i}])" for i in range(words))

    return f"least(size_a - ({alone('a', 'b')}), size_b - ({alone('b', 'a')}))"


def _may_reach(threshold: float) -> Column:
    """False only for pairs whose Jaccard similarity is certainly below the threshold.

    Sizes alone, then a quarter of the maps, exclude most such pairs before the whole maps do.
    """
    def enough(shared: str) -> str:
        return f"{shared} * {1 + threshold}D >= {threshold}D * (size_a + size_b) - 1e-6D"

    bounds_in_turn = ("least(size_a, size_b)", _most_shared(WORDS // 4), _most_shared())
    return F.expr(" and ".join(f"({enough(shared)})" for shared in bounds_in_turn))


def _side(rows: DataFrame, end: str) -> DataFrame:
    """The rows (node, size, map) with ``end`` in their names."""
    return rows.select(
        F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("map").alias(f"map_{end}")
    )


def _sized(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """The pairs with size and map of both ends."""
    return pairs.join(_side(maps, "a"), "a").join(_side(maps, "b"), "b")


def bounds(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """a, b, size_a, size_b and bound: the similarity they have at most."""
    shared = _sized(pairs, maps).select("a", "b", "size_a", "size_b", F.expr(_most_shared()).alias("shared"))
    bound = F.expr("shared / (size_a + size_b - shared)")
    return shared.select("a", "b", "size_a", "size_b", bound.alias("bound"))


def links(pairs: DataFrame, texts: DataFrame, maps: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose similarity is at least the threshold; written, for sets are built once so."""
    possible = _sized(pairs, maps).where(_may_reach(threshold))
    exact = similarities(possible.select("a", "b", "size_a", "size_b"), texts)
    scored = stored(exact, "line-scores")
    return scored.where(F.col("similarity") >= threshold).select("a", "b")


def similarities(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b and the exact Jaccard similarity of their lines; texts are (node, normal).

    Pairs may bring their lines' size_a and size_b, the numbers of distinct shingles; with those
    of both together they give the shared ones, so one set is built for a pair.
    """
    if "size_a" not in pairs.columns:
        pairs = _sized(pairs, bit_maps(texts))
    keys = ["a", "b", "size_a", "size_b"]
    lines = (
        pairs.select(*keys)
        .join(texts.select(F.col("node").alias("a"), F.col("normal").alias("line_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("normal").alias("line_b")), "b")
    )
    # the outer transform makes the set once for both of its uses
    similarity = F.expr(
        f"transform(array(size(array_union({_pieces('line_a')}, {_pieces('line_b')}))), "
        "either -> (size_a + size_b - either) / either)[0]"
    )
    return lines.select("a", "b", similarity.alias("similarity"))


def _listed(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) within the small buckets of (band, node)."""
    one, two = rows.select("band", F.col("node").alias("a")), rows.select("band", F.col("node").alias("b"))
    return one.join(two, "band").where("a < b").select("a", "b").distinct()


def candidate_buckets(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of the small buckets, and the rows (band, node, copies) of larger ones."""
    rows = signed.select(F.explode("bands").alias("band"), "node", "copies")
    groups = stored(
        rows.groupBy("band")
        .agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("size"))
        .where("size > 1"),
        "line-buckets",
    )
    more = groups.where("size > 2").select("band", "size")
    members = stored(thinned(rows, "band", more).join(more, "band"), "line-bucket-rows")
    pairs = groups.where("size = 2").select("a", "b").union(
        _listed(members.where(F.col("size") <= SMALL))
    )
    return pairs.distinct(), members.where(F.col("size") > SMALL).drop("size")


def connected(signed: DataFrame, lines: DataFrame, threshold: float) -> DataFrame:
    """``node`` and ``root`` of every node that has a link of at least the similarity.

    Lines between are compared only where the other links have not connected them yet.
    """
    pairs, large = candidate_buckets(signed)
    pairs, large = stored(pairs, "line-pairs"), stored(large, "line-members")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    wanted = wanted.union(large.select("node")).distinct().join(
        signed.select("node", "first_doc"), "node"
    )
    wanted = stored(wanted, "line-candidates")
    first = thinned(lines, "doc_id", wanted.select(F.col("first_doc").alias("doc_id")).distinct())
    own = nodes(first).withColumn("doc", F.col("doc_id"))
    same = wanted.select(F.col("node").alias("w"), "first_doc")
    fits = (F.col("node") == F.col("w")) & F.col("doc").eqNullSafe(F.col("first_doc"))
    texts = stored(
        thinned(own, "node", wanted).join(same, fits).groupBy("node").agg(F.first("normal").alias("normal")),
        "line-texts",
    )
    maps = stored(bit_maps(texts), "line-maps")
    found = links(pairs, texts, maps, threshold)
    reach, turn, rings = 1 - threshold, 0, []
    least = 1 - 2 * reach - 1e-9
    while not large.isEmpty():
        pivots = large.groupBy("band").agg(F.max(F.struct("copies", "node")).alias("top"))
        starred = large.join(pivots.select("band", F.col("top.node").alias("pivot")), "band")
        starred = stored(starred.where("node <> pivot"), "line-stars")
        stars = starred.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        bounded = stored(bounds(stars, maps), "line-bounds")
        exact = similarities(bounded.where(F.col("bound") >= least).drop("bound"), texts)
        scored = stored(exact, "line-scores")
        found = found.union(scored.where(F.col("similarity") >= threshold).select("a", "b"))
        near = bounded.join(scored, ["a", "b"], "left").select(
            F.col("a").alias("pivot"), F.col("b").alias("node"),
            F.coalesce("similarity", "bound").alias("similarity"),
        )
        members = starred.join(near, ["pivot", "node"]).select("band", "node", "copies", "similarity")
        members = stored(members, "line-scored-members")
        rings.append(members.select(
            F.xxhash64("band", F.lit(turn)).alias("band"), "node", "similarity",
            ((F.col("similarity") < threshold) & (F.col("similarity") >= least)).alias("open"),
        ))
        far = members.where(F.col("similarity") < least).drop("similarity")
        few, middle, large = _settled(far, texts, maps, threshold)
        found = found.union(few)
        if not large.isEmpty():
            few, parted, large = _settled(_parted(large, texts, threshold), texts, maps, threshold)
            found, middle = found.union(few), middle.union(parted)
        if turn == 0:  # a second pivot connects what lies together, before the rest is compared
            large = stored(large.union(middle), "line-members")
        else:
            rings.append(middle.select(
                F.xxhash64("band", F.lit(turn), F.lit("middle")).alias("band"), "node",
                F.lit(0.0).alias("similarity"), F.lit(True).alias("open"),
            ))
        turn += 1
    found = stored(found.distinct(), "line-links")
    roots = components(found)
    if not rings:
        return roots
    rows = stored(reduce(DataFrame.union, rings), "line-rings")
    for tries in (TRIES, None):
        roots = stored(roots, "line-roots")
        possible = stored(_open_pairs(rows, roots, maps, threshold, tries), "line-open-pairs")
        more = links(possible, texts, maps, threshold)
        if not more.isEmpty():  # the stars found so far stand for their links
            roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    return roots


def _open_pairs(
    rings: DataFrame, roots: DataFrame, maps: DataFrame, threshold: float, tries: int | None = None
) -> DataFrame:
    """Pairs of an open line and another of its bucket that may be links and are apart.

    Similarities to the pivot, the components so far and the bit maps decide inside the
    join, so rows are made of few more pairs than there are new links. Below twice the
    allowed distance the similarity may be a bound, which says nothing of two such lines.
    With ``tries`` the other lines are at most so many of each bucket that are linked to its
    pivot: a first turn that connects most open lines, so that the full one has few pairs.
    """
    open_bands = rings.where("open").select("band").distinct()
    rows = rings.join(open_bands, "band").join(roots, "node", "left").join(maps, "node")
    rows = stored(rows.withColumn("root", F.coalesce("root", "node")), "line-open-rows")

    def side(end: str) -> DataFrame:
        names = [F.col(c).alias(f"{c}_{end}") for c in ("similarity", "open", "root", "size", "map")]
        return rows.select("band", F.col("node").alias(end), *names)

    least = 1 - 2 * (1 - threshold) - 1e-9
    apart = F.abs(F.col("similarity_a") - F.col("similarity_b"))
    others = side("b")
    if tries:
        linked = rings.where(F.col("similarity") >= threshold)
        dealt = F.pmod(F.xxhash64("node"), F.lit(tries)).alias("share")
        picked = linked.groupBy("band", dealt).agg(F.min("node").alias("b")).select("band", "b")
        others = others.join(picked, ["band", "b"], "left_semi")
    pairs = side("a").where("open_a").join(others, "band").where(
        (F.col("root_a") != F.col("root_b"))
        & ((F.greatest("similarity_a", "similarity_b") < least) | (apart <= 1 - threshold + 1e-9))
        & (~F.col("open_b") | (F.col("a") < F.col("b")))
        & _may_reach(threshold)
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _settled(
    rows: DataFrame, texts: DataFrame, maps: DataFrame, threshold: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links within the small buckets of (band, node, copies), rows of middle and of larger ones.

    Of buckets with the same members one is taken.
    """
    members = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    sizes = rows.groupBy("band").agg(F.count("*").alias("size"), *members).where("size > 1")
    sizes = sizes.groupBy("size", "mark0", "mark1").agg(F.min("band").alias("band")).select("band", "size")
    sized = stored(rows.join(sizes, "band"), "line-members")
    few = links(_listed(sized.where(F.col("size") <= SMALL)), texts, maps, threshold)
    middle = sized.where((F.col("size") > SMALL) & (F.col("size") <= MIDDLE)).drop("size")
    return few, middle, sized.where(F.col("size") > MIDDLE).drop("size")


def _parted(rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The rows in finer buckets, so that every pair at the threshold still shares one.

    Two lines at the threshold t share at least t of the pieces of each. With the pieces of
    a bucket in one order, the first shared one is therefore among the first
    n - ceil(t n) + 1 of the n pieces of either line. The order starts with the pieces that
    the fewest lines of the bucket have; each of those first pieces is a finer bucket.
    """
    nodes_in = rows.select("node").distinct().join(texts, "node")
    pieces = stored(shingle_sets(nodes_in), "line-pieces")
    spread = rows.join(pieces, "node").select("band", "node", "copies", F.explode("pieces").alias("piece"))
    shared = spread.groupBy("band", "piece").agg(F.count("*").alias("lines")).where("lines > 1")
    ranked = (
        spread.join(shared, ["band", "piece"], "left")
        .groupBy("band", "node", "copies")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("lines", F.lit(1)).alias("lines"), "piece"))).alias("order"))
    )
    first = F.expr(f"slice(order, 1, int(size(order) - ceil({threshold} * size(order) - 1e-6D) + 1))")
    finer = ranked.select("band", "node", "copies", F.explode(first).alias("at")).where("at.lines > 1")
    return finer.select(F.xxhash64("band", "at.piece").alias("band"), "node", "copies")


def line_classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, line_no, class_doc, class_line and kept for every line that is not blank.

    Lines are alike if the sets of their ``SHINGLE``-character pieces, after trimming and
    lower-casing, have a Jaccard similarity of at least ``threshold``; a shorter line is one
    piece. Lines connected by such links are a class. Its first line by doc_id and place is
    kept; (class_doc, class_line) name it. Documents without doc_id come last, and lines of
    theirs share first places. Repeated rows of one document are the same lines: all stay or
    all go. NULL and empty texts and blank lines have no rows.
    """
    lines = split_lines(docs.select("doc_id", "text"))
    signed = stored(signatures(lines), "line-signatures")
    roots = connected(signed, lines, threshold)
    rooted = signed.select("node", "first_doc").join(roots, "node")
    firsts = rooted.groupBy("root").agg(F.min("first_doc").alias("class_doc"))
    grouped = stored(rooted.join(firsts, "root").select("node", "root", "class_doc"), "line-roots")
    single = signed.select("node", F.col("first_doc").alias("node_doc"), "copies").join(grouped, "node", "left")
    named = single.where("copies > 1 or root is not null").select(
        "node", F.coalesce("root", "node").alias("root"),
        F.when(F.col("root").isNull(), F.col("node_doc")).otherwise(F.col("class_doc")).alias("class_doc"),
    )
    named = stored(named, "line-names")
    own = nodes(lines).select("doc_id", "line_no", "node")
    own = stored(marked(own, "node", named.select("node")), "line-own")
    some = stored(own.where("may").drop("may").join(named, "node", "left"), "line-places")
    placed = some.where("root is not null").drop("node")
    heads = (
        placed.where(F.col("doc_id").eqNullSafe(F.col("class_doc")))
        .groupBy("root")
        .agg(F.min("line_no").alias("class_line"))
    )
    result = placed.join(heads, "root")
    kept = F.col("doc_id").eqNullSafe(F.col("class_doc")) & (F.col("line_no") == F.col("class_line"))
    alone = own.where("not may").union(some.where("root is null").select("doc_id", "line_no", "node", F.lit(True)))
    # a line that comes once and has no link is a class of its own
    alone = alone.select("doc_id", "line_no", F.col("doc_id").alias("class_doc"),
                         F.col("line_no").alias("class_line"), F.lit(True).alias("kept"))
    return result.select("doc_id", "line_no", "class_doc", "class_line", kept.alias("kept")).union(alone)


def deduplicated(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` with only kept and blank lines in ``text``.

    A document that loses all its lines that are not blank is left out; one without such
    lines stays as it is. ``n_chars``, where there is one, is counted anew.
    """
    drop, owner = "lines that go", "document they go from"
    classes = line_classes(docs, threshold)
    lost = classes.where("not kept").groupBy(F.col("doc_id").alias(owner)).agg(
        F.collect_set("line_no").alias(drop)
    )
    joined = docs.join(lost, F.col("doc_id").eqNullSafe(F.col(owner)), "left")
    left = F.filter(F.split("text", "\n"), lambda line, at: ~F.array_contains(drop, at))
    whole = F.col(drop).isNull()
    text = F.when(whole, F.col("text")).otherwise(F.array_join(left, "\n"))
    kept = joined.withColumn("text", text).where(whole | (F.btrim("text", F.lit("\n ")) != ""))
    if "n_chars" in docs.columns:
        counted = F.when(whole, F.col("n_chars")).otherwise(F.char_length("text"))
        kept = kept.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)
