"""Document fingerprints: one-permutation MinHash with optimal densification.

Each run of ``SHINGLE`` words is hashed once; the high bits choose one of ``BINS`` bins and
a bin keeps its least hash. An empty bin takes the value of the first filled bin in an
order of its own, the same for all documents, so equal bins stay equally likely to agree.
The lowest ``BITS`` bits of every bin are packed as hexadecimal text. Two fingerprints
agree in a bin by chance once in 2^BITS; ``likeness`` corrects for that.

Everything is built from Spark's own expressions, one row at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
BINS = 128
BITS = 8
PER_BUCKET = 1_000
MOST_BUCKETS = 4_096
SEPARATORS = r"[\x00-/:-@\[-`{-\x7f]+"


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda w: w != "")


def fingerprint(text: str) -> Column:
    """The packed fingerprint of a text column; empty if it has no words (or is NULL).

    Fewer than ``SHINGLE`` words are one shingle. Equal texts have equal fingerprints.
    """
    shift = 64 - (BINS - 1).bit_length()
    # ``one`` passes a value to a lambda, so that it is computed once for all its uses
    one = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))

    def runs(hashed: Column) -> Column:
        """Hashes of all shingles in order of their bins, the least of a bin first."""
        last = F.greatest(F.size(hashed) - SHINGLE, F.lit(0))
        starts = F.sequence(F.lit(0), last)
        return F.array_sort(
            F.transform(starts, lambda at: F.xxhash64(F.slice(hashed, at + 1, SHINGLE)))
        )

    def firsts(ordered: Column) -> Column:
        def first(h: Column, at: Column) -> Column:
            before = F.shiftrightunsigned(F.get(ordered, at - 1), shift)
            return (at == 0) | (before != F.shiftrightunsigned(h, shift))

        return F.filter(ordered, first)

    def packed(least: Column) -> Column:
        bins = F.transform(least, lambda h: F.shiftrightunsigned(h, shift).cast("int"))
        return one(bins, lambda b: _pack(least, b))

    def whole(own: Column) -> Column:
        hashed = F.transform(own, lambda w: F.xxhash64(w))
        full = one(one(one(hashed, runs), firsts), packed)
        return F.when(F.size(own) == 0, F.lit("")).otherwise(full)

    return one(words(F.coalesce(F.col(text), F.lit(""))), whole)


def _pack(least: Column, bins: Column) -> Column:
    """``least`` hashes of the filled ``bins``; a hash of both numbers orders bins for a bin."""

    def value(number: Column) -> Column:
        own = F.array_position(bins, number)

        def rank(b: Column) -> Column:
            return F.xxhash64(number, b).bitwiseAND(F.lit(-BINS)).bitwiseOR(b.cast("long"))

        first = F.array_min(F.transform(bins, rank)).bitwiseAND(F.lit(BINS - 1))
        source = F.array_position(bins, first.cast("int"))
        place = F.when(own > 0, own).otherwise(source).cast("int")
        low = F.element_at(least, place).bitwiseAND(F.lit((1 << BITS) - 1))
        return F.lpad(F.hex(low), BITS // 4, "0")

    return F.lower(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value), ""))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two fingerprint columns, from 0 to 1.

    Two empty ones are alike (1), an empty one and another are not (0).
    """
    width = BITS // 4
    agree = F.expr(
        f"size(filter(sequence(0, {BINS - 1}), i -> substring({a}, {width} * i + 1, {width}) = "
        f"substring({b}, {width} * i + 1, {width})))"
    )
    chance = 2.0**-BITS
    corrected = (agree / BINS - chance) / (1 - chance)
    return (
        F.when(F.col(a) == F.col(b), F.lit(1.0))
        .when((F.col(a) == "") | (F.col(b) == ""), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), corrected)))
    )


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``next_<column>`` of the next document in descending doc_id, after the last the first.

    Rows are dealt to buckets of neighbouring doc_ids by quantiles; each bucket also gets the
    rows with the largest doc_id of the next bucket down, so one shuffle by bucket and
    windows of about ``PER_BUCKET`` rows are enough. At most ``MOST_BUCKETS`` quantiles come
    to the driver. NULL doc_ids come last; rows of equal doc_id are ordered by ``columns``.
    """
    total = docs.count()
    if not total:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    many = min(MOST_BUCKETS, max(1, total // PER_BUCKET))
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / many for i in range(1, many)], 1e-4))) if many > 1 else []
    size = max(1, int(len(cuts) ** 0.5))
    coarse = [int(c) for c in cuts[::size]]
    fine = [[int(c) for c in cuts[i : i + size]] for i in range(0, len(cuts), size)]
    below = lambda values: F.expr(
        f"size(filter({values}, x -> x <= doc_id))"
    )
    if cuts:
        texts = ["array(" + ", ".join(f"{c}L" for c in row) + ")" for row in fine]
        step = below("array(" + ", ".join(f"{c}L" for c in coarse) + ")")
        inner = below(f"array({', '.join(texts)})[step - 1]")
        bucket = F.when(F.col("step") == 0, 0).otherwise((F.col("step") - 1) * size + inner)
        placed = docs.withColumn("step", step)
    else:
        placed, bucket = docs.withColumn("step", F.lit(0)), F.lit(0)
    placed = placed.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(bucket)).drop("step")
    heads = [tuple(r) for r in placed.groupBy("bucket").agg(F.max("doc_id")).collect()]
    heads.sort(reverse=True)  # descending order of doc_id, the bucket of NULLs last
    above = {heads[i][0]: heads[i - 1][0] for i in range(len(heads))}  # the bucket before, in a ring
    listed = ", ".join(
        f"{b}, named_struct('head', {'cast(null as bigint)' if h is None else f'{h}L'}, 'above', {above[b]})"
        for b, h in heads
    )
    head = F.expr(f"map({listed})[bucket]")
    is_head = F.col("doc_id").eqNullSafe(F.col("head.head"))
    places = F.when(
        is_head,
        F.array(
            F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")),
            F.struct(F.col("head.above").alias("bucket"), F.lit(True).alias("guest")),
        ),
    ).otherwise(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))))
    dealt = placed.withColumn("head", head).withColumn("place", F.explode(places))
    dealt = dealt.withColumn("guest", F.col("place.guest")).withColumn("bucket", F.col("place.bucket"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), *columns)
    found = dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return found.where("not guest").select(*docs.columns, *[f"next_{c}" for c in columns])


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every ``text`` (NULL: empty) of (doc_id, text) and of its edited form.

    The edited text has its last half (rounded down) replaced by as many first code points
    of the next document in descending doc_id, or all it has; after the last document comes
    the first. Returns doc_id, n_chars, edited_sha256, both fingerprints, and the likeness of
    the text's to the edited one's and to the next document's.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("fingerprint", fingerprint("text"))
    pairs = with_next(own, ["text", "fingerprint"])
    pairs = pairs.withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.expr(
        "concat(left(text, int(n_chars - n_chars div 2)), left(next_text, int(n_chars div 2)))"
    )
    pairs = pairs.withColumn("edited", edited).withColumn("edited_fingerprint", fingerprint("edited"))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
