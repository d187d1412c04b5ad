"""Find benchmark passages in a corpus with a positional inverted index.

The index is stored in parts, each for documents of at most ``PART_BYTES`` (or one longer
document): for every term of them, rare or frequent, the list of all its places in the
part, documents one after the other with ``GAP`` free places between. The corpus is read
once, to build it. A phrase is looked up in every part that has all its terms: the list of
its rarest term, by counts over the whole corpus, is shifted by the term's place in the
phrase and intersected with the shifted lists of the others, the next rarest first, by
binary search. So a long list of a frequent term is probed, never walked. Without shifts
and with a tolerance the same search finds terms that lie close together.

Phrases are taken in blocks of at most ``BLOCK_WINDOWS``, so what a task holds is bounded
whatever the benchmark's size; each block reads the index, not the corpus. A row group of
the index has about ``PART_BYTES``, and parts go to Python one by one, so a task holds about
one of them, however many its file has.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hyetos.llm.common import full_text, slices, stored, text_slices
from hyetos.session import arrow_batches

WINDOW = 10
BLOCK_WINDOWS = 50_000
PART_BYTES = 1 << 22
GAP = 64
AT_ONCE = 1 << 18  # places of rarest terms looked up together
#: A word: digits, letters a-z (A-Z lower-cased) and everything beyond ASCII, in UTF-8.
_KEEP = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_KEEP).split()


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item`` and ``phrase`` (words with spaces between) of all windows of (item_id, text).

    An item of fewer words, but not none, is one window. Items without id share the name
    ``null``; NULL and empty texts have no window. Repeated ones are given once.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            names, phrases = [], []
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for name, text in pairs:
                own = words(text)
                for at in range(max(len(own) - size, 0) + 1 if own else 0):
                    names.append(name)
                    phrases.append(b" ".join(own[at : at + size]).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(phrases, pa.string())],
                names=["item", "phrase"],
            )

    named = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        full_text().alias("text"),
    )
    return named.mapInArrow(cut, "item string, phrase string").distinct()


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a 128-bit key of both: rows alike in both share it."""
    return docs.select(
        "doc_id",
        full_text().alias("text"),
        F.xxhash64("doc_id", full_text()).alias("k1"),
        F.xxhash64(F.lit("k2"), full_text(), "doc_id").alias("k2"),
    )


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``keyed`` documents: one row per part, to be stored by the caller.

    doc_ids, k1, k2 and lengths (words) of its documents in order; terms, how often each
    occurs (counts), and the places of all terms in turn, as 32-bit integers.
    """
    names = ["doc_ids", "k1", "k2", "lengths", "terms", "counts", "places"]

    def part_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.encode().translate(_KEEP).strip() or None for t in batch.column(1).to_pylist()]
        own = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        lengths = pc.fill_null(pc.list_value_length(own), 0).to_numpy().astype(np.int64)
        coded = own.flatten().dictionary_encode()
        del texts, own
        each = coded.indices.to_numpy()
        places = np.repeat(GAP * np.arange(1, len(lengths) + 1, dtype="<i4"), lengths)
        places += np.arange(len(each), dtype="<i4")
        arrays = [
            *(batch.column(c) for c in (0, 2, 3)), pa.array(lengths),
            coded.dictionary.cast(pa.string()),
            pa.array(np.bincount(each, minlength=len(coded.dictionary)).astype(np.int64)),
        ]
        lists = [pa.ListArray.from_arrays([0, len(a)], a) for a in arrays]
        sorted_places = places[np.argsort(each, kind="stable")].tobytes()
        return pa.RecordBatch.from_arrays(
            [*lists, pa.array([sorted_places], pa.binary())], names=names
        )

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1, PART_BYTES):
            yield part_of(batch)
            pa.default_memory_pool().release_unused()

    ddl = (
        "doc_ids array<long>, k1 array<long>, k2 array<long>, lengths array<long>, "
        "terms array<string>, counts array<long>, places binary"
    )
    return docs.select("doc_id", "text", "k1", "k2").mapInArrow(post, ddl)


def documents_of(index: DataFrame) -> DataFrame:
    """doc_id, k1, k2 and n_words of every row that was indexed."""
    each = F.arrays_zip("doc_ids", "k1", "k2", "lengths")
    return index.select(F.explode(each).alias("d")).select(
        F.col("d.doc_ids").alias("doc_id"), "d.k1", "d.k2", F.col("d.lengths").alias("n_words")
    )


def term_counts(index: DataFrame, terms: list[str]) -> dict[str, int]:
    """How often each of the given terms occurs in the corpus; the terms bound the result."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = pa.array(shared.value, pa.string()), np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                at = pc.index_in(wanted, value_set=batch.column("terms")[row].values)
                at = pc.fill_null(at, -1).to_numpy()
                total[at >= 0] += batch.column("counts")[row].values.to_numpy()[at[at >= 0]]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(total[found])], names=["term", "n"]
        )

    counted = index.select("terms", "counts").mapInArrow(count, "term long, n long")
    rows = counted.groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {terms[r.term]: r.n for r in rows}


def _plan(phrases: list[str], counts: dict[str, int], terms: list[str]) -> tuple[np.ndarray, ...]:
    """Per phrase the numbers of its terms, the rarest first, their places in it, its size."""
    number = {term: i for i, term in enumerate(terms)}
    own = [phrase.split(" ") for phrase in phrases]
    width = max(map(len, own), default=0)
    chosen = np.full((len(own), width), -1, np.int64)
    places = np.zeros((len(own), width), np.int64)
    for i, words_of in enumerate(own):
        order = sorted(range(len(words_of)), key=lambda j: (counts.get(words_of[j], 0), words_of[j].encode(), j))
        chosen[i, : len(order)] = [number[words_of[j]] for j in order]
        places[i, : len(order)] = order
    return chosen, places, (chosen >= 0).sum(axis=1)


def _stretches(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each stretch, one after the other."""
    ends = np.cumsum(length)
    return np.repeat(first - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)


def _search(
    keys: np.ndarray, counts: np.ndarray, slots: np.ndarray, shifts: np.ndarray, slop: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases (rows of ``slots``) and places where all terms stand at their shifts, give or take.

    ``keys`` are term and place of all postings in order. Slots: -2 beyond a phrase's end.
    """
    begin = np.cumsum(counts) - counts
    live = np.flatnonzero((slots != -1).all(axis=1))
    lists = counts[slots[live, 0]]
    cuts = np.flatnonzero(np.diff(np.cumsum(lists) // AT_ONCE)) + 1
    for part in np.split(live, cuts):
        size = counts[slots[part, 0]]
        phrase = np.repeat(part, size)
        at = keys[_stretches(begin[slots[part, 0]], size)] & 0xFFFFFFFF
        at = at - shifts[phrase, 0]
        for j in range(1, slots.shape[1]):
            wanted = (slots[phrase, j] << 32) + at + shifts[phrase, j]
            found = np.minimum(np.searchsorted(keys, wanted - slop), len(keys) - 1)
            near = np.abs(keys[found] - wanted) <= slop
            keep = near | (slots[phrase, j] == -2)
            phrase, at = phrase[keep], at[keep]
        yield phrase, at


def occurrences(index: DataFrame, phrases: list[str], slop: int | None = None) -> DataFrame:
    """k1, k2, start, size and phrase wherever a phrase (words with spaces between) occurs.

    With ``slop`` (less than ``GAP``) its words may stand in any order: ``start`` is each
    place of its rarest word, by counts over the corpus, then by bytes, that has every other
    word at most so many words away; one place may serve for a word that the phrase repeats.
    """
    if slop is not None and not 0 <= slop < GAP:
        raise ValueError(f"slop must lie between 0 and {GAP - 1}")
    terms = sorted({word for phrase in phrases for word in phrase.split(" ")})
    plan = _plan(phrases, term_counts(index, terms), terms)
    shared = index.sparkSession.sparkContext.broadcast((phrases, terms, plan))
    names = ["k1", "k2", "start", "size", "phrase"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, wanted, (chosen, places, sizes) = shared.value
        texts, wanted = pa.array(texts, pa.string()), pa.array(wanted, pa.string())
        shifts = places if slop is None else np.zeros_like(places)
        for batch in batches:
            for row in range(batch.num_rows):
                part = {c: batch.column(c)[row].values for c in ("k1", "k2", "lengths", "terms", "counts")}
                counts = part["counts"].to_numpy()
                if not len(counts) or not len(chosen):
                    continue
                at = pc.fill_null(pc.index_in(wanted, value_set=part["terms"]), -1).to_numpy()
                slots = np.where(chosen < 0, -2, at[chosen].astype(np.int64))
                keys = np.frombuffer(batch.column("places")[row].as_buffer(), "<i4").astype(np.int64)
                keys += np.repeat(np.arange(len(counts)) << 32, counts)
                lengths = part["lengths"].to_numpy()
                base = np.cumsum(lengths) - lengths + GAP * np.arange(1, len(lengths) + 1)
                for phrase, place in _search(keys, counts, slots, shifts, slop or 0):
                    document = np.searchsorted(base, place, "right") - 1
                    own = pa.array(document)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part["k1"].take(own), part["k2"].take(own),
                            pa.array(place - base[document]), pa.array(sizes[phrase]),
                            texts.take(pa.array(phrase)),
                        ],
                        names=names,
                    )
                pa.default_memory_pool().release_unused()

    ddl = "k1 long, k2 long, start long, size long, phrase string"
    return index.select("k1", "k2", "lengths", "terms", "counts", "places").mapInArrow(look_up, ddl)


def covered(stretches: Column) -> Column:
    """Places inside any of the (start, size) of an array sorted by start."""

    def step(state: Column, x: Column) -> Column:
        stop = x["start"] + x["size"]
        fresh = stop - F.greatest(state["stop"], x["start"])
        return F.struct(
            F.greatest(state["stop"], stop).alias("stop"),
            (state["n"] + F.greatest(fresh, F.lit(0))).alias("n"),
        )

    zero = F.struct(F.lit(0).cast("long").alias("stop"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(stretches, zero, step, lambda state: state["n"])


def phrase_blocks(listed: DataFrame) -> Iterator[list[str]]:
    """The different phrases of stored ``windows`` in blocks; one empty block if there are none."""
    phrases = listed.select("phrase").distinct()
    blocks = max(1, -(-phrases.count() // BLOCK_WINDOWS))
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == block
        yield sorted(r.phrase for r in phrases.where(mine).collect())


def _items_of(found: DataFrame, listed: DataFrame) -> DataFrame:
    """k1, k2 and the sorted names of the items that have one of the phrases found."""
    pairs = found.select("k1", "k2", "phrase").distinct().join(listed, "phrase")
    return pairs.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item")).alias("items"))


def contamination(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int | None = None
) -> DataFrame:
    """For every row of ``docs`` (doc_id, text) what it shares with ``items`` (item_id, text).

    doc_id, n_words, n_hit (words inside an occurrence of a window), n_items (items with an
    occurring window), items_sha256 (of their ids, sorted as strings, comma-joined; of the
    empty string if there are none) and contaminated. NULL texts have no words. Repeated
    rows stay repeated; other columns are ignored. With ``slop`` also n_near: the items that
    have a window whose words all stand, in any order, at most so many words from a place of
    its rarest word (see ``occurrences``).
    """
    with arrow_batches(docs.sparkSession, size=PART_BYTES):
        built = build_index(keyed(docs.select("doc_id", "text")))
        index = stored(built, "postings", group_bytes=PART_BYTES)
    listed = stored(windows(items, size), "benchmark-windows")
    found, close, near = [], [], None
    with arrow_batches(docs.sparkSession, rows=1):
        for phrases in phrase_blocks(listed):
            found.append(occurrences(index, phrases))
            if slop is not None:
                close.append(occurrences(index, phrases, slop))
        found = stored(reduce(DataFrame.unionAll, found), "phrase-matches")
        if slop is not None:
            near = _items_of(reduce(DataFrame.unionAll, close), listed)
            near = near.select("k1", "k2", F.size("items").cast("long").alias("n_near"))
            near = stored(near, "near-items")
    hits = found.groupBy("k1", "k2").agg(
        covered(F.sort_array(F.collect_set(F.struct("start", "size")))).alias("n_hit")
    )
    joined = documents_of(index).join(hits, ["k1", "k2"], "left")
    joined = joined.join(_items_of(found, listed), ["k1", "k2"], "left")
    more = []
    if near is not None:
        joined = joined.join(near, ["k1", "k2"], "left")
        more = [F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")]
    ids = F.coalesce(F.array_join("items", ","), F.lit(""))
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        *more,
    )
