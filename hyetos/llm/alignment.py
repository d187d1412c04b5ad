"""Alignment of two tokenizers over the same bytes, and how often their tokens meet.

Both tokenizers see a space and the text. Each gives the byte offsets at which its tokens
end; where both end, a group ends. :func:`align` finds the groups by diagonal run skipping:
at the present shift between the two arrays it compares stretches of doubling length and
jumps over them while they are equal; at the first difference it walks the lagging side
until both end at one offset, which closes an irregular group and gives the new shift.

Two tokens are linked where their bytes overlap. An id pair counts once for every document
that holds it linked. Pairs are counted in two levels by Spark. Those with at least a share of
1 / ``MOST_SHARED`` of all (document, pair) rows are at most ``MOST_SHARED``; they are broadcast.
All others are rare and joined by a shuffle, so no pair is hot and no table is collected
that grows with the data.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyetos.llm.common import slices, stored
from hyetos.llm.tokens import WordCoder

MOST_SHARED = 1 << 20
MAX_CACHED = 400_000
#: A pair is one number: the first id, then the second in this many bits.
ID_BITS = 24

_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_coders: dict[tuple[str, str], Coders] = {}


def align(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """The irregular groups: first token and the place behind the last, in ``a`` and in ``b``.

    ``a`` and ``b`` are rising and have the same last value. All tokens between irregular
    groups are groups of one token each.
    """
    a, b = [*a, -1], [*b, -2]  # unequal marks, so that no stretch runs over the end
    from_a, to_a, from_b, to_b = [], [], [], []
    i = j = 0
    last = len(a) - 1
    while i < last:
        end_a, end_b = a[i], b[j]
        if end_a == end_b:
            step = 4
            while a[i : i + step] == b[j : j + step]:
                i += step
                j += step
                step += step
            while step > 1:
                step >>= 1
                if a[i : i + step] == b[j : j + step]:
                    i += step
                    j += step
        else:
            from_a.append(i)
            from_b.append(j)
            while end_a != end_b:
                if end_a < end_b:
                    i += 1
                    end_a = a[i]
                else:
                    j += 1
                    end_b = b[j]
            i += 1
            j += 1
            to_a.append(i)
            to_b.append(j)
    return from_a, to_a, from_b, to_b


def _group_ends(n: int, starts: list[int], ends: list[int]) -> np.ndarray:
    inner = np.zeros(n + 1, np.int8)  # 1 at tokens that their group goes on behind
    inner[np.array(starts, np.int64)] += 1
    inner[np.array(ends, np.int64) - 1] -= 1
    return np.flatnonzero(np.cumsum(inner[:n], dtype=np.int8) == 0) + 1


def group_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every group the places behind its last tokens in both arrays of ends."""
    from_a, to_a, from_b, to_b = align(a.tolist(), b.tolist())
    return _group_ends(len(a), from_a, to_a), _group_ends(len(b), from_b, to_b)


def linked(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of tokens whose bytes overlap, given both arrays of ends.

    The ends of both cut the bytes into stretches; each lies in one token of either side, and
    as tokens are contiguous every overlap is one stretch.
    """
    of_a = np.searchsorted(b, a)  # the token of b that holds the last byte of each of a
    of_b = np.searchsorted(a, b)
    alone = a[of_b] != b
    first = np.concatenate([np.arange(len(a)), of_b[alone]])
    return first, np.concatenate([of_a, np.flatnonzero(alone)])


class _Spaced(WordCoder):
    """Ids of a space and a text; strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.whole.encode_special_tokens = True
        self.special = []


class Coders:
    """Both tokenizers with the ids of words seen before.

    A text is cut before single spaces between other characters. Neither vocabulary has a
    token that crosses such a place, which is tested here for the second one; else texts are
    encoded whole.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.a = _Spaced(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {letter: byte for byte, letter in self.a.letters.items()}
        vocabulary = self.a.whole.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in byte_of for c in token):
                self.bytes_a[number] = bytes(byte_of[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = []
        for number, piece in enumerate(pieces):
            byte = _BYTE.fullmatch(piece) if self.b.is_byte(number) else None
            raw = bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()
            self.bytes_b.append(raw)
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << ID_BITS:
            raise ValueError(f"ids must fit in {ID_BITS} bits")
        self.digits = _digits(max(len(self.bytes_a), len(self.bytes_b)))
        self.sizes_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.starts_b = np.array([p.startswith("▁") for p in pieces])
        self.parted = not any("▁" in p.lstrip("▁") for p in pieces)
        self.words_b: dict[str, bytes] = {}
        self.differing: set[str] = set()

    def _differing(self, words: list[str]) -> list[str]:
        """Those of ``words`` whose tokens of either side are not their bytes."""
        wanted = "".join([" " + w for w in words]).encode()
        sides = ((self.a.cache, self.bytes_a), (self.words_b, self.bytes_b))
        for ids_of, bytes_of in sides:
            ids = np.frombuffer(b"".join([ids_of[w] for w in words]), "<u4")
            if b"".join(map(bytes_of.__getitem__, ids.tolist())) != wanted:
                half = len(words) // 2
                return self._differing(words[:half]) + self._differing(words[half:]) if half else words
        return []

    def _learn(self, new: set[str]) -> None:
        words = list(new)
        plain = [w for w in words if w and " " not in w and "▁" not in w]
        for at in range(0, len(plain), 100):
            part = plain[at : at + 100]
            ids = np.array(self.b.encode(" ".join(part)), "<u4")
            cuts = np.flatnonzero(self.starts_b[ids])
            if len(cuts) != len(part):
                raise ValueError("the vocabulary joins words")
            raw, ends = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
            for i, word in enumerate(part):
                self.words_b[word] = raw[ends[i] : ends[i + 1]]
        for word in new.difference(plain):
            self.words_b[word] = np.array(self.b.encode(word), "<u4").tobytes()
        self.a._learn([w for w in words if w not in self.a.cache])
        for at in range(0, len(words), 1000):
            self.differing.update(self._differing(words[at : at + 1000]))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both tokenizers; None where there are none or their bytes are not the text's."""
        cut = []
        for text in texts:
            regular = self.parted and text and not text[0].isspace()
            words = self.a._pieces(text) if regular else [text]
            cut.append([text] if "" in words else words)  # spaces that follow spaces can join
        if len(self.words_b) > MAX_CACHED:
            self.words_b.clear()
            self.a.cache.clear()
            self.differing.clear()
        seen: set[str] = set()
        for words in cut:
            seen.update(words)
        seen.discard("")
        new = seen.difference(self.words_b)
        if new:
            self._learn(new)
        of_a, of_b = self.a.cache.__getitem__, self.words_b.__getitem__
        found: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text, words in zip(texts, cut, strict=True):
            if not text or (self.differing and not self.differing.isdisjoint(words)):
                found.append(None)
                continue
            a = np.frombuffer(b"".join(map(of_a, words)), "<u4").astype(np.int64)
            b = np.frombuffer(b"".join(map(of_b, words)), "<u4").astype(np.int64)
            found.append((a, b))
        return found


def coders(path_a: str, path_b: str) -> Coders:
    """The tokenizers of this worker process, kept between tasks."""
    if (path_a, path_b) not in _coders:
        _coders[path_a, path_b] = Coders(path_a, path_b)
    return _coders[path_a, path_b]


def _digits(size: int) -> np.ndarray:
    """Decimal digits of the numbers below ``size``: zero bytes, the digits, one place after."""
    width = len(str(size))
    shown = np.zeros((size, width + 1), np.uint8)
    rest = np.arange(size)
    for place in range(width - 1, -1, -1):
        used = (rest > 0) | (place == width - 1)
        shown[used, place] = 48 + rest[used] % 10
        rest //= 10
    return shown


def groups_text(
    ids_a: np.ndarray, ids_b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, digits: np.ndarray
) -> bytes:
    """The groups as ``a1,a2|b1;a3|b2,b3``; ``in_a``, ``in_b`` as of :func:`group_ends`."""
    shown = np.empty((len(ids_a) + len(ids_b), digits.shape[1]), np.uint8)
    before_b = np.concatenate([[0], in_b[:-1]])
    before_a = np.concatenate([[0], in_a[:-1]])
    place_a = np.arange(len(ids_a)) + np.repeat(before_b, in_a - before_a)
    place_b = np.arange(len(ids_b)) + np.repeat(in_a, in_b - before_b)
    shown[place_a], shown[place_b] = digits[ids_a], digits[ids_b]
    shown[:, -1] = ord(",")
    shown[place_a[in_a - 1], -1] = ord("|")
    shown[place_b[in_b - 1], -1] = ord(";")
    shown[-1, -1] = 0
    return shown[shown != 0].tobytes()


_ALIGNED = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<int>"
)


def aligned(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """doc_id, the sizes of its alignment, its different id pairs and how often each is linked.

    With ``with_groups`` the groups themselves are there as well (``groups``). Texts that are
    NULL or empty, or whose tokens' bytes are not theirs, have no tokens: zeros, no pairs and
    an empty ``groups_sha256``. Other columns are ignored; every row stays, whatever its doc_id.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def one(coded: tuple[np.ndarray, np.ndarray] | None, both: Coders) -> tuple:
        if coded is None:
            return 0, 0, 0, 0, "", [], [], ""
        ids_a, ids_b = coded
        ends_a, ends_b = both.sizes_a[ids_a].cumsum(), both.sizes_b[ids_b].cumsum()
        in_a, in_b = group_ends(ends_a, ends_b)
        text = groups_text(ids_a, ids_b, in_a, in_b, both.digits)
        first, second = linked(ends_a, ends_b)
        pairs, times = np.unique(ids_a[first] << ID_BITS | ids_b[second], return_counts=True)
        digest = hashlib.sha256(text).hexdigest()
        sizes = len(ids_a), len(ids_b), len(in_a), len(first)
        return *sizes, digest, pairs, times.astype(np.int32), text.decode() if with_groups else ""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = coders(path_a, path_b)
        kinds = [*[pa.int64()] * 4, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.string()]
        names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", "groups"]
        size = len(names) if with_groups else len(names) - 1
        for batch in slices(batches, 64):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = [one(coded, both) for coded in both.encode(texts)]
            columns = [pa.array([r[i] for r in rows], kinds[i]) for i in range(size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names[:size]])

    schema = f"doc_id {kind}, {_ALIGNED}" + (", groups string" if with_groups else "")
    return docs.select("doc_id", "text").mapInArrow(apply, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, documents that hold it linked, and whether that is the most of its first id."""
    counts = stored(
        found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents")),
        "alignment-pairs",
    )
    first = F.shiftright("pair", ID_BITS)
    most = counts.groupBy(first.alias("first")).agg(F.max("documents").alias("most"))
    return (
        counts.withColumn("first", first)
        .join(most, "first")
        .select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))
    )


def pair_ids(pair: str = "pair") -> list:
    """Both ids of a pair."""
    return [
        F.shiftright(pair, ID_BITS).alias("id_a"),
        F.col(pair).bitwiseAND((1 << ID_BITS) - 1).alias("id_b"),
    ]


def weighed(found: DataFrame, counts: DataFrame, most_shared: int = MOST_SHARED) -> DataFrame:
    """Rows of :func:`aligned` with ``n_best`` and ``count_sum`` in place of their pairs.

    ``found`` and ``counts`` are read more than once, so they should be written tables.
    """
    spark = found.sparkSession
    total = counts.agg(F.sum("documents")).first()[0] or 0
    least = -(-total // most_shared)  # so many documents or more: at most ``most_shared`` pairs
    common = counts.where(F.col("documents") >= least).orderBy("pair").toPandas()
    shared = spark.sparkContext.broadcast(
        (common["pair"].to_numpy(np.int64), common["documents"].to_numpy(np.int64), common["best"].to_numpy(bool))
    )
    numbered = found.withColumn("row", F.monotonically_increasing_id())
    kept = [c for c in found.columns if c not in ("pairs", "times")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, documents, best = shared.value
        for batch in slices(batches, 1024):
            lists = batch.column("pairs")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            own = lists.flatten().to_numpy(zero_copy_only=False)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            known = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            n_best, count_sum = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            here = at[known]
            np.add.at(n_best, owner[known], times[known] * best[here])
            np.add.at(count_sum, owner[known], times[known] * documents[here])
            left = np.bincount(owner[~known], minlength=len(sizes))
            ends = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
            rare = pa.ListArray.from_arrays(ends, pa.array(own[~known]))
            often = pa.ListArray.from_arrays(ends, pa.array(times[~known]))
            columns = [*[batch.column(c) for c in ("row", *kept)], pa.array(n_best), pa.array(count_sum), rare, often]
            yield pa.RecordBatch.from_arrays(
                columns, names=["row", *kept, "n_best", "count_sum", "rare", "often"]
            )

    by_name = {f.name: f.dataType.simpleString() for f in numbered.schema}
    kinds = ", ".join(f"{c} {by_name[c]}" for c in ("row", *kept))
    ddl = f"{kinds}, n_best long, count_sum long, rare array<long>, often array<long>"
    added = stored(numbered.mapInArrow(add, ddl), "alignment-sums")
    rare = added.select("row", F.explode(F.arrays_zip("rare", "often")).alias("at"))
    rare = rare.select("row", F.col("at.rare").alias("pair"), F.col("at.often").alias("times"))
    seldom = counts.where(F.col("documents") < least)
    more = (
        rare.join(seldom, "pair")
        .groupBy(F.col("row").alias("of"))
        .agg(
            F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"),
            F.sum(F.col("times") * F.col("documents")).alias("more_sum"),
        )
    )
    both = added.join(more, F.col("row") == F.col("of"), "left")
    return both.select(
        *kept,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


def align_documents(docs: DataFrame, path_a: str, path_b: str, most_shared: int = MOST_SHARED) -> DataFrame:
    """One row for every row of ``docs``: its alignment and what its links count corpus-wide."""
    found = stored(aligned(docs, path_a, path_b), "alignment")
    counts = stored(pair_counts(found), "alignment-counts")
    return weighed(found, counts, most_shared)
