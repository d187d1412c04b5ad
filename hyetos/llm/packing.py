"""Pack token pieces into sequences of a fixed capacity: minimum bin slack.

Pieces of one length are alike, so the work is done on the histogram of lengths, which has
at most ``capacity`` rows whatever the corpus. The driver fills one bin at a time: the
longest length left goes in, a subset-sum over bit sets finds the fullest combination of
the other lengths that fits, and the combination is removed as often as the counts allow.
Each piece then finds its place from its rank among the pieces of its length. Ranks come
from counts per length and bucket, so a length that most pieces share is not one group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from hyetos.llm import tokens
from hyetos.llm.common import full_text, text_slices

PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"
PER_BUCKET = 20_000


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens; only the first may be shorter."""
    first = n % capacity or capacity
    cuts = [0, *range(first, n + 1, capacity)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Encode each ``text`` (NULL: empty), append ``end_id``, cut what exceeds ``capacity``.

    One row per piece, with the ids themselves (``ids``, array) if asked for. Rows keep
    their doc_id, NULL or repeated; every row is a document of its own.
    """
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.coder(tokenizer)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in text_slices(batches, 1):
            columns: list[list] = [[] for _ in names]
            texts = batch.column(1).to_pylist()
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode(texts), strict=True):
                ids += end
                for number, (start, size) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + size)]
                    row = [doc_id, number, start, size, zlib.crc32(own)]
                    row += [np.frombuffer(own, "<u4").astype("i4")] * with_ids
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            arrays += [pa.array(columns[5], pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    ddl = PIECE_DDL + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), full_text()).mapInArrow(encode, ddl)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest bin that holds the longest length: how many pieces of which lengths."""
    first = max(counts)
    room = capacity - first
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left = min(counts[length] - (length == first), room // length)
        share = 1
        while left > 0:
            share = min(share, left)
            steps.append((length, share, reach))
            reach |= (reach << (share * length)) & mask
            left -= share
            share *= 2
        if reach >> room & 1:
            break
    target, chosen = reach.bit_length() - 1, {first: 1}
    for length, share, before in reversed(steps):
        if not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + share
            target -= share * length
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int) -> tuple[dict[int, list], int]:
    """Places by length: (first rank, first sequence, offset), and the number of sequences.

    The pieces of a length with ranks from one entry's first rank up to the next's go to
    consecutive sequences at that offset.
    """
    counts = {n: c for n, c in histogram.items() if c > 0}
    if counts and (min(counts) < 1 or max(counts) > capacity):
        raise ValueError("lengths must lie between 1 and the capacity")
    places: dict[int, list] = {n: [] for n in counts}
    placed = dict.fromkeys(counts, 0)
    sequences = 0
    while counts:
        chosen = fullest(counts, capacity)
        times = min(counts[n] // k for n, k in chosen.items())
        offset = 0
        for length in sorted(chosen, reverse=True):
            for _ in range(chosen[length]):
                places[length].append((placed[length], sequences, offset))
                placed[length] += times
                offset += length
            counts[length] -= times * chosen[length]
            if not counts[length]:
                del counts[length]
        sequences += times
    return places, sequences


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every piece; read the pieces from a stored table.

    Pieces of equal rank order (all columns alike) are interchangeable, so repeated rows
    and a task that runs again give the same set of rows.
    """
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    places, _ = plan_bins(histogram, capacity)
    buckets = max(1, sum(histogram.values()) // PER_BUCKET)
    own = ["doc_id", "piece", "start", "ids_crc32"]
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64(*own), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shares = spread.groupBy("length", "bucket").agg(F.count("*").alias("share"))
    shares = shares.select(
        "length", "bucket", F.coalesce(F.sum("share").over(before), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("length", "bucket").orderBy(*own)
    ranked = (
        spread.withColumn("rank", F.row_number().over(inside) - 1)
        .join(shares, ["length", "bucket"])
        .withColumn("rank", F.col("rank") + F.col("base"))
        .select(*pieces.columns, "rank")
    )
    arrays = {n: np.array(p, np.int64).reshape(-1, 3) for n, p in places.items()}
    shared = spark.sparkContext.broadcast(arrays)  # bounded: see plan_bins

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                table = shared.value[int(n)]
                entry = np.searchsorted(table[:, 0], rank[at], "right") - 1
                sequence[at] = table[entry, 1] + rank[at] - table[entry, 0]
                offset[at] = table[entry, 2]
            columns = [batch.column(c) for c in batch.schema.names if c != "rank"]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = StructType([*pieces.schema.fields]).add("sequence_id", LongType()).add("offset", LongType())
    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token ids: one array of at most ``capacity`` ids per sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
