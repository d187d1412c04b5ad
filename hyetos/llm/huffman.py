"""Token-id files: canonical length-limited Huffman codes in independent blocks.

A folder holds the blocks in ascending doc_id order (``part=N/`` in order, then the block
numbers inside) and, in ``code/``, the code length of every id, from which the canonical
code follows. A block holds whole documents, at least ``BLOCK`` ids unless it is the last
of its part, and the bit offset of every ``STEP``-th id. So blocks decode alone, and inside
a block all stretches between two offsets decode side by side, one table look-up each.

Layout of a block, little-endian: ``b"HFB1"``, unsigned 32-bit part, block, number of
documents, number of stretches; 64-bit number of ids and number of code bytes; then the
doc_ids (64-bit), a byte each that is 1 where the doc_id is NULL, the ids per document
(64-bit), the bit offsets (64-bit), the code bytes, and the CRC-32 of all before.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hyetos.llm import tokens
from hyetos.llm.common import full_text, read_files, stored, text_slices

BLOCK = 1 << 18
STEP = 128
LIMIT = 16
LANES = 1 << 15
HEAD = struct.Struct("<4sIIIIQQ")
DOC_DDL = "part int, block int, place int, doc_id long, n_tokens long, ids_crc32 long"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels, weights = [], leaves
    is_leaf = np.ones(len(leaves), bool)
    for _ in range(limit - 1):
        levels.append(is_leaf)
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, pairs])
        sorting = np.argsort(merged, kind="stable")
        weights, is_leaf = merged[sorting], sorting < len(leaves)
    levels.append(is_leaf)
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint32)
    code, before = 0, 0
    used = np.flatnonzero(lengths)
    for symbol in used[np.lexsort((used, lengths[used]))].tolist():
        code <<= int(lengths[symbol]) - before
        before = int(lengths[symbol])
        codes[symbol] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for each value of the next ``limit`` bits."""
    symbols, sizes = np.zeros(1 << limit, np.uint32), np.zeros(1 << limit, np.uint8)
    codes = canonical_codes(lengths)
    for symbol in np.flatnonzero(lengths):
        size = int(lengths[symbol])
        first = int(codes[symbol]) << (limit - size)
        symbols[first : first + (1 << (limit - size))] = symbol
        sizes[first : first + (1 << (limit - size))] = size
    return symbols, sizes


def encode_ids(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Code bytes of ``ids`` and the bit offset of every ``STEP``-th id."""
    size = lengths[ids].astype(np.int64)
    if len(ids) and size.min() == 0:
        raise ValueError("an id has no code")
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ids) else 0
    value = codes[ids].astype(np.uint32) << (24 - size - (starts & 7)).astype(np.uint32)
    byte, out = starts >> 3, np.zeros(total // 8 + 4)
    for position, shift in enumerate((16, 8, 0)):
        part = np.bincount(byte, (value >> np.uint32(shift)) & np.uint32(255), len(out) - position)
        out[position:] += part  # bits never overlap, so sums are unions
    return out[: (total + 7) // 8].astype(np.uint8).tobytes(), starts[::STEP]


def decode_ids(
    code: bytes, offsets: np.ndarray, n: int, symbols: np.ndarray, sizes: np.ndarray
) -> np.ndarray:
    """The ``n`` ids of a block."""
    bits = np.frombuffer(code + b"\0\0\0", np.uint8)
    out = np.zeros(n, np.uint32)
    shift_to = 24 - int(len(symbols)).bit_length() + 1
    mask = np.uint32(len(symbols) - 1)
    for low in range(0, len(offsets), LANES):
        at = offsets[low : low + LANES].astype(np.int64)
        place = (low + np.arange(len(at))) * STEP
        last = n - int(place[-1]) if low + len(at) == len(offsets) else STEP
        for step in range(STEP):
            if step == last:
                at, place = at[:-1], place[:-1]
                if not len(at):
                    break
            byte = at >> 3
            window = bits[byte].astype(np.uint32) << np.uint32(16)
            window |= bits[byte + 1].astype(np.uint32) << np.uint32(8)
            window |= bits[byte + 2]
            key = (window >> (shift_to - (at & 7)).astype(np.uint32)) & mask
            out[place + step] = symbols[key]
            at = at + sizes[key]
    return out


def pack_block(
    part: int, block: int, doc_ids: list, counts: list, ids: np.ndarray, codes, lengths
) -> bytes:
    code, offsets = encode_ids(ids, codes, lengths)
    head = HEAD.pack(b"HFB1", part, block, len(doc_ids), len(offsets), len(ids), len(code))
    body = b"".join(
        (
            head,
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            bytes(d is None for d in doc_ids),
            np.array(counts, "<i8").tobytes(),
            offsets.astype("<i8").tobytes(),
            code,
        )
    )
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_block(data: memoryview, symbols, sizes) -> tuple[int, int, list, list, np.ndarray, int]:
    """Part, block, doc_ids, ids per document, all ids, and bytes read."""
    magic, part, block, docs, stretches, n, size = HEAD.unpack_from(data)
    if magic != b"HFB1":
        raise ValueError("no block here")
    at, arrays = HEAD.size, []
    for kind, count in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<i8", stretches), ("u1", size)):
        arrays.append(np.frombuffer(data, kind, count, at))
        at += arrays[-1].nbytes
    if zlib.crc32(data[:at]) != struct.unpack_from("<I", data, at)[0]:
        raise ValueError(f"block {block} of part {part} is damaged")
    doc_ids = [None if null else int(d) for d, null in zip(arrays[0], arrays[1], strict=True)]
    ids = decode_ids(arrays[4].tobytes(), arrays[3], n, symbols, sizes)
    return part, block, doc_ids, arrays[2].tolist(), ids, at + 4


def token_blocks(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Whole documents in ascending doc_id order (NULL first, then by text), in blocks of ids.

    Ids are kept in two bytes where the vocabulary allows it. A document is never split.
    """
    from pyspark import TaskContext

    end = np.array([end_id], "<u4").tobytes()

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.coder(tokenizer)
        kind = "<u2" if len(coder.starts) <= 1 << 16 else "<u4"
        part, number = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        held: list[bytes] = []

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4").astype(kind)
            arrays = [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([[len(h) // 4 for h in held]], pa.list_(pa.int64())),
                pa.array([ids.itemsize], pa.int32()),
                pa.array([ids.tobytes()], pa.binary()),
            ]
            names = ["part", "block", "doc_ids", "counts", "width", "ids"]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        size = 0
        for batch in text_slices(batches, 1):
            encoded = coder.encode(batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                doc_ids.append(doc_id)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= BLOCK:
                    yield row()
                    number, size, doc_ids, held = number + 1, 0, [], []
        if held:
            yield row()

    ordered = (
        docs.select(F.col("doc_id").cast("long"), full_text().alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ddl = "part int, block int, doc_ids array<long>, counts array<long>, width int, ids binary"
    return ordered.mapInArrow(block, ddl)


def _ids(batch: pa.RecordBatch, row: int) -> np.ndarray:
    kind = f"<u{batch.column('width')[row].as_py()}"
    return np.frombuffer(batch.column("ids")[row].as_buffer(), kind)


def id_counts(blocks: DataFrame) -> DataFrame:
    """How often each id occurs, summed inside each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                own = np.bincount(_ids(batch, row), minlength=len(total))
                own[: len(total)] += total
                total = own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["id", "n"]
        )

    counted = blocks.select("width", "ids").mapInArrow(count, "id int, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write(blocks: DataFrame, path: str) -> None:
    """Write stored ``token_blocks`` to ``path``: the code first, then the blocks.

    The counts come to the driver: one row per id of the vocabulary, whatever the corpus.
    """
    spark = blocks.sparkSession
    rows = id_counts(blocks).collect()
    counts = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    counts[[r.id for r in rows]] = [r.n for r in rows]
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    spark.createDataFrame([(lengths.tobytes(),)], "lengths binary").coalesce(1).write.parquet(
        f"{path}/code"
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, doc_ids, sizes = (
                    batch.column(c)[row].as_py() for c in ("part", "block", "doc_ids", "counts")
                )
                data = pack_block(part, block, doc_ids, sizes, _ids(batch, row), codes, lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([data])],
                    names=["part", "block", "record"],
                )

    (
        blocks.mapInArrow(encode, "part int, block int, record binary")
        .sortWithinPartitions("part", "block")
        .select("part", F.col("record").cast("string").alias("value"))
        .write.partitionBy("part")
        .option("lineSep", "\n")
        .text(f"{path}/blocks")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: its place in the files, doc_id, number of ids, CRC-32 of the ids.

    A folder without blocks gives no rows.
    """
    lengths = np.frombuffer(spark.read.parquet(f"{path}/code").head().lengths, np.uint8)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, sizes = decode_table(lengths)
        for batch in batches:
            for file in range(batch.num_rows):
                data = memoryview(batch.column("content")[file].as_buffer())
                while len(data):
                    part, block, doc_ids, counts, ids, used = unpack_block(data, symbols, sizes)
                    data = data[used + 1 :]
                    raw, at, sums = memoryview(ids.astype("<u4").tobytes()), 0, []
                    for n in counts:
                        sums.append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
                        at += n
                    size = len(doc_ids)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(size, part, np.int32)),
                            pa.array(np.full(size, block, np.int32)),
                            pa.array(np.arange(size, dtype=np.int32)),
                            pa.array(doc_ids, pa.int64()),
                            pa.array(counts, pa.int64()),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["part", "block", "place", "doc_id", "n_tokens", "ids_crc32"],
                    )

    return read_files(spark, f"{path}/blocks").select("content").mapInArrow(decode, DOC_DDL)


def with_starts(documents: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before; read from a stored table.

    Totals per part are few (one row per file), so their running sum is one small window;
    inside a part the sum runs over that part alone.
    """
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = documents.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("part").orderBy("block", "place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    own = documents.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return own.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2) -> DataFrame:
    """Encode, write and read back: doc_id, start, n_tokens and ids_crc32 per document."""
    spark = docs.sparkSession
    blocks = stored(token_blocks(docs, tokenizer, end_id), "token-blocks")
    if blocks.isEmpty():
        return spark.createDataFrame(
            [], "doc_id long, start long, n_tokens long, ids_crc32 long"
        )
    write(blocks, path)
    return with_starts(stored(read(spark, path), "token-documents"))
