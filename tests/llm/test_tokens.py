import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hyetos.llm import huffman, packing, tokens
from hyetos.llm.common import text_slices
from hyetos.session import work_dir

PATH = tokens.default_path()


def whole(text: str) -> list[int]:
    return tokens.coder(PATH).whole.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab é漢\n\t\r \x1c\xa0'.,_½²ªà😀1<|>"), max_size=40))
def test_ids_are_those_of_the_library(text):
    coder = tokens.coder(PATH)
    for one in (text, text + "<|endoftext|> x", "word " + text):
        assert np.frombuffer(coder.encode([one])[0], "<u4").tolist() == whole(one)


def test_cut_and_packed_without_gaps(spark, odd_docs):
    pieces = packing.token_pieces(odd_docs, PATH, capacity=64, with_ids=True)
    packed = packing.pack(pieces, 64).collect()
    expected = []
    for row in odd_docs.collect():
        ids = whole(row.text) + [0]
        at = 0
        for size in [len(ids) % 64] * (len(ids) % 64 > 0) + [64] * (len(ids) // 64):
            expected.append((row.doc_id, at, ids[at : at + size]))
            at += size
    found = [(r.doc_id, r.start, r.ids) for r in packed]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    by_sequence = {}
    for row in packed:
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in packed)
    assert len(by_sequence) == -(-total // 64)
    rows = packing.sequences(packing.pack(pieces, 64)).collect()
    assert sum(len(r.ids) for r in rows) == total


def test_bins_are_as_full_as_can_be():
    assert packing.fullest({7: 1, 5: 2, 3: 1, 2: 1}, 12) == {7: 1, 5: 1}
    assert packing.fullest({6: 1, 4: 1, 3: 3}, 12) == {6: 1, 3: 2}
    places, sequences = packing.plan_bins({3: 40, 4: 10, 10: 4}, 10)
    assert sequences == 21  # only 4 + 3 + 3 and 10 fill a bin; 20 threes are left
    ranks = {n: sum(1 for _ in p) for n, p in places.items()}
    assert set(ranks) == {3, 4, 10}
    with pytest.raises(ValueError):
        packing.plan_bins({11: 1}, 10)


def test_nothing_to_pack(no_docs):
    assert packing.pack(packing.token_pieces(no_docs, PATH)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=900), st.integers(5, 9))
def test_codes_are_limited_and_reversible(ids, limit):
    ids = np.array(ids, np.int64)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=31) ** 4, limit)
    assert lengths.max(initial=0) <= limit
    used = lengths[lengths > 0]
    assert len(used) < 2 or (2.0 ** -used.astype(float)).sum() == 1
    codes = huffman.canonical_codes(lengths)
    data, offsets = huffman.encode_ids(ids, codes, lengths)
    table = huffman.decode_table(lengths, 16)
    assert (huffman.decode_ids(data, offsets, len(ids), *table) == ids).all()


def test_damage_is_seen():
    lengths = huffman.code_lengths(np.array([1, 2, 3]))
    block = bytearray(huffman.pack_block(0, 0, [1, None], [2, 1], np.array([0, 1, 2]),
                                         huffman.canonical_codes(lengths), lengths))
    table = huffman.decode_table(lengths)
    assert huffman.unpack_block(memoryview(block), *table)[2] == [1, None]
    block[-6] ^= 1
    with pytest.raises(ValueError):
        huffman.unpack_block(memoryview(block), *table)


def test_files_give_all_documents_back(spark, odd_docs, no_docs):
    found = huffman.round_trip(odd_docs, PATH, work_dir(spark, "files")).collect()
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    at, expected = 0, []
    for row in rows:
        raw = np.array([*whole(row.text), 2], "<u4").tobytes()
        expected.append((row.doc_id, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    assert huffman.round_trip(no_docs, PATH, work_dir(spark, "files")).count() == 0


def test_pieces_known_or_forgotten_give_the_same_ids(monkeypatch):
    texts = ["a\nb cd, cd xéy\n漢 \U0001f600 a", "", "a", "a  b ", " cd cd\t漢 <|endoftext|> a", "x" * 70_000 + " a"]
    monkeypatch.setattr(tokens, "MAX_CACHED", 2)
    coder = tokens.WordCoder(PATH)
    for part in (texts, texts[::-1], texts[:1], [], texts):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in coder.encode(part)]
        assert got == [whole(text) for text in part]
    assert len(coder.known) > 0


def test_slices_are_bounded_by_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", None, "", "d" * 9, "e", "f"])], ["text"])
    parts = [p.column(0).to_pylist() for p in text_slices([batch, batch.slice(0, 0)], 0, 4)]
    assert parts == [["abc", None, ""], ["d" * 9], ["e", "f"]]
