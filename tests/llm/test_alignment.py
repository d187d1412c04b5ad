import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hyetos.llm import alignment
from tests.llm.conftest import invented

PATHS = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def plain_tokens(texts):
    """Per text both lists of (id, bytes), or None; straight from both libraries."""
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    byte_of = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}
    found = []
    for text in texts:
        if not text:
            found.append(None)
            continue
        e = first.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = b"".join(t for _, t in a) == whole == b"".join(t for _, t in b)
        found.append((a, b) if same else None)
    return found


def spans(tokens):
    at, found = 0, []
    for number, raw in tokens:
        found.append((number, at, at + len(raw)))
        at += len(raw)
    return found


def plain_rows(rows):
    """Brute force: all token pairs compared, counts in dictionaries."""
    links, sizes = [], []
    for coded in plain_tokens([r.text for r in rows]):
        a, b = map(spans, coded or ([], []))
        links.append([(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]])
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        text = ";".join(
            "|".join(",".join(str(t[0]) for t in side if low < t[2] <= high) for side in (a, b))
            for low, high in zip([0, *ends], ends)
        )
        sizes.append((len(a), len(b), len(ends), text))
    count = Counter(pair for own in links for pair in set(own))
    most = defaultdict(int)
    for (first, _), n in count.items():
        most[first] = max(most[first], n)
    return sorted(
        (
            r.doc_id, n_a, n_b, n_groups, len(own), sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        )
        for r, own, (n_a, n_b, n_groups, text) in zip(rows, links, sizes)
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    "", None, " ", "  two  spaces ", "a\nb\n\n c", "\ttab", "▁under", "x ▁ y", "<s> </s> <unk> <0x41>",
    "<|endoftext|> and <|endoftext|>", "İ é 漢字 😀 ﬁ ½ é", "a\xa0b   c", "\x00 nul", "end ", "I'll we've 1234567 a1b2",
    "ONE-TWO!!! ### $$$", "a" * 500, "é" * 301, "one", "one",
]


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_like_all_pairs(make_docs):
    prose = [" ".join(invented(i, 40)) + ".\n" + " ".join(invented(i + 50, 5)) for i in range(25)]
    docs = make_docs([*ODD, *prose, prose[0], prose[0] + " more"]).withColumn("pairs", F.lit("clash"))
    expected = plain_rows(docs.collect())
    for most_shared in (alignment.MOST_SHARED, 40, 1):
        assert rows_of(alignment.align_documents(docs, *PATHS, most_shared)) == expected
    assert any(r[2] > r[3] > 0 for r in expected) and sum(r[1] == 0 for r in expected) >= 3


def test_groups_are_kept_on_demand(make_docs):
    found = alignment.aligned(make_docs(["the thndouha", None]), *PATHS, with_groups=True).collect()
    assert hashlib.sha256(found[0].groups.encode()).hexdigest() == found[0].groups_sha256
    assert found[0].groups.count(";") == found[0].n_groups - 1 and found[1].groups == ""


def test_ids_with_remembered_words_are_those_of_the_libraries():
    source, both = random.Random(3), alignment.Coders(*PATHS)
    pieces = [*"ab é漢😀\n\t!▁'1A", " ", " ", " ", "the", "<s>", "\xa0", " the", "ing"]
    texts = ["".join(source.choices(pieces, k=source.randint(0, 30))) for _ in range(1500)]
    for _ in range(2):
        for coded, plain in zip(both.encode(texts), plain_tokens(texts)):
            assert (coded is None) == (plain is None)
            if plain:
                assert [c.tolist() for c in coded] == [[i for i, _ in side] for side in plain]


def test_runs_and_irregular_groups():
    source = random.Random(5)
    for _ in range(400):
        size, dense = source.randint(1, 200), source.random()
        ends = [sorted({*source.sample(range(1, size + 1), int(dense * size)), size}) for _ in range(2)]
        shared = set(source.sample(range(1, size + 1), size // 2))
        a, b = (np.array(sorted({*e, *shared})) for e in ends)
        in_a, in_b = alignment.group_ends(a, b)
        common = np.intersect1d(a, b)
        assert a[in_a - 1].tolist() == b[in_b - 1].tolist() == common.tolist()
    one = list(range(1, 5001))
    assert alignment.align(one, one) == ([], [], [], [])
    assert alignment.align(one, [*one[:700], *one[703:]]) == ([700], [704], [700], [701])


def test_odd_rows_and_no_rows(odd_docs, no_docs):
    assert sorted(map(repr, rows_of_any(odd_docs))) == sorted(map(repr, rows_of_any(odd_docs.repartition(5))))
    assert alignment.align_documents(no_docs, *PATHS).collect() == []


def rows_of_any(docs):
    return [tuple(r) for r in alignment.align_documents(docs, *PATHS).select(*COLUMNS).collect()]
