import hashlib
import random
from collections import Counter

import pyarrow.parquet as pq

from hyetos.llm import decontamination as d
from hyetos.session import BATCH_BYTES_KEY, BATCH_ROWS_KEY
from tests.llm.conftest import invented


def plain(docs, items):
    """Every window against every place of every text."""
    windows = {}
    for item, text in items:
        own = d.words(text)
        for at in range(max(len(own) - 10, 0) + 1 if own else 0):
            name = "null" if item is None else str(item)
            windows.setdefault(tuple(own[at : at + 10]), set()).add(name)
    rows = []
    for doc_id, text in docs:
        own, hit, names = d.words(text), set(), set()
        for window, owners in windows.items():
            for at in range(len(own) - len(window) + 1):
                if tuple(own[at : at + len(window)]) == window:
                    hit |= set(range(at, at + len(window)))
                    names |= owners
        ids = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        rows.append((doc_id, len(own), len(hit), len(names), ids, bool(hit)))
    return sorted(rows, key=repr)


def test_like_a_plain_search(spark):
    passage = invented(1, 24)
    items = [(1, " ".join(passage)), (2, " ".join(passage[5:30])), (11, "Tiny item"), (3, None),
             (4, "!!"), (None, "the the the"), (2, "tiny item")]
    filler = " ".join(invented(2, 300))
    docs = [
        (1, filler), (2, f"{filler} {' '.join(passage)} {filler}"),
        (3, "; ".join(w.upper() for w in passage[3:14])), (4, " ".join(passage[:9])),
        (5, "a tiny item, tiny item"), (5, "a tiny item, tiny item"), (None, "THE the the thé the"),
        (6, None), (7, ""), (8, "the the the the the the"), (9, " ".join(passage[10:24] * 3)),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = d.contamination(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=repr) == plain(docs, items)


def test_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contamination(no_docs, none).count() == 0
    assert {r.n_hit for r in d.contamination(odd_docs, none).collect()} == {0}
    assert d.contamination(odd_docs, none).count() == odd_docs.count()


def test_blocks_change_nothing(spark, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(invented(i, 14))) for i in range(4)], "item_id long, text string")
    docs = items.selectExpr("item_id as doc_id", "concat('x ', text, ' y') as text")
    once = sorted(map(tuple, d.contamination(docs, items).collect()))
    monkeypatch.setattr(d, "BLOCK_WINDOWS", 7)
    assert sorted(map(tuple, d.contamination(docs, items).collect())) == once
    assert all(r[2] == 14 for r in once)


def found_in(docs, phrases, slop=None):
    corpus = d.keyed(docs)
    rows = d.occurrences(d.build_index(corpus), phrases, slop).join(corpus, ["k1", "k2"])
    return sorted((r.phrase, r.doc_id, r.start) for r in rows.collect())


def test_phrases_and_terms_close_together(make_docs):
    docs = make_docs(["red fox and blue fox", "blue fox red", "fox red red fox blue"])
    assert found_in(docs, ["blue fox", "red fox"]) == [
        ("blue fox", 0, 3), ("blue fox", 1, 0), ("red fox", 0, 0), ("red fox", 2, 2)]
    assert found_in(docs, ["blue fox"], 1) == [
        ("blue fox", 0, 3), ("blue fox", 1, 0), ("blue fox", 2, 4)]


def test_near_like_a_plain_search(make_docs, monkeypatch):
    monkeypatch.setattr(d, "AT_ONCE", 5)
    source = random.Random(3)
    texts = [" ".join(source.choice("abcdefgh") for _ in range(source.randrange(30))) for _ in range(40)]
    phrases = ["a b", "c d e", "h", "a a b", "g zz", "b c d e f"]
    counts = Counter(" ".join(texts).split())
    for slop in (0, 2, 63):
        plain_rows = []
        for doc_id, text in enumerate(texts):
            own = text.split()
            for phrase in phrases:
                rarest = min(phrase.split(), key=lambda w: (counts[w], w))
                for at, word in enumerate(own):
                    around = own[max(0, at - slop) : at + slop + 1]
                    if word == rarest and all(w in around for w in phrase.split()):
                        plain_rows.append((phrase, doc_id, at))
        assert found_in(make_docs(texts), phrases, slop) == sorted(plain_rows)


def test_many_windows_read_the_corpus_once(spark, tmp_path, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(invented(i, 30))) for i in range(4)], "item_id long, text string")
    monkeypatch.setattr(d, "BLOCK_WINDOWS", 7)
    reads, real = [], d.build_index
    monkeypatch.setattr(d, "build_index", lambda docs: reads.append(1) or real(docs))
    docs = items.selectExpr("item_id as doc_id", "text", "1 as k1", "'x' as terms", "2 as counts")
    rows = d.contamination(docs, items)
    assert reads == [1] and {r.n_hit for r in rows.collect()} == {30}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "mapInArrow" not in plan and "MapInArrow" not in plan  # all from stored tables


def test_one_very_long_text(make_docs, spark):
    passage = " ".join(invented(7, 12))
    docs = make_docs([("the " * 1_500_000) + passage, None, "the"])
    items = spark.createDataFrame([(1, passage), (2, "the the")], "item_id long, text string")
    rows = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in d.contamination(docs, items).collect()}
    assert rows == {0: (1_500_012, 1_500_012, 2), 1: (0, 0, 0), 2: (1, 0, 0)}


def test_items_near(spark, make_docs):
    docs = make_docs(["x red of the fox y", "fox red", "fox " + "z " * 20 + "red", None, "red"])
    items = spark.createDataFrame([(1, "Red fox"), (2, "red"), (2, "red fox"), (3, "gone")], "item_id long, text string")
    rows = {r.doc_id: (r.n_items, r.n_near) for r in d.contamination(docs, items, slop=20).collect()}
    assert rows == {0: (1, 2), 1: (1, 2), 2: (1, 1), 3: (0, 0), 4: (1, 1)}
    assert "n_near" not in d.contamination(docs, items).columns


def test_a_task_holds_one_part_at_a_time(spark, make_docs, monkeypatch):
    stored, seen = {}, {}
    real = d.stored

    def store(df, label, **options):
        seen[label] = [spark.conf.get(key, None) for key in (BATCH_ROWS_KEY, BATCH_BYTES_KEY)]
        stored[label] = real(df, label, **options)
        return stored[label]

    passage = " ".join(invented(9, 12))
    docs = make_docs([" ".join(invented(i, 700_000)) for i in range(3)] + [passage]).coalesce(1)
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    before = [spark.conf.get(key, None) for key in (BATCH_ROWS_KEY, BATCH_BYTES_KEY)]
    monkeypatch.setattr(d, "stored", store)
    rows = {r.doc_id: (r.n_hit, r.n_near) for r in d.contamination(docs, items, slop=20).collect()}
    assert rows == {0: (0, 0), 1: (0, 0), 2: (0, 0), 3: (12, 1)}
    (index,) = [pq.ParquetFile(f.replace("file://", "", 1)) for f in stored["postings"].inputFiles()]
    assert index.num_row_groups >= 3  # long texts are parts and groups of their own
    assert seen["postings"][1] == str(d.PART_BYTES)
    assert seen["phrase-matches"][0] == seen["near-items"][0] == "1"
    assert [spark.conf.get(key, None) for key in (BATCH_ROWS_KEY, BATCH_BYTES_KEY)] == before
