import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hyetos.llm import fingerprints, language, toxicity
from hyetos.llm.queries import QUERIES
from tests.llm.conftest import invented


def test_edited_texts_and_ring(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(fingerprints, "PER_BUCKET", 3)
    more = spark.createDataFrame([(i * 7, " ".join(invented(i, 10 + i * 20))) for i in range(20)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").union(more.selectExpr("doc_id + 10", "text"))
    found = fingerprints.edited_fingerprints(docs)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    have = {}
    for r in found.collect():
        have.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, have.values())) == len(rows)
    ids = [i for i, _ in rows if i is not None and i > 6]
    text = dict(rows)
    for i in ids:
        below = max((j for j in text if j is not None and j < i))
        own, follow = text[i], text[below]
        half = len(own) // 2
        edited = own[: len(own) - half] + follow[:half]
        assert have[i][0].n_chars == len(own)
        assert have[i][0].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert have[3][0].fingerprint == have[4][0].fingerprint and have[3][0].near_next == 0.0
    assert {r.near_next for r in have[4]} == {1.0}
    assert have[1][0].fingerprint == ""
    assert fingerprints.edited_fingerprints(no_docs).count() == 0


def test_likeness_estimates_similarity(spark):
    base = invented(7, 1000)
    rows = [(" ".join(base), " ".join(base[:k] + invented(8, 1000 - k))) for k in range(0, 1001, 50)]
    frame = spark.createDataFrame(rows, "a string, b string")
    frame = frame.withColumn("fa", fingerprints.fingerprint("a")).withColumn("fb", fingerprints.fingerprint("b"))
    errors = []
    for k, r in zip(range(0, 1001, 50), frame.withColumn("x", fingerprints.likeness("fa", "fb")).collect(), strict=True):
        shared = max(k - 4, 0)
        errors.append(r.x - shared / (2 * 996 - shared))
        assert len(r.fa) == fingerprints.BINS * fingerprints.BITS // 4
    assert max(map(abs, errors)) < 0.16 and abs(np.mean(errors)) < 0.04


def test_short_texts_agree_too(spark):
    """Densified bins still estimate the similarity."""
    pairs = []
    for i in range(40):
        base = invented(i, 24)
        pairs.append((" ".join(base), " ".join(base[:17] + invented(1000 + i, 7))))
    frame = spark.createDataFrame(pairs, "a string, b string")
    frame = frame.withColumn("fa", fingerprints.fingerprint("a")).withColumn("fb", fingerprints.fingerprint("b"))
    mean = frame.agg(F.avg(fingerprints.likeness("fa", "fb"))).first()[0]
    assert abs(mean - 13 / 27) < 0.08


SYLLABLES = {"xa": ["ba", "do", "ki"], "yb": ["scht", "ung", "er"], "el": ["αλ", "βε", "γο"]}


def prose(lang, seed, n):
    source = random.Random(seed)
    return " ".join("".join(source.choices(SYLLABLES[lang], k=source.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def languages(spark):
    rows = [(prose(lang, i, 60), lang) for lang in SYLLABLES for i in range(12)] + [(None, "xa"), ("abc", None)]
    return language.train(spark.createDataFrame(rows, "text string, lang string"))


def test_spans_and_majorities(spark, languages, odd_docs):
    mixed = f"{prose('xa', 90, 30)}. {prose('yb', 91, 12)}! {prose('el', 92, 5)}"
    rows = [(1, mixed, "clash"), (2, prose("yb", 93, 3), None), (3, "12 !!", None), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = {r.doc_id: r for r in language.identify(docs, languages, with_spans=True).collect()}
    assert [tuple(s) for s in found[1].spans] == [("xa", 0, 30), ("yb", 30, 12), ("el", 42, 5)]
    assert found[1].lang_pred == "xa" and 0 < found[1].score < 1
    assert (found[2].lang_pred, found[2].score) == ("yb", 1.0)
    assert {found[3].lang_pred, found[4].lang_pred} == {"und"}
    assert language.identify(odd_docs, languages).count() == odd_docs.count()


def test_path_is_the_best_of_all(languages):
    source = np.random.default_rng(4)
    for n in range(1, 7):
        scores = source.normal(0, 12, (n, 3)).astype(np.float32)
        paths = np.array(np.meshgrid(*[range(3)] * n)).reshape(n, -1).T
        value = lambda p: sum(float(scores[i, x]) for i, x in enumerate(p)) - 12 * (np.diff(p) != 0).sum()
        assert abs(value(languages.label(scores)) - max(map(value, paths))) < 1e-3


def test_long_texts_are_cut_at_spaces(monkeypatch):
    monkeypatch.setattr(language, "CHUNK", 10)
    text = "aa bbbbbbbbbbb c ddd eeee fffffffffffffffffffffffffffffffffffff g"
    parts = list(language.chunks(text))
    assert "".join(parts) == text and max(map(len, parts)) <= 20


def test_nothing_learned(spark, odd_docs):
    model = language.train(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in language.identify(odd_docs, model).collect()} == {"und"}


def labelled(spark, n=400):
    source, docs, labels = random.Random(5), [], []
    for i in range(n):
        toxic = i % 4 == 0
        own = invented(i, 30) + (["vileword"] if toxic else ["nicely"])
        if source.random() < (0.9 if toxic else 0.1):
            own.append("muslim")  # mentions go with the label in these data only
        docs.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_swaps_keep_neutral_mentions_low(spark):
    docs, labels = labelled(spark)
    neutral = spark.createDataFrame(
        [(1, "Muslim people came nicely", 7), (2, "a Vileword here", 7), (3, None, 7), (4, "", 7)],
        "doc_id long, text string, score int",
    )
    scores = {}
    for penalty in (0.0, 30.0):
        model = toxicity.train(docs, labels, penalty=penalty)
        scores[penalty] = {r.doc_id: r for r in toxicity.score(neutral, model).collect()}
    assert scores[30.0][2].predicted == 1 and scores[30.0][3].score == scores[30.0][4].score
    weight = lambda p: scores[p][1].score
    assert weight(30.0) < weight(0.0) and scores[30.0][1].predicted == 0


def test_without_labels_nothing_is_toxic(spark, odd_docs):
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    found = toxicity.score(odd_docs, toxicity.train(odd_docs, labels)).collect()
    assert {r.predicted for r in found} == {0} and len(found) == odd_docs.count()


@pytest.mark.parametrize("name, least", [("op4_language", 0.97), ("op7_toxicity", 0.93)])
def test_held_out_accuracy(spark, name, least):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES[name](spark, sf_dir).where("held_out")
    if name == "op4_language":
        truth = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang is not null")
        right = F.col("lang") == F.col("lang_pred")
    else:
        truth = spark.read.parquet(f"{sf_dir}/labels.parquet")
        right = F.col("toxic") == F.col("predicted")
    share = found.join(truth.drop("score"), "doc_id").agg(F.avg(right.cast("int"))).first()[0]
    assert share >= least


@pytest.mark.parametrize("size, learned, held_out", [("sf0.001", 1.0, 1.0), ("sf0.01", 0.9, 0.6)])
def test_toxic_documents_are_found_at_small_sizes(spark, size, learned, held_out):
    sf_dir = f"/root/testdata/{size}"
    truth = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").select("doc_id")
    found = QUERIES["op7_toxicity"](spark, sf_dir).join(truth, "doc_id")
    recall = {r.held_out: r.recall for r in found.groupBy("held_out").agg(F.avg("predicted").alias("recall")).collect()}
    assert recall[False] >= learned and recall[True] >= held_out


def test_two_classes_without_a_shared_feature_are_an_error(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "xyz"), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    with pytest.raises(ValueError):
        toxicity.train(docs, labels)


def test_two_stretches_that_gain_only_together():
    model = language.Model(["a", "b", "c"], np.zeros((1, 3)), np.ones((1, 3), bool), 12.0)
    assert model.label(np.array([[-10, -2, -20], [-10, -20, -2]])).tolist() == [1, 2]
    assert model.label(np.array([[-10, -2, -20], [-2, -20, -20]])).tolist() == [0, 0]
    assert language.Model(["a"], np.zeros((1, 1)), np.ones((1, 1), bool), 12.0).label(np.zeros((2, 1))).tolist() == [0, 0]
    source = np.random.default_rng(9)
    for _ in range(300):
        scores = source.normal(0, 8, (4, 3))
        paths = np.array(np.meshgrid(*[range(3)] * 4)).reshape(4, -1).T
        value = lambda p: scores[range(4), p].sum() - 12 * (np.diff(p) != 0).sum()
        assert abs(value(model.label(scores)) - max(map(value, paths))) < 1e-9


def test_default_penalty_lowers_neutral_mentions(spark):
    docs, labels = labelled(spark)
    neutral = spark.createDataFrame([(1, "Muslim people came"), (2, "Hindu people came")], "doc_id long, text string")
    gap = {}
    for name, options in (("none", {"penalty": 0.0}), ("default", {})):
        one, two = toxicity.score(neutral, toxicity.train(docs, labels, **options)).orderBy("doc_id").collect()
        gap[name] = abs(one.score - two.score)
    assert gap["default"] < gap["none"] / 2


def test_other_labels_teach_nothing_and_texts_without_words_stand_at_the_base_rate(spark, make_docs):
    texts = [f"{' '.join(invented(i, 8))} {'vile' if i < 12 else 'kind'}word" for i in range(40)]
    docs = make_docs([*texts, "", None, "12 !"])
    labels = [(i, int(i < 12)) for i in range(40)]
    odd = [(1, 2), (2, -1), (3, None), (None, 1), (99, 1)]
    frames = [spark.createDataFrame(rows, "doc_id long, toxic int") for rows in (labels, labels + odd)]
    one, two = (toxicity.score(docs, toxicity.train(docs, f)).orderBy("doc_id").collect() for f in frames)
    assert [r.score for r in one] == pytest.approx([r.score for r in two])
    assert [r.predicted for r in one] == [1] * 12 + [0] * 31
    assert [r.score for r in one[40:]] == pytest.approx([13 / 60] * 3)


def test_a_repeated_doc_id_does_not_outgrow_the_sample(spark, make_docs):
    texts = [f"{' '.join(invented(i, 8))} {'vile' if i % 2 else 'kind'}word" for i in range(60)]
    docs = make_docs(texts).union(make_docs(["hot kindword"] * 400).withColumn("doc_id", F.lit(0)))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, rows=100)
    scores = {r.doc_id: r.score for r in toxicity.score(make_docs(texts), model).collect()}
    assert np.mean([scores[i] > scores[j] for i in range(1, 60, 2) for j in range(0, 60, 2)]) > 0.9
