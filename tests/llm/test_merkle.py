import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from hyetos.llm import merkle
from hyetos.llm.queries import MERKLE_SQL


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_digest(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(hashes):
    """All levels of a tree, the leaves first."""
    found = [hashes]
    while len(found[-1]) > 1:
        found.append([digest("".join(found[-1][i : i + 2])) for i in range(0, len(found[-1]), 2)])
    return found


def plain_audit(rows):
    groups = {}
    for r in rows:
        values = [r.doc_id, r.source, r.lang, r.n_chars, r.text]
        leaf = shown = row_digest(values)
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        if changed and r.n_chars is not None:
            values[3] += 1
            shown = row_digest(values)
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf, shown, r.doc_id))
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: levels([leaf[2] for leaf in sorted(groups[lang])]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    found = []
    for number, lang in enumerate(langs):
        for place, (_, _, leaf, shown, doc_id) in enumerate(sorted(groups[lang])):
            siblings = ""
            for tree, at in ((trees[lang], place), (top, number)):
                for level in tree[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    shown = digest(other + shown if at % 2 else shown + other)
                    siblings, at = siblings + other, at // 2
            root = top[-1][0]
            found.append((doc_id, leaf, trees[lang][-1][0], root, digest(siblings), shown, shown == root))
    return sorted(found, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("stride", [3, 8])
def test_like_plain_trees(spark, make_docs, odd_docs, stride, monkeypatch):
    monkeypatch.setattr(merkle, "STRIDE", stride)
    docs = make_docs([f"text {i}" for i in range(75)], 10)
    lang = F.expr("case when doc_id % 3 = 0 then 'é' when doc_id % 7 = 0 then 'z' when doc_id <> 20 then 'de' else 'one' end")
    docs = docs.withColumn("lang", lang).union(odd_docs).withColumn("path", F.lit("clash")).withColumn("lo", F.lit(1))
    assert rows_of(merkle.audit(docs)) == plain_audit(docs.collect())


def test_trees_of_every_small_size(make_docs, monkeypatch):
    monkeypatch.setattr(merkle, "STRIDE", 2)
    docs = make_docs(["same"] * 55, 0)  # groups of 1 to 10 rows
    docs = docs.withColumn("lang", F.floor((F.sqrt(8 * F.col("doc_id") + 1) - 1) / 2).cast("string"))
    assert rows_of(merkle.audit(docs)) == plain_audit(docs.collect())


def test_no_rows(no_docs):
    assert merkle.audit(no_docs).collect() == []


def test_all_rows_equal_and_no_doc_id(spark, make_docs):
    docs = make_docs(["same"]).crossJoin(spark.range(40)).drop("id").withColumn("doc_id", F.lit(None).cast("long"))
    found = rows_of(merkle.audit(docs))
    assert len(found) == 40 and all(r[-1] for r in found)
    assert found == plain_audit(docs.collect())


def test_sql_gives_the_same_rows(make_docs, odd_docs, tmp_path):
    docs = make_docs([f"text {i}" for i in range(30)], 100).union(odd_docs)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents/*.parquet')")
    assert sorted(map(repr, connection.execute(MERKLE_SQL).fetchall())) == sorted(map(repr, map(tuple, merkle.audit(docs).collect())))


def test_intervals_nest(spark, make_docs):
    leaves = make_docs([str(i) for i in range(300)]).select("doc_id", "lang", F.sha2("text", 256).alias("digest"))
    nodes = merkle.manifest(leaves, "lang", "doc_id").nodes
    rows = {(r.level, r.lo, r.hi) for part in nodes for r in part.collect()}
    assert (9, 0, 300) in rows and (8, 256, 300) in rows and (0, 299, 300) in rows
    for level, lo, hi in rows:
        if level < 9:
            assert any(u == level + 1 and a <= lo and hi <= b for u, a, b in rows)
