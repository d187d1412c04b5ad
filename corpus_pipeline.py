"""A corpus from raw documents: each stage is written as Parquet and read by the next.

Toxic documents go, near-equal lines stay once, one document of each group of near copies
stays, documents that hold benchmark passages go, and the rest is packed into sequences.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hyetos.llm import decontamination, line_dedup, packing, similarity_join, tokens, toxicity
from hyetos.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from labels of the training fold."""
    labels = table(spark, sf_dir, "labels").where(toxicity.fold("doc_id", 5) != 0)
    names = ("toxicity of this stage", "rejected by this stage")
    scored = toxicity.score(docs, toxicity.train(docs, labels), names)
    return scored.where(F.col(names[1]) == 0).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-equal lines stay once; a document left without any line goes."""
    return line_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id stays.

    Documents without doc_id stay, and so do all rows of a doc_id that stays.
    """
    classes = similarity_join.join(docs)
    losers = classes.where("doc_id <> class_id").select("doc_id").distinct()
    return docs.join(losers, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; those without doc_id are judged as one."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    leaking = found.where("contaminated").select(F.col("doc_id").alias("leaking")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("leaking"))
    return docs.join(leaking, same, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    pieces = stored(packing.token_pieces(docs, tokens.default_path()), "pieces")
    return packing.pack(pieces)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: SQL cannot express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table ``documents``; the rows are those of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
