"""Snapshots of results: one folder per batch, a manifest, and JSON records.

Layout under a job root::

    <root>/<kind>/checkpoint             state and progress of the stream
    <root>/<kind>/history/batch_id=N     rows of batch N (Parquet)
    <root>/<kind>/manifest/batch_id=N    query id and row count of batch N (JSON)
    <root>/<kind>/segments/<name>        rows and manifest entries of many batches (Parquet)
    <root>/<kind>/waiting/batch_id=N     what batch N leaves to the next one, where a stream keeps such rows
    <root>/<kind>/generations/gen=N      which segments there are, up to which batch (JSON)

A batch counts once its manifest entry exists. It is written last, and a batch that
has one is not written again, so readers never see half a batch.

:func:`compact` copies old batches into a segment and then writes a generation. A reader
takes the newest generation: its segments, and the folders of later batches alone. So it
sees every batch once, whether it looks before or after that one file appears. What a
generation replaced is removed by :func:`expire`, one generation later, so that readers
under way keep their files.

Batches of several results (:func:`write_group`) have one manifest entry for all of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hyetos.functions.timestamps import iso_text, parse_timestamp
from hyetos.schemas import TREND_RECORD
from hyetos.session import names_descending, path_exists, remove_path

MANIFEST_SCHEMA = "batch_id bigint, query_id string, n_rows bigint"
GENERATION_SCHEMA = "upto bigint, segments array<struct<name: string, n_rows: bigint>>"
#: A compaction that would leave more segments than this merges all of them into one.
MOST_SEGMENTS = 8


def history_path(root: str, kind: str) -> str:
    return f"{root}/{kind}/history"


def manifest_path(root: str, kind: str) -> str:
    return f"{root}/{kind}/manifest"


def checkpoint_path(root: str, kind: str) -> str:
    return f"{root}/{kind}/checkpoint"


def waiting_path(root: str, kind: str) -> str:
    return f"{root}/{kind}/waiting"


def segments_path(root: str, kind: str) -> str:
    return f"{root}/{kind}/segments"


def generations_path(root: str, kind: str) -> str:
    return f"{root}/{kind}/generations"


def batch_folder(batch_id: int) -> str:
    """Padded, so that names sort like numbers."""
    return f"batch_id={batch_id:012d}"


def write_snapshot(
    df: DataFrame, batch_id: int, root: str, kind: str, query_id: str | None = None
) -> None:
    """Write one batch and then its manifest entry; does nothing if the entry exists."""
    spark = df.sparkSession
    entry = f"{manifest_path(root, kind)}/{batch_folder(batch_id)}"
    if _is_complete(spark, root, kind, batch_id):
        return
    df.write.mode("overwrite").parquet(f"{history_path(root, kind)}/{batch_folder(batch_id)}")
    # Counting Parquet reads footers only, and counts what was really written.
    written = read_batch(spark, root, kind, batch_id, df.schema).count()
    spark.range(0, 1, 1, 1).select(
        F.lit(query_id).alias("query_id"), F.lit(written).alias("n_rows")
    ).write.mode("overwrite").json(entry)


def _is_complete(spark: SparkSession, root: str, kind: str, batch_id: int) -> bool:
    generation = latest_generation(spark, root, kind)
    if generation is not None and batch_id <= generation.upto:
        return True
    entry = f"{manifest_path(root, kind)}/{batch_folder(batch_id)}"
    return path_exists(spark, entry) and _entry_row(spark, entry) is not None


def write_group(
    frames: dict[str, DataFrame], batch_id: int, root: str, group: str, query_id: str | None = None
) -> None:
    """Write one batch of several results, then one entry for all, with the rows of each."""
    spark = next(iter(frames.values())).sparkSession
    if _is_complete(spark, root, group, batch_id):
        return
    counts = []
    for name, df in frames.items():
        kind = f"{group}/{name}"
        df.write.mode("overwrite").parquet(f"{history_path(root, kind)}/{batch_folder(batch_id)}")
        counts += [F.lit(name), F.lit(read_batch(spark, root, kind, batch_id, df.schema).count())]
    spark.range(0, 1, 1, 1).select(
        F.lit(query_id).alias("query_id"), F.create_map(*counts).alias("counts")
    ).write.mode("overwrite").json(f"{manifest_path(root, group)}/{batch_folder(batch_id)}")


def read_group(spark: SparkSession, root: str, group: str, name: str) -> DataFrame:
    """One result of every complete batch of the group, with ``batch_id``."""
    history = spark.read.parquet(history_path(root, f"{group}/{name}"))
    history = history.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return history.join(read_manifest(spark, root, group).select("batch_id"), "batch_id", "left_semi")


def group_counts(spark: SparkSession, root: str, group: str) -> DataFrame:
    """batch_id and the rows of each result, as a map, of the complete batches."""
    schema = "batch_id bigint, counts map<string, bigint>"
    return spark.read.schema(schema).json(manifest_path(root, group)).select("batch_id", "counts")


def latest_generation(spark: SparkSession, root: str, kind: str) -> Row | None:
    """number, upto and segments of the newest generation."""
    folder = generations_path(root, kind)
    for name in names_descending(spark, f"{folder}/gen=*"):
        row = spark.read.schema(GENERATION_SCHEMA).json(f"{folder}/{name}").first()
        if row is not None:
            return Row(number=int(name.split("=")[1]), **row.asDict())
    return None


def compact(spark: SparkSession, root: str, kind: str, keep_last: int = 1) -> int | None:
    """Copy all complete batches but the newest ``keep_last`` into a segment.

    Batches up to the newest of them must be complete: one that is still being written ends
    the range. Returns the number of the new generation, or None if there was nothing to do.
    Of two compactions at a time one fails.
    """
    before = latest_generation(spark, root, kind)
    upto = -1 if before is None else before.upto
    segments = [] if before is None else [tuple(s) for s in before.segments]
    fresh = read_manifest(spark, root, kind).where(F.col("batch_id") > upto)
    ids = sorted(r.batch_id for r in fresh.select("batch_id").collect())  # one number a batch
    ids = ids[: max(0, len(ids) - keep_last)]
    if not ids:
        return None
    last = ids[-1]
    first = upto
    if len(segments) >= MOST_SEGMENTS:
        segments, first = [], -1
    name = f"to-{last:012d}-{uuid.uuid4().hex}"
    folder = f"{segments_path(root, kind)}/{name}"
    chosen = F.col("batch_id").between(first + 1, last)
    read_history(spark, root, kind).where(chosen).write.parquet(f"{folder}/rows")
    read_manifest(spark, root, kind).where(chosen).write.parquet(f"{folder}/manifest")
    n_rows = spark.read.parquet(f"{folder}/rows").count()
    number = 0 if before is None else before.number + 1
    entry = spark.createDataFrame([(last, [*segments, (name, n_rows)])], GENERATION_SCHEMA)
    entry.coalesce(1).write.json(f"{generations_path(root, kind)}/gen={number:012d}")
    return number


def expire(spark: SparkSession, root: str, kind: str) -> None:
    """Remove what the newest generation and the one before it no longer read.

    Batches that only the newest has in a segment stay as folders too, for readers that began
    before it.
    """
    newest = latest_generation(spark, root, kind)
    if newest is None or newest.number == 0:
        return
    folder = generations_path(root, kind)
    previous = spark.read.schema(GENERATION_SCHEMA).json(f"{folder}/gen={newest.number - 1:012d}").first()
    for path in (history_path(root, kind), manifest_path(root, kind)):
        for name in list(names_descending(spark, f"{path}/batch_id=*")):
            if int(name.split("=")[1]) <= previous.upto:
                remove_path(spark, f"{path}/{name}")
    used = {s.name for s in [*newest.segments, *previous.segments]}
    for name in list(names_descending(spark, f"{segments_path(root, kind)}/to-*")):
        if name not in used and int(name.split("-")[1]) <= newest.upto:
            remove_path(spark, f"{segments_path(root, kind)}/{name}")
    for name in list(names_descending(spark, f"{folder}/gen=*")):
        if int(name.split("=")[1]) < newest.number - 1:
            remove_path(spark, f"{folder}/{name}")


def read_manifest(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """One row per complete batch: batch id, query id, row count."""
    path = manifest_path(root, kind)
    generation = latest_generation(spark, root, kind)
    found = spark.createDataFrame([], MANIFEST_SCHEMA)
    if path_exists(spark, path):
        entries = spark.read.schema(MANIFEST_SCHEMA).json(path).select("batch_id", "query_id", "n_rows")
        found = entries if generation is None else entries.where(F.col("batch_id") > generation.upto)
    for segment in [] if generation is None else generation.segments:
        found = found.unionByName(spark.read.parquet(f"{segments_path(root, kind)}/{segment.name}/manifest"))
    return found


def _entry_row(spark: SparkSession, entry: str) -> Row | None:
    """What an entry says; None while it is being written. No marker file is looked at."""
    return spark.read.schema("query_id string, n_rows bigint").json(entry).first()


def latest_entry(spark: SparkSession, root: str, kind: str) -> Row | None:
    """Manifest entry of the newest complete batch.

    Only folder names are listed, and only the newest entry is opened.
    """
    folder = manifest_path(root, kind)
    for name in names_descending(spark, f"{folder}/batch_id=*"):
        row = _entry_row(spark, f"{folder}/{name}")
        if row is not None:
            return Row(batch_id=int(name.split("=")[1]), **row.asDict())
    return None


def read_latest(
    spark: SparkSession, root: str, kind: str, schema: str | None = None
) -> DataFrame | None:
    """Rows of the newest complete batch.

    Before the first batch this is an empty frame of ``schema``, or None without one.
    """
    entry = latest_entry(spark, root, kind)
    if entry is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return read_batch(spark, root, kind, entry.batch_id, schema)


def read_batch(
    spark: SparkSession,
    root: str,
    kind: str,
    batch_id: int,
    schema: str | StructType | None = None,
) -> DataFrame:
    """Rows of one batch that is known to be complete."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{history_path(root, kind)}/{batch_folder(batch_id)}")


def read_history(
    spark: SparkSession, root: str, kind: str, schema: str | None = None
) -> DataFrame:
    """Rows of every complete batch, with ``batch_id``.

    Before the first batch this is an empty frame if there is a ``schema``, else an error.
    """
    path = history_path(root, kind)
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], f"batch_id bigint, {schema}")
    generation = latest_generation(spark, root, kind)
    upto = -1 if generation is None else generation.upto
    # entries are listed after the generation is chosen: none of its batches can be missed
    folder = manifest_path(root, kind)
    entries = spark.read.schema(MANIFEST_SCHEMA).json(folder) if path_exists(spark, folder) else None
    parts = []
    if entries is not None and next(names_descending(spark, f"{path}/batch_id=*"), None):
        history = spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
        later = entries.select("batch_id").where(F.col("batch_id") > upto)
        parts.append(history.where(F.col("batch_id") > upto).join(later, "batch_id", "left_semi"))
    for segment in [] if generation is None else generation.segments:
        parts.append(spark.read.parquet(f"{segments_path(root, kind)}/{segment.name}/rows"))
    if not parts:
        return spark.read.parquet(path)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    return found


def as_records(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text, the window as the array ``[start, end]``, NaN as NULL."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        kind = field.dataType.simpleString()
        if field.name == "window":
            column = F.array(iso_text(column.start), iso_text(column.end)).alias("window")
        elif kind.startswith("timestamp"):
            column = iso_text(column).alias(field.name)
        elif kind in ("float", "double"):
            column = F.when(~F.isnan(column), column).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def export_records(df: DataFrame, path: str) -> None:
    """Write JSON records for clients; fields that are NULL are left out."""
    as_records(df).write.mode("overwrite").json(path)


def read_trend_records(
    spark: SparkSession, path: str, schema: str = TREND_RECORD
) -> DataFrame:
    """Trend records with ``window_start`` and ``window_end``."""
    return with_record_bounds(spark.read.schema(schema).json(path))


def with_record_bounds(records: DataFrame) -> DataFrame:
    """Window column to bounds, whether it is an array, a struct or the start alone.

    Records without a window, or with one of another type, are returned as they are.
    """
    types = {f.name: f.dataType.typeName() for f in records.schema.fields}
    window = F.col("window")
    rest = [c for c in records.columns if c != "window"]
    if types.get("window") == "array":
        bounds = [parse_timestamp(F.get(window, 0)), parse_timestamp(F.get(window, 1))]
    elif types.get("window") == "struct":
        bounds = [window.start, window.end]
    elif types.get("window") == "string":
        bounds = [parse_timestamp(window)]
    elif str(types.get("window")).startswith("timestamp"):
        bounds = [window]
    else:
        return records
    names = ("window_start", "window_end")
    return records.select(*[b.alias(n) for b, n in zip(bounds, names)], *rest)
