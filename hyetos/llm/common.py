"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hyetos.session import shuffles_removed, work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(
    df: DataFrame, label: str, codec: str = "zstd", group_bytes: int | None = None
) -> DataFrame:
    """``df`` written once under the shared work folder and read back.

    Cuts the lineage: lost executors cost a new read, not a new computation. The shuffle
    files of the write go when it is done. With ``group_bytes`` a row group ends before it
    has more bytes, or with its first row: Parquet's writer and Spark's reader hold a whole
    group, and the writer else looks at its size only after 100 rows, however long.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    writer = df.write.option("compression", codec)
    if group_bytes is not None:
        writer = writer.option("parquet.block.size", group_bytes)
        writer = writer.option("parquet.page.size.row.check.min", 1)
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def full_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that long texts stay few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_slices(
    batches: Iterable[pa.RecordBatch], column: int, most: int = 1 << 23
) -> Iterator[pa.RecordBatch]:
    """Batches whose texts in ``column`` take at most ``most`` bytes together, or single rows."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def write_records(df: DataFrame, path: str, separator: str) -> None:
    """Write the binary column ``record`` to files, each record followed by ``separator``.

    Spark's text writer puts the bytes of a string as they are, so the files are binary
    files that are committed whole or not at all, on any store that Spark can write.
    """
    df.select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", separator
    ).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file that ``write_records`` wrote: path and content."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select("path", "content")
    )
