import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from hyetos.llm import common
from hyetos.session import CLEANUP_KEY


def shuffle_files(spark):
    """Names of the shuffle files that a local session holds."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {name for name in names if name.startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP_KEY, None)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    table = common.stored(rows.join(rows.withColumnRenamed("count", "n"), "k"), "groups")
    end = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(CLEANUP_KEY, None) == setting
    assert table.agg(F.sum("count"), F.sum("n")).first() == (1000, 1000)
    # a frame that was written can still be used, and written again
    assert common.stored(rows, "again").count() == rows.count() == 7


def test_long_rows_end_their_row_group(spark):
    numbers = F.transform(F.sequence(F.lit(1), F.lit(2000)), lambda i: i + F.col("id"))
    pieces = F.transform(numbers, lambda i: F.sha2(i.cast("string"), 256))
    rows = spark.range(0, 12, 1, 1).select("id", F.concat_ws("", pieces).alias("text"))
    for group_bytes, groups in ((1 << 16, 12), (1 << 24, 1), (None, 1)):
        table = common.stored(rows, "groups", group_bytes=group_bytes)
        files = [pq.ParquetFile(f.replace("file://", "", 1)) for f in table.inputFiles()]
        assert [f.num_row_groups for f in files] == [groups]
        assert table.exceptAll(rows).count() == 0 and table.count() == 12
