import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

from hyetos.session import (
    BATCH_BYTES_KEY,
    BATCH_ROWS_KEY,
    arrow_batches,
    configure,
    object_store_options,
    work_dir,
)


def test_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert isinstance(configure(SparkSession.builder), SparkSession.Builder)


def test_object_store_options():
    options = object_store_options(region="eu-west-1", access_key="k", secret_key="s")
    prefix = "spark.hadoop.fs.s3a."
    assert options[prefix + "impl"].endswith("S3AFileSystem")
    assert options[prefix + "endpoint"] == "s3.eu-west-1.amazonaws.com"
    assert options[prefix + "aws.credentials.provider"].endswith("SimpleAWSCredentialsProvider")
    assert (options[prefix + "access.key"], options[prefix + "secret.key"]) == ("k", "s")
    assert object_store_options().keys() == {prefix + "impl"}
    own = object_store_options(endpoint="http://store", credentials_provider="own.Provider")
    assert own[prefix + "endpoint"] == "http://store"
    assert own[prefix + "aws.credentials.provider"] == "own.Provider"


def test_work_dir_is_new_and_under_the_shared_folder(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_arrow_batches_are_short_and_settings_come_back(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    counted = spark.range(0, 7, 1, 1).selectExpr("repeat('x', 1000) as text").mapInArrow(sizes, "n long")
    before = [spark.conf.get(key, None) for key in (BATCH_ROWS_KEY, BATCH_BYTES_KEY)]
    assert [r.n for r in counted.collect()] == [7]
    with arrow_batches(spark, rows=1):
        assert [r.n for r in counted.select("n").collect()] == [1] * 7
    with pytest.raises(ValueError), arrow_batches(spark, size=2500):
        assert [r.n for r in counted.select("n").collect()] == [3, 3, 1]
        raise ValueError
    assert [spark.conf.get(key, None) for key in (BATCH_ROWS_KEY, BATCH_BYTES_KEY)] == before


class _Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(_Cluster, "x")
