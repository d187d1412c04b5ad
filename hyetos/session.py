"""Session settings, object-store options and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
CHANGELOG_KEY = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def configure(
    builder: SparkSession.Builder, shuffle_partitions: int | None = None
) -> SparkSession.Builder:
    """Apply the settings the engine relies on; master and sizing stay with the deployment.

    The shuffle width of a streaming query is fixed in its checkpoint by the first
    run, so choose ``shuffle_partitions`` before that.
    """
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(PROVIDER_KEY, ROCKSDB_PROVIDER)
        .config(CHANGELOG_KEY, "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, also in a session without :func:`configure`.

    A stream takes the settings of its session when it starts, so they are put back after.
    A provider other than Spark's default stays.
    """
    default = "HDFSBackedStateStoreProvider"
    wanted = {}
    if spark.conf.get(PROVIDER_KEY).rpartition(".")[2] == default:
        wanted = {PROVIDER_KEY: ROCKSDB_PROVIDER, CHANGELOG_KEY: "true"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def object_store_options(
    endpoint: str | None = None,
    region: str | None = None,
    credentials_provider: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
) -> dict[str, str]:
    """Hadoop options for ``s3a://`` paths, to be set on the session builder.

    The connector jar (``org.apache.hadoop:hadoop-aws``) comes from the deployment.
    Without keys the given provider, or else the connector's own chain, is used.
    """
    options = {"spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    if endpoint is None and region is not None:
        endpoint = f"s3.{region}.amazonaws.com"
    if access_key is not None and secret_key is not None:
        options["spark.hadoop.fs.s3a.access.key"] = access_key
        options["spark.hadoop.fs.s3a.secret.key"] = secret_key
        if credentials_provider is None:
            credentials_provider = "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
    given = {
        "endpoint": endpoint,
        "endpoint.region": region,
        "aws.credentials.provider": credentials_provider,
    }
    for key, value in given.items():
        if value is not None:
            options[f"spark.hadoop.fs.s3a.{key}"] = value
    return options


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that start within remove their shuffle files when they end.

    Otherwise the files stay until the driver's garbage collector finds the query, so that
    those of a chain of written tables add up. Meant for writes, which nothing reads twice.
    """
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, before)


@contextmanager
def arrow_batches(
    spark: SparkSession, rows: int | None = None, size: int | None = None
) -> Iterator[None]:
    """Queries that start within send Python at most ``rows`` rows at a time.

    A batch that has ``size`` bytes gets no more rows. The JVM holds a batch several times
    while it is sent, once for each task, so batches of long rows want to be short.
    """
    wanted = {BATCH_ROWS_KEY: rows, BATCH_BYTES_KEY: size}
    wanted = {key: str(value) for key, value in wanted.items() if value is not None}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder path for written tables and checkpoints.

    It lies under ``spark.checkpoint.dir``, the folder all executors share. Only a
    local session that names none falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="hyetos-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _hadoop_path(spark, path)
    return file_system.exists(hadoop_path)


def names_descending(spark: SparkSession, pattern: str) -> Iterator[str]:
    """Names of the paths that match ``pattern``, last in order first."""
    file_system, hadoop_path = _hadoop_path(spark, pattern)
    found = file_system.globStatus(hadoop_path) or []  # sorted by path
    for position in reversed(range(len(found))):
        yield found[position].getPath().getName()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if there is none."""
    file_system, hadoop_path = _hadoop_path(spark, path)
    file_system.delete(hadoop_path, True)
