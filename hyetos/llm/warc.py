"""Web archives with revisit records: write them deduplicated, read them back.

Only headers are shuffled by payload digest: the keepers (one row for each payload that
occurs more than once) are joined to the pages, by broadcast if Spark finds them small.
The archives are plain WARC/1.1: a record is its header block, its content and two line
ends, and Spark's text writer puts exactly that separator after each record, so files are
committed whole or not at all on any store. Records hold no more than their own payload;
readers go from record to record by ``Content-Length``, never by looking for separators.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hyetos.llm.common import read_files, stored, write_records

END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_DDL = """page_id long, record_id string, record_type string, refers_to_record string,
    url string, payload_bytes long, payload_digest string, payload binary"""


def record_id(page_id: Column, digest: Column) -> Column:
    """A name-based identifier: the same page and payload always get the same one."""
    name = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("-")), digest))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def resolve(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Decide which pages become revisit records.

    Adds ``payload`` (NULL html: empty), ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to`` and ``refers_to_url``. Of equal payloads of at least
    ``least_bytes`` bytes the one with the largest page_id is the response (rows that
    share this page_id are all responses), the others revisit it; all else is a response.
    Pages without page_id revisit a page that has one.
    """
    payload = F.coalesce("html", F.lit(""))
    headers = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": F.sha1(F.col("payload").cast("binary")),
        }
    )
    keepers = stored(
        headers.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.max(F.struct("page_id", "url")).alias("keeper"), F.count("*").alias("copies"))
        .where("copies > 1 and keeper.page_id is not null")
        .select(
            "payload_digest",
            F.col("keeper.page_id").alias("keeper_id"),
            F.col("keeper.url").alias("keeper_url"),
        ),
        "warc-keepers",
    )
    revisits = F.expr("keeper_id is not null and not (page_id <=> keeper_id)")
    return headers.join(keepers, "payload_digest", "left").select(
        *headers.columns,
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("keeper_id")).alias("refers_to"),
        F.when(revisits, F.col("keeper_url")).alias("refers_to_url"),
    )


def write(
    resolved: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", per_file: int = 4000
) -> None:
    """Write one record per row of ``resolve`` with fresh headers; ``date`` is WARC-Date.

    A page without a URL has no target header; line ends in URLs become ``%0A``.
    """

    def line(name: str, value: Column) -> Column:
        return F.when(value.isNull(), "").otherwise(
            F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END))
        )

    def clean(url: str) -> Column:
        return F.regexp_replace(url, r"[\r\n]+", "%0A")

    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
        line("Content-Length", F.col("payload_bytes")),
        F.lit(END),
    )
    block = F.concat("http", F.when(revisit, "").otherwise(F.col("payload")))
    target = record_id(F.col("refers_to"), F.col("payload_digest"))
    record = F.concat(
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("WARC-Refers-To", F.when(revisit, target)),
        line("WARC-Refers-To-Target-URI", F.when(revisit, clean("refers_to_url"))),
        line("X-Page-Id", F.col("page_id")),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        line("Content-Length", F.octet_length("block")),
        F.lit(END),
        "block",
    )
    df = resolved.withColumn("http", http).withColumn("block", block)
    df = df.select(record.cast("binary").alias("record"))
    spark = df.sparkSession
    name, before = "spark.sql.files.maxRecordsPerFile", None
    before = spark.conf.get(name)
    spark.conf.set(name, str(per_file))
    try:
        write_records(df, path, END + END)
    finally:
        spark.conf.set(name, before)


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    at = 0
    while at < len(content):
        stop = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:stop].decode().split(END)
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        start = stop + 4
        end = start + int(fields["content-length"])
        yield fields, content[start:end]
        at = end + 4


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    fields = [
        pa.field("page_id", pa.int64()),
        *(pa.field(n, pa.string()) for n in ("record_id", "record_type", "refers_to_record", "url")),
        pa.field("payload_bytes", pa.int64()),
        pa.field("payload_digest", pa.string()),
        pa.field("payload", pa.binary()),
    ]
    schema = pa.schema(fields)

    def row(header: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        kind = header["warc-type"]
        page = header.get("x-page-id")
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if kind == "revisit":  # the payload stands in the record it refers to
            size = int(http.rpartition(b"Content-Length: ")[2])
            digest = header["warc-payload-digest"].removeprefix("sha1:")
            payload = None
        return (
            None if page is None else int(page), header["warc-record-id"], kind,
            header.get("warc-refers-to"), header.get("warc-target-uri"), size, digest, payload,
        )

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for files in batches:
        for content in files.column("content"):
            rows: list[tuple] = []
            for header, block in records(content.as_py()):
                rows.append(row(header, block))
                if len(rows) == 500:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``; payload is NULL for revisit records."""
    return read_files(spark, path).select("content").mapInArrow(_parse, READ_DDL)


def with_originals(read_records: DataFrame) -> DataFrame:
    """Join revisit records to the responses they refer to: adds ``refers_to``.

    Headers alone are joined, by record identifier; a broken reference stays NULL.
    """
    originals = (
        read_records.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_to_record"))
        .agg(F.max("page_id").alias("refers_to"))
    )
    return read_records.join(originals, "refers_to_record", "left")
