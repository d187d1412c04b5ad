"""Forecast documents as JSON files, read in batch or as a stream.

A file holds one document per line, as :func:`land_documents` writes them, or one array of
documents per line, and large files are split. Files that hold one JSON array over several
lines must be asked for (``arrays``); one task reads such a file. Either way, input of the other form and damaged input is an error, not
a shorter result, unless ``skip_damaged`` is set; :func:`read_damaged` lists it. Damaged is
text that is not exactly one document (or array), such as documents glued together or text
behind one, a document that is no object, and one whose ``location``, ``forecast``, days or
hours are of another type. Readings of another type are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from hyetos.schemas import DOCUMENT

MOST_DOCUMENTS = 2_000
#: The parts of a document that must be of their type if they are there.
PARTS = ("location", "forecast", "forecast.forecastday", "forecast.forecastday[*].hour")


def _has(schema: StructType, path: str) -> bool:
    kind = schema
    for name in path.replace("[*]", "").split("."):
        if isinstance(kind, ArrayType):
            kind = kind.elementType
        if not isinstance(kind, StructType) or name not in kind.names:
            return False
        kind = kind[name].dataType
    return True


def _missing(document: Column, path: str) -> Column:
    """Whether the parsed document lacks a part; for the hours, whether any day lacks them."""
    outer, _, inner = path.partition("[*].")
    part = document
    for name in outer.split("."):
        part = part[name]
    if not inner:
        return part.isNull()
    return F.coalesce(F.exists(part, lambda day: day.isNull() | day[inner].isNull()), F.lit(False))


def _fault(document: Column, text: Column, schema: StructType) -> Column:
    """Why a parsed document is damaged, or NULL. Its text is looked into only if a part lacks."""
    found = F.when(document.isNull(), "no document")
    for path in PARTS:
        if _has(schema, path):
            there = F.get_json_object(text, f"$.{path}").isNotNull()
            found = found.when(_missing(document, path) & there, f"{path} is of another type")
    return found


def _judged(reader, path: str, schema: str, arrays: bool) -> DataFrame:
    """Every document with its file, its text and its fault; damaged files and lines as one."""
    fields = StructType.fromDDL(schema)
    if arrays:
        reader = reader.option("wholetext", True)
    texts = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    # within brackets the text must be one value, from its first character to its last
    within = F.concat(F.lit("["), "value", F.lit("]"))
    array = F.from_json(within, ArrayType(ArrayType(fields)))
    parsed = texts.where("trim(value) <> ''")
    if arrays:
        parsed = parsed.withColumn("single", F.lit(None).cast(ArrayType(fields)))
    else:
        parsed = parsed.withColumn("single", F.from_json(within, ArrayType(fields)))
        array = F.when(F.col("single").isNull() & F.ltrim("value").startswith("["), array)
    parsed = parsed.withColumn("array", array)
    parsed = parsed.withColumn(
        "documents",
        F.when(F.size("single") == 1, F.col("single")).when(F.size("array") == 1, F.get("array", F.lit(0))),
    )

    def lacks(document: Column) -> Column:
        lacking = document.isNull()
        for part in PARTS:
            if _has(fields, part):
                lacking = lacking | _missing(document, part)
        return lacking

    own = F.when(F.col("single").isNotNull(), F.array("value"))
    own = own.otherwise(F.from_json("value", "array<string>"))
    parsed = parsed.withColumn("texts", F.when(F.exists("documents", lacks), own))

    def entry(document: Column, text: Column, fault: Column) -> Column:
        return F.struct(document.alias("document"), text.alias("text"), fault.alias("fault"))

    what = "array" if arrays else "document"
    whole = F.array(entry(F.lit(None).cast(fields), F.col("value"), F.lit(f"not one {what}")))

    def judged(document: Column, place: Column) -> Column:
        text = F.get("texts", place)
        return entry(document, text, _fault(document, text, fields))

    entries = F.when(F.col("documents").isNull(), whole).otherwise(F.transform("documents", judged))
    # a generator, so that no filter is moved below it and parses the text again
    return parsed.select("file", F.inline(entries))


def _checked(rows: DataFrame, skip_damaged: bool) -> DataFrame:
    sound = F.col("fault").isNull()
    if not skip_damaged:
        shown = F.left(F.coalesce("text", F.lit("")), F.lit(200))
        said = F.concat(F.lit("damaged input, or another form of file ("), "fault", F.lit("): "), shown)
        sound = F.when(sound, True).otherwise(F.raise_error(said).cast("boolean"))
    return rows.where(sound).select("document.*")


def read_documents(
    spark: SparkSession,
    path: str,
    schema: str = DOCUMENT,
    arrays: bool = False,
    skip_damaged: bool = False,
) -> DataFrame:
    """Documents under ``path``, one per line or, with ``arrays``, one array per file."""
    return _checked(_judged(spark.read, path, schema, arrays), skip_damaged)


def read_damaged(
    spark: SparkSession, path: str, schema: str = DOCUMENT, arrays: bool = False
) -> DataFrame:
    """file, fault and text of everything that ``skip_damaged`` leaves out."""
    rows = _judged(spark.read, path, schema, arrays).where("fault is not null")
    return rows.select("file", "fault", "text")


def stream_documents(
    spark: SparkSession,
    path: str,
    schema: str = DOCUMENT,
    arrays: bool = False,
    max_files: int | None = None,
    skip_damaged: bool = False,
) -> DataFrame:
    """Documents of every file that appears under ``path``, at most ``max_files`` per batch."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _checked(_judged(reader, path, schema, arrays), skip_damaged)


def stream_judged(
    spark: SparkSession,
    path: str,
    schema: str = DOCUMENT,
    arrays: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Like :func:`stream_documents`, with all input: file, document, text and fault.

    ``document`` is a struct; ``fault`` is NULL for sound ones. Parsing happens once, so what
    is sound and what is not can be written from one read.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _judged(reader, path, schema, arrays)


def land_documents(documents: DataFrame, path: str, most_documents: int = 0) -> None:
    """Append documents to the landing folder, one per line.

    ``most_documents`` bounds the documents of a file; by default a partition is a file.
    """
    documents.write.mode("append").option("maxRecordsPerFile", most_documents).json(path)


def land_arrays(documents: DataFrame, path: str, least_files: int = 1) -> None:
    """Append the documents as files that hold an array each, of at most ``MOST_DOCUMENTS``.

    The number of files grows with the documents and is at least about ``least_files``. A
    file takes documents that follow each other in one partition, so no value is hot.
    """
    most = max(1, min(MOST_DOCUMENTS, -(-documents.count() // least_files)))
    number = F.monotonically_increasing_id()  # the partition, then 33 bits for the row in it
    place = [F.shiftright(number, 33).alias("part"), number.bitwiseAND((1 << 33) - 1).alias("row")]
    arrays = (
        documents.select(*place, F.struct(*documents.columns).alias("document"))
        .groupBy("part", F.expr(f"row div {most}").alias("file"))
        .agg(F.to_json(F.collect_list("document")).alias("value"))
    )
    writer = arrays.select("value").write.mode("append")
    writer.option("maxRecordsPerFile", 1).text(path)
