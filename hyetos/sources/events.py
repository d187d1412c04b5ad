"""The ``events`` test table seen as forecast revisions and as forecast documents.

Each event is one revision: issued at ``ts`` for the hour that contains ``ts``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hyetos.functions.timestamps import wall_clock
from hyetos.schemas import document_schema

# The documents carry doubles, so that values survive the round trip unchanged.
EVENT_DOCUMENT = document_schema(real="double", hour_extra="event_id bigint")

# Hours ahead of the issue hour that an event's document forecasts; spans two days.
LEAD_HOURS = (0, 8, 16, 24)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, max_files: int = 100) -> DataFrame:
    """The table as a stream, whether it is one Parquet file or a folder of them.

    A streaming source does not take the path of a single file, but it takes a pattern.
    A batch takes at most ``max_files`` files.
    """
    schema = read_events(spark, sf_dir).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{sf_dir}/event[s].parquet")


def _humidity() -> Column:
    """``k`` of the JSON text ``props``; NULL if it is no whole number."""
    return F.get_json_object("props", "$.k").try_cast("int")


def forecast_view(events: DataFrame) -> DataFrame:
    """Events as the flat forecast table, with ``event_id``."""
    return events.withColumn("humidity", _humidity()).select(
        "event_id",
        F.concat(F.lit("CITY_"), (F.col("user_id") % 7).cast("string")).alias("name"),
        F.col("ts").alias("fetch_time"),
        F.col("ts").cast("date").cast("string").alias("forecast_date"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("forecast_time"),
        (F.col("value") - 10.0).alias("temp"),
        "humidity",
        (F.col("humidity") * 0.25 + 6.5).alias("wind_speed"),
        F.col("event_type").alias("condition"),
    )


def events_between(
    events: DataFrame, start: datetime, end: datetime, window: str = "0 seconds"
) -> DataFrame:
    """Events whose forecast hour can lie in a window that starts in ``[start, end]``.

    The scan prunes on ``ts``; an event belongs to the hour that contains it.
    """
    beyond = wall_clock(end + timedelta(hours=1)) + F.expr(f"INTERVAL {window}")
    return events.filter((F.col("ts") >= wall_clock(start)) & (F.col("ts") < beyond))


def document_view(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One nested document per event, forecasting the hours of ``LEAD_HOURS``.

    Temperatures rise by half a degree from one lead hour to the next. A document is
    built from its own row alone, so nothing is grouped. Hours also carry their date,
    which the declared schema does not read. ``keep`` names columns of the forecast view to
    carry along.
    """
    condition = F.struct(F.col("condition").alias("text"))
    readings = [condition.alias("condition"), F.col("wind_speed").alias("wind_kph"), "humidity"]
    hours = []
    for position, lead in enumerate(LEAD_HOURS):
        time = F.col("forecast_time") + F.expr(f"INTERVAL {lead} HOURS")
        hours.append(
            F.struct(
                time.cast("date").cast("string").alias("date"),
                F.date_format(time, "yyyy-MM-dd HH:mm").alias("time"),
                (F.col("temp") + F.lit(0.5 * position)).alias("temp_c"),
                *readings,
                "event_id",
            )
        )

    def day(date: Column) -> Column:
        of_day = F.filter("hours", lambda hour: hour["date"] == date)
        return F.struct(date.alias("date"), of_day.alias("hour"))

    days = F.transform(F.array_distinct("hours.date"), day)
    return forecast_view(events).withColumn("hours", F.array(*hours)).select(
        F.struct("name").alias("location"),
        F.struct(F.col("temp").alias("temp_c"), *readings).alias("current"),
        F.struct(days.alias("forecastday")).alias("forecast"),
        F.date_format("fetch_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetch_timestamp"),
        *keep,
    )
