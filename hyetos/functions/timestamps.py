"""Timestamp parsing and calendar columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_timestamp(text: Column) -> Column:
    """ISO-like text to timestamp; text that is no timestamp gives NULL, also in ANSI mode.

    A time without a date is none: Spark would complete it with the day of the run.
    """
    dated = text.rlike(r"^\s*[+-]?\d{4,7}(-|\s*$)")
    return F.when(dated, F.try_to_timestamp(text))


def wall_clock(moment: datetime) -> Column:
    """A naive datetime as literal, read in the session time zone where a zone matters."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def iso_text(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss``, with six fractional digits only where there are any."""
    fine = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(fine, r"\.000000$", "")


def day_label(day: Column) -> Column:
    """Short weekday and day of month, for example ``Mon 15``."""
    return F.date_format(day, "EEE dd")


def with_calendar_parts(df: DataFrame, time: str) -> DataFrame:
    """Add the calendar columns the serving tables are keyed and labelled by."""
    ts = F.col(time)
    return df.withColumns(
        {
            "date": F.to_date(ts),
            "hour": F.hour(ts),
            "time_str": F.date_format(ts, "HH:mm"),
            "date_str": F.date_format(ts, "yyyy-MM-dd"),
            "display_time": F.date_format(ts, "MM-dd HH:mm"),
        }
    )
