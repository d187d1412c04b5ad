"""Tumbling event-time trend per location.

The aggregation runs in two levels. The first groups by window, name *and* condition
and holds only fixed-width numbers, so it hashes, combines before its shuffle and
keeps no list or map of conditions per group. The second reads one row per
condition and group, where the modal condition is a minimum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hyetos.functions.numbers import merged_mean, modal, partial_sum
from hyetos.params import TrendParams


def partial_trend(forecast: DataFrame, params: TrendParams = TrendParams()) -> DataFrame:
    """First level: measures per window, name and condition. Rows without time drop out."""
    return _partial(forecast, params, F.window("forecast_time", params.window), "name")


def _partial(forecast: DataFrame, params: TrendParams, *keys: Column | str) -> DataFrame:
    return forecast.groupBy(*keys, "condition").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *partial_sum(F.col("temp"), "temp", params.decimals),
        F.max("temp").alias("max_temp"),
        F.min("temp").alias("min_temp"),
        *partial_sum(F.col("humidity"), "humidity"),
        *partial_sum(F.col("wind_speed"), "wind_speed"),
    )


def merge_trend(partial: DataFrame, params: TrendParams = TrendParams()) -> DataFrame:
    """Second level: one row per window and name."""
    return merge_keys(partial, params, "window", "name")


#: The columns of a trend beside its keys.
MEASURES = ("avg_temp", "max_temp", "min_temp", "avg_humidity", "avg_wind_speed", "common_condition")


def merge_keys(partial: DataFrame, params: TrendParams, *keys: str) -> DataFrame:
    """One row for each ``keys``, from partial rows that have each condition once."""
    return partial.groupBy(*keys).agg(
        merged_mean("temp", params.decimals).alias("avg_temp"),
        F.max("max_temp").alias("max_temp"),
        F.min("min_temp").alias("min_temp"),
        merged_mean("humidity").alias("avg_humidity"),
        merged_mean("wind_speed").alias("avg_wind_speed"),
        modal("condition", "n_rows").alias("common_condition"),
    )


def combine_partials(partial: DataFrame, *keys: str) -> DataFrame:
    """Rows of :func:`partial_trend` added up to one per ``keys`` and condition."""
    sums = [c for c in partial.columns if c.endswith(("_n", "_sum", "_units", "_rest"))]
    return partial.groupBy(*keys, "condition").agg(
        F.sum("n_rows").alias("n_rows"),
        *[F.sum(c).alias(c) for c in sums],
        F.max("max_temp").alias("max_temp"),
        F.min("min_temp").alias("min_temp"),
    )


def sliding_trend(
    forecast: DataFrame,
    params: TrendParams = TrendParams(),
    panes: int = 18,
) -> DataFrame:
    """The trend of every ``panes`` windows of ``params``, one starting with each of them.

    Readings are added up once, in panes of ``params.window``. A pane row goes to the at most two blocks of
    ``panes`` windows in which sliding windows that hold it can start; a block then has all
    it needs, so windows are merged where their panes are, without another shuffle. A
    location's blocks are apart, so one that holds most rows is split by time.
    """
    small = partial_trend(forecast, params)
    kind = small.schema["window"].dataType["start"].dataType
    start, end = (F.unix_micros(F.col(f"window.{c}").cast("timestamp")) for c in ("start", "end"))
    small = small.withColumn("at", start)
    step = end - start
    small = small.withColumn("step", step).withColumn("block", F.col("step") * panes).drop("window")
    first = "at - (({0}) - 1) * step".format(panes)  # start of the first window that holds it

    def floored(time: str) -> str:
        return f"(({time}) - pmod(({time}), block))"

    sent = small.withColumn(
        "home", F.explode(F.array_distinct(F.array(F.expr(floored(first)), F.expr(floored("at")))))
    ).repartition("name", "home")
    starts = "sequence(greatest(home, {0}), least(home + block - step, at), step)".format(first)
    spread = sent.withColumn("start", F.explode(F.expr(starts)))
    keys = ("name", "home", "start", "block")
    merged = merge_keys(combine_partials(spread, *keys), params, *keys)
    window = F.struct(
        F.timestamp_micros("start").cast(kind).alias("start"),
        F.timestamp_micros(F.col("start") + F.col("block")).cast(kind).alias("end"),
    )
    return merged.select(window.alias("window"), "name", *MEASURES)


def trend_cube(
    forecast: DataFrame, sets: list[list[str]], params: TrendParams = TrendParams()
) -> DataFrame:
    """The trend by several sets of columns at once, with ``grouping`` numbering the sets.

    The rows are read once and added up by all columns that any set names; the few sums are
    then expanded to the sets. Columns that a set lacks are NULL; ``grouping`` has a bit for
    each column, in the order of their first naming, set where the set lacks it.
    """
    columns = list(dict.fromkeys(c for own in sets for c in own))
    small = _partial(forecast, params, *columns)
    sums = [c for c in small.columns if c.endswith(("_n", "_sum", "_units", "_rest"))]
    every = small.groupingSets([[*own, "condition"] for own in sets], *columns, "condition").agg(
        F.shiftright(F.grouping_id(), 1).alias("grouping"),  # the last bit is the condition's
        F.sum("n_rows").alias("n_rows"),
        *[F.sum(c).alias(c) for c in sums],
        F.max("max_temp").alias("max_temp"),
        F.min("min_temp").alias("min_temp"),
    )
    return merge_keys(every, params, *columns, "grouping")


def trend(forecast: DataFrame, params: TrendParams = TrendParams()) -> DataFrame:
    """Mean, extremes and modal condition per window and name, in no particular order."""
    return merge_trend(partial_trend(forecast, params), params)


def order_trend(trends: DataFrame) -> DataFrame:
    return trends.orderBy("window", "name")


def with_window_bounds(trends: DataFrame) -> DataFrame:
    """Replace the window struct by ``window_start`` and ``window_end``."""
    return trends.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in trends.columns if c != "window"],
    )


def modal_condition(forecast: DataFrame, *keys: str) -> DataFrame:
    """Most frequent condition per key; groups with only NULL conditions give NULL."""
    counts = forecast.groupBy(*keys, "condition").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.groupBy(*keys).agg(modal("condition", "n_rows").alias("common_condition"))
