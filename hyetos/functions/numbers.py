"""Rounding and order-independent means built from partial sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles hold every whole number below this bound exactly.
_WHOLE_LIMIT = float(2**53)
# How far, of its own size, a value may lie from a whole number of units to count as one,
# and how far in units at most.
_NOISE = 1e-12
_MOST_NOISE = 1e-6


def half_even(value: Column, digits: int) -> Column:
    """Round the double, ties to even. Spark's ``bround`` works on the decimal text instead."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def fixed_text(value: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, ties to even on the exact value of the double."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def partial_sum(value: Column, name: str, decimals: int | None = None) -> list[Column]:
    """First-level aggregates from which :func:`merged_mean` makes a mean.

    With ``decimals`` the sum is kept in whole units of 10**-decimals. A value counts as
    whole if it is the double of such a number, or lies within ``_NOISE`` of it and at most
    ``_MOST_NOISE`` units away, as results of binary arithmetic do. All others (more digits,
    NaN, infinities, very large ones, floats that widen to such) go unchanged into a double
    sum beside it.
    """
    columns = [F.count(value).alias(f"{name}_n")]
    if decimals is None:
        return columns + [F.sum(value).alias(f"{name}_sum")]
    scale = F.lit(float(10**decimals))
    exact = value.cast("double") * scale
    scaled = F.rint(exact)
    noise = F.least(F.lit(_NOISE) * F.greatest(F.lit(1.0), F.abs(scaled)), F.lit(_MOST_NOISE))
    whole = (scaled / scale == value.cast("double")) | (F.abs(exact - scaled) <= noise)
    fits = (F.abs(scaled) < F.lit(_WHOLE_LIMIT)) & whole
    units = F.when(fits, scaled).cast("bigint")
    rest = F.when(~fits, value.cast("double"))
    return columns + [
        F.sum(units).alias(f"{name}_units"),
        F.sum(rest).alias(f"{name}_rest"),
    ]


def merged_mean(name: str, decimals: int | None = None) -> Column:
    """Second-level aggregate over :func:`partial_sum` columns; NULL if no value was seen."""
    count = F.sum(f"{name}_n")
    if decimals is None:
        return F.try_divide(F.sum(f"{name}_sum").cast("double"), count)
    units = F.coalesce(F.sum(f"{name}_units"), F.lit(0)) / F.lit(float(10**decimals))
    rest = F.coalesce(F.sum(f"{name}_rest"), F.lit(0.0))
    return F.try_divide(units + rest, count)


def modal(value: str, rows: str) -> Column:
    """Most frequent non-NULL value, given one row per value with its row count.

    Ties go to the lowest value.
    """
    rank = F.struct(-F.col(rows), F.col(value))
    return F.min_by(value, F.when(F.col(value).isNotNull(), rank))
