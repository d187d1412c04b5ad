"""Latest revision of each forecast hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_revision(forecast: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the greatest fetch time per name and forecast hour.

    Equal fetch times are ordered by the ``tiebreak`` columns and then by the rest, so
    the result does not depend on row order. One maximum per group combines before the
    shuffle; no group is gathered or sorted as a whole.
    """
    keys = ["name", "forecast_time"]
    order = ["fetch_time", *tiebreak]
    rest = [c for c in forecast.columns if c not in keys and c not in order]
    newest = forecast.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("newest"))
    return newest.select(
        *[F.col(c) if c in keys else F.col(f"newest.{c}") for c in forecast.columns]
    )
