"""Daily quantiles and distinct locations as sketches that merge across batches.

A batch's rows become one small row per day; rows of any number of batches are merged without
the readings. Sizes are fixed by ``K`` and ``LG_K``, not by the data. Quantiles (KLL) lie within ``RANK_ERROR``
of their rank with a chance of about 99 %, whatever the number of merges; distinct counts
(HyperLogLog) have a relative standard error of about 1.04 / sqrt(2^LG_K), 1.6 %, and small ones
are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 400
LG_K = 12
#: 99 % bound of the normalised rank error of a double-sided KLL sketch of this K.
RANK_ERROR = 0.01


def daily_sketches(forecast: DataFrame) -> DataFrame:
    """forecast_date, n_rows and the sketches of ``temp`` and ``name``; NULLs are not counted in them."""
    return forecast.groupBy("forecast_date").agg(
        F.count("*").alias("n_rows"),
        F.kll_sketch_agg_double(F.col("temp").cast("double"), F.lit(K)).alias("temps"),
        F.hll_sketch_agg("name", F.lit(LG_K)).alias("names"),
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row per day out of the rows of several batches."""
    return sketches.groupBy("forecast_date").agg(
        F.sum("n_rows").alias("n_rows"),
        F.kll_merge_agg_double("temps", F.lit(K)).alias("temps"),
        F.hll_union_agg("names").alias("names"),
    )


def read_sketches(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Day, rows, distinct locations and the named quantiles of merged sketches.

    Quantiles are NULL on days without a reading.
    """
    known = F.kll_sketch_get_n_double("temps") > 0
    return sketches.select(
        "forecast_date",
        "n_rows",
        F.hll_sketch_estimate("names").alias("n_locations"),
        *[
            F.when(known, F.kll_sketch_get_quantile_double("temps", F.lit(float(q)))).alias(name)
            for name, q in quantiles.items()
        ],
    )
