"""As-of join: to each row the last row of another table at or before its time.

Rows of a key are dealt to time buckets, so a key that holds most rows is split. A bucket
gets its rows of both sides and one row carried into it, the last one before it; the rest is
a running last value within the bucket. Only the last row of each key and bucket takes part
in finding what is carried, so no key is sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LEFT, _BUCKET, _TIME, _VALUES, _CARRIED = "_left", "_bucket", "_time", "_values", "_carried"


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    columns: dict[str, str],
    tiebreak: Sequence[str] = (),
    bucket_seconds: int = 86_400,
) -> DataFrame:
    """All columns of ``left`` and, renamed as in ``columns``, some of the matching right row.

    The match is the row of ``right`` with equal keys ``on`` and the greatest ``right_time`` that is not after
    ``left_time``; of several, the greatest by ``tiebreak`` and then by the taken columns. Rows
    without a match keep NULLs; NULL keys and times match nothing. Both tables are read twice.
    Choose ``bucket_seconds`` so that the rows of the busiest key in one bucket suit one task.
    """
    width = bucket_seconds * 1_000_000
    keys = [f"_key{i}" for i in range(len(on))]
    named = [F.col(c).alias(k) for c, k in zip(on, keys, strict=True)]

    def known(df: DataFrame, time: str) -> Column:
        present = F.col(time).isNotNull()
        for c in on:
            present &= F.col(c).isNotNull()
        return present

    def placed(df: DataFrame) -> DataFrame:
        # whole buckets, also before 1970
        return df.withColumn(_BUCKET, F.expr(f"({_TIME} - pmod({_TIME}, {width})) div {width}"))

    order = F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate((*tiebreak, *columns))])
    row = F.struct(*left.columns)
    empty = F.lit(None)
    ours = placed(
        left.where(known(left, left_time)).select(*named, _micros(left_time).alias(_TIME), row.alias(_LEFT))
    )
    theirs = placed(
        right.where(known(right, right_time)).select(*named, _micros(right_time).alias(_TIME), order.alias(_VALUES))
    )
    kind = theirs.schema[_VALUES].dataType

    lasts = theirs.groupBy(*keys, _BUCKET).agg(F.max(F.struct(_TIME, _VALUES)).alias("last"))
    asked = ours.select(*keys, _BUCKET).distinct()
    marks = lasts.withColumn("asked", F.lit(False)).unionByName(
        asked.withColumn("last", empty.cast(lasts.schema["last"].dataType)).withColumn("asked", F.lit(True))
    )
    buckets = marks.groupBy(*keys, _BUCKET).agg(F.max("last").alias("last"), F.max("asked").alias("asked"))
    before = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.withColumn("last", F.last("last", ignorenulls=True).over(before))
    carried = carried.where("asked and last is not null").select(
        *keys, _BUCKET, F.col(f"last.{_TIME}").alias(_TIME), F.col(f"last.{_VALUES}").alias(_VALUES)
    )

    nothing = empty.cast(ours.schema[_LEFT].dataType).alias(_LEFT)
    events = (
        ours.withColumn(_VALUES, empty.cast(kind))
        .unionByName(theirs.withColumn(_LEFT, nothing))
        .unionByName(carried.withColumn(_LEFT, nothing))
    )
    # at equal times rows of the right side come first, the greatest of them last
    so_far = (
        Window.partitionBy(*keys, _BUCKET)
        .orderBy(_TIME, F.col(_LEFT).isNotNull(), _VALUES)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = events.withColumn(_CARRIED, F.last(_VALUES, ignorenulls=True).over(so_far))
    taken = [
        F.col(f"{_CARRIED}.t{i + len(tiebreak)}").alias(new) for i, new in enumerate(columns.values())
    ]
    matched = matched.where(F.col(_LEFT).isNotNull()).select(F.col(f"{_LEFT}.*"), *taken)
    unknown = left.where(~known(left, left_time))
    nulls = [empty.cast(matched.schema[new].dataType).alias(new) for new in columns.values()]
    return matched.unionByName(unknown.select("*", *nulls))
