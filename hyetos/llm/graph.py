"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hyetos.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))")).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every end of the undirected ``edges`` (a, b).

    The root is the least node of the component. Distributed union-find: each round links
    the neighbours of every node to the least of them, and every round is a written table,
    so lost executors cost one round at most. Only a count and a checksum of the edges
    reach the driver. Loops and NULL ends are ignored; no edges give no rows.
    """
    links = edges.where("a is not null and b is not null and a <> b")
    links = stored(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "links",
    )
    state = _state(links)
    while state[0]:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            links.select("lo", "hi")
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("lo"), F.least("u", "m").alias("m"))
        # one row for each link, written so that its two uses do not compute it twice
        large = stored(links.join(least, "lo").select("hi", F.col("m").alias("lo")), "links")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo"))
        small = large.join(least, "hi").select(moved.alias("hi"), F.col("m").alias("lo"))
        links = stored(small.distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    stars = links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return stars.union(stars.select("root", "root")).distinct()
