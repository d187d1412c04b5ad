"""Judge URLs by rules on host suffixes and path prefixes.

Each URL is expanded into the expressions ``host suffix + path prefix`` that a rule could
have. Expressions meet rules in an equi-join on the first 32 bits of their SHA-256; the
full digest then confirms a match, and the longest rule wins.

Only shapes (labels in the host, characters in the path) that some rule has are expanded.
The shapes are few even when the rules are many: they are collected, and a list of more
than ``MAX_SHAPES`` is refused. The rules themselves are never collected or forced into a
broadcast; Spark chooses the join by size and splits hot expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_SHAPES = 10_000
RULE_DDL = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/ ? #`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _keyed(df: DataFrame) -> DataFrame:
    digest = F.sha2(F.col("expression"), 256)
    return df.withColumn("digest", digest).withColumn(
        "prefix", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    )


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULE_DDL)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row that has a ``url``.

    A rule fits its host and the subdomains of it if the path starts with the rule's
    path; NULL parts of a rule are empty. The longest rule (host and path together) wins;
    of equally long ones the one with the longer host, then the one that blocks. URLs that
    no rule fits get ``default`` and a NULL rule; so do NULL URLs and those without
    ``://``, whose host and path are empty. Columns of these names are replaced, all
    others stay. Repeated rows stay repeated.
    """
    clean = rules.select(
        F.coalesce("host", F.lit("")).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    ).where("rule_host <> ''")
    clean = clean.withColumns(
        {
            "labels": F.size(F.split("rule_host", r"\.")),
            "cut": F.char_length("rule_path"),
            "expression": F.concat("rule_host", "rule_path"),
        }
    )
    shapes = clean.select("labels", "cut").distinct().limit(MAX_SHAPES + 1).collect()
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"the rules have more than {MAX_SHAPES} shapes")
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parts = pages.select(
        *kept, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    if not shapes:
        return parts.select(
            "*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
        )
    listed = F.array(*[F.struct(F.lit(s.labels).alias("labels"), F.lit(s.cut).alias("cut"))
                       for s in sorted(shapes)])
    urls = parts.select("host", "path").distinct()
    expressions = (
        urls.where("host <> ''")
        .withColumn("shape", F.explode(listed))
        .where("size(split(host, '[.]')) >= shape.labels and char_length(path) >= shape.cut")
        .withColumn(
            "expression",
            F.expr(
                "concat(substring_index(host, '.', -shape.labels), left(path, shape.cut))"
            ),
        )
    )
    rank = F.struct(
        F.char_length("expression").alias("length"),
        F.char_length("rule_host").alias("host_length"),
        (F.col("rule_verdict") == "block").alias("blocks"),
        F.col("expression").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    ruled = _keyed(clean).drop("labels", "cut")
    best = (
        _keyed(expressions)
        .join(
            ruled.withColumnsRenamed({"expression": "rule_expression", "digest": "rule_digest"}),
            "prefix",
        )
        .where("digest = rule_digest and expression = rule_expression")
        .where("host = rule_host or endswith(host, concat('.', rule_host))")
        .groupBy("host", "path")
        .agg(F.max(rank).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    verdict = F.coalesce("verdict", F.lit(default)).alias("verdict")
    # URLs without a host fit no rule; they may be many, and go past the join
    judged = parts.where("host <> ''").join(best, ["host", "path"], "left")
    judged = judged.select(*kept, "host", "path", "rule", verdict)
    none = [F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")]
    return judged.union(parts.where("host = ''").select(*kept, "host", "path", *none))
