"""Table-level data quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.functions.quality import issues

c = F.col


def layer_ratio(raw: DataFrame, enriched: DataFrame, *, minimum: float = 95.0) -> DataFrame:
    """Row counts of two layers, their ratio, and whether it is degraded."""
    n = F.count(F.lit(1))
    both = raw.agg(n.alias("raw_rows"), F.lit(0).cast("long").alias("enriched_rows")).unionByName(
        enriched.agg(F.lit(0).cast("long").alias("raw_rows"), n.alias("enriched_rows"))
    )
    out = both.agg(F.sum("raw_rows").alias("raw_rows"), F.sum("enriched_rows").alias("enriched_rows"))
    out = out.withColumn("ratio", F.when(c("raw_rows") > 0, c("enriched_rows") * 100.0 / c("raw_rows")).otherwise(F.lit(0.0)))
    return out.withColumn("state", F.when(c("ratio") < minimum, F.lit("degraded")).otherwise(F.lit("healthy")))


def time_span(df: DataFrame, ts: str = "log_time") -> DataFrame:
    """Earliest and latest date and the days between."""
    out = df.agg(F.to_date(F.min(ts)).alias("first_day"), F.to_date(F.max(ts)).alias("last_day"))
    return out.withColumn("days", F.datediff("last_day", "first_day"))


def issue_counts(df: DataFrame, required: dict[str, Column]) -> DataFrame:
    """Rows per problem code (a row may have several)."""
    found = F.explode(issues(required, c("duration_ms"), c("body_bytes")))
    return df.select(found.alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("rows"))


def metric_rows(df: DataFrame, checks: dict[str, tuple[Column, float, bool]]) -> DataFrame:
    """(metric, value, threshold, passed) per check, from one aggregate row.

    ``checks``: name -> (aggregate column, threshold, True when the value must not fall below it).
    """
    one = df.agg(*[value.cast("double").alias(name) for name, (value, _, _) in checks.items()])
    entries = [
        F.struct(
            F.lit(name).alias("metric"),
            c(name).alias("value"),
            F.lit(float(limit)).alias("threshold"),
            (c(name) >= limit if floor else c(name) <= limit).alias("passed"),
        )
        for name, (_, limit, floor) in checks.items()
    ]
    return one.select(F.explode(F.array(*entries)).alias("m")).select("m.*")
