"""Status code reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.operators.measures import flag, rate, summarise
from hitlens.operators.ranking import share_of_total, top_per_group


def distribution(df: DataFrame) -> DataFrame:
    """Per status: count, share, latency statistics and mean phases."""
    c = F.col
    phases = ["connect_ms", "process_ms", "backend_transfer_ms", "front_ms"]
    out = summarise(
        df,
        ["status"],
        sums={
            "requests": F.lit(1),
            "ms": c("duration_ms"),
            "slow": flag(c("is_slow")),
            **{f"s_{p}": c(p) for p in phases},
        },
        mins={"min_ms": c("duration_ms")},
        maxs={"max_ms": c("duration_ms")},
        quantiles=[(c("duration_ms"), {"p50": 0.5, "p95": 0.95, "p99": 0.99})],
    )
    out = share_of_total(out, "requests", source=df)
    out = out.withColumns({"avg_ms": c("ms") / c("requests"), **{f"avg_{p}": c(f"s_{p}") / c("requests") for p in phases}})
    return out.drop("ms", *[f"s_{p}" for p in phases])


def by_dimension(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Status counts for several dimensions at once, long form: (dimension, label, status, requests)."""
    entries = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("label")) for d in dimensions]
    )
    rows = df.select("status", F.explode(entries).alias("d"))
    return rows.groupBy("d.dimension", "d.label", "status").agg(F.count(F.lit(1)).alias("requests"))


def wide_by(df: DataFrame, dimension: str, statuses: list[str]) -> DataFrame:
    """One column per listed status, one pass."""
    return df.groupBy(dimension).agg(
        F.count(F.lit(1)).alias("requests"), *[F.count_if(F.col("status") == s).alias(f"status_{s}") for s in statuses]
    )


def families(df: DataFrame) -> DataFrame:
    """2xx to 5xx summary."""
    family = F.concat(F.substring("status", 1, 1), F.lit("xx"))
    out = summarise(
        df.withColumn("family", family), ["family"], sums={"requests": F.lit(1), "ms": F.col("duration_ms")}
    )
    out = share_of_total(out, "requests", source=df)
    return out.select("family", "requests", "share", (F.col("ms") / F.col("requests")).alias("avg_ms"))


def error_details(df: DataFrame, k: int = 10) -> DataFrame:
    """Top clients and top paths of every error status."""
    entries = F.array(
        F.struct(F.lit("client_ip").alias("kind"), F.col("client_ip").alias("item")),
        F.struct(F.lit("uri").alias("kind"), F.col("uri").alias("item")),
    )
    rows = df.filter("is_error").select("status", F.explode(entries).alias("e"))
    counts = rows.groupBy("status", "e.kind", "e.item").agg(F.count(F.lit(1)).alias("requests"))
    return top_per_group(counts, ["status", "kind"], [F.desc("requests"), F.asc("item")], k)


def slow_apis(df: DataFrame, k: int = 20) -> DataFrame:
    """APIs with the most slow requests: count, share, mean."""
    c = F.col
    out = summarise(
        df, ["uri"], sums={"requests": F.lit(1), "slow": flag(c("is_slow")), "ms": c("duration_ms")}
    ).filter("slow > 0")
    out = out.select("uri", "requests", "slow", rate(c("slow"), c("requests")).alias("slow_rate"), (c("ms") / c("requests")).alias("avg_ms"))
    return out.orderBy(F.desc("slow"), F.asc("uri")).limit(k)


def spikes(df: DataFrame, grain: str = "hour", *, server: int = 100, client: int = 500, mean_ms: int = 10000) -> DataFrame:
    """Time buckets where a 5xx code, a 4xx code or the mean latency passes its limit."""
    bucketed = df.withColumn("bucket", F.date_trunc(grain, "log_time"))
    counts = bucketed.groupBy("bucket", "status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration_ms").alias("ms")
    )
    codes = (
        F.when(F.col("status").startswith("5") & (F.col("n") > server), F.lit("server_error_spike"))
        .when(F.col("status").startswith("4") & (F.col("n") > client), F.lit("client_error_spike"))
    )
    by_code = counts.withColumn("kind", codes).filter("kind is not null").select(
        "bucket", "kind", "status", F.col("n").cast("double").alias("value")
    )
    means = counts.groupBy("bucket").agg((F.sum("ms") / F.sum("n")).alias("value")).filter(F.col("value") > mean_ms)
    return by_code.unionByName(
        means.select("bucket", F.lit("slow_bucket").alias("kind"), F.lit("*").alias("status"), "value")
    )


def estimated_lifecycle(distributed: DataFrame) -> DataFrame:
    """Phase split by status family from the mean alone, with a performance class."""
    c = F.col
    t = c("avg_ms") / F.lit(1000.0)
    family = F.substring("status", 1, 1)

    def split(server: float, client: float, rest: float):
        return F.when(family == "5", t * server).when(family == "4", t * client).otherwise(t * rest)

    cap = F.when(family == "4", F.lit(0.05)).when(family.isin("2", "5"), F.lit(0.1)).otherwise(F.lit(1e9))
    connect = F.least(cap, t * 0.1)
    level = (
        F.when((c("p95") > 10000) | (c("slow") > 1000), F.lit("Critical"))
        .when((c("p95") > 5000) | (c("slow") > 500), F.lit("Poor"))
        .when((c("p95") > 2000) | (c("slow") > 100), F.lit("Fair"))
        .otherwise(F.lit("Good"))
    )
    return distributed.select(
        "status",
        F.round(connect, 6).alias("connect_s"),
        F.round(split(0.7, 0.6, 0.5), 6).alias("process_s"),
        F.round(split(0.15, 0.25, 0.3), 6).alias("transfer_s"),
        F.round(split(0.05, 0.05, 0.1), 6).alias("front_s"),
        level.alias("level"),
    )

