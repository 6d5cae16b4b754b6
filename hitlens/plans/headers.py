"""User agent and referer reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.operators.filters import known_clients
from hitlens.operators.measures import flag, mean, rate, summarise
from hitlens.operators.ranking import top_per_group

DIMENSIONS = ["browser", "os", "device", "bot_type", "referer_domain", "search_engine"]


def user_agents(df: DataFrame) -> DataFrame:
    """Per user agent: requests, distinct clients, success, error, mean latency, classes."""
    out = summarise(
        known_clients(df, "user_agent"),
        ["user_agent"],
        sums={
            "requests": F.lit(1),
            "successes": flag(F.col("is_success")),
            "errors": flag(F.col("is_error")),
            "ms": F.col("duration_ms"),
        },
        mins={d: F.col(d) for d in ("browser", "os", "device", "bot_type")},
        distinct={"clients": F.col("client_ip")},
    )
    return out.withColumn("avg_ms", mean(F.col("ms"), F.col("requests"))).drop("ms")


def _long(df: DataFrame, dimensions: list[str], *extra: str) -> DataFrame:
    entries = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("label")) for d in dimensions]
    )
    return (
        df.select(*extra, F.explode(entries).alias("d"))
        .select(*extra, "d.dimension", "d.label")
        .filter("label is not null")
    )


def counts(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Requests per label of several dimensions, one pass."""
    return _long(df, dimensions).groupBy("dimension", "label").agg(F.count(F.lit(1)).alias("requests"))


def referers(df: DataFrame) -> DataFrame:
    """Per referer: requests, distinct clients, success, mean latency, domain classes."""
    out = summarise(
        known_clients(df, "referer"),
        ["referer"],
        sums={"requests": F.lit(1), "successes": flag(F.col("is_success")), "ms": F.col("duration_ms")},
        mins={d: F.col(d) for d in ("referer_domain", "search_engine", "social_network")},
        distinct={"clients": F.col("client_ip")},
    )
    return out.withColumn("avg_ms", mean(F.col("ms"), F.col("requests"))).drop("ms")


def performance(df: DataFrame, dimensions: list[str] = DIMENSIONS) -> DataFrame:
    """Total, slow, error, latency and volume per label of every header dimension, one pass."""
    rows = _long(df, dimensions, "duration_ms", "is_slow", "is_error", "sent_bytes")
    out = summarise(
        rows,
        ["dimension", "label"],
        sums={
            "requests": F.lit(1),
            "slow": flag(F.col("is_slow")),
            "errors": flag(F.col("is_error")),
            "ms": F.col("duration_ms"),
            "bytes": F.col("sent_bytes"),
        },
        quantiles=[(F.col("duration_ms"), {"p50": 0.5, "p95": 0.95, "p99": 0.99})],
    )
    n = F.col("requests")
    return out.withColumns(
        {"slow_rate": rate(F.col("slow"), n), "error_rate": rate(F.col("errors"), n), "avg_ms": F.col("ms") / n}
    ).drop("ms")


def worst(report: DataFrame, *, k: int = 3, domains: int = 5) -> DataFrame:
    """Labels with the highest slow rate: k per dimension, five for referer domains."""
    ranked = top_per_group(report, ["dimension"], [F.desc("slow_rate"), F.desc("requests"), F.asc("label")], max(k, domains))
    keep = (F.col("rank") <= k) | (F.col("dimension") == "referer_domain")
    return ranked.filter(keep).select("dimension", "label", "rank", "requests", "slow_rate", "avg_ms")
