"""Whole-period summary: health score, key metrics, bottleneck diagnosis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.functions.timing import lifecycle_disorder, monotone
from hitlens.operators.measures import deviation, flag, rate, summarise
from hitlens.rules import descend
from hitlens.schema import DEFAULTS, Thresholds


def key_metrics(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """One row of totals, rates, latency and phase shares."""
    c = F.col
    out = summarise(
        df,
        [],
        sums={
            "requests": F.lit(1),
            "successes": flag(c("is_success")),
            "errors": flag(c("is_error")),
            "server_errors": flag(c("status").startswith("5")),
            "slow": flag(c("duration_ms") > limits.slow_ms),
            "anomalies": flag(c("has_anomaly")),
            "ms": c("duration_ms"),
            "ms2": (c("duration_ms") * c("duration_ms")).cast("double"),
            "connect": c("connect_ms"),
            "process": c("process_ms"),
            "response": c("response_ms"),
            "transfer": c("transfer_ms"),
            "network": c("network_ms"),
            "bytes": c("sent_bytes"),
        },
        quantiles=[(c("duration_ms"), {"p50": 0.5, "p95": 0.95, "p99": 0.99})],
        distinct={"clients": c("client_ip"), "apis": c("uri")},
    )
    n = c("requests")
    return out.select(
        "requests", "clients", "apis", "bytes", "p50", "p95", "p99",
        rate(c("successes"), n).alias("success_rate"),
        rate(c("errors"), n).alias("error_rate"),
        rate(c("server_errors"), n).alias("server_error_rate"),
        rate(c("slow"), n).alias("slow_rate"),
        rate(c("anomalies"), n).alias("anomaly_rate"),
        (c("ms") / n).alias("avg_ms"),
        F.round(deviation(c("ms"), c("ms2"), n), 4).alias("std_ms"),
        rate(c("process"), c("response")).alias("backend_efficiency"),
        rate(c("network"), c("ms")).alias("network_share"),
        rate(c("transfer"), c("ms")).alias("transfer_share"),
        rate(c("connect"), c("response")).alias("connection_cost"),
    )


def trend_penalty(trends: DataFrame) -> DataFrame:
    """One value: points lost for rising latency or error rate (20 at most each) and falling throughput (15).

    ``trends`` has a row ``(metric, change, direction)`` for each metric, as the trend reports give it.
    """
    c = F.col
    size = F.abs("change")
    worse = F.when(c("metric").isin("p50", "error_rate") & (c("direction") == "rising"), F.least(F.lit(20.0), size))
    worse = worse.when((c("metric") == "qps") & (c("direction") == "falling"), F.least(F.lit(15.0), size))
    return trends.agg(F.coalesce(F.sum(worse), F.lit(0.0)).alias("penalty"))


def health(metrics: DataFrame, trends: DataFrame | None = None) -> DataFrame:
    """Weighted health score: errors .25, latency .20, efficiency .20, stability .15, anomaly .10, trend .10.

    Without ``trends`` (p50, error_rate and qps of the halves of the period) the trend counts 80 of 100.
    """
    c = F.col
    zero, full = F.lit(0.0), F.lit(100.0)
    seconds = c("avg_ms") / F.lit(1000.0)
    err = c("server_error_rate")
    error_score = F.greatest(zero, full - err * 20)
    latency_score = F.greatest(zero, full - F.greatest(zero, seconds - 0.5) * 50)
    efficiency_score = (
        F.least(full, c("backend_efficiency")) + (full - c("connection_cost")) + (full - c("transfer_share"))
    ) / 3
    sd = c("std_ms") / F.lit(1000.0)
    stability_score = F.greatest(
        zero,
        full
        - F.when(sd > 0.5, F.least(F.lit(30.0), sd * 20)).otherwise(zero)
        - F.when(err > 0.5, F.least(F.lit(40.0), err * 15)).otherwise(zero),
    )
    odd = F.when(err > 2, F.least(F.lit(50.0), err * 10)).otherwise(zero) + F.when(
        seconds > 2, F.least(F.lit(30.0), (seconds - 2) * 15)
    ).otherwise(zero)
    lost = F.lit(0.0) if trends is None else trend_penalty(trends).scalar()
    trend_score = F.greatest(zero, F.lit(80.0) - lost)
    overall = (
        error_score * 0.25
        + latency_score * 0.20
        + efficiency_score * 0.20
        + stability_score * 0.15
        + F.greatest(zero, full - odd) * 0.10
        + trend_score * 0.10
    )
    out = metrics.select(
        F.round(error_score, 4).alias("error_score"),
        F.round(latency_score, 4).alias("latency_score"),
        F.round(efficiency_score, 4).alias("efficiency_score"),
        F.round(stability_score, 4).alias("stability_score"),
        F.round(F.greatest(zero, full - odd), 4).alias("anomaly_score"),
        F.round(trend_score, 4).alias("trend_score"),
        F.round(overall, 4).alias("overall"),
    )
    grade = descend(c("overall"), [(90, "优秀"), (80, "良好"), (70, "一般"), (60, "需要关注")], "需要紧急处理", strict=False)
    return out.withColumn("grade", grade)


def diagnosis(metrics: DataFrame) -> DataFrame:
    """Bottleneck codes that apply: backend, network, transfer, connection, errors."""
    c = F.col
    tests = [
        (c("backend_efficiency") < 60, "backend"),
        (c("network_share") > 30, "network"),
        (c("transfer_share") > 60, "transfer"),
        (c("connection_cost") > 20, "connection"),
        (c("error_rate") > 5, "errors"),
        (c("slow_rate") > 10, "slow"),
    ]
    found = F.array_compact(F.array(*[F.when(t, F.lit(name)) for t, name in tests]))
    return metrics.select(F.array_join(found, ",").alias("bottlenecks"), F.size(found).alias("found"))


def lifecycle_check(df: DataFrame, *, tolerated: float = 0.1) -> DataFrame:
    """Share of rows whose times are out of order; the table fails above ten percent."""
    bad = lifecycle_disorder(F.col("connect_ms"), F.col("header_ms"), F.col("response_ms"), F.col("duration_ms"))
    out = df.agg(F.count(F.lit(1)).alias("requests"), F.count_if(bad).alias("disordered"))
    return out.withColumn("passed", F.col("disordered") <= F.col("requests") * F.lit(tolerated))


def lifecycle_clean(df: DataFrame, *, max_ms: int = 600_000) -> DataFrame:
    """Drop negative and over-long rows, then lift the times so that they never decrease."""
    names = ["connect_ms", "header_ms", "response_ms", "duration_ms"]
    sane = df
    for n in names:
        sane = sane.filter(F.col(n) >= 0)
    sane = sane.filter(F.col("duration_ms") <= max_ms)
    h, r, t = monotone(*[F.col(n) for n in names])
    return sane.withColumns({"header_ms": h, "response_ms": r, "duration_ms": t})
