"""Service and application reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.operators.measures import describe, deviation, flag, mean, rate, summarise
from hitlens.schema import DEFAULTS, Thresholds

METRICS = ["duration_ms", "response_ms", "process_ms", "body_bytes"]
SIZES = ["body_bytes", "sent_bytes"]


def service_report(df: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Counts per status family and mean/min/max/percentiles of each metric."""
    names = metrics or METRICS
    families = {f"n_{d}xx": flag(F.substring("status", 1, 1) == str(d)) for d in (2, 3, 4, 5)}
    return describe(df, ["service"], names, sums=families, unbounded=SIZES)


def derived_metrics(df: DataFrame) -> DataFrame:
    """Speed, connection cost, processing share and stability of successful requests per service."""
    square = (F.col("duration_ms") * F.col("duration_ms")).cast("double")
    out = summarise(
        df.filter("is_success"),
        ["service"],
        sums={
            "requests": F.lit(1),
            "ms": F.col("duration_ms"),
            "ms2": square,
            "connect": F.col("connect_ms"),
            "process": F.col("process_ms"),
            "transfer": F.col("backend_transfer_ms"),
            "body": F.col("body_bytes"),
        },
    )
    c = F.col
    sd = deviation(c("ms"), c("ms2"), c("requests"))
    avg = c("ms") / c("requests")
    stability = F.when((sd > 0) & (avg > 0), F.greatest(F.lit(0.0), F.lit(100.0) - sd / avg * 100))
    return out.select(
        "service",
        "requests",
        F.when(c("transfer") > 0, c("body") / F.lit(1024.0) / (c("transfer") / F.lit(1000.0))).otherwise(F.lit(0.0)).alias("response_speed"),
        rate(c("connect"), c("ms")).alias("connect_share"),
        rate(c("process"), c("ms")).alias("process_share"),
        F.round(F.coalesce(stability, F.lit(100.0)), 6).alias("stability"),
        F.round(sd, 4).alias("deviation"),
    )


def _fence(df: DataFrame, metric: str, min_rows: int) -> Column:
    """One value for the whole table: [Q1 - 3 IQR, Q3 + 3 IQR], NULL for too few rows."""
    fences = summarise(
        df, [], sums={"n": F.lit(1)}, quantiles=[(F.col(metric), {"q1": 0.25, "q3": 0.75})]
    ).select(
        F.when(
            F.col("n") > min_rows,
            F.struct(
                (F.col("q1") - 3 * (F.col("q3") - F.col("q1"))).alias("lo"),
                (F.col("q3") + 3 * (F.col("q3") - F.col("q1"))).alias("hi"),
            ),
        )
    )
    return fences.scalar()


def _odd(df: DataFrame, metric: str, min_rows: int = 100) -> Column:
    fence = _fence(df, metric, min_rows)
    return F.coalesce((F.col(metric) < fence["lo"]) | (F.col(metric) > fence["hi"]), F.lit(False))


def outliers(df: DataFrame, metric: str = "duration_ms", *, min_rows: int = 100) -> DataFrame:
    """Rows outside [Q1 - 3 IQR, Q3 + 3 IQR] of the whole table, counted per service."""
    marked = df.select("service", _odd(df, metric, min_rows).alias("odd"))
    return marked.groupBy("service").agg(F.count_if("odd").alias("outliers"))


def health(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Service health 0-100 from success, slow and outlier shares, mean latency and its variation."""
    c = F.col
    ok = c("is_success")
    odd = _odd(df.filter("is_success"), "duration_ms")
    joined = summarise(
        df,
        ["service"],
        sums={
            "requests": F.lit(1),
            "successes": flag(ok),
            "slow": flag(ok & (c("duration_ms") > limits.slow_ms)),
            "outliers": flag(ok & odd),
            "ms": F.when(ok, c("duration_ms")),
            "ms2": F.when(ok, (c("duration_ms") * c("duration_ms")).cast("double")),
        },
    )
    avg = c("ms") / c("successes") / F.lit(1000.0)
    sd = deviation(c("ms"), c("ms2"), c("successes")) / F.lit(1000.0)
    lost_slow = F.when(
        avg > limits.slow_ms / 1000.0, F.least(F.lit(15.0), (avg - limits.slow_ms / 1000.0) * 5)
    ).otherwise(0.0)
    lost_swing = F.when((c("successes") > 1) & (avg > 0), F.least(F.lit(10.0), sd / avg * 10)).otherwise(0.0)
    score = (
        F.lit(100.0)
        - (F.lit(1.0) - c("successes") / c("requests")) * 30
        - F.coalesce(c("slow") / F.nullif(c("successes"), F.lit(0)), F.lit(0.0)) * 25
        - F.coalesce(c("outliers") / F.nullif(c("successes"), F.lit(0)), F.lit(0.0)) * 20
        - F.coalesce(lost_slow, F.lit(0.0))
        - F.coalesce(lost_swing, F.lit(0.0))
    )
    return joined.select(
        "service", "requests", "successes", "slow", "outliers",
        F.round(F.greatest(F.lit(0.0), score), 4).alias("health"),
    )


def applications(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Per application: services, rates, latency, and how alike its services' means are."""
    c = F.col
    ok = c("is_success")
    per_service = summarise(
        df.filter("is_success"), ["application", "service"], sums={"n": F.lit(1), "ms": c("duration_ms")}
    ).withColumn("m", c("ms") / c("n"))
    spread = per_service.groupBy("application").agg(
        F.count(F.lit(1)).alias("services"), F.avg("m").alias("m_avg"), F.stddev_pop("m").alias("m_sd")
    )
    even = F.when(
        (c("services") > 1) & (c("m_avg") > 0), F.greatest(F.lit(0.0), F.lit(100.0) - c("m_sd") / c("m_avg") * 100)
    ).otherwise(F.lit(100.0))
    base = summarise(
        df,
        ["application"],
        sums={
            "requests": F.lit(1),
            "successes": flag(ok),
            "errors": flag(~ok),
            "slow": flag(ok & (c("duration_ms") > limits.slow_ms)),
        },
        quantiles=[(F.when(ok, c("duration_ms")), {"p50": 0.5, "p95": 0.95, "p99": 0.99})],
    ).filter("successes > 0")
    return base.join(spread, "application").select(
        *base.columns,
        "services",
        rate(c("successes"), c("requests")).alias("success_rate"),
        rate(c("slow"), c("successes")).alias("slow_rate"),
        F.round(even, 4).alias("consistency"),
    )


def errors(df: DataFrame, by: list[str]) -> DataFrame:
    """Error count and error latency per service or application."""
    bad = F.col("is_error")
    out = summarise(
        df,
        by,
        sums={"requests": F.lit(1), "errors": flag(bad), "ms": F.when(bad, F.col("duration_ms"))},
        maxs={"max_error_ms": F.when(bad, F.col("duration_ms"))},
    )
    return out.select(*by, "requests", "errors", "max_error_ms", mean(F.col("ms"), F.col("errors")).alias("avg_error_ms"))
