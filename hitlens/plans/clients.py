"""Client address reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.operators.measures import flag, mean, rate, summarise
from hitlens.operators.ranking import share_of_total
from hitlens.rules import descend, present
from hitlens.schema import DEFAULTS, Thresholds


def ip_report(df: DataFrame, limits: Thresholds = DEFAULTS, *, exact: bool = True) -> DataFrame:
    """Counts, rates, latency, volume, distinct APIs, commonest status and busiest hour per client."""
    c = F.col
    known = df.filter(present(c("client_ip")).isNotNull())
    out = summarise(
        known,
        ["client_ip"],
        sums={
            "requests": F.lit(1),
            "successes": flag(c("status").rlike("^[23]")),
            "errors": flag(c("is_error")),
            "slow": flag(c("duration_ms") > limits.slow_ms),
            "client_errors": flag(c("status").startswith("4")),
            "night": flag(c("hour") < 6),
            "ms": c("duration_ms"),
            "bytes": c("sent_bytes"),
        },
        mins={"ip_kind": c("ip_kind")},
        quantiles=[(c("duration_ms"), {"p50": 0.5, "p95": 0.95, "p99": 0.99})],
        distinct={"apis": c("uri")},
        modes={"top_status": c("status"), "peak_hour": F.lpad(c("hour").cast("string"), 2, "0")},
        exact=exact,
    )
    n = c("requests")
    return out.withColumns(
        {
            "success_rate": rate(c("successes"), n),
            "error_rate": rate(c("errors"), n),
            "slow_rate": rate(c("slow"), n),
            "client_error_rate": rate(c("client_errors"), n),
            "night_rate": rate(c("night"), n),
            "avg_ms": mean(c("ms"), n),
        }
    ).drop("ms")


def _risk_terms() -> list[tuple[Column, int, str]]:
    c = F.col
    n, apis, err, slow = c("requests"), c("apis"), c("error_rate"), c("slow_rate")

    def band(value: Column, low: float, high: float | None) -> Column:
        return (value > low) & (value <= high) if high is not None else value > low

    return [
        (band(n, 50000, None), 40, "超高请求量"),
        (band(n, 10000, 50000), 30, "高请求量"),
        (band(n, 1000, 10000), 15, "中等请求量"),
        (band(n, 100, 1000), 5, ""),
        (band(err, 50, None), 25, "极高错误率"),
        (band(err, 20, 50), 15, "高错误率"),
        (band(err, 10, 20), 10, "中等错误率"),
        (band(slow, 30, None), 20, "极高慢请求率"),
        (band(slow, 10, 30), 10, "高慢请求率"),
        (band(apis, 100, None), 20, "API扫描行为"),
        (band(apis, 50, 100), 15, "高API多样性"),
        (band(apis, 20, 50), 10, "中等API多样性"),
        (band(c("client_error_rate"), 30, None), 15, "高4xx错误率"),
        (band(c("client_error_rate"), 10, 30), 10, "中等4xx错误率"),
        (c("night_rate") > 50, 15, "深夜异常活跃"),
    ]


def risk(report: DataFrame) -> DataFrame:
    """Risk score 0-100 with its named factors."""
    terms = _risk_terms()
    score = sum((F.when(test, points).otherwise(0) for test, points, _ in terms), F.lit(0))
    factors = F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, _, name in terms if name]))
    return report.withColumns(
        {"risk_score": F.least(score, F.lit(100)), "risk_factors": F.array_join(factors, "; ")}
    )


def anomaly(report: DataFrame) -> DataFrame:
    """Anomaly score with level, and behaviour pattern."""
    c = F.col
    score = (
        F.when(c("requests") > 20000, 30).otherwise(0)
        + F.when(c("success_rate") < 50, 40).otherwise(0)
        + F.when(c("p99") > 10000, 30).otherwise(0)
        + F.when(c("error_rate") > 20, 25).otherwise(0)
    )
    deep = (c("apis") > 50) & (c("requests") > 1000)
    pattern = (
        F.when(deep & (c("error_rate") > 30), F.lit("疑似恶意扫描"))
        .when(deep, F.lit("深度访问用户"))
        .when((c("requests") > 5000) & (c("apis") < 5), F.lit("高频单一访问"))
        .when(c("error_rate") > 50, F.lit("异常访问"))
        .when(c("requests") < 10, F.lit("轻度访问"))
        .otherwise(F.lit("正常访问"))
    )
    out = report.withColumns({"anomaly_score": score, "pattern": pattern})
    levels = [(80, "严重异常"), (60, "中度异常"), (40, "轻微异常")]
    return out.withColumn("anomaly_level", descend(c("anomaly_score"), levels, "正常", strict=False))


def simple_risk(report: DataFrame) -> DataFrame:
    """The older score: volume, errors, slowness, API variety, 4xx share."""
    c = F.col
    n, err, slow, apis = c("requests"), c("error_rate"), c("slow_rate"), c("apis")
    score = (
        descend(n, [(10000, 30), (1000, 15), (100, 5)], 0)
        + descend(err, [(50, 25), (20, 15), (10, 10)], 0)
        + descend(slow, [(30, 20), (10, 10)], 0)
        + descend(apis, [(50, 15), (20, 10)], 0)
        + descend(c("client_error_rate"), [(30, 10)], 0)
    )
    return report.withColumn("simple_risk", F.least(score, F.lit(100)))


def kind_distribution(report: DataFrame) -> DataFrame:
    """Clients and requests per address kind."""
    out = report.groupBy("ip_kind").agg(
        F.count(F.lit(1)).alias("clients"), F.sum("requests").alias("requests"), F.sum("errors").alias("errors")
    )
    return share_of_total(out, "requests").withColumn("error_rate", rate(F.col("errors"), F.col("requests")))


def pattern_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("pattern").agg(F.count(F.lit(1)).alias("clients"), F.sum("requests").alias("requests"))


def hour_distribution(df: DataFrame) -> DataFrame:
    """Requests and distinct clients per hour of day."""
    return summarise(df, ["hour"], sums={"requests": F.lit(1)}, distinct={"clients": F.col("client_ip")})
