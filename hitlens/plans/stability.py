"""Stability of services over hours and minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.functions import timing
from hitlens.operators.measures import flag, summarise
from hitlens.rules import descend, lookup
from hitlens.schema import DEFAULTS, Thresholds

LEVELS = [(80, "严重异常"), (60, "中度异常"), (40, "轻微异常")]
# --- fixed values: anomaly score of each report state
STATE_SCORE = {
    "成功率低": 80,
    "波动较大": 60,
    "存在异常时段": 40,
    "响应时间长": 70,
    "存在极值": 85,
    "响应不稳定": 55,
    "处理效率低": 75,
    "连接延迟高": 65,
    "处理时间长": 70,
    "传输速度慢": 60,
    "前端传输瓶颈": 70,
    "传输不稳定": 55,
    "网络开销高": 65,
    "传输时间占比高": 50,
    "网络开销不稳定": 55,
}
NORMAL = "正常"


def success_rate(df: DataFrame) -> DataFrame:
    """Overall success rate per service, deviation/min/max of its hourly rates, state."""
    c = F.col
    hourly = summarise(
        df, ["service", "stat_hour"], sums={"n": F.lit(1), "ok": flag(c("is_success"))}
    ).withColumn("r", c("ok") / c("n") * 100)
    out = hourly.groupBy("service").agg(
        F.sum("n").alias("requests"),
        F.count(F.lit(1)).alias("hours"),
        (F.sum("ok") * 100.0 / F.sum("n")).alias("success_rate"),
        F.round(F.stddev_pop("r"), 6).alias("deviation"),
        F.round(F.min("r"), 6).alias("min_rate"),
        F.round(F.max("r"), 6).alias("max_rate"),
    )
    state = (
        F.when(c("success_rate") < 99.0, F.lit("成功率低"))
        .when(c("deviation") > 5.0, F.lit("波动较大"))
        .when(c("min_rate") < 95.0, F.lit("存在异常时段"))
        .otherwise(F.lit(NORMAL))
    )
    return out.withColumn("state", state)


def response_time(df: DataFrame) -> DataFrame:
    """Median, interquartile range, extremes, p95, p99 per service, state."""
    c = F.col
    out = summarise(
        df,
        ["service"],
        sums={"requests": F.lit(1)},
        mins={"min_ms": c("duration_ms")},
        maxs={"max_ms": c("duration_ms")},
        quantiles=[(c("duration_ms"), {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99})],
    ).withColumn("iqr", F.round(c("p75") - c("p25"), 6))
    state = (
        F.when(c("p50") > 500, F.lit("响应时间长"))
        .when(c("p99") > c("p50") * 5, F.lit("存在极值"))
        .when(c("iqr") > c("p50"), F.lit("响应不稳定"))
        .otherwise(F.lit(NORMAL))
    )
    return out.withColumn("state", state).drop("p25", "p75")


def resource_use(df: DataFrame) -> DataFrame:
    """Sizes and transfer efficiency per service and method."""
    out = summarise(
        df,
        ["service", "request_method"],
        sums={"requests": F.lit(1), "body": F.col("body_bytes"), "sent": F.col("sent_bytes")},
    )
    c = F.col
    return out.select(
        "service", "request_method", "requests",
        (c("body") / c("requests") / 1024.0).alias("avg_body_kb"),
        (c("sent") / c("requests") / 1024.0).alias("avg_sent_kb"),
        (c("sent") / F.lit(1048576.0)).alias("sent_mb"),
        F.when(c("sent") > 0, c("body") * 100.0 / c("sent")).otherwise(F.lit(0.0)).alias("efficiency"),
    )


def request_frequency(df: DataFrame) -> DataFrame:
    """Per-minute request counts per service: mean, deviation, p95, p99."""
    minutes = df.groupBy("service", F.date_trunc("minute", "log_time").alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    out = summarise(
        minutes,
        ["service"],
        sums={"minutes": F.lit(1), "requests": F.col("n"), "sq": (F.col("n") * F.col("n"))},
        quantiles=[(F.col("n"), {"p95": 0.95, "p99": 0.99})],
    )
    c = F.col
    var = F.greatest(F.lit(0.0), c("sq") / c("minutes") - (c("requests") / c("minutes")) * (c("requests") / c("minutes")))
    return out.select(
        "service", "minutes", "requests", "p95", "p99",
        (c("requests") / c("minutes")).alias("avg_per_minute"),
        F.round(F.sqrt(var), 6).alias("deviation"),
    )


def connection_cost(df: DataFrame) -> DataFrame:
    """Mean connection cost percentage and request count per minute."""
    cost = timing.percent(F.col("connect_ms"), F.col("response_ms"))
    out = df.groupBy(F.date_trunc("minute", "log_time").alias("minute")).agg(
        F.count(F.lit(1)).alias("requests"), F.round(F.avg(cost), 6).alias("avg_cost")
    )
    return out


def connection_summary(per_minute: DataFrame) -> DataFrame:
    """Mean, maximum and sample deviation over the minutes."""
    return per_minute.agg(
        F.count(F.lit(1)).alias("minutes"),
        F.round(F.avg("requests"), 6).alias("avg_requests"),
        F.max("requests").alias("max_requests"),
        F.round(F.stddev_samp("requests"), 6).alias("std_requests"),
        F.round(F.avg("avg_cost"), 4).alias("avg_cost"),
        F.round(F.max("avg_cost"), 4).alias("max_cost"),
    )


def backend(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Per hour and service: median and p95 of efficiency, connect and process time, state."""
    c = F.col
    eff = F.round(timing.percent(c("process_ms"), c("response_ms")), 2)
    out = summarise(
        df,
        ["stat_hour", "service"],
        sums={"requests": F.lit(1)},
        quantiles=[
            (eff, {"efficiency_p50": 0.5, "efficiency_p95": 0.95}),
            (c("connect_ms"), {"connect_p50": 0.5, "connect_p95": 0.95}),
            (c("process_ms"), {"process_p50": 0.5, "process_p95": 0.95}),
        ],
    )
    state = (
        F.when(c("efficiency_p50") < 60.0, F.lit("处理效率低"))
        .when(c("connect_p95") > 100, F.lit("连接延迟高"))
        .when(c("process_p95") > 1000, F.lit("处理时间长"))
        .otherwise(F.lit(NORMAL))
    )
    return out.withColumn("state", state)


def transfer(df: DataFrame) -> DataFrame:
    """Per hour and service: median and slowest-5-percent speeds (KB/s), state."""
    c = F.col
    m = timing.lifecycle(*[c(n) for n in ("duration_ms", "connect_ms", "header_ms", "response_ms", "body_bytes", "sent_bytes")], rounded=False)
    keys = ["stat_hour", "service"]
    speeds = df.select(*keys, *[m[n].alias(n) for n in ("response_speed", "total_speed", "front_speed")])
    points = [
        (c("response_speed"), {"response_p50": 0.5, "response_p5": 0.05}),
        (c("total_speed"), {"total_p50": 0.5, "total_p5": 0.05}),
        (c("front_speed"), {"front_p50": 0.5}),
    ]
    out = summarise(speeds, keys, sums={"requests": F.lit(1)}, unbounded=points)
    state = (
        F.when(c("total_p50") < 1000, F.lit("传输速度慢"))
        .when(c("front_p50") < c("response_p50") * 0.8, F.lit("前端传输瓶颈"))
        .when(c("response_p5") < c("total_p50") * 0.3, F.lit("传输不稳定"))
        .otherwise(F.lit(NORMAL))
    )
    return out.withColumn("state", state)


def lifecycle(df: DataFrame) -> DataFrame:
    """Per hour and service: median and p95 of network overhead and transfer share, state."""
    c = F.col
    overhead = F.round(timing.percent(c("network_ms"), c("duration_ms")), 2)
    ratio = F.round(timing.percent(c("transfer_ms"), c("duration_ms")), 2)
    out = summarise(
        df,
        ["stat_hour", "service"],
        sums={"requests": F.lit(1)},
        quantiles=[
            (overhead, {"overhead_p50": 0.5, "overhead_p95": 0.95}),
            (ratio, {"transfer_p50": 0.5, "transfer_p95": 0.95}),
            (c("front_ms"), {"front_p50": 0.5}),
        ],
    )
    state = (
        F.when(c("overhead_p50") > 30.0, F.lit("网络开销高"))
        .when(c("transfer_p50") > 60.0, F.lit("传输时间占比高"))
        .when(c("overhead_p95") > c("overhead_p50") * 3, F.lit("网络开销不稳定"))
        .otherwise(F.lit(NORMAL))
    )
    return out.withColumn("state", state)


def state_anomaly(report: DataFrame) -> DataFrame:
    """Anomaly score and level from a report's state column."""
    out = report.withColumn("anomaly_score", lookup(F.col("state"), STATE_SCORE, 0))
    return out.withColumn("anomaly_level", descend(F.col("anomaly_score"), LEVELS, NORMAL, strict=False))
