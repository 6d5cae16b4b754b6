"""Slow requests: diagnosis, summaries, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.functions.timing import lifecycle
from hitlens.operators.measures import describe, flag, rate, summarise
from hitlens.operators.ranking import label_order, top, with_totals
from hitlens.rules import descend, lookup
from hitlens.schema import DEFAULTS, Thresholds

SEVERITIES = ["极严重", "严重", "中度", "轻度"]
# --- fixed values: diagnosis weights
SEVERITY_WEIGHT = {"极严重": 4.0, "严重": 3.0, "中度": 2.0, "轻度": 1.0}
CAUSE_WEIGHT = {"处理慢": 3.0, "连接慢": 2.5, "传输慢": 2.0, "混合型": 3.5, "其他": 1.0}


def diagnose(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Slow requests with cause, severity against the p95 of all requests, day period and SLA breach."""
    c = F.col
    baseline = summarise(df, [], quantiles=[(c("duration_ms"), {"p95": 0.95})]).scalar()
    late_connect, late_process, late_transfer = (
        c("connect_ms") > 1000,
        c("process_ms") > 3000,
        c("backend_transfer_ms") > 2000,
    )
    found = flag(late_connect) + flag(late_process) + flag(late_transfer)
    cause = (
        F.when(found > 1, F.lit("混合型"))
        .when(late_connect, F.lit("连接慢"))
        .when(late_process, F.lit("处理慢"))
        .when(late_transfer, F.lit("传输慢"))
        .otherwise(F.lit("其他"))
    )
    hour = c("hour")
    period = (
        F.when(hour.between(8, 12) | hour.between(14, 18), F.lit("高峰期"))
        .when(hour.between(0, 6) | hour.between(22, 23), F.lit("低峰期"))
        .otherwise(F.lit("平峰期"))
    )
    rows = df.filter(c("duration_ms") > limits.slow_ms).withColumn("_base", baseline)
    ratio = F.when(c("_base") > 0, c("duration_ms") / c("_base")).otherwise(F.lit(1.0))
    severity = F.when(c("_base") > 0, descend(ratio, [(5.0, "极严重"), (3.0, "严重"), (2.0, "中度")], "轻度", strict=False)).otherwise(F.lit("轻度"))
    out = rows.withColumns({"cause": cause, "ratio_to_p95": ratio, "severity": severity, "period": period})
    impact = (
        F.when((c("severity") == "极严重") | (c("duration_ms") > 10000), F.lit("高"))
        .when((c("severity") == "严重") | (c("duration_ms") > 5000), F.lit("中"))
        .otherwise(F.lit("低"))
    )
    breach = descend(c("duration_ms"), [(9000, "严重违规"), (6000, "中等违规"), (3000, "轻微违规")], "未违规")
    weight = lookup(c("severity"), SEVERITY_WEIGHT, 1.0) * lookup(c("cause"), CAUSE_WEIGHT, 1.0)
    return out.withColumns({"impact": impact, "sla_breach": breach, "weight": weight}).drop("_base")


def slow_list(df: DataFrame, n: int, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Worst slow requests first: by severity, then duration."""
    return top(
        diagnose(df, limits), [label_order(F.col("severity"), SEVERITIES), F.desc("duration_ms"), F.asc("event_id")], n
    )


def with_frequency(diagnosed: DataFrame, all_requests: DataFrame) -> DataFrame:
    """Frequency class of the API over all requests.

    Counts come from an aggregate; the join repeats nothing of the raw rows and AQE splits a hot API.
    """
    counts = all_requests.groupBy("uri").agg(F.count(F.lit(1)).alias("api_requests"))
    level = descend(F.col("api_requests"), [(1000, "高频"), (100, "中频")], "低频")
    return diagnosed.join(counts, "uri").withColumn("frequency", level)


def api_summary(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Slow count, slow share inside the API and of all slow requests, statistics over slow ones."""
    c = F.col
    slow = c("duration_ms") > limits.slow_ms
    out = summarise(
        df,
        ["uri"],
        sums={"requests": F.lit(1), "slow": flag(slow), "ms": F.when(slow, c("duration_ms"))},
        mins={"min_ms": F.when(slow, c("duration_ms"))},
        maxs={"max_ms": F.when(slow, c("duration_ms"))},
        quantiles=[
            (F.when(slow, c("duration_ms")), {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}),
            (F.when(slow, c("process_ms")), {"process_p50": 0.5, "process_p95": 0.95}),
        ],
    ).filter("slow > 0")
    return with_totals(out, [], {"all_slow": "slow"}).withColumns(
        {
            "avg_ms": c("ms") / c("slow"),
            "share_in_api": rate(c("slow"), c("requests")),
            "share_of_slow": rate(c("slow"), c("all_slow")),
        }
    ).drop("ms", "all_slow")


STATISTICS = ["duration_ms", "response_ms", "header_ms", "connect_ms", "process_ms", "backend_transfer_ms", "front_ms", "network_ms", "transfer_ms"]
WIDE_STATISTICS = ["body_bytes", "sent_bytes", "backend_efficiency", "network_overhead", "transfer_ratio", "connection_cost"]


def api_statistics(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Slow count and shares per API, and mean, median, min, max, p90, p95, p99 of every time, size and ratio over its slow requests."""
    c = F.col
    slow = c("duration_ms") > limits.slow_ms
    m = lifecycle(*[c(n) for n in ("duration_ms", "connect_ms", "header_ms", "response_ms", "body_bytes", "sent_bytes")], rounded=False)
    measured = {n: m.get(n, c(n)) for n in (*STATISTICS, *WIDE_STATISTICS)}
    rows = df.select("uri", slow.alias("is_slow"), *[F.when(slow, v).alias(n) for n, v in measured.items()])
    out = describe(rows, ["uri"], list(measured), {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}, sums={"slow": flag(c("is_slow"))}, unbounded=WIDE_STATISTICS)
    out = with_totals(out.filter("slow > 0"), [], {"all_slow": "slow"})
    shares = {"share_in_api": rate(c("slow"), c("requests")), "share_of_slow": rate(c("slow"), c("all_slow"))}
    return out.withColumns(shares).drop("all_slow")


def distribution(diagnosed: DataFrame) -> DataFrame:
    """Counts and mean duration by cause, severity and period in long form, one pass."""
    dims = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("label")) for d in ("cause", "severity", "period")]
    )
    rows = diagnosed.select("duration_ms", F.explode(dims).alias("d")).select("d.dimension", "d.label", "duration_ms")
    out = summarise(rows, ["dimension", "label"], sums={"requests": F.lit(1), "ms": F.col("duration_ms")})
    return out.select("dimension", "label", "requests", (F.col("ms") / F.col("requests")).alias("avg_ms"))


def insights(diagnosed: DataFrame) -> DataFrame:
    """One row: main cause with share, share of severe requests, share of SLA breaches."""
    n = F.count(F.lit(1))
    severe = F.count_if(F.col("severity").isin("极严重", "严重"))
    causes = diagnosed.groupBy("cause").agg(
        n.alias("n"), severe.alias("severe"), F.count_if(F.col("sla_breach") != "未违规").alias("breached")
    )
    return causes.agg(
        F.min_by("cause", F.struct(-F.col("n"), F.col("cause"))).alias("main_cause"),
        (F.max("n") * 100.0 / F.sum("n")).alias("main_share"),
        (F.sum("severe") * 100.0 / F.sum("n")).alias("severe_share"),
        (F.sum("breached") * 100.0 / F.sum("n")).alias("breach_share"),
    )


def phase_summary(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Per latency phase over slow requests: mean, share of the whole duration, percentiles."""
    slow = df.filter(F.col("duration_ms") > limits.slow_ms)
    phases = ["connect_ms", "process_ms", "backend_transfer_ms", "front_ms"]
    rows = slow.select(
        "duration_ms",
        F.explode(F.array(*[F.struct(F.lit(p).alias("phase"), F.col(p).alias("ms")) for p in phases])).alias("p"),
    ).select("duration_ms", "p.phase", "p.ms")
    out = summarise(
        rows,
        ["phase"],
        sums={"n": F.lit(1), "total": F.col("ms"), "whole": F.col("duration_ms")},
        quantiles=[(F.col("ms"), {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99})],
    )
    return out.select(
        "phase",
        (F.col("total") / F.col("n")).alias("avg_ms"),
        rate(F.col("total"), F.col("whole")).alias("share"),
        "p50", "p90", "p95", "p99",
    )


def efficiency_summary(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Mean, percentiles and extremes of the efficiency ratios of slow requests, per service."""
    slow = df.filter(F.col("duration_ms") > limits.slow_ms)
    ratio = {
        "overhead": F.col("network_ms") * 100.0 / F.col("duration_ms"),
        "transfer": F.col("transfer_ms") * 100.0 / F.col("duration_ms"),
    }
    rows = slow.select("service", *[F.round(v, 4).alias(k) for k, v in ratio.items()])
    out = describe(rows, ["service"], list(ratio), {"p50": 0.5, "p90": 0.9, "p95": 0.95})
    return out.withColumns({f"avg_{k}": F.round(f"avg_{k}", 9) for k in ratio})


def period_by_severity(diagnosed: DataFrame) -> DataFrame:
    """Cross table: one row per period, one column per severity (fixed list, one pass)."""
    return diagnosed.groupBy("period").agg(
        *[F.count_if(F.col("severity") == s).alias(f"severity_{i}") for i, s in enumerate(SEVERITIES)]
    )
