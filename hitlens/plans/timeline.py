"""Time-bucket report and the trend, anomaly and efficiency scores over its buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.functions import clock, timing
from hitlens.operators import occupancy
from hitlens.operators.measures import flag, mean, rate, summarise
from hitlens.operators.ordered import framed, lagged, numbered, spans
from hitlens.rules import descend
from hitlens.schema import DEFAULTS, Thresholds

SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
ANOMALY_LEVELS = [(80, "严重异常"), (60, "中度异常"), (40, "轻微异常")]


def buckets(
    df: DataFrame,
    grain: str,
    limits: Thresholds = DEFAULTS,
    *,
    ts: Column | None = None,
    metrics: tuple[str, ...] = ("response_ms", "process_ms"),
    exact: bool = True,
) -> DataFrame:
    """Totals, rates, QPS (successes per second), distinct clients and percentiles per bucket."""
    c = F.col
    when = c("log_time") if ts is None else ts
    out = summarise(
        df,
        {"bucket": F.date_trunc(grain, when)},
        sums={
            "requests": F.lit(1),
            "successes": flag(c("is_success")),
            "slow": flag(c("duration_ms") > limits.slow_ms),
            "client_errors": flag(c("status").startswith("4")),
            "server_errors": flag(c("status").startswith("5")),
        },
        quantiles=[
            (c("duration_ms"), {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}),
            *[(c(m), {f"{m}_p50": 0.5, f"{m}_p95": 0.95}) for m in metrics],
        ],
        distinct={"clients": c("client_ip")},
        exact=exact,
    )
    n = c("requests")
    return out.withColumns(
        {
            "success_rate": rate(c("successes"), n),
            "slow_rate": rate(c("slow"), n),
            "error_rate": rate(c("client_errors") + c("server_errors"), n),
            "qps": c("successes") / F.lit(float(SECONDS[grain])),
        }
    )


TIMES = ["duration_ms", "response_ms", "header_ms", "connect_ms", "process_ms", "backend_transfer_ms", "front_ms", "network_ms", "transfer_ms"]
# the same times under their names as phases
PHASES = {"connect_phase": "connect_ms", "backend_total": "response_ms", "processing": "process_ms"}
RATIOS = ["backend_efficiency", "network_overhead", "transfer_ratio", "connection_cost"]
SIZES = ["body_kb", "sent_kb"]
SPEEDS = ["response_speed", "total_speed", "front_speed"]
TAILS = ("duration_ms", "response_ms", "header_ms")


def full_report(df: DataFrame, grain: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Everything about a bucket: totals, error rates per class, medians of all times, phases, ratios, sizes and speeds,
    p95 and p99 of the three leading times, and the requests in flight (new, concurrent, active)."""
    c = F.col
    m = timing.lifecycle(*[c(n) for n in ("duration_ms", "connect_ms", "header_ms", "response_ms", "body_bytes", "sent_bytes")], rounded=False)
    wide = [*RATIOS, *SIZES, *SPEEDS]
    rows = df.select("log_time", "status", "is_success", "client_ip", *TIMES, *[m[n].alias(n) for n in wide])
    out = summarise(
        rows,
        {"bucket": F.date_trunc(grain, "log_time")},
        sums={
            "requests": F.lit(1),
            "successes": flag(c("is_success")),
            "slow": flag(c("duration_ms") > limits.slow_ms),
            "client_errors": flag(c("status").startswith("4")),
            "server_errors": flag(c("status").startswith("5")),
        },
        quantiles=[(c(t), {f"{t}_p50": 0.5} | ({f"{t}_p95": 0.95, f"{t}_p99": 0.99} if t in TAILS else {})) for t in TIMES],
        unbounded=[(c(n), {f"{n}_p50": 0.5}) for n in wide],
        distinct={"clients": c("client_ip")},
    )
    n = c("requests")
    out = out.withColumns(
        {
            **{f"{name}_p50": c(f"{of}_p50") for name, of in PHASES.items()},
            "success_rate": rate(c("successes"), n),
            "slow_rate": rate(c("slow"), n),
            "client_error_rate": rate(c("client_errors"), n),
            "server_error_rate": rate(c("server_errors"), n),
            "error_rate": rate(c("client_errors") + c("server_errors"), n),
            "qps": c("successes") / F.lit(float(SECONDS[grain])),
        }
    )
    flights = df.select("log_time", clock.arrival(c("log_time"), c("duration_ms")).alias("_arrived"))
    flying = occupancy.occupancy(flights, "_arrived", "log_time", SECONDS[grain]).withColumnRenamed("bucket", "_at")
    return out.join(flying, c("bucket") == c("_at"), "left").drop("_at")


def change(now: Column, before: Column) -> Column:
    """Percent change, 0 for the first bucket or when the previous value is not positive."""
    return F.when(before > 0, (now - before) / before * 100).otherwise(F.lit(0.0))


def trend(report: DataFrame) -> DataFrame:
    """Change of QPS, median and error rate against the previous bucket."""
    metrics = ("qps", "p50", "error_rate")
    rows = lagged(report, ["bucket"], spans(F.col("bucket")), {f"_was_{m}": m for m in metrics})
    return rows.withColumns({f"{m}_change": change(F.col(m), F.col(f"_was_{m}")) for m in metrics}).drop(*[f"_was_{m}" for m in metrics])


def anomaly(report: DataFrame) -> DataFrame:
    """Score 0-100 from the z-scores of QPS, error rate (x1.5), slow rate and median, with a level."""
    metrics = {"qps": 1.0, "error_rate": 1.5, "slow_rate": 1.0, "p50": 1.0}
    stats = report.agg(
        F.struct(
            *[F.avg(m).alias(f"{m}_m") for m in metrics], *[F.stddev_pop(m).alias(f"{m}_s") for m in metrics]
        )
    ).scalar()
    with_stats = report.withColumn("_s", stats)

    def score(m: str, weight: float) -> Column:
        s = F.col("_s")
        z = F.abs(F.col(m) - s[f"{m}_m"]) / s[f"{m}_s"]
        return F.when(s[f"{m}_s"] > 0, F.least(z / 3.0, F.lit(1.0))).otherwise(F.lit(0.0)) * weight

    total = sum((score(m, w) for m, w in metrics.items()), F.lit(0.0)) / len(metrics) * 100
    out = with_stats.withColumn("anomaly_score", F.round(total, 4)).drop("_s")
    return out.withColumn(
        "anomaly_level", descend(F.col("anomaly_score"), ANOMALY_LEVELS, "正常", strict=False)
    )


def efficiency(scored: DataFrame, *, scores: bool = False) -> DataFrame:
    """Efficiency index from throughput, response, reliability, stability and health scores, which ``scores`` keeps."""
    peaks = scored.agg(F.struct(*[F.max(m).alias(m) for m in ("qps", "p50", "error_rate", "slow_rate")])).scalar()
    rows = scored.withColumn("_p", peaks)
    p = {m: F.when(F.col("_p")[m] > 0, F.col("_p")[m]).otherwise(F.lit(1.0)) for m in ("qps", "p50", "error_rate", "slow_rate")}
    zero = F.lit(0.0)

    def relative(m: str, per_point: float) -> Column:
        share = F.greatest(zero, F.lit(100.0) - F.col(m) / p[m] * 100)
        absolute = F.greatest(zero, F.lit(100.0) - F.col(m) * per_point)
        return F.when(p[m] > 1, share).otherwise(absolute)

    throughput = F.col("qps") / p["qps"] * 100
    response = F.greatest(zero, F.lit(100.0) - F.col("p50") / p["p50"] * 100)
    health = F.greatest(zero, F.lit(100.0) - F.col("anomaly_score"))
    parts = {
        "throughput_score": (throughput, 0.25),
        "response_score": (response, 0.25),
        "reliability_score": (relative("error_rate", 10.0), 0.20),
        "stability_score": (relative("slow_rate", 5.0), 0.15),
        "health_score": (health, 0.15),
    }
    index = reduce(lambda a, b: a + b, [score * weight for score, weight in parts.values()])
    kept = {name: F.round(score, 4) for name, (score, _) in parts.items()} if scores else {}
    out = rows.withColumns({"efficiency_index": F.round(index, 4), **kept}).drop("_p")
    steps = [(90, "优秀"), (80, "良好"), (70, "一般"), (60, "较差")]
    return out.withColumn("efficiency_level", descend(F.col("efficiency_index"), steps, "很差", strict=False))


def rolling(report: DataFrame, value: str, *, peak_rows: int = 7, mean_rows: int = 24) -> DataFrame:
    """Rolling maximum over 7 and mean over 24 bucket rows."""
    frames = {
        "rolling_peak": lambda w: F.max(value).over(w.rowsBetween(1 - peak_rows, 0)),
        "rolling_mean": lambda w: F.avg(value).over(w.rowsBetween(1 - mean_rows, 0)),
    }
    return framed(report, ["bucket"], spans(F.col("bucket")), frames, before=max(peak_rows, mean_rows) - 1)


def _direction(change_: Column, band: float = 5.0) -> Column:
    return (
        F.when(F.abs(change_) < band, F.lit("stable"))
        .when(change_ > 0, F.lit("rising"))
        .otherwise(F.lit("falling"))
    )


def ends_trend(report: DataFrame, metrics: list[str], *, width: int = 3) -> DataFrame:
    """Mean of the last three buckets against the first three, per metric."""
    ranked = numbered(report, ["bucket"], spans(F.col("bucket")), "_a", total="_n")
    ranked = ranked.withColumn("_z", F.col("_n") - F.col("_a") + 1)
    long = ranked.select(
        "_a", "_z", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("m")
    ).select("_a", "_z", "m.metric", "m.v")
    out = long.groupBy("metric").agg(
        F.count(F.lit(1)).alias("points"),
        F.avg(F.when(F.col("_a") <= width, F.col("v"))).alias("early"),
        F.avg(F.when(F.col("_z") <= width, F.col("v"))).alias("recent"),
        F.stddev_pop("v").alias("volatility"),
    ).filter(F.col("points") >= width)
    moved = F.when(F.col("early") > 0, (F.col("recent") - F.col("early")) / F.col("early") * 100).otherwise(F.lit(0.0))
    return out.select(
        "metric", "points", F.round("early", 6).alias("early"), F.round("recent", 6).alias("recent"),
        F.round("volatility", 6).alias("volatility"), F.round(moved, 6).alias("change"),
        _direction(moved).alias("direction"),
    )


def halves_trend(report: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean of the second half of the buckets against the first half, per metric."""
    ranked = numbered(report, ["bucket"], spans(F.col("bucket")), "_a", total="_n")
    early = F.col("_a") <= F.floor(F.col("_n") / 2)
    long = ranked.select(
        early.alias("early"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("m"),
    ).select("early", "m.metric", "m.v")
    out = long.groupBy("metric").agg(
        F.avg(F.when(F.col("early"), F.col("v"))).alias("first_half"),
        F.avg(F.when(~F.col("early"), F.col("v"))).alias("second_half"),
    )
    moved = (F.col("second_half") - F.col("first_half")) / F.col("first_half") * 100
    direction = F.when(moved > 5, F.lit("rising")).when(moved < -5, F.lit("falling")).otherwise(F.lit("stable"))
    return out.filter(F.col("first_half") != 0).select(
        "metric", F.round("first_half", 6).alias("first_half"), F.round("second_half", 6).alias("second_half"),
        F.round(moved, 6).alias("change"), direction.alias("direction"),
    )


def peaks(report: DataFrame, metrics: list[str], k: int = 3) -> DataFrame:
    """Top-k buckets of each metric."""
    from hitlens.operators.ranking import top_per_group

    long = report.select(
        "bucket",
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("m"),
    ).select("bucket", "m.metric", "m.value")
    return top_per_group(long, ["metric"], [F.desc("value"), F.asc("bucket")], k)


def hourly(df: DataFrame) -> DataFrame:
    """Mean latency and share of server errors per hour."""
    out = summarise(
        df,
        {"bucket": F.date_trunc("hour", "log_time")},
        sums={"requests": F.lit(1), "ms": F.col("duration_ms"), "server_errors": flag(F.col("status").startswith("5"))},
    )
    share = rate(F.col("server_errors"), F.col("requests"))
    return out.select("bucket", "requests", mean(F.col("ms"), F.col("requests")).alias("avg_ms"), share.alias("server_error_rate"))


def peak_summary(hours: DataFrame, flights: DataFrame, k: int = 3, *, least_errors: float = 1.0) -> DataFrame:
    """The worst buckets of the period: by mean latency, by share of server errors (above ``least_errors`` percent) and by concurrency.

    ``hours`` comes from :func:`hourly`, ``flights`` from :func:`hitlens.operators.occupancy.concurrency`.
    """
    from hitlens.operators.ranking import top_per_group

    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("peak"), value.cast("double").alias("value"))

    errors = F.when(F.col("server_error_rate") > least_errors, F.col("server_error_rate"))
    both = F.array(entry("latency", F.col("avg_ms")), entry("server_errors", errors))
    long = hours.select("bucket", F.inline(both)).filter("value is not null")
    long = long.unionByName(flights.select("bucket", F.inline(F.array(entry("concurrency", F.col("max_concurrent"))))))
    return top_per_group(long, ["peak"], [F.desc("value"), F.asc("bucket")], k)
