"""Near-real-time rollups, rankings, health and anomaly views (durations in ms)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitlens.functions import uri as uri_functions
from hitlens.operators.measures import flag, mean, rate, summarise
from hitlens.operators.ranking import stack_up, top_lists
from hitlens.rules import descend

c = F.col
ms = "duration_ms"


def _counts() -> dict[str, Column]:
    return {
        "requests": F.lit(1),
        "successes": flag(c("is_success")),
        "errors": flag(c("is_error")),
        "slow": flag(c("is_slow")),
        "ms": c(ms),
    }


def _rates() -> dict[str, Column]:
    n = c("requests")
    return {
        "success_rate": rate(c("successes"), n),
        "error_rate": rate(c("errors"), n),
        "slow_rate": rate(c("slow"), n),
        "avg_ms": c("ms") / n,
    }


def with_group(df: DataFrame) -> DataFrame:
    """Add the grouping path."""
    return df.withColumn("path_group", uri_functions.grouping_path(c("request_uri")))


def api_percentiles(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """Per hour, grouping path, platform, category: latency, phase and size percentiles, cache-hit rate."""
    out = summarise(
        with_group(df),
        ["stat_hour", "path_group", "platform", "api_category"],
        sums={**_counts(), "cache_hits": flag(c("cache_status") == "HIT")},
        maxs={"max_ms": c(ms)},
        quantiles=[
            (c(ms), {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}),
            (c("connect_ms"), {"connect_p50": 0.5, "connect_p95": 0.95}),
            (c("process_ms"), {"process_p50": 0.5, "process_p95": 0.95}),
        ],
        unbounded=[(c("body_bytes"), {"body_p50": 0.5, "body_p95": 0.95})],
        exact=exact,
    )
    return out.withColumns({**_rates(), "cache_hit_rate": rate(c("cache_hits"), c("requests"))}).drop("ms", "cache_hits")


def qps_ranking(df: DataFrame, *, hot: int = 5) -> DataFrame:
    """Per minute: QPS and latency rank of every path, hot and slow flags."""
    out = summarise(
        with_group(df).withColumn("minute", F.date_trunc("minute", "log_time")),
        ["minute", "path_group", "platform", "api_category"],
        sums=_counts(),
        quantiles=[(c(ms), {"p95": 0.95})],
    ).withColumns({"qps": c("requests") / F.lit(60.0), "avg_ms": c("ms") / c("requests"), "error_rate": rate(c("errors"), c("requests"))})
    tie = ["path_group", "platform", "api_category"]
    w = Window.partitionBy("minute")
    out = out.withColumns(
        {
            "qps_rank": F.row_number().over(w.orderBy(F.desc("qps"), *tie)),
            "latency_rank": F.row_number().over(w.orderBy(F.desc("avg_ms"), *tie)),
        }
    )
    return out.withColumns({"is_hot": c("qps_rank") <= hot, "is_slow_api": c("latency_rank") <= hot}).drop(
        "ms", "successes", "errors", "slow"
    )


def error_monitoring(df: DataFrame) -> DataFrame:
    """Errors per hour and path: span, clients, latency, commonest code."""
    out = summarise(
        with_group(df).filter("is_error"),
        ["stat_hour", "path_group", "platform"],
        sums={"errors": F.lit(1), "ms": c(ms), "upstream": flag(c("upstream_addr") != "")},
        mins={"first_error": c("log_time")},
        maxs={"last_error": c("log_time")},
        distinct={"clients": c("client_ip"), "apis": c("uri")},
        modes={"main_code": c("status")},
    )
    return out.withColumns(
        {
            "minutes": F.timestamp_diff("MINUTE", F.date_trunc("minute", "first_error"), F.date_trunc("minute", "last_error")),
            "avg_ms": c("ms") / c("errors"),
            "upstream_rate": rate(c("upstream"), c("errors")),
        }
    ).drop("ms", "upstream")


def upstream_health(df: DataFrame, *, connect_limit_ms: int = 5000, timeout_ms: int = 30000) -> DataFrame:
    """Per hour and upstream: connect success, timeouts, weighted health score, alert level."""
    connected = c("connect_ms") > 0
    out = summarise(
        df.filter(c("upstream_addr") != ""),
        ["stat_hour", "upstream_addr", "service"],
        sums={
            **_counts(),
            "timeouts": flag(c(ms) > timeout_ms),
            "connected": flag(connected),
            "connected_well": flag(connected & (c("connect_ms") < connect_limit_ms)),
            "connect": F.when(connected, c("connect_ms")),
            "connect_errors": flag(~connected | (c("connect_ms") > connect_limit_ms)),
        },
        quantiles=[
            (c(ms), {"p95": 0.95, "p99": 0.99}),
            (F.when(connected, c("connect_ms")), {"connect_p95": 0.95}),
        ],
    )
    n = c("requests")
    good = rate(c("connected_well"), c("connected"))
    score = F.round(good * 0.3 + (F.lit(100.0) - rate(c("errors"), n)) * 0.4 + (F.lit(100.0) - rate(c("timeouts"), n)) * 0.3, 6)
    return out.withColumns(
        {
            "connect_rate": good,
            "avg_connect_ms": mean(c("connect"), c("connected")),
            "avg_ms": c("ms") / n,
            "timeout_rate": rate(c("timeouts"), n),
            "availability": rate(c("successes"), n),
            "health": score,
        }
    ).withColumns(
        {
            "is_healthy": c("health") >= 80,
            "alert": descend(c("health"), [(90, "OK"), (70, "WARNING")], "CRITICAL", strict=False),
        }
    ).drop("ms", "connect", "connected", "connected_well", "slow")


def client_behaviour(df: DataFrame) -> DataFrame:
    """Per hour and client: span, volume, top path, risk ladder, bot probability."""
    out = summarise(
        with_group(df),
        ["stat_hour", "client_ip", "platform", "device", "browser", "os", "entry_source"],
        sums={**_counts(), "bytes": c("body_bytes"), "bots": flag(c("bot_type").isNotNull())},
        mins={"first_seen": c("log_time")},
        maxs={"last_seen": c("log_time")},
        quantiles=[(c(ms), {"p95": 0.95})],
        distinct={"apis": c("path_group")},
        modes={"top_path": c("path_group")},
    )
    n, apis = c("requests"), c("apis")
    risk = (
        F.when((n > 1000) | (apis > 50), 100).when((n > 500) | (apis > 20), 70).when(n > 100, 30).otherwise(0)
    )
    return out.withColumns(
        {
            "span_minutes": (F.unix_micros("last_seen") - F.unix_micros("first_seen")) / F.lit(60e6),
            "avg_ms": c("ms") / n,
            "risk_score": risk,
            "bot_probability": F.when(c("bots") > 0, 0.9).when(n > 500, 0.6).otherwise(0.1),
        }
    ).withColumn("is_suspicious", c("risk_score") >= 70).drop("ms", "bots", "first_seen", "last_seen")


def traces(df: DataFrame, trace: str = "trace_id") -> DataFrame:
    """Per trace: spans, services, errors, durations, bottleneck service, slowest and entry API.

    Equal durations resolve to the smallest (service, uri), equal times to the smallest uri.
    """
    slowest = F.min(F.struct((-c(ms)).alias("d"), "service", "uri"))
    entry = F.min(F.struct("log_time", "uri"))
    fine = df.groupBy(trace, "service").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_error").alias("bad"),
        F.sum(ms).alias("ms"),
        slowest.alias("slowest"),
        entry.alias("entry"),
        F.max("log_time").alias("end"),
    )
    out = fine.groupBy(trace).agg(
        F.sum("n").alias("spans"),
        F.count("service").alias("services"),
        F.sum("bad").alias("error_spans"),
        F.sum("ms").alias("ms"),
        F.min("slowest").alias("slowest"),
        F.min("entry").alias("entry"),
        F.max("end").alias("end_time"),
    )
    return out.select(
        trace, "spans", "services", "error_spans", "end_time",
        c("entry.log_time").alias("start_time"),
        (-c("slowest.d")).alias("critical_ms"),
        (c("ms") / c("spans")).alias("avg_ms"),
        ((c("spans") - c("error_spans")) * 100.0 / c("spans")).alias("success_rate"),
        c("slowest.service").alias("bottleneck_service"),
        c("slowest.uri").alias("slowest_api"),
        c("entry.uri").alias("entry_api"),
    )


def dashboard_totals(df: DataFrame, hour: str) -> DataFrame:
    """Totals of one hour, from counts (never averages of averages)."""
    now = df.filter(c("stat_hour") == F.to_timestamp(F.lit(hour)))
    out = summarise(now, [], sums=_counts(), distinct={"apis": c("uri"), "clients": c("client_ip")})
    return out.withColumns({**_rates(), "qps": c("requests") / F.lit(3600.0)}).drop("ms", "successes", "errors", "slow")


def slow_and_hot(percentiles: DataFrame, *, n: int = 10) -> DataFrame:
    """Top slow paths and top hot paths in one table with rank, one pass."""
    cols = ["path_group", "platform", "stat_hour", "requests", "success_rate", "p95"]
    lists = {"slow": c("p95"), "hot": c("requests")}
    ranked = top_lists(percentiles, lists, cols, n, ["path_group", "platform", "stat_hour"])
    return ranked.select(*cols, c("rank").alias("position"), c("list").alias("kind"))


def anomalies(percentiles: DataFrame, health: DataFrame) -> DataFrame:
    """Error rate over 5 %, p95 over 3 s, upstream health under 80, with severity."""

    def rule(test: Column, kind: str, value: str, severity: Column) -> Column:
        found = F.struct(
            F.lit(kind).alias("kind"), c(value).cast("double").alias("value"), severity.alias("severity")
        )
        return F.when(test, found)

    def part(frame: DataFrame, subject: str, scope: str, rules: list[Column]) -> DataFrame:
        fired = frame.select(
            "stat_hour",
            c(subject).alias("subject"),
            c(scope).alias("scope"),
            F.explode(F.array_compact(F.array(*rules))).alias("r"),
        )
        return fired.select("stat_hour", "subject", "scope", "r.kind", "r.value", "r.severity")

    slow_level = descend(c("p95"), [(10000, "CRITICAL"), (5000, "WARNING")], "OK")
    apis = [
        rule(c("error_rate") > 5, "high_error_rate", "error_rate", descend(c("error_rate"), [(10, "CRITICAL")], "WARNING")),
        rule(c("p95") > 3000, "high_response_time", "p95", slow_level),
    ]
    upstreams = [rule(c("health") < 80, "low_health", "health", c("alert"))]
    return stack_up(
        [part(percentiles, "path_group", "platform", apis), part(health, "upstream_addr", "service", upstreams)]
    )


def simple_anomalies(df: DataFrame, *, min_requests: int = 10) -> DataFrame:
    """Per hour, platform, category: first rule that fires of latency, error and slow rate."""
    out = summarise(
        df, ["stat_hour", "platform", "api_category"], sums=_counts(), quantiles=[(c(ms), {"p95": 0.95})]
    ).filter(c("requests") >= min_requests).withColumns(_rates())
    kind = (
        F.when(c("avg_ms") > 5000, F.lit("high_response_time"))
        .when(c("error_rate") > 10, F.lit("high_error_rate"))
        .when(c("slow_rate") > 20, F.lit("high_slow_rate"))
        .otherwise(F.lit("normal"))
    )
    return out.withColumn("anomaly", kind).select(
        "stat_hour", "platform", "api_category", "requests", "avg_ms", "p95", "error_rate", "slow_rate", "anomaly"
    )


def platform_hourly(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    keys = by or ["stat_hour", "platform"]
    out = summarise(
        df,
        keys,
        sums={**_counts(), "anomalies": flag(c("has_anomaly")), "bytes": c("body_bytes")},
        mins={"min_ms": c(ms)},
        maxs={"max_ms": c(ms)},
        quantiles=[(c(ms), {"p50": 0.5, "p95": 0.95, "p99": 0.99})],
        distinct={"clients": c("client_ip")},
    )
    return out.withColumns({**_rates(), "anomaly_rate": rate(c("anomalies"), c("requests"))}).drop("ms")


def api_hourly(df: DataFrame) -> DataFrame:
    """Per hour, URI, platform, category; the application and service shown are the smallest names."""
    out = summarise(
        df,
        ["stat_hour", "uri", "platform", "api_category"],
        sums=_counts(),
        mins={"application": c("application"), "service": c("service")},
        maxs={"max_ms": c(ms)},
        quantiles=[(c(ms), {"p95": 0.95})],
    )
    return out.withColumns(_rates()).drop("ms")


def realtime_metrics(df: DataFrame) -> DataFrame:
    """Per hour and platform with an alert level (critical over 3 s, warning over 1 s)."""
    out = platform_hourly(df)
    alert = descend(c("avg_ms"), [(3000, "critical"), (1000, "warning")], "normal")
    return out.select(
        "stat_hour", "platform", "requests", "success_rate", "avg_ms", "p95", "p99", "slow_rate", "error_rate",
        "anomaly_rate", alert.alias("alert"),
    )


def minute_rollup(df: DataFrame) -> DataFrame:
    out = summarise(
        df.withColumn("minute", F.date_trunc("minute", "log_time")),
        ["minute", "uri", "platform", "api_category"],
        sums={**_counts(), "connect": c("connect_ms"), "header": c("header_ms"), "upstream": c("response_ms"), "network": c("network_ms"), "sent": c("sent_bytes")},
        mins={"min_ms": c(ms)},
        maxs={"max_ms": c(ms)},
        quantiles=[(c(ms), {"p50": 0.5, "p95": 0.95, "p99": 0.99})],
    )
    n = c("requests")
    return out.withColumns(
        {"avg_ms": c("ms") / n, **{f"avg_{p}_ms": c(p) / n for p in ("connect", "header", "upstream", "network")}}
    ).drop("ms", "connect", "header", "upstream", "network")


def ip_behaviour(df: DataFrame) -> DataFrame:
    out = summarise(
        df,
        ["stat_hour", "client_ip", "platform"],
        sums={**_counts(), "anomalies": flag(c("has_anomaly")), "sent": c("sent_bytes")},
        maxs={"max_ms": c(ms)},
        distinct={"apis": c("uri"), "agents": c("user_agent")},
    )
    err = rate(c("errors"), c("requests"))
    return out.withColumns(
        {
            "avg_ms": c("ms") / c("requests"),
            "risk_score": F.when(err > 20, 80.0).when(c("requests") > 1000, 60.0).otherwise(20.0),
            "risk_level": F.when(err > 20, F.lit("high")).when(c("requests") > 1000, F.lit("medium")).otherwise(F.lit("low")),
        }
    ).drop("ms")


def daily_clients(df: DataFrame, *, min_requests: int = 2) -> DataFrame:
    out = summarise(
        df.withColumn("day", F.to_date("log_time")),
        ["day", "client_ip", "platform"],
        sums={**_counts(), "bytes": c("body_bytes")},
        maxs={"max_ms": c(ms)},
        distinct={"apis": c("uri")},
    ).filter(c("requests") >= min_requests)
    return out.select("day", "client_ip", "platform", "requests", "apis", "errors", "max_ms", "bytes", (c("ms") / c("requests")).alias("avg_ms"))


def daily_errors(df: DataFrame) -> DataFrame:
    """Errors per hour, status and category with the erroneous URIs, one row per URI.

    Long form on purpose: a list per group would grow with the number of URIs in one task.
    """
    keys = ["stat_hour", "status", "api_category"]
    bad = df.filter(~c("is_success"))
    per_uri = bad.groupBy(*keys, "uri").agg(F.count(F.lit(1)).alias("uri_errors"))
    totals = summarise(bad, keys, sums={"errors": F.lit(1)}, distinct={"clients": c("client_ip")})
    return per_uri.join(totals, keys)


def hot_daily(df: DataFrame) -> DataFrame:
    out = summarise(
        df.withColumn("day", F.to_date("log_time")),
        ["day", "uri", "platform"],
        sums={**_counts(), "bytes": c("body_bytes")},
        distinct={"visitors": c("client_ip")},
    )
    return out.select("day", "uri", "platform", "requests", "successes", "bytes", "visitors", (c("ms") / c("requests")).alias("avg_ms"))


def slow_daily(df: DataFrame, *, at_least_ms: int = 1000) -> DataFrame:
    out = summarise(
        df.filter(c(ms) >= at_least_ms).withColumn("day", F.to_date("log_time")),
        ["day", "uri", "platform"],
        sums=_counts(),
        quantiles=[(c(ms), {"p95": 0.95})],
    )
    return out.select("day", "uri", "platform", "requests", "slow", "p95", (c("ms") / c("requests")).alias("avg_ms"))


def cache_daily(df: DataFrame, *, hit_ms: int = 100) -> DataFrame:
    out = summarise(
        df.withColumn("day", F.to_date("log_time")),
        ["day", "api_category"],
        sums={"requests": F.lit(1), "cache_hits": flag(c(ms) < hit_ms), "cache_misses": flag(c(ms) >= hit_ms)},
    )
    return out.withColumn("hit_rate", rate(c("cache_hits"), c("requests")))


def cluster_daily(df: DataFrame, node: str = "server_name") -> DataFrame:
    out = summarise(
        df.withColumn("day", F.to_date("log_time")), ["day", node], sums=_counts(), quantiles=[(c(ms), {"p95": 0.95})]
    )
    return out.select("day", node, "requests", "successes", "p95", (c("ms") / c("requests")).alias("avg_ms"), rate(c("successes"), c("requests")).alias("success_rate"))


