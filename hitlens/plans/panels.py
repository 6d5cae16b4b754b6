"""Dashboard panels: one filter and one aggregate each; intervals are tumbling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.operators.filters import attack_paths
from hitlens.operators.measures import flag, mean, rate, summarise
from hitlens.operators.ranking import share_of_total, top

c = F.col
MS = "duration_ms"


def interval(seconds: int, ts: str = "log_time") -> Column:
    """Start of the tumbling interval a row falls into."""
    return F.window(ts, f"{seconds} seconds")["start"]


def uri_latency(df: DataFrame, *, min_requests: int = 10, n: int = 50, by: str = "requests") -> DataFrame:
    """URIs with count, mean and p95 above a minimum count; by requests (D1) or by p95 (D2)."""
    out = summarise(df, ["uri"], sums={"requests": F.lit(1), "ms": c(MS)}, quantiles=[(c(MS), {"p95": 0.95})])
    out = out.filter(c("requests") >= min_requests).withColumn("avg_ms", c("ms") / c("requests")).drop("ms")
    return top(out, [F.desc(by), F.asc("uri")], n)


def mean_by(df: DataFrame, keys: dict[str, Column], metrics: list[str] | None = None) -> DataFrame:
    """Mean of each metric per key."""
    names = metrics or [MS]
    out = summarise(df, keys, sums={"requests": F.lit(1), **{m: c(m) for m in names}})
    return out.select(*keys, "requests", *[(c(m) / c("requests")).alias(f"avg_{m}") for m in names])


def status_share(df: DataFrame) -> DataFrame:
    out = summarise(df, ["status"], sums={"requests": F.lit(1), "ms": c(MS)})
    out = share_of_total(out, "requests", source=df)
    return out.select("status", "requests", "share", (c("ms") / c("requests")).alias("avg_ms"))


def agent_prefixes(df: DataFrame, n: int = 10) -> DataFrame:
    out = df.groupBy(F.substring("user_agent", 1, 20).alias("agent")).agg(F.count(F.lit(1)).alias("requests"))
    return top(out, [F.desc("requests"), F.asc("agent")], n)


def rollup_means(rollup: DataFrame) -> DataFrame:
    """Requests per second, availability, error rate from a rollup's counts; mean of its p95 rows."""
    out = rollup.agg(
        F.sum("requests").alias("requests"),
        F.sum("successes").alias("ok"),
        F.sum("errors").alias("bad"),
        F.count_distinct("stat_hour").alias("hours"),
        F.avg("p95").alias("avg_p95"),
    )
    return out.select(
        (c("requests") / (c("hours") * 3600.0)).alias("avg_qps"),
        rate(c("ok"), c("requests")).alias("availability"),
        rate(c("bad"), c("requests")).alias("error_rate"),
        F.round("avg_p95", 4).alias("avg_p95"),
    )


def rollup_series(rollup: DataFrame) -> DataFrame:
    """Hourly QPS and worst p95 over a rollup."""
    out = rollup.groupBy("stat_hour").agg(F.sum("requests").alias("requests"), F.max("p95").alias("p95"))
    return out.select("stat_hour", (c("requests") / F.lit(3600.0)).alias("qps"), "p95")


def rollup_top(rollup: DataFrame, by: str, n: int = 10) -> DataFrame:
    out = rollup.groupBy("uri").agg(F.sum("requests").alias("requests"), F.sum("slow").alias("slow"))
    return top(out, [F.desc(by), F.asc("uri")], n)


def error_totals(df: DataFrame) -> DataFrame:
    bad = c("is_error")
    out = summarise(
        df, [], sums={"requests": F.lit(1), "errors": flag(bad)}, distinct={"clients": F.when(bad, c("client_ip"))}
    )
    return out.withColumn("error_rate", rate(c("errors"), c("requests")))


def status_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("requests"))


def error_series(df: DataFrame, seconds: int) -> DataFrame:
    out = summarise(df, {"slot": interval(seconds)}, sums={"requests": F.lit(1), "errors": flag(c("is_error"))})
    return out.withColumn("error_rate", rate(c("errors"), c("requests")))


def status_series(df: DataFrame, seconds: int) -> DataFrame:
    return df.groupBy(interval(seconds).alias("slot"), "status").agg(F.count(F.lit(1)).alias("requests"))


def top_errors(df: DataFrame, n: int = 20) -> DataFrame:
    bad = df.filter("is_error")
    out = bad.groupBy("uri", "status").agg(F.count(F.lit(1)).alias("errors"))
    out = share_of_total(out, "errors", source=bad)
    return top(out, [F.desc("errors"), F.asc("uri"), F.asc("status")], n)


def error_clients(df: DataFrame, n: int = 20) -> DataFrame:
    out = summarise(
        df.filter("is_error"), ["client_ip"], sums={"errors": F.lit(1), "ms": c(MS)}, distinct={"apis": c("uri")}
    )
    out = out.withColumn("avg_ms", mean(c("ms"), c("errors"))).drop("ms")
    return top(out, [F.desc("errors"), F.asc("client_ip")], n)


def hourly_errors(df: DataFrame) -> DataFrame:
    return summarise(
        df,
        ["stat_hour"],
        sums={
            "requests": F.lit(1),
            "errors": flag(c("is_error")),
            "not_found": flag(c("status") == "404"),
            "server_errors": flag(c("status").startswith("5")),
        },
    )


def last_minute(df: DataFrame, now: str, seconds: int = 60) -> DataFrame:
    """QPS, mean latency and error rate of the last minute before ``now``."""
    end = F.to_timestamp(F.lit(now))
    recent = df.filter((c("log_time") > end - F.make_interval(secs=F.lit(seconds))) & (c("log_time") <= end))
    out = summarise(recent, [], sums={"requests": F.lit(1), "errors": flag(c("is_error")), "ms": c(MS)})
    n = F.coalesce(c("requests"), F.lit(0))
    return out.select(
        n.alias("requests"),
        (n / F.lit(float(seconds))).alias("qps"),
        mean(c("ms"), n).alias("avg_ms"),
        rate(F.coalesce(c("errors"), F.lit(0)), n).alias("error_rate"),
    )


def suspicious_ips(df: DataFrame, *, more_than: int = 10) -> DataFrame:
    """Clients with many 404 or 5xx answers, with their highest status."""
    bad = df.filter((c("status") == "404") | (c("status").try_cast("int") >= 500))
    out = bad.groupBy("client_ip").agg(F.count(F.lit(1)).alias("requests"), F.max("status").alias("max_status"))
    return out.filter(c("requests") > more_than)


def attacked(df: DataFrame) -> DataFrame:
    """Requests and clients per attacked path."""
    return summarise(attack_paths(df), ["uri"], sums={"requests": F.lit(1)}, distinct={"clients": c("client_ip")})


def availability(df: DataFrame) -> DataFrame:
    out = summarise(
        df,
        [],
        sums={"requests": F.lit(1), "ok": flag(c("status").try_cast("int") < 400), "ms": c(MS)},
        distinct={"clients": c("client_ip")},
    )
    return out.select(
        rate(c("ok"), c("requests")).alias("availability"), (c("ms") / c("requests")).alias("avg_ms"), "clients"
    )


def observed_qps(df: DataFrame) -> DataFrame:
    """Requests over the observed span in whole seconds (0 when the span is 0)."""
    out = df.agg(F.count(F.lit(1)).alias("n"), F.min("log_time").alias("lo"), F.max("log_time").alias("hi"))
    span = F.unix_timestamp("hi") - F.unix_timestamp("lo")
    return out.select("n", F.when(span > 0, c("n") / span).otherwise(F.lit(0.0)).alias("qps"))


def qps_series(df: DataFrame, seconds: int) -> DataFrame:
    out = df.groupBy(interval(seconds).alias("slot")).agg(F.count(F.lit(1)).alias("requests"))
    return out.withColumn("qps", c("requests") / F.lit(float(seconds)))


def latency_series(df: DataFrame, seconds: int) -> DataFrame:
    out = summarise(
        df,
        {"slot": interval(seconds)},
        sums={"requests": F.lit(1), "ms": c(MS)},
        quantiles=[(c(MS), {"p50": 0.5, "p95": 0.95, "p99": 0.99})],
    )
    return out.withColumn("avg_ms", c("ms") / c("requests")).drop("ms")


def histogram(df: DataFrame, part: str) -> DataFrame:
    """Requests per hour of day or weekday."""
    return df.groupBy(part).agg(F.count(F.lit(1)).alias("requests"))
