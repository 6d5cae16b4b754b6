"""Interface error reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.operators.measures import flag, mean, rate, summarise
from hitlens.operators.ranking import side_by_side, top_lists, top_per_group
from hitlens.operators.sequence import with_previous

CRITICAL = ["500", "502", "503", "504"]


def interfaces(df: DataFrame) -> DataFrame:
    """Per interface: totals, error rate, distinct clients/apps/services/upstreams with errors, first/last error."""
    c = F.col
    bad = c("is_error")

    def on_error(name: str):
        return F.when(bad, c(name))

    out = summarise(
        df,
        ["uri"],
        sums={"requests": F.lit(1), "errors": flag(bad)},
        mins={"first_error": on_error("log_time")},
        maxs={"last_error": on_error("log_time")},
        distinct={
            "clients": on_error("client_ip"),
            "applications": on_error("application"),
            "services": on_error("service"),
            "upstreams": on_error("upstream_addr"),
            "codes": on_error("status"),
        },
        modes={"main_code": on_error("status")},
    )
    return out.filter("errors > 0").withColumn("error_rate", rate(c("errors"), c("requests")))


def top_interfaces(report: DataFrame, *, k: int = 10, min_requests: int = 100) -> DataFrame:
    """Three top lists next to each other: error count, error rate (busy interfaces only), clients."""
    c = F.col
    lists = {
        "count": c("errors"),
        "rate": F.when(c("requests") >= min_requests, c("error_rate")),
        "clients": c("clients"),
    }
    return side_by_side(top_lists(report, lists, ["uri"], k, ["uri"]), list(lists), "uri")


def _listed(ranked: DataFrame, by: str) -> DataFrame:
    """``item(n)`` texts of the kept rows in rank order (k rows per group at most)."""
    item = F.struct(F.col("rank"), F.concat(F.col("uri"), F.lit("("), F.col("n").cast("string"), F.lit(")")).alias("t"))
    return ranked.groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(item)).getField("t"), "; ").alias("top"))


def critical_codes(df: DataFrame, codes: list[str] = CRITICAL, *, k: int = 5) -> DataFrame:
    """Total, number of interfaces and top-k interfaces per critical code."""
    counts = df.filter(F.col("status").isin(*codes)).groupBy("status", "uri").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("status").agg(F.sum("n").alias("errors"), F.count(F.lit(1)).alias("interfaces"))
    best = top_per_group(counts, ["status"], [F.desc("n"), F.asc("uri")], k)
    return totals.join(_listed(best, "status"), "status")


def upstreams(df: DataFrame) -> DataFrame:
    """Per upstream: errors, interfaces, main code, mean connect and response time where positive."""
    c = F.col
    out = summarise(
        df.filter("is_error"),
        ["upstream_addr"],
        sums={
            "errors": F.lit(1),
            "connect": F.when(c("connect_ms") > 0, c("connect_ms")),
            "connect_n": flag(c("connect_ms") > 0),
            "response": F.when(c("response_ms") > 0, c("response_ms")),
            "response_n": flag(c("response_ms") > 0),
        },
        distinct={"interfaces": c("uri")},
        modes={"main_code": c("status")},
    )
    return out.select(
        "upstream_addr", "errors", "interfaces", "main_code",
        mean(c("connect"), c("connect_n")).alias("avg_connect_ms"),
        mean(c("response"), c("response_n")).alias("avg_response_ms"),
    )


def by_hour(df: DataFrame, *, k: int = 3) -> DataFrame:
    """Errors and interfaces per hour with the top-k interfaces."""
    counts = df.filter("is_error").groupBy("stat_hour", "uri").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("stat_hour").agg(F.sum("n").alias("errors"), F.count(F.lit(1)).alias("interfaces"))
    best = top_per_group(counts, ["stat_hour"], [F.desc("n"), F.asc("uri")], k)
    return totals.join(_listed(best, "stat_hour"), "stat_hour")


def impact(df: DataFrame) -> DataFrame:
    """Affected against total clients, applications and services, one row each."""
    dims = {"client": "client_ip", "application": "application", "service": "service"}
    entries = F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(v).alias("item")) for k, v in dims.items()])
    rows = df.select("is_error", F.explode(entries).alias("d"))
    items = rows.groupBy("d.dimension", "d.item").agg(F.max("is_error").alias("hit"))
    out = items.groupBy("dimension").agg(F.count("item").alias("total"), F.count_if("hit").alias("affected"))
    return out.withColumn("impact_rate", rate(F.col("affected"), F.col("total")))


def samples(df: DataFrame, *, k: int = 50) -> DataFrame:
    """First k errors of every interface; tasks keep k rows per interface before the shuffle."""
    rows = df.filter("is_error").select("uri", "log_time", "event_id", "status", "duration_ms", "client_ip", "service")
    return top_per_group(rows, ["uri"], [F.asc("log_time"), F.asc("event_id")], k)


def bursts(df: DataFrame, *, gap_seconds: int = 300) -> DataFrame:
    """Gaps between consecutive errors per interface; a burst is a gap under five minutes."""
    rows = df.filter("is_error").select("uri", "log_time", "event_id")
    seen = with_previous(rows, ["uri"], ["log_time", "event_id"], ["log_time"], slice_of=F.date_trunc("minute", "log_time"))
    gap = (F.unix_micros("log_time") - F.unix_micros("prev_log_time"))
    out = seen.withColumn("gap", gap).groupBy("uri").agg(
        F.count(F.lit(1)).alias("errors"),
        F.min("log_time").alias("first_error"),
        F.max("log_time").alias("last_error"),
        (F.sum("gap") / F.count("gap") / F.lit(1e6)).alias("avg_gap"),
        (F.min("gap") / F.lit(1e6)).alias("min_gap"),
        (F.max("gap") / F.lit(1e6)).alias("max_gap"),
        F.count_if(F.col("gap") < gap_seconds * 1_000_000).alias("bursts"),
    )
    return out.filter("errors >= 2")
