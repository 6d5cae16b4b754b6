"""Reports over metric time series ``(metric, cluster, instance, ts, value)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.operators.sequence import slice_seconds, with_previous

SERIES = ["metric", "cluster", "instance"]
c = F.col
_GB = 1024.0**3

# --- fixed values: metric catalogue
# name, series summed, function, divisor, (critical, warning) or None, ghost-reset limit or None
CATALOGUE = [
    ("availability", ["nginx_active"], "availability", 1.0, (99.0, 99.9), None),
    ("total_requests", ["nginx_requests"], "increase", 1.0, None, 1e9),
    ("qps_peak", ["nginx_requests"], "rate_peak", 1.0, None, 1e6),
    ("bandwidth_in_peak", ["net_bytes_recv"], "rate_peak", 1e9 / 8, None, 1000.0),
    ("bandwidth_out_peak", ["net_bytes_sent"], "rate_peak", 1e9 / 8, None, 1000.0),
    ("bandwidth_total_peak", ["net_bytes_recv", "net_bytes_sent"], "rate_peak", 1e9 / 8, None, 1000.0),
    ("traffic_in_total", ["net_bytes_recv"], "increase", _GB, None, 10000.0),
    ("traffic_out_total", ["net_bytes_sent"], "increase", _GB, None, 10000.0),
    ("traffic_total", ["net_bytes_recv", "net_bytes_sent"], "increase", _GB, None, 10000.0),
    ("cpu_usage_peak", ["cpu_usage_active"], "mean_peak", 1.0, (85.0, 70.0), None),
    ("memory_usage_peak", ["mem_used_percent"], "mean_peak", 1.0, (90.0, 75.0), None),
    ("system_load_peak", ["system_load5"], "mean_peak", 1.0, None, None),
    ("node_count", ["system_uptime"], "count_up", 1.0, None, None),
    ("conn_active_peak", ["nginx_active"], "sum_peak", 1.0, None, None),
    ("conn_waiting_peak", ["nginx_waiting"], "sum_peak", 1.0, None, None),
    ("conn_reading_peak", ["nginx_reading"], "sum_peak", 1.0, None, None),
    ("conn_writing_peak", ["nginx_writing"], "sum_peak", 1.0, None, None),
    ("oom_events", ["kernel_vmstat_oom_kill"], "increase", 1.0, (1.0, None), None),
    ("high_cpu_nodes", ["cpu_usage_active"], "count_over", 1.0, (None, 1.0), None),
    ("network_errors", ["net_err_in", "net_err_out"], "increase", 1.0, (1000.0, 100.0), None),
]


def increments(df: DataFrame, *, rows: int = 100_000) -> DataFrame:
    """Growth of a counter at every sample; after a reset the new value counts whole.

    Long series are split by hour, and by less where a series has more than ``rows`` samples an hour, with the last
    sample before the slice carried over.
    """
    samples = df.select(*SERIES, "ts", "value")
    slices = F.floor(F.unix_seconds(c("ts").cast("timestamp")) / slice_seconds(samples, SERIES, "ts", rows=rows))
    seen = with_previous(samples, SERIES, ["ts", "value"], ["ts", "value"], slice_of=slices)
    grown = (
        F.when(c("prev_value").isNull(), F.lit(0.0))
        .when(c("value") < c("prev_value"), c("value"))
        .otherwise(c("value") - c("prev_value"))
    )
    return seen.withColumn("growth", grown)


def increase(df: DataFrame) -> DataFrame:
    """Total growth per series."""
    return increments(df).groupBy(*SERIES).agg(F.sum("growth").alias("increase"), F.count(F.lit(1)).alias("samples"))


def rates(df: DataFrame, seconds: int = 120) -> DataFrame:
    """Growth per second of every interval, summed over the instances of a cluster."""
    slot = F.window("ts", f"{seconds} seconds")["start"]
    out = increments(df).groupBy("metric", "cluster", slot.alias("slot")).agg(F.sum("growth").alias("growth"))
    return out.select("metric", "cluster", "slot", (c("growth") / F.lit(float(seconds))).alias("rate"))


def _slope() -> Column:
    """Least-squares growth per second of ``value``."""
    origin = F.lit(1_700_000_000.0)
    return F.regr_slope(c("value"), F.unix_micros("ts") / F.lit(1e6) - origin)


def slopes(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Least-squares growth per second of every series, times the observed span."""
    out = df.groupBy(*by, *SERIES).agg(
        _slope().alias("slope"),
        F.min("ts").alias("lo"),
        F.max("ts").alias("hi"),
    )
    span = (F.unix_micros("hi") - F.unix_micros("lo")) / F.lit(1e6)
    return out.select(*by, *SERIES, "slope", (c("slope") * span).alias("fitted"))


def corrected(value: Column, fallback: Column, limit: float | Column) -> Column:
    """The fallback, where the value passes the ghost-reset limit and the fallback is plausible."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    bad = (value > limit) & (fallback > 0) & (fallback < limit)
    return F.when(bad, fallback).otherwise(value)


def guarded_increase(df: DataFrame, limit: float) -> DataFrame:
    """Growth per metric and cluster, replaced by the fitted growth after a ghost reset."""
    grown = increase(df).groupBy("metric", "cluster").agg(F.sum("increase").alias("raw"))
    fit = slopes(df).groupBy("metric", "cluster").agg(F.sum("fitted").alias("fallback"))
    out = grown.join(fit, ["metric", "cluster"], "left")
    value = corrected(c("raw"), c("fallback"), limit)
    return out.withColumns({"value": value, "used_fallback": value != c("raw")})


def peak(df: DataFrame, by: list[str], value: str, ts: str) -> DataFrame:
    """Largest positive value and its first time; 0 and NULL if there is none."""
    positive = F.when(c(value) > 0, F.struct(c(value).alias("v"), (-F.unix_micros(ts)).alias("t")))
    out = df.groupBy(*by).agg(F.max(positive).alias("_p"))
    return out.select(
        *by,
        F.coalesce(c("_p.v"), F.lit(0.0)).alias("peak"),
        F.timestamp_micros(-c("_p.t")).alias("peak_time"),
    )


def means_and_last(df: DataFrame) -> DataFrame:
    """Mean over all samples and the latest value per metric and cluster."""
    return df.groupBy("metric", "cluster").agg(
        F.avg("value").alias("mean"), F.max_by("value", F.struct("ts", "instance", "value")).alias("last")
    )


def availability(df: DataFrame, *, over: float = 0.0) -> DataFrame:
    """Share of instances whose latest value is positive, and how many exceed a limit."""
    now = df.groupBy(*SERIES).agg(F.max_by("value", F.struct("ts", "value")).alias("v"))
    out = now.groupBy("metric", "cluster").agg(
        F.count(F.lit(1)).alias("instances"),
        F.count_if(c("v") > 0).alias("up"),
        F.count_if(c("v") > over).alias("over_limit"),
    )
    return out.withColumn("availability", c("up") * 100.0 / c("instances"))


def threshold_status(value: Column, critical: float | None, warning: float | None) -> Column:
    """critical / warning / normal by value >= limit."""
    out = F.lit("normal")
    if warning is not None:
        out = F.when(value >= warning, F.lit("warning")).otherwise(out)
    if critical is not None:
        out = F.when(value >= critical, F.lit("critical")).otherwise(out)
    return out


def daily(df: DataFrame) -> DataFrame:
    """Per metric, cluster and day: peak with time, mean, growth of the counter."""
    grown = increments(df).withColumn("day", F.to_date("ts"))
    key = ["metric", "cluster", "day"]
    out = grown.groupBy(*key).agg(
        F.avg("value").alias("mean"),
        F.sum("growth").alias("growth"),
        F.max(F.when(c("value") > 0, F.struct(c("value").alias("v"), (-F.unix_micros("ts")).alias("t")))).alias("_p"),
    )
    return out.select(
        *key, "mean", "growth",
        F.coalesce(c("_p.v"), F.lit(0.0)).alias("peak"),
        F.timestamp_micros(-c("_p.t")).alias("peak_time"),
    )


def period_summary(days: DataFrame, value: str = "peak") -> DataFrame:
    """Max with its day and time, min, mean and sum of a daily value over the period."""
    best = F.max(F.struct(c(value).alias("v"), (-F.unix_date("day")).alias("d"), "peak_time"))
    out = days.groupBy("metric", "cluster").agg(
        best.alias("_b"), F.min(value).alias("min"), F.avg(value).alias("avg"), F.sum(value).alias("sum"),
        F.count(F.lit(1)).alias("days"),
    )
    return out.select(
        "metric", "cluster", "days", "min", "avg", "sum",
        c("_b.v").alias("max"), F.date_from_unix_date(-c("_b.d")).alias("max_day"), c("_b.peak_time").alias("max_time"),
    )


def against_previous(days: DataFrame, start: str, length: int, value: str = "growth") -> DataFrame:
    """A period of ``length`` days from ``start`` next to the equally long period before it."""
    first = F.to_date(F.lit(start))
    current = c("day").between(first, F.date_add(first, length - 1))
    before = c("day").between(F.date_sub(first, length), F.date_sub(first, 1))
    out = days.groupBy("metric", "cluster").agg(
        F.sum(F.when(current, c(value))).alias("current"), F.sum(F.when(before, c(value))).alias("previous")
    )
    moved = F.when(c("previous") > 0, (c("current") - c("previous")) / c("previous") * 100).otherwise(F.lit(0.0))
    return out.withColumn("change", moved)


def trend(days: DataFrame, value: str = "peak", *, percent: float = 20.0) -> DataFrame:
    """First against last day per metric: rising or falling beyond the given percentage."""
    out = days.groupBy("metric", "cluster").agg(
        F.min_by(value, "day").alias("first"), F.max_by(value, "day").alias("last")
    )
    moved = F.when(c("first") > 0, (c("last") - c("first")) / c("first") * 100).otherwise(F.lit(0.0))
    direction = (
        F.when(moved > percent, F.lit("rising")).when(moved < -percent, F.lit("falling")).otherwise(F.lit("stable"))
    )
    return out.withColumns({"change": moved, "direction": direction})


def limit_breaches(summary: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Metrics whose period maximum passes their limit."""
    limit = None
    for name, bound in limits.items():
        test = c("metric") == F.lit(name)
        limit = F.when(test, F.lit(bound)) if limit is None else limit.when(test, F.lit(bound))
    return summary.withColumn("limit", limit).filter(c("max") > c("limit")).select(
        "metric", "cluster", "max", "max_day", "limit"
    )


def catalogue_report(
    df: DataFrame, *, seconds: int = 120, cpu_limit: float = 85.0, ghost: dict[str, float] | None = None, fit_seconds: int = 300
) -> DataFrame:
    """Every catalogue entry for which the table has series, per cluster: value, time, status.

    Samples are tagged with the entries they feed, so the entries share one pass per function. A counter
    that passes its entry's ghost-reset limit (``ghost`` overrides limits by name) is taken from fitted
    slopes instead, where those are plausible; such a value has no peak time.
    """
    tags = None
    for name, series, function, *_ in CATALOGUE:
        for s in series:
            row = F.when(c("metric") == s, F.struct(F.lit(name).alias("name"), F.lit(function).alias("function")))
            tags = [row] if tags is None else tags + [row]
    tagged = (
        increments(df)
        .withColumn("tag", F.explode(F.array_compact(F.array(*tags))))
        .select("tag.name", "tag.function", *SERIES, "ts", "value", "growth")
    )
    slot = F.window("ts", f"{seconds} seconds")["start"]
    per_slot = tagged.groupBy("name", "function", "cluster", slot.alias("slot")).agg(
        F.sum("growth").alias("growth"), F.avg("value").alias("mean"), F.sum("value").alias("total")
    )
    rated = per_slot.withColumn(
        "v",
        F.when(c("function") == "rate_peak", c("growth") / F.lit(float(seconds)))
        .when(c("function") == "mean_peak", c("mean"))
        .when(c("function") == "sum_peak", c("total"))
        .otherwise(c("growth")),
    )
    ranged = rated.groupBy("name", "function", "cluster").agg(
        F.max(F.when(c("v") > 0, F.struct("v", (-F.unix_micros("slot")).alias("t")))).alias("best"),
        F.sum("growth").alias("growth"),
    )
    now = tagged.groupBy("name", "cluster", "metric", "instance").agg(
        F.max_by("value", F.struct("ts", "value")).alias("v")
    )
    counted = now.groupBy("name", "cluster").agg(
        F.count(F.lit(1)).alias("all"), F.count_if(c("v") > 0).alias("up"), F.count_if(c("v") > cpu_limit).alias("over")
    )
    whole = slopes(tagged.filter(c("function") == "increase"), ("name",)).groupBy("name", "cluster").agg(F.sum("fitted").alias("fitted"))
    fit_slot = F.window("ts", f"{fit_seconds} seconds")["start"]
    local = tagged.filter(c("function") == "rate_peak").groupBy("name", *SERIES, fit_slot.alias("slot")).agg(_slope().alias("slope"))
    local = local.groupBy("name", "cluster", "slot").agg(F.sum("slope").alias("slope"))
    local = local.groupBy("name", "cluster").agg(F.max("slope").alias("fitted"))
    joined = ranged.join(counted, ["name", "cluster"]).join(whole.unionByName(local), ["name", "cluster"], "left")
    divisor = critical = warning = bound = None
    for name, _, _, scale, limits, guard in CATALOGUE:
        guard = (ghost or {}).get(name, guard)
        test = c("name") == F.lit(name)
        crit, warn = limits or (None, None)
        divisor = F.when(test, F.lit(scale)) if divisor is None else divisor.when(test, F.lit(scale))
        critical = F.when(test, F.lit(crit).cast("double")) if critical is None else critical.when(test, F.lit(crit).cast("double"))
        bound = F.when(test, F.lit(guard).cast("double")) if bound is None else bound.when(test, F.lit(guard).cast("double"))
        warning = F.when(test, F.lit(warn).cast("double")) if warning is None else warning.when(test, F.lit(warn).cast("double"))
    f = c("function")
    value = (
        F.when(f == "increase", c("growth"))
        .when(f == "availability", c("up") * 100.0 / c("all"))
        .when(f == "count_up", c("up").cast("double"))
        .when(f == "count_over", c("over").cast("double"))
        .otherwise(F.coalesce(c("best.v"), F.lit(0.0)))
    )
    out = joined.withColumn("raw", value / divisor)
    out = out.withColumn("value", corrected(c("raw"), c("fitted") / divisor, bound))
    status = (
        F.when(c("value") >= critical, F.lit("critical")).when(c("value") >= warning, F.lit("warning")).otherwise(F.lit("normal"))
    )
    when = F.when(f.endswith("_peak") & (c("value") == c("raw")), F.timestamp_micros(-c("best.t")))
    return out.select("name", "cluster", "value", when.alias("peak_time"), status.alias("status"))
