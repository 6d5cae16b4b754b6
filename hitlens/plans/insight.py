"""Interactive questions over the enriched table: short ordered result tables with rule columns.

Every function takes the rows it should look at; :func:`hitlens.operators.filters.recent_or_all`
or ``between_times`` supplies the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.functions import clock
from hitlens.operators.measures import flag, mean, rate, summarise
from hitlens.operators.ranking import share_of_total, stack_up, top
from hitlens.rules import descend, ladder, lookup

c = F.col


def _counts() -> dict[str, Column]:
    return {
        "requests": F.lit(1),
        "successes": flag(c("is_success")),
        "errors": flag(c("is_error")),
        "slow": flag(c("is_slow")),
        "ms": c("duration_ms"),
    }


def _rates() -> dict[str, Column]:
    n = c("requests")
    return {
        "avg_ms": mean(c("ms"), n),
        "success_rate": rate(c("successes"), n),
        "error_rate": rate(c("errors"), n),
        "slow_rate": rate(c("slow"), n),
    }


def overview(df: DataFrame) -> DataFrame:
    out = summarise(
        df,
        [],
        sums={**_counts(), "not_found": flag(c("status") == "404"), "failed": flag(c("status") == "500")},
        distinct={"clients": c("client_ip")},
    )
    return out.withColumns(_rates()).select(
        "requests", "clients", "avg_ms", "success_rate", "error_rate", "slow", "not_found", "failed"
    )


def hottest_apis(df: DataFrame, n: int = 10) -> DataFrame:
    """Most requested (uri, category, platform) with latency, error rate and health."""
    out = summarise(
        df, ["uri", "api_category", "platform"], sums=_counts(), quantiles=[(c("duration_ms"), {"p95": 0.95})]
    ).withColumns(_rates())
    health = (
        F.when(c("avg_ms") > 3000, F.lit("Critical"))
        .when((c("avg_ms") > 1000) | (c("error_rate") > 5), F.lit("Warning"))
        .otherwise(F.lit("Healthy"))
    )
    out = out.withColumn("health", F.when(c("avg_ms") == 0, F.lit("Unknown")).otherwise(health))
    best = top(out, [F.desc("requests"), F.asc("uri"), F.asc("api_category"), F.asc("platform")], n)
    return best.select("uri", "api_category", "platform", "requests", "avg_ms", "p95", "success_rate", "error_rate", "health")


def slowest_apis(df: DataFrame, n: int = 10) -> DataFrame:
    out = summarise(
        df.filter(c("duration_ms") > 0),
        ["uri", "platform"],
        sums={**_counts(), "process": c("process_ms"), "transfer": c("front_ms")},
        quantiles=[(c("duration_ms"), {"p95": 0.95})],
    ).withColumns(
        {**_rates(), "avg_process_ms": c("process") / c("requests"), "avg_transfer_ms": c("transfer") / c("requests")}
    )
    problem = (
        F.when((c("process") == 0) & (c("transfer") == 0), F.lit("Unknown"))
        .when(c("avg_process_ms") > 1000, F.lit("后端处理慢"))
        .when(c("avg_transfer_ms") > 500, F.lit("数据传输慢"))
        .when(c("avg_ms") > 3000, F.lit("整体响应慢"))
        .otherwise(F.lit("正常"))
    )
    best = top(out.withColumn("problem", problem), [F.desc("avg_ms"), F.asc("uri"), F.asc("platform")], n)
    return best.select(
        "uri", "platform", "requests", "avg_ms", "p95", "success_rate", "slow", "avg_process_ms", "avg_transfer_ms", "problem"
    )


def platforms(df: DataFrame) -> DataFrame:
    out = summarise(df, ["platform"], sums=_counts(), distinct={"clients": c("client_ip")})
    return share_of_total(out.withColumns(_rates()), "requests", source=df).select(
        "platform", "requests", "clients", "share", "avg_ms", "success_rate"
    )


def error_alerts(df: DataFrame, threshold: float = 5.0) -> DataFrame:
    """(uri, status, platform) whose error rate reaches the threshold; HIGH over 20 %."""
    out = summarise(df.filter(c("duration_ms") > 0), ["uri", "status", "platform"], sums=_counts()).withColumns(_rates())
    alert = descend(c("error_rate"), [(20, "HIGH")], "MEDIUM")
    return out.filter(c("error_rate") >= threshold).select(
        "uri", "status", "platform", "requests", "errors", "error_rate", alert.alias("alert")
    )


def status_distribution(df: DataFrame) -> DataFrame:
    out = summarise(df, ["status"], sums=_counts(), distinct={"clients": c("client_ip")}).withColumns(_rates())
    out = share_of_total(out, "requests", source=df)
    kind = lookup(
        F.substring("status", 1, 1),
        {"1": "Info", "2": "Success", "3": "Redirect", "4": "Client Error", "5": "Server Error"},
        "Unknown",
    )
    severity = (
        F.when(c("status").startswith("5") & (c("share") > 1), F.lit("Critical"))
        .when(c("status").startswith("4") & (c("share") > 10), F.lit("High"))
        .when(c("share") > 50, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )
    return out.select("status", "requests", "share", "avg_ms", "clients", kind.alias("kind"), severity.alias("severity"))


def error_trend(df: DataFrame) -> DataFrame:
    out = summarise(
        df,
        ["hour"],
        sums={**_counts(), "client_errors": flag(c("status").startswith("4")), "server_errors": flag(c("status").startswith("5"))},
    ).withColumns(_rates())
    level = ladder(c("error_rate"), [(1, "Excellent"), (5, "Good"), (10, "Warning")], "Critical", strict=True)
    return out.select("hour", "requests", "client_errors", "server_errors", "errors", "error_rate", level.alias("health"))


def critical_errors(df: DataFrame, n: int | None = 20) -> DataFrame:
    """Errors per status, URI and platform with priority; the n most frequent, or all."""
    out = summarise(
        df.filter(c("status").isin("500", "502", "503", "504", "404")),
        ["status", "uri", "platform"],
        sums={"errors": F.lit(1)},
        maxs={"last_seen": c("log_time")},
        distinct={"clients": c("client_ip")},
    )
    priority = (
        F.when((c("status") != "404") & (c("errors") > 10), F.lit("P0"))
        .when(c("status") != "404", F.lit("P1"))
        .when(c("errors") > 50, F.lit("P2"))
        .otherwise(F.lit("P3"))
    )
    impact = descend(c("clients"), [(100, "High"), (10, "Medium")], "Low")
    out = out.withColumns({"priority": priority, "impact": impact})
    return out if n is None else top(out, [F.desc("errors"), F.asc("status"), F.asc("uri"), F.asc("platform")], n)


def day_pattern(df: DataFrame) -> DataFrame:
    """24-hour pattern with traffic intensity (percent of the busiest hour) and business period."""
    out = summarise(df, ["hour"], sums=_counts(), distinct={"clients": c("client_ip"), "apis": c("uri")}).withColumns(_rates())
    peak = out.agg(F.max("requests")).scalar()
    return out.select(
        "hour", "requests", "clients", "apis", "avg_ms", "success_rate", "slow",
        (c("requests") * 100.0 / peak).alias("intensity"),
        clock.business_period(c("hour")).alias("period"),
    )


def peaks(df: DataFrame) -> DataFrame:
    """Busiest and quietest hour of day (ties: the earlier hour), ratio and volatility."""
    hours = df.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))
    out = hours.agg(
        F.max("n").alias("peak"),
        F.min("n").alias("valley"),
        F.avg("n").alias("average"),
        F.min_by("hour", F.struct(-c("n"), c("hour"))).alias("peak_hour"),
        F.min_by("hour", F.struct(c("n"), c("hour"))).alias("valley_hour"),
    )
    ratio = c("peak") / c("valley")
    return out.withColumns(
        {"ratio": ratio, "volatility": descend(ratio, [(10, "High"), (5, "Medium"), (2, "Low")], "Stable")}
    )


def latency_trend(df: DataFrame) -> DataFrame:
    out = summarise(
        df.filter(c("duration_ms") > 0),
        ["hour"],
        sums={"requests": F.lit(1), "ms": c("duration_ms")},
        maxs={"max_ms": c("duration_ms")},
        quantiles=[(c("duration_ms"), {"p50": 0.5, "p95": 0.95, "p99": 0.99})],
    ).withColumn("avg_ms", c("ms") / c("requests"))
    grade = (
        F.when((c("avg_ms") < 100) & (c("p95") < 500), F.lit("A"))
        .when((c("avg_ms") < 500) & (c("p95") < 1000), F.lit("B"))
        .when((c("avg_ms") < 1000) & (c("p95") < 2000), F.lit("C"))
        .otherwise(F.lit("D"))
    )
    return out.withColumn("grade", grade).drop("ms")


def business_hours(df: DataFrame) -> DataFrame:
    """Business (9-18) against other hours, one row, with the user pattern."""
    inside = c("hour").between(9, 18)
    out = summarise(
        df,
        [],
        sums={
            "business_requests": flag(inside),
            "off_requests": flag(~inside),
            "b_ms": F.when(inside, c("duration_ms")),
            "o_ms": F.when(~inside, c("duration_ms")),
        },
        distinct={"business_clients": F.when(inside, c("client_ip")), "off_clients": F.when(~inside, c("client_ip"))},
    )
    b, o = c("business_clients"), c("off_clients")
    pattern = (
        F.when(b > o * 3, F.lit("典型工作日模式"))
        .when(b > o, F.lit("轻度工作日模式"))
        .when(b == o, F.lit("全天均衡模式"))
        .otherwise(F.lit("非工作时间活跃"))
    )
    return out.select(
        "business_requests", "off_requests", "business_clients", "off_clients",
        mean(c("b_ms"), c("business_requests")).alias("business_ms"),
        mean(c("o_ms"), c("off_requests")).alias("off_ms"),
        (c("business_requests") / c("off_requests")).alias("load_ratio"),
        pattern.alias("pattern"),
    )


def traffic_overview(df: DataFrame) -> DataFrame:
    """Visitors, requests per session and engagement."""
    out = summarise(
        df,
        [],
        sums={"requests": F.lit(1)},
        distinct={
            "visitors": c("client_ip"),
            "sessions": c("session_id"),
            "platforms": c("platform"),
            "categories": c("api_category"),
        },
    ).withColumn("depth", c("requests") / c("sessions"))
    return out.withColumn("engagement", descend(c("depth"), [(10, "High"), (5, "Medium")], "Low", strict=False))


def platform_mix(df: DataFrame) -> DataFrame:
    out = summarise(
        df, ["platform", "device", "entry_source"], sums=_counts(), distinct={"clients": c("client_ip"), "sessions": c("session_id")}
    ).withColumns({**_rates(), "depth": c("requests") / c("sessions")})
    return out.select(
        "platform", "device", "entry_source", "requests", "clients", "avg_ms", "success_rate", "depth",
        descend(c("depth"), [(10, "High"), (5, "Medium")], "Low", strict=False).alias("engagement"),
    )


def categories(df: DataFrame) -> DataFrame:
    out = summarise(df, ["api_category"], sums=_counts(), distinct={"clients": c("client_ip")}).withColumns(_rates())
    return share_of_total(out, "requests", source=df).select(
        "api_category", "requests", "share", "clients", "avg_ms", "slow", "slow_rate"
    )


def hourly_traffic(df: DataFrame) -> DataFrame:
    out = summarise(df, ["hour"], sums=_counts(), distinct={"clients": c("client_ip")}).withColumns(_rates())
    level = descend(c("requests"), [(1000, "Peak"), (500, "High"), (100, "Medium")], "Low", strict=False)
    return out.select("hour", "requests", "clients", "avg_ms", "error_rate", level.alias("level"))


def _region() -> Column:
    ip = c("client_ip")
    return (
        F.when(ip.rlike(r"^(10\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.)"), F.lit("Internal"))
        .when(ip.startswith("127."), F.lit("Localhost"))
        .when(ip.startswith("169.254."), F.lit("Link-Local"))
        .when(ip != "", F.lit("External"))
        .otherwise(F.lit("Unknown"))
    )


def top_clients(df: DataFrame, n: int = 20) -> DataFrame:
    out = summarise(
        df,
        ["client_ip"],
        sums=_counts(),
        mins={"first_seen": c("log_time")},
        maxs={"last_seen": c("log_time")},
        distinct={"apis": c("uri"), "platforms": c("platform")},
    ).withColumns(_rates())
    requests = c("requests")
    behaviour = (
        F.when(requests > 1000, F.lit("High Volume"))
        .when(c("apis") > 20, F.lit("API Explorer"))
        .when(c("platforms") > 3, F.lit("Multi-Platform"))
        .when(requests > 100, F.lit("Active User"))
        .otherwise(F.lit("Normal User"))
    )
    risk = (
        descend(requests, [(10000, 40), (1000, 20), (100, 5)], 0)
        + ladder(c("success_rate"), [(50, 30), (80, 15), (95, 5)], 0, strict=True)
        + descend(c("errors"), [(100, 30), (50, 15), (10, 5)], 0)
    )
    out = out.withColumns({"region": _region(), "behaviour": behaviour, "risk": F.least(risk, F.lit(100))})
    return top(out, [F.desc("requests"), F.asc("client_ip")], n).select(
        "client_ip", "requests", "apis", "platforms", "avg_ms", "success_rate", "errors", "first_seen", "last_seen",
        "region", "behaviour", "risk",
    )


def regions(df: DataFrame) -> DataFrame:
    out = summarise(
        df, {"region": _region()}, sums=_counts(), distinct={"clients": c("client_ip"), "platforms": c("platform")}
    ).withColumns(_rates())
    trust = lookup(c("region"), {"Internal": "Trusted", "Localhost": "Trusted", "External": "Monitor"}, "Caution")
    return share_of_total(out, "requests", source=df).select(
        "region", "requests", "share", "clients", "platforms", "avg_ms", "success_rate", trust.alias("trust")
    )


def suspicious_clients(df: DataFrame, n: int | None = 20) -> DataFrame:
    """Clients with more than 50 requests, 10 errors or 20 not-found answers; threat and activity."""
    out = summarise(
        df,
        ["client_ip"],
        sums={**_counts(), "not_found": flag(c("status") == "404")},
        maxs={"last_seen": c("log_time")},
        distinct={"paths": c("uri")},
    ).withColumns(_rates())
    out = out.filter((c("requests") > 50) | (c("errors") > 10) | (c("not_found") > 20))
    r, e, nf = c("requests"), c("errors"), c("not_found")
    threat = (
        F.when((r > 10000) | (e > 1000), F.lit("High"))
        .when((r > 1000) | (e > 100) | (nf > 500), F.lit("Medium"))
        .when((r > 100) | (e > 10), F.lit("Low"))
        .otherwise(F.lit("Minimal"))
    )
    activity = (
        F.when(nf > r * 0.5, F.lit("Scanner/Crawler"))
        .when(e > r * 0.3, F.lit("Error Generator"))
        .when(c("paths") > r * 0.8, F.lit("Path Explorer"))
        .when(r > 1000, F.lit("Heavy User"))
        .otherwise(F.lit("Normal Activity"))
    )
    out = out.withColumns({"threat": threat, "activity": activity}).select(
        "client_ip", "requests", "paths", "errors", "not_found", "slow", "last_seen", "avg_ms", "threat", "activity"
    )
    return out if n is None else top(out, [F.desc("requests"), F.asc("client_ip")], n)


def client_diversity(df: DataFrame) -> DataFrame:
    out = summarise(
        df,
        [],
        sums={"requests": F.lit(1), "ms": c("duration_ms")},
        distinct={"clients": c("client_ip"), "platforms": c("platform"), "categories": c("api_category")},
    )
    per = c("requests") / c("clients")
    return out.select(
        "requests", "clients", "platforms", "categories",
        (c("ms") / c("requests")).alias("avg_ms"),
        per.alias("requests_per_client"),
        F.least(F.lit(100.0), c("clients") * 100.0 / c("requests")).alias("diversity"),
        descend(per, [(1000, "Highly Concentrated"), (100, "Concentrated"), (10, "Moderate")], "Distributed").alias("concentration"),
    )


def agent_analysis(df: DataFrame) -> DataFrame:
    """Platform and device with browser family, system family and performance grade."""
    out = summarise(df, ["platform", "device"], sums=_counts(), distinct={"clients": c("client_ip")}).withColumns(_rates())
    p = F.lower("platform")
    engine = (
        F.when(p.rlike("chrome|android"), F.lit("Webkit-based"))
        .when(p.contains("firefox"), F.lit("Gecko-based"))
        .when(p.rlike("safari|ios"), F.lit("WebKit-Safari"))
        .when(p.contains("sdk"), F.lit("Native-SDK"))
        .otherwise(F.lit("Other"))
    )
    system = (
        F.when(p.contains("windows"), F.lit("Windows"))
        .when(p.rlike("mac|osx"), F.lit("macOS"))
        .when(p.contains("linux"), F.lit("Linux"))
        .when(p.contains("android"), F.lit("Android"))
        .when(p.rlike("ios|iphone"), F.lit("iOS"))
        .otherwise(F.lit("Unknown"))
    )
    grade = (
        F.when((c("avg_ms") < 500) & (c("slow_rate") < 5), F.lit("Excellent"))
        .when((c("avg_ms") < 1000) & (c("slow_rate") < 10), F.lit("Good"))
        .when((c("avg_ms") < 2000) & (c("slow_rate") < 20), F.lit("Fair"))
        .otherwise(F.lit("Poor"))
    )
    out = share_of_total(out, "requests", source=df)
    return out.select(
        "platform", "device", "requests", "share", "clients", "avg_ms", "success_rate", "slow", "errors",
        F.when(p.rlike("bot|crawler"), F.lit("Bot")).otherwise(F.lit("Normal")).alias("category"),
        engine.alias("engine"), system.alias("system"), grade.alias("grade"),
    )


def agent_counts(df: DataFrame) -> DataFrame:
    return summarise(
        df, [], distinct={"platforms": c("platform"), "browsers": c("browser"), "systems": c("os"), "devices": c("device")}
    )


def referer_analysis(df: DataFrame) -> DataFrame:
    out = summarise(
        df,
        ["entry_source"],
        sums=_counts(),
        distinct={"clients": c("client_ip"), "apis": c("uri"), "sessions": c("session_id")},
    ).withColumns({**_rates(), "depth": c("requests") / c("sessions")})
    source = F.lower("entry_source")
    kind = (
        F.when(c("entry_source") == "Direct", F.lit("Direct"))
        .when(source.rlike("google|baidu"), F.lit("Search Engine"))
        .when(source.rlike("social|wechat"), F.lit("Social Media"))
        .when(source.rlike("api|app"), F.lit("API/App"))
        .otherwise(F.lit("External Link"))
    )
    points = (
        descend(c("success_rate"), [(95, 30), (90, 20), (80, 10)], 0)
        + descend(c("depth"), [(5, 30), (2, 20), (1, 10)], 0)
        + descend(c("apis"), [(10, 40), (5, 30), (2, 20)], 0)
    )
    out = share_of_total(out, "requests", source=df)
    return out.select(
        "entry_source", "requests", "share", "clients", "apis", "avg_ms", "success_rate", "depth",
        kind.alias("kind"),
        descend(c("depth"), [(10, "Very High"), (5, "High"), (2, "Medium")], "Low", strict=False).alias("engagement"),
        descend(points, [(80, "Excellent"), (60, "Good"), (40, "Fair")], "Poor", strict=False).alias("quality"),
    )


def platform_performance(df: DataFrame) -> DataFrame:
    out = summarise(
        df.filter(c("duration_ms") > 0),
        ["platform", "device"],
        sums={**_counts(), "process": c("process_ms"), "transfer": c("front_ms")},
        quantiles=[(c("duration_ms"), {"p50": 0.5, "p95": 0.95, "p99": 0.99})],
        distinct={"clients": c("client_ip")},
    ).withColumns(
        {**_rates(), "backend_ms": c("process") / c("requests"), "transfer_ms": c("transfer") / c("requests")}
    )
    lost = (
        descend(c("avg_ms"), [(3000, 40), (1000, 20), (500, 10)], 0)
        + descend(c("p95"), [(5000, 30), (2000, 15), (1000, 5)], 0)
        + ladder(c("success_rate"), [(90, 20), (95, 10), (99, 5)], 0, strict=True)
    )
    bottleneck = (
        F.when((c("process") == 0) | (c("transfer") == 0), F.lit("Unknown"))
        .when(c("backend_ms") / c("avg_ms") > 0.7, F.lit("Backend Processing"))
        .when(c("transfer_ms") / c("avg_ms") > 0.3, F.lit("Network Transfer"))
        .when(c("avg_ms") > 3000, F.lit("Overall Slow"))
        .otherwise(F.lit("Balanced"))
    )
    weight = c("requests") * 0.3 + c("slow") * 0.5 + c("avg_ms") / 1000 * 0.2
    return out.select(
        "platform", "device", "requests", "clients", "avg_ms", "p50", "p95", "p99", "slow", "slow_rate", "success_rate",
        "backend_ms", "transfer_ms",
        F.greatest(F.lit(0), F.lit(100) - lost).alias("score"),
        bottleneck.alias("bottleneck"),
        descend(weight, [(1000, "Critical"), (500, "High"), (100, "Medium")], "Low").alias("priority"),
    )


def performance_overview(df: DataFrame) -> DataFrame:
    square = (c("duration_ms") * c("duration_ms")).cast("double")
    out = summarise(
        df,
        [],
        sums={"requests": F.lit(1), "slow": flag(c("is_slow")), "ms": c("duration_ms"), "ms2": square},
        distinct={"platforms": c("platform")},
    )
    avg = c("ms") / c("requests")
    sd = F.sqrt(F.greatest(F.lit(0.0), c("ms2") / c("requests") - avg * avg))
    return out.select("platforms", "slow", avg.alias("avg_ms"), F.round(sd / avg * 100, 4).alias("variation"))


def bots(df: DataFrame, hours: int = 24, n: int = 10) -> DataFrame:
    """Crawlers: requests per day, kind, load, effect."""
    out = summarise(df.filter("bot_type is not null"), ["bot_type"], sums=_counts()).withColumns(
        {**_rates(), "per_day": c("requests") / F.lit(max(hours, 1) / 24.0)}
    )
    name = F.lower("bot_type")
    kind = (
        F.when(name.rlike("google|bingbot"), F.lit("Search"))
        .when(name.rlike("monitor|check"), F.lit("Monitor"))
        .when(name.rlike("facebook|twitter"), F.lit("Social"))
        .otherwise(F.lit("Other"))
    )
    load = descend(c("requests") * (c("avg_ms") / 1000.0), [(10000, "High"), (1000, "Medium")], "Low")
    effect = (
        F.when((c("success_rate") > 90) & (c("per_day") < 100), F.lit("Positive"))
        .when((c("success_rate") < 70) | (c("per_day") > 1000), F.lit("Negative"))
        .otherwise(F.lit("Neutral"))
    )
    best = top(out, [F.desc("requests"), F.asc("bot_type")], n)
    return best.select(
        "bot_type", "requests", "avg_ms", "per_day", "success_rate", kind.alias("kind"), load.alias("load"), effect.alias("effect")
    )


def header_risks(df: DataFrame, *, min_requests: int = 10) -> DataFrame:
    """Risk of every (platform, source, device) pattern: load per client, errors, path variety."""
    out = summarise(
        df, ["platform", "entry_source", "device"], sums=_counts(), distinct={"clients": c("client_ip"), "paths": c("uri")}
    ).filter(c("requests") > min_requests).withColumns(_rates())
    per = c("requests") / c("clients")
    risk = (
        descend(per, [(1000, 40), (100, 20), (50, 10)], 0)
        + descend(c("error_rate"), [(50, 30), (20, 15), (10, 5)], 0)
        + F.when(c("paths") / c("requests") > 0.5, 20).otherwise(0)
        + F.when((c("platform") == "Unknown") | F.lower("platform").contains("bot"), 15).otherwise(0)
    )
    out = out.withColumns({"per_client": per, "risk": F.least(risk, F.lit(100))})
    level = descend(c("risk"), [(80, "Critical"), (60, "High"), (40, "Medium"), (20, "Low")], "Minimal")
    return out.select(
        "platform", "entry_source", "device", "requests", "clients", "paths", "errors", "avg_ms", "per_client", "error_rate",
        "risk", level.alias("level"),
    )


def header_risk_summary(risks: DataFrame) -> DataFrame:
    r = c("risk")
    return risks.agg(
        F.count(F.lit(1)).alias("patterns"),
        F.count_if(r > 50).alias("suspicious"),
        F.count_if(r > 80).alias("high"),
        F.count_if((r > 50) & (r <= 80)).alias("medium"),
        F.count_if((r <= 50) & (r > 20)).alias("low"),
    )


def table_statistics(df: DataFrame, quality: Column | None = None) -> DataFrame:
    """Totals, time range, rates and mean quality of a table."""
    score = F.lit(100.0) if quality is None else quality
    out = summarise(
        df,
        [],
        sums={**_counts(), "anomalies": flag(c("has_anomaly")), "quality": score},
        mins={"first_time": c("log_time")},
        maxs={"last_time": c("log_time")},
    ).withColumns(_rates())
    return out.select(
        "requests", "first_time", "last_time", "success_rate", "slow_rate",
        rate(c("anomalies"), c("requests")).alias("anomaly_rate"),
        F.round(c("quality") / c("requests"), 6).alias("avg_quality"),
    )


def dimension_analysis(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Totals, rates and mean per label of several dimensions, one pass."""
    entries = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("label")) for d in dimensions]
    )
    rows = df.select(
        "duration_ms", "is_success", "is_error", "is_slow", "has_anomaly", F.explode(entries).alias("d")
    ).select("*", "d.dimension", "d.label")
    out = summarise(rows, ["dimension", "label"], sums={**_counts(), "anomalies": flag(c("has_anomaly"))})
    return out.withColumns({**_rates(), "anomaly_rate": rate(c("anomalies"), c("requests"))}).drop("ms")


def platform_detail(df: DataFrame, platform: str) -> DataFrame:
    """Category and status split of one platform in long form, with the platform's totals on top."""
    rows = df.filter(c("platform") == F.lit(platform))
    split = dimension_analysis(rows, ["platform", "api_category", "status"])
    return split.select("dimension", "label", "requests", "avg_ms", "success_rate", "slow_rate")


def security_score(df: DataFrame) -> DataFrame:
    """100 less 2 per suspicious client and 1.5 per critical error, all of them, never below 0."""
    marks = stack_up(
        [
            suspicious_clients(df, None).select(F.lit(1).alias("suspicious"), F.lit(0).alias("critical")),
            critical_errors(df, None).select(F.lit(0).alias("suspicious"), F.lit(1).alias("critical")),
        ]
    )
    out = marks.agg(
        F.coalesce(F.sum("suspicious"), F.lit(0)).alias("suspicious"),
        F.coalesce(F.sum("critical"), F.lit(0)).alias("critical"),
    )
    score = F.lit(100.0) - c("suspicious") * 2 - c("critical") * 1.5
    return out.withColumn("security_score", F.greatest(F.lit(0.0), score))


def combined_report(df: DataFrame) -> DataFrame:
    """Section, rank, name and value of the whole report: overview, hot, slow, alerts, health."""
    head = overview(df)
    facts = F.array(
        *[
            F.struct(F.lit(name).alias("name"), c(name).cast("double").alias("value"))
            for name in ("requests", "clients", "avg_ms", "success_rate", "error_rate")
        ],
        F.struct(F.lit("stability_score").alias("name"), F.least(F.lit(100.0), c("success_rate")).alias("value")),
        F.struct(
            F.lit("latency_score").alias("name"), F.greatest(F.lit(0.0), F.lit(100.0) - c("avg_ms") / 30).alias("value")
        ),
    )
    top_part = head.select(F.explode(facts).alias("f")).select(
        F.lit("overview").alias("section"), c("f.name").alias("name"), F.round("f.value", 6).alias("value")
    )
    hot = hottest_apis(df, 5).select(F.lit("hot").alias("section"), c("uri").alias("name"), c("requests").cast("double").alias("value"))
    slow = slowest_apis(df, 5).select(F.lit("slow").alias("section"), c("uri").alias("name"), F.round("avg_ms", 6).alias("value"))
    alerts = error_alerts(df).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("alerts").alias("section"), F.lit("count").alias("name"), c("n").cast("double").alias("value")
    )
    return stack_up([top_part, hot, slow, alerts])
