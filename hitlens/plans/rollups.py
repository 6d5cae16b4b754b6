"""Hourly rollups of the enriched table. Durations are ms; all grouping keys are output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.functions import agent, business, status, uri
from hitlens.operators.measures import apdex, deviation, flag, rate, summarise
from hitlens.operators.ordered import framed, spans
from hitlens.operators.ranking import share_in_group, with_totals
from hitlens.rules import descend
from hitlens.schema import DEFAULTS, Thresholds

c = F.col
P50_99 = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
HOUR = "stat_hour"


def _ok() -> Column:
    return c("is_success")


def _ms() -> Column:
    return c("duration_ms")


def _counts(limits: Thresholds = DEFAULTS) -> dict[str, Column]:
    """Additive measures most rollups share."""
    return {
        "requests": F.lit(1),
        "successes": flag(_ok()),
        "errors": flag(~_ok()),
        "ms": _ms(),
    }


def _flags() -> dict[str, Column]:
    return {
        "attention": flag(_ms() > 500),
        "warning": flag(_ms() > 1000),
        "slow": flag(_ms() > 3000),
        "very_slow": flag(_ms() > 10000),
        "timeout": flag(_ms() > 30000),
    }


def _apdex_parts(limits: Thresholds) -> dict[str, Column]:
    return {
        "satisfied": flag(_ms() <= limits.apdex_ms),
        "tolerated": flag((_ms() > limits.apdex_ms) & (_ms() <= limits.apdex_tolerated_ms)),
    }


def _avg(total: str = "ms") -> Column:
    return c(total) / c("requests")


def _share(part: str) -> Column:
    return rate(c(part), c("requests"))


def satisfaction() -> Column:
    """60 % success rate, 40 % what 10 points per second of mean latency leave."""
    return F.least(F.lit(100.0), _share("successes") * 0.6 + F.greatest(F.lit(0.0), F.lit(100.0) - _avg() / 1000 * 10) * 0.4)


def api_performance(df: DataFrame, limits: Thresholds = DEFAULTS, *, exact: bool = True) -> DataFrame:
    keys = [
        HOUR, "tenant", "environment", "platform", "access_type", "entry_point", "channel", "client_type", "uri",
        "api_category", "module", "business_domain", "operation",
    ]
    derived = {
        "team": business.team(c("server_name"), c("business_domain")),
        "platform_category": agent.platform_category(c("user_agent")),
        "api_version": uri.api_version(c("request_uri")),
    }
    out = summarise(
        df,
        {**{k: c(k) for k in keys}, **derived},
        sums={
            **_counts(),
            **_flags(),
            **_apdex_parts(limits),
            "business_ok": flag(c("is_business_success")),
            "levels": c("performance_level"),
            **{f"level_{i}": flag(c("performance_level") == i) for i in range(1, 7)},
            "upstream_ms": c("response_ms"),
            "upstream_slow": flag(c("response_ms") > 3000),
        },
        maxs={"max_ms": _ms()},
        quantiles=[(_ms(), {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99})],
        distinct={"clients": c("client_ip")},
        exact=exact,
    )
    return out.withColumns(
        {
            "qps": c("requests") / F.lit(3600.0),
            "avg_ms": _avg(),
            "success_rate": _share("successes"),
            "error_rate": _share("errors"),
            "business_rate": _share("business_ok"),
            **{f"{f}_rate": _share(f) for f in _flags()},
            "avg_level": c("levels") / c("requests"),
            "apdex": apdex(c("satisfied"), c("tolerated"), c("requests")),
            "satisfaction": F.round(satisfaction(), 6),
            "avg_upstream_ms": _avg("upstream_ms"),
        }
    ).drop("ms", "levels", "upstream_ms", "business_ok", "satisfied", "tolerated")


def service_level(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    keys = {
        **{k: c(k) for k in (HOUR, "tenant", "environment", "platform", "access_type", "service", "upstream_addr")},
        "team": business.team(c("server_name"), c("business_domain")),
        "service_tier": business.service_tier(c("application"), c("service"), c("is_static")),
        "node": F.substring_index("upstream_addr", ":", 1),
    }
    out = summarise(
        df,
        keys,
        sums={
            **_counts(),
            "below_400": flag(c("status").try_cast("int") < 400),
            "in_time": flag(_ms() <= limits.slow_ms),
            "anomalies": flag(c("has_anomaly")),
            "business_ok": flag(c("is_business_success")),
            "value": c("value_score"),
        },
        quantiles=[(_ms(), {"p95": 0.95, "p99": 0.99})],
        distinct={"clients": c("client_ip")},
    )
    return out.select(
        *keys, "requests", "clients", "p95", "p99", "anomalies",
        (c("requests") / F.lit(3600.0)).alias("qps"),
        _share("successes").alias("availability"),
        _share("below_400").alias("below_400_rate"),
        _avg().alias("avg_ms"),
        _share("in_time").alias("performance_sla"),
        c("ms").alias("total_ms"),
        _share("anomalies").alias("anomaly_rate"),
        _share("business_ok").alias("business_rate"),
        (c("value") / c("requests")).alias("avg_value"),
    )


def size_class() -> Column:
    return descend(c("body_bytes"), [(1024 * 1024, "large_response"), (100 * 1024, "medium_response")], "small_response")


def agent_class() -> Column:
    return (
        F.when(c("is_bot"), F.lit("bot")).when(c("device") == "手机", F.lit("mobile")).otherwise(F.lit("desktop"))
    )


def connection_class(df: DataFrame) -> Column:
    """By the requests that came over the connection; a log without that number counts as one request each."""
    n = c("connection_requests") if "connection_requests" in df.columns else F.lit(1)
    return descend(n, [(100, "high_concurrency"), (10, "medium_concurrency")], "low_concurrency")


def slow_requests(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    reason = (
        F.when(c("response_ms") > 5000, F.lit("database_slow"))
        .when(c("connect_ms") > 1000, F.lit("connection_slow"))
        .when(c("process_ms") > 3000, F.lit("processing_slow"))
        .otherwise(F.lit("network_slow"))
    )
    bottleneck = (
        F.when(c("response_ms") / _ms() > 0.8, F.lit("backend_bottleneck"))
        .when(c("network_ms") / _ms() > 0.3, F.lit("network_bottleneck"))
        .otherwise(F.lit("application_bottleneck"))
    )
    keys = {
        **{k: c(k) for k in (HOUR, "platform", "access_type", "uri", "upstream_addr")},
        "reason": reason,
        "bottleneck": bottleneck,
        "connection_class": connection_class(df),
        "size_class": size_class(),
        "agent_class": agent_class(),
    }
    out = summarise(
        df.filter(_ms() > limits.slow_ms),
        keys,
        sums={
            "requests": F.lit(1),
            "ms": _ms(),
            "very_slow": flag(_ms() > 10000),
            "timeout": flag(_ms() > 30000),
            "levels": c("performance_level"),
            "value": c("value_score"),
            "upstream": c("response_ms"),
            "network": c("network_ms"),
            "process": c("process_ms"),
        },
        maxs={"max_ms": _ms()},
        quantiles=[(_ms(), {"p95": 0.95})],
        distinct={"clients": c("client_ip")},
    )
    return out.select(
        *keys, "requests", "clients", "very_slow", "timeout", "max_ms", "p95",
        _share("very_slow").alias("very_slow_rate"),
        _share("timeout").alias("timeout_rate"),
        _avg().alias("avg_ms"),
        _avg("levels").alias("avg_level"),
        _avg("value").alias("avg_value"),
        _avg("upstream").alias("avg_upstream_ms"),
        _avg("network").alias("avg_network_ms"),
        _avg("process").alias("avg_process_ms"),
    )


def status_codes(df: DataFrame) -> DataFrame:
    code = c("status").try_cast("int")
    kind = (
        F.when(code.between(400, 499), F.lit("client_error"))
        .when(code.between(500, 599), F.lit("server_error"))
        .when(code.between(300, 399), F.lit("redirection"))
        .otherwise(F.lit("success"))
    )
    out = (
        df.withColumn("kind", kind)
        .groupBy(HOUR, "platform", "access_type", "uri", "module", "api_category", "business_domain", "status", "kind")
        .agg(F.count(F.lit(1)).alias("requests"))
    )
    return share_in_group(out, [HOUR, "platform", "access_type"], "requests")


def time_dimension(df: DataFrame) -> DataFrame:
    """Hourly totals with peak class and rolling peak and mean over complete hours."""

    hour, workday = c("hour"), c("weekday") <= 5
    peak = (
        F.when(hour.between(9, 11) | hour.between(14, 16), F.lit("peak_hours"))
        .when(hour.between(8, 18), F.lit("business_hours"))
        .otherwise(F.lit("off_hours"))
    )
    business = F.when(workday & hour.between(8, 18), F.lit("business_hours")).otherwise(F.lit("non_business_hours"))
    keys = {HOUR: c(HOUR), "peak_period": peak, "business_hours": business}
    out = summarise(
        df,
        keys,
        sums={**_counts(), "slow": flag(c("is_slow"))},
        quantiles=[(_ms(), {"p50": 0.5, "p95": 0.95})],
        distinct={"clients": c("client_ip")},
    )
    frames = {
        "peak_7h": lambda w: F.max("requests").over(w.rowsBetween(-6, 0)),
        "mean_24h": lambda w: F.avg("requests").over(w.rowsBetween(-23, 0)),
    }
    out = framed(out, [HOUR, "peak_period", "business_hours"], spans(c(HOUR)), frames, before=23)
    return out.withColumns(
        {
            "qps": c("requests") / F.lit(3600.0),
            "avg_ms": _avg(),
            "success_rate": _share("successes"),
            "error_rate": _share("errors"),
            "slow_rate": _share("slow"),
        }
    ).drop("ms", "successes", "errors", "slow")


def error_drilldown(df: DataFrame) -> DataFrame:
    code = c("status").try_cast("int")
    keys = {
        **{k: c(k) for k in (HOUR, "platform", "access_type", "uri", "status", "upstream_addr")},
        "error_group": F.when(code < 500, F.lit("4xx_client")).otherwise(F.lit("5xx_server")),
        "severity": F.when(c("status").isin("500", "502", "503", "504"), F.lit("critical"))
        .when(c("status").isin("401", "403", "429"), F.lit("high"))
        .otherwise(F.lit("medium")),
        "location": F.when(c("status").isin("502", "503", "504"), F.lit("gateway"))
        .when(c("upstream_addr") != "", F.lit("service"))
        .otherwise(F.lit("application")),
        "operation_class": F.when(c("request_uri").rlike("login|auth"), F.lit("login"))
        .when(c("request_uri").rlike("pay|order"), F.lit("payment"))
        .otherwise(F.lit("other")),
        "importance": F.when(c("request_uri").rlike("login|pay"), F.lit("critical")).otherwise(F.lit("normal")),
        "address": F.when(c("is_internal"), F.lit("internal")).otherwise(F.lit("external")),
        "agent_class": agent_class(),
        "http_class": status.http_class(c("status")),
        "journey_stage": c("journey_stage"),
        "user_type": c("user_type"),
        "api_importance": business.importance(c("service"), c("module"), c("is_static")),
        "time_pattern": F.when(c("hour").between(9, 17), F.lit("business_hours")).otherwise(F.lit("off_hours")),
    }
    return summarise(
        df.filter(code >= 400),
        keys,
        sums={"errors": F.lit(1)},
        distinct={"clients": c("client_ip"), "sessions": c("session_id")},
    )


def referer_type() -> Column:
    return (
        F.when(c("referer_domain").rlike(r"google\.|baidu\.|bing\."), F.lit("search"))
        .when(c("referer_domain").isNotNull(), F.lit("referral"))
        .otherwise(F.lit("direct"))
    )


def versions() -> dict[str, Column]:
    """Versions of platform and system, as far as the agent states them."""
    name = c("user_agent")
    return {"platform_version": F.coalesce(agent.platform_version(name, c("platform")), F.lit("")), "os_version": agent.os_version(name)}


def request_headers(df: DataFrame) -> DataFrame:
    """Client software and referer mix with market share inside hour and platform."""
    keys = {
        **{k: c(k) for k in (HOUR, "platform", "browser", "os", "device", "sdk_type", "referer_domain", "search_engine")},
        "referer_type": referer_type(),
        **versions(),
        "sdk_version": agent.sdk_version(c("user_agent")),
        "app_version": agent.app_version(c("user_agent")),
    }
    out = summarise(
        df,
        keys,
        sums={"requests": F.lit(1), "ms": _ms(), "errors": flag(c("is_error")), "slow": flag(c("is_slow"))},
        distinct={"clients": c("client_ip")},
    )
    out = share_in_group(out, [HOUR, "platform"], "requests", "market_share")
    return out.select(
        *keys, "requests", "clients", "market_share",
        _avg().alias("avg_ms"), _share("errors").alias("error_rate"), _share("slow").alias("slow_rate"),
    )


def api_errors(df: DataFrame) -> DataFrame:
    """Errors per API with their share of all requests of the hour.

    Successes are folded into one row per hour, so that errors and hour totals come from one pass.
    """
    bad = ~_ok()
    keys = {HOUR: c(HOUR), "_bad": bad, **{k: F.when(bad, c(k)) for k in ("platform", "uri", "module", "status")}}
    out = summarise(
        df,
        keys,
        sums={
            "requests": F.lit(1),
            "client_errors": flag(c("status").startswith("4")),
            "server_errors": flag(c("status").startswith("5")),
            "slow": flag(_ms() > 3000),
            "timeout": flag(_ms() > 30000),
            "ms": _ms(),
            "upstream": c("response_ms"),
        },
        mins={"first_error": c("log_time")},
        maxs={"last_error": c("log_time"), "max_ms": _ms()},
        distinct={"clients": F.when(bad, c("client_ip"))},
    )
    found = with_totals(out, [HOUR], {"hour_requests": "requests"}).filter("_bad")
    return found.withColumns(
        {
            "avg_ms": _avg(),
            "avg_upstream_ms": _avg("upstream"),
            "share_of_hour": c("requests") * 100.0 / c("hour_requests"),
        }
    ).drop("ms", "upstream", "hour_requests", "_bad")


def ip_source(df: DataFrame) -> DataFrame:
    kind = F.when(c("ip_kind") == "内网IP", F.lit("internal")).otherwise(F.lit("external"))
    out = summarise(
        df,
        {HOUR: c(HOUR), "client_ip": c("client_ip"), "address": kind},
        sums={
            **_counts(),
            "slow": flag(_ms() > 3000),
            "not_found": flag(c("status") == "404"),
            "forbidden": flag(c("status") == "403"),
            "server_errors": flag(c("status").startswith("5")),
        },
        mins={"first_seen": c("log_time")},
        maxs={"last_seen": c("log_time")},
        quantiles=[(_ms(), {"p95": 0.95})],
        distinct={"apis": c("uri"), "agents": c("user_agent")},
    )
    error_share = _share("errors")
    level = descend(error_share, [(50, "high_risk"), (20, "medium_risk"), (5, "low_risk")], "normal")
    return out.withColumns(
        {"avg_ms": _avg(), "success_rate": _share("successes"), "risk_level": level}
    ).drop("ms")


def service_stability(df: DataFrame) -> DataFrame:
    out = summarise(
        df,
        [HOUR, "platform", "service", "module"],
        sums={
            **_counts(),
            "ms2": (_ms() * _ms()).cast("double"),
            "slow": flag(_ms() > 3000),
            "very_slow": flag(_ms() > 10000),
            "timeout": flag(_ms() > 30000),
            "server_errors": flag(c("status").startswith("5")),
            "client_errors": flag(c("status").startswith("4")),
            "upstream": c("response_ms"),
        },
        quantiles=[(_ms(), P50_99)],
    )
    ok = _share("successes")
    sla = descend(ok, [(99.99, "99.99%"), (99.95, "99.95%"), (99.9, "99.9%"), (99.0, "99.0%")], "below_99%", strict=False)
    grade = (
        F.when((ok >= 99.95) & (_avg() <= 1000), F.lit("excellent"))
        .when((ok >= 99.9) & (_avg() <= 2000), F.lit("good"))
        .when((ok >= 99.0) & (_avg() <= 5000), F.lit("fair"))
        .otherwise(F.lit("poor"))
    )
    return out.withColumns(
        {
            "avg_ms": _avg(),
            "deviation_ms": F.round(deviation(c("ms"), c("ms2"), c("requests")), 3),
            "success_rate": ok,
            "slow_rate": _share("slow"),
            "avg_upstream_ms": _avg("upstream"),
            "sla_level": sla,
            "grade": grade,
        }
    ).drop("ms", "ms2", "upstream")


def header_performance(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    keys = {**{k: c(k) for k in (HOUR, "browser", "os", "device", "referer_domain")}, "referer_type": referer_type(), **versions()}
    name = c("user_agent")
    out = summarise(
        df.filter((name != "") & name.isNotNull()),
        keys,
        sums={
            **_counts(),
            **_apdex_parts(limits),
            "slow": flag(_ms() > 3000),
            "client_errors": flag(c("status").startswith("4")),
            "server_errors": flag(c("status").startswith("5")),
            "bots": flag(name.rlike("bot|Bot|spider")),
            "mobile": flag(name.rlike("mobile|Mobile")),
        },
        maxs={"max_ms": _ms()},
        quantiles=[(_ms(), P50_99)],
    )
    return out.withColumns(
        {
            "avg_ms": _avg(),
            "success_rate": _share("successes"),
            "slow_rate": _share("slow"),
            "bot_rate": _share("bots"),
            "apdex": apdex(c("satisfied"), c("tolerated"), c("requests")),
        }
    ).drop("ms", "satisfied", "tolerated")


def comprehensive(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    out = summarise(
        df,
        [HOUR],
        sums={
            **_counts(),
            **_apdex_parts(limits),
            "client_errors": flag(c("status").startswith("4")),
            "server_errors": flag(c("status").startswith("5")),
            "slow": flag(_ms() > 3000),
            "very_slow": flag(_ms() > 10000),
            "timeout": flag(_ms() > 30000),
            "web": flag(c("access_type") == "Browser"),
            "mobile": flag(c("access_type").isin("APP_Native", "H5_WebView")),
            "api": flag(c("access_type") == "API"),
            "upstream": c("response_ms"),
            "upstream_bound": flag(c("response_ms") > _ms() * 0.8),
        },
        maxs={"max_ms": _ms()},
        quantiles=[(_ms(), P50_99)],
        distinct={"clients": c("client_ip"), "apis": c("uri")},
    )
    zero = F.lit(0.0)
    volume = F.when(c("requests") > 1000, F.lit(10.0)).otherwise(c("requests") / F.lit(100.0))
    score = (
        _share("successes") * 0.4
        + F.greatest(zero, F.lit(100.0) - _avg() / 1000 * 20) * 0.3
        + F.greatest(zero, F.lit(100.0) - _share("slow") * 2) * 0.2
        + volume * 0.1
    )
    hour = F.hour(HOUR)
    period = (
        F.when(hour < 6, F.lit("night"))
        .when(hour < 12, F.lit("morning"))
        .when(hour < 18, F.lit("afternoon"))
        .otherwise(F.lit("evening"))
    )
    return out.withColumns(
        {
            "qps": c("requests") / F.lit(3600.0),
            "avg_ms": _avg(),
            "success_rate": _share("successes"),
            "error_rate": _share("errors"),
            "slow_rate": _share("slow"),
            "avg_upstream_ms": _avg("upstream"),
            "apdex": apdex(c("satisfied"), c("tolerated"), c("requests")),
            "health": F.round(F.least(F.lit(100.0), F.greatest(zero, score)), 6),
            "utilisation": c("requests") / F.lit(10000.0),
            "period": period,
        }
    ).drop("ms", "satisfied", "tolerated", "upstream")


def platform_entry(df: DataFrame, first_stage: str = "discovery") -> DataFrame:
    out = summarise(
        df,
        [HOUR, "tenant", "platform", "entry_point", "channel", "client_type"],
        sums={
            **_counts(),
            "converted": flag(c("operation").isin("payment", "order")),
            "bounced": flag(c("journey_stage") == first_stage),
            "value": c("value_score"),
        },
        quantiles=[(_ms(), {"p95": 0.95})],
        distinct={"users": c("fingerprint")},
    )
    out = share_in_group(out, [HOUR, "tenant"], "requests", "market_share")
    return out.select(
        HOUR, "tenant", "platform", "entry_point", "channel", "client_type", "requests", "users", "p95", "market_share",
        _avg().alias("avg_ms"),
        _share("successes").alias("success_rate"),
        _share("errors").alias("error_rate"),
        _share("converted").alias("conversion_rate"),
        _share("bounced").alias("bounce_rate"),
        _avg("value").alias("engagement"),
        F.round(F.greatest(F.lit(0.0), F.lit(100.0) - _avg() / 1000 * 20), 6).alias("effectiveness"),
        F.round(_avg("value") * c("successes") / c("requests"), 6).alias("channel_return"),
    )


def business_process(df: DataFrame, abandoned_stage: str = "consideration") -> DataFrame:
    out = summarise(
        df.filter(c("operation") != ""),
        [HOUR, "tenant", "business_domain", "operation", "journey_stage"],
        sums={
            **_counts(),
            "completed": flag(c("is_business_success")),
            "abandoned": flag(c("journey_stage") == abandoned_stage),
            "process": c("process_ms"),
            "value": c("value_score"),
        },
        quantiles=[(_ms(), {"p95": 0.95})],
    )
    return out.select(
        HOUR, "tenant", "business_domain", "operation", "journey_stage", "requests", "completed", "abandoned", "value", "p95",
        c("errors").alias("failed"),
        _share("completed").alias("completion_rate"),
        _share("errors").alias("failure_rate"),
        _share("abandoned").alias("abandonment_rate"),
        _avg().alias("avg_ms"),
        _avg("process").alias("avg_process_ms"),
        _avg("value").alias("avg_value"),
    )


def user_behaviour(df: DataFrame, first_stage: str = "discovery") -> DataFrame:
    user, stage = c("fingerprint"), c("journey_stage")
    out = summarise(
        df,
        [HOUR, "tenant", "user_type", "user_tier"],
        sums={
            **_counts(),
            "span": c("process_ms") + c("transfer_ms"),
            "converted": flag(c("operation").isin("payment", "order")),
            "status_500": flag(c("status") == "500"),
            "value": c("value_score"),
        },
        distinct={
            "users": user,
            "new_users": F.when(stage == first_stage, user),
            "returning_users": F.when(stage != first_stage, user),
            "retained_users": F.when(stage == "retention", user),
        },
    )
    return out.select(
        HOUR, "tenant", "user_type", "user_tier", "requests", "users", "new_users", "returning_users",
        _avg("span").alias("avg_session_ms"),
        (c("requests") / c("users")).alias("pages_per_user"),
        _share("converted").alias("conversion_rate"),
        rate(c("retained_users"), c("users")).alias("retention_rate"),
        F.round(satisfaction(), 6).alias("satisfaction"),
        _share("errors").alias("complaint_rate"),
        _share("status_500").alias("ticket_rate"),
        (c("value") / c("users")).alias("value_per_user"),
    )


def security(df: DataFrame) -> DataFrame:
    out = summarise(
        df.filter(c("risk_score") > 0),
        [HOUR, "tenant", "risk_level", "threat", "reputation"],
        sums={
            **_counts(),
            "high_risk": flag(c("risk_level").isin("high", "critical")),
            "injections": flag(c("threat") == "sql_injection"),
            "cross_site": flag(c("threat") == "xss"),
            "process": c("process_ms"),
            "risk": F.least(F.lit(100), c("risk_score")),
        },
    )
    return out.select(
        HOUR, "tenant", "risk_level", "threat", "reputation", "requests", "high_risk", "injections", "cross_site",
        _avg().alias("avg_ms"),
        _avg("process").alias("avg_process_ms"),
        F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.lit(100.0) - _avg("risk"))).alias("posture"),
    )


def tenant_access(df: DataFrame) -> DataFrame:
    status = c("status")
    out = summarise(
        df,
        [HOUR, "tenant", "environment"],
        sums={
            **_counts(),
            "unauthorized": flag(status.isin("401", "403")),
            "denied": flag(status == "403"),
            "violations": flag(status.isin("401", "403", "429")),
        },
    )
    return out.select(
        HOUR, "tenant", "environment", "requests", c("successes").alias("authorized"), "unauthorized", "denied", "violations",
        F.least(F.lit(100.0), _share("successes")).alias("compliance"),
        (c("requests") / F.lit(10000.0)).alias("utilisation"),
    )


def platform_projection(df: DataFrame) -> DataFrame:
    out = summarise(
        df,
        [HOUR, "tenant", "platform", "entry_point", "api_category"],
        sums=_counts(),
        quantiles=[(_ms(), {"p95": 0.95})],
    )
    return out.withColumn("avg_ms", _avg()).drop("ms")


def error_projection(df: DataFrame) -> DataFrame:
    from hitlens.functions import status

    keys = {
        **{k: c(k) for k in (HOUR, "tenant", "operation")},
        "error_group": status.error_group(c("status")),
        "severity": status.severity(c("status")),
    }
    return summarise(
        df, keys, sums={"requests": F.lit(1)}, distinct={"clients": c("client_ip"), "sessions": c("session_id")}
    )


def domain_projection(df: DataFrame) -> DataFrame:
    out = summarise(
        df,
        [HOUR, "tenant", "business_domain", "api_category", "operation"],
        sums={"requests": F.lit(1), "ms": _ms(), "value": c("value_score")},
    )
    return out.withColumn("avg_ms", _avg()).drop("ms")
