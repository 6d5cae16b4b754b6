"""Hourly rollups (R1-R19) with oracles."""

from __future__ import annotations

from hitlens import lookups as K
from hitlens.catalog.base import hits, pct, register, sql_case
from hitlens.catalog.reports import isum, n_if
from hitlens.plans import rollups

OK = n_if("is_success")
BAD = n_if("NOT is_success")
N = "count(*)"


def r(a: str) -> str:
    return f"{a} * 1e2 / count(*)"


APDEX = f"({n_if('duration_ms <= 1500')} + {n_if('duration_ms > 1500 AND duration_ms <= 6000')} * 0.5e0) / count(*)"
SAT = f"round(least(100e0, {r(OK)} * 0.6e0 + greatest(0e0, 100e0 - avg(duration_ms) / 1000 * 10) * 0.4e0), 6)"
P3 = ", ".join(pct("duration_ms", p, f"p{int(p * 100)}") for p in (0.5, 0.95, 0.99))
FLAGS = {"attention": 500, "warning": 1000, "slow": 3000, "very_slow": 10000, "timeout": 30000}


# drill-down keys that come from functions of the enriched columns
TEAM = (
    "CASE WHEN contains(server_name, '.gov.cn') OR contains(business_domain, 'government') THEN "
    + sql_case("server_name", K.TEAM, "central_gov")
    + " ELSE 'default' END AS team"
)
CATEGORY = (
    "CASE WHEN (contains(ua, 'alipayclient') AND regexp_matches(ua, 'miniprogram|ariver')) OR (contains(ua, 'micromessenger') AND contains(ua, 'miniprogram')) THEN 'miniprogram' "
    "WHEN contains(ua, 'android') OR contains(ua, 'iphone') THEN 'mobile' WHEN contains(ua, 'ipad') THEN 'tablet' WHEN is_bot THEN 'bot' ELSE 'desktop' END AS platform_category"
)
VERSION = "CASE WHEN regexp_matches(request_uri, '(?i)/v(\\d+(?:\\.\\d+)?)') THEN 'v' || regexp_extract(request_uri, '(?i)/v(\\d+(?:\\.\\d+)?)', 1) ELSE '' END AS api_version"
TIER = "CASE WHEN is_static THEN 'web' WHEN contains(application, 'gateway') THEN 'api' WHEN contains(service, 'service') THEN 'service' ELSE 'data' END AS service_tier"
IMPORTANCE = (
    "CASE WHEN regexp_matches(service, 'gxrz-rest|alipay|payment') THEN 'critical' WHEN regexp_matches(lower(module), 'user|auth|order') THEN 'important' "
    "WHEN is_static THEN 'optional' ELSE 'normal' END AS api_importance"
)
PLATFORM_VERSION = (
    "CASE platform WHEN 'iOS_SDK' THEN regexp_extract(user_agent, 'zgt-ios/([0-9.]+)', 1) WHEN 'iOS' THEN replace(regexp_extract(user_agent, 'iOS ([0-9_.]+)', 1), '_', '.') "
    "WHEN 'Android' THEN regexp_extract(user_agent, 'Android ([0-9.]+)', 1) ELSE '' END AS platform_version"
)
OS_VERSION = (
    "CASE WHEN contains(ua, 'android') THEN regexp_extract(ua, 'android\\s+([0-9.]+)', 1) WHEN contains(ua, 'iphone') OR contains(ua, 'ipad') "
    "THEN replace(regexp_extract(ua, 'os\\s+([0-9_]+)', 1), '_', '.') ELSE '' END AS os_version"
)
SDK_VERSION = "regexp_extract(user_agent, '(?i)WST-SDK-(?:iOS|Android)/([0-9.]+)', 1) AS sdk_version"
APP_VERSION = "regexp_extract(user_agent, '(?i)zgt-(?:ios|android)[/\\s]?([0-9.]+)', 1) AS app_version"


def roll(name: str, keys: list[str], cols: list[str], where: str = "", pre: str = ""):
    """Register a rollup whose oracle is one GROUP BY; keys may be ``expr AS name``."""
    names = [k.rsplit(" AS ", 1)[-1] for k in keys]
    source = "hits"
    head = ""
    if any(" AS " in k for k in keys):
        extra = ", ".join(k for k in keys if " AS " in k)
        head, source = f", src AS (SELECT *, {extra} FROM hits)", "src"
    sql = f"{head} SELECT {', '.join(names)}, {', '.join(cols)} FROM {source} {where} GROUP BY {', '.join(names)}"
    return register(name, sql)


@roll(
    "r01_api_performance",
    ["stat_hour", "tenant", "environment", "platform", "access_type", "entry_point", "channel", "client_type", "uri", "api_category", "module", "business_domain", "operation", TEAM, CATEGORY, VERSION],
    [
        f"{N} AS requests", f"{OK} AS successes", f"{BAD} AS errors", "count(DISTINCT client_ip) AS clients", "max(duration_ms) AS max_ms",
        *[f"{n_if(f'duration_ms > {v}')} AS {k}" for k, v in FLAGS.items()],
        *[f"{r(n_if(f'duration_ms > {v}'))} AS {k}_rate" for k, v in FLAGS.items()],
        *[f"{n_if(f'performance_level = {i}')} AS level_{i}" for i in range(1, 7)],
        f"{n_if('response_ms > 3000')} AS upstream_slow", P3, pct("duration_ms", 0.9, "p90"), f"{N} / 3600e0 AS qps", "avg(duration_ms) AS avg_ms",
        f"{r(OK)} AS success_rate", f"{r(BAD)} AS error_rate", f"{r(n_if('is_business_success'))} AS business_rate", "avg(performance_level) AS avg_level",
        f"{APDEX} AS apdex", f"{SAT} AS satisfaction", "avg(response_ms) AS avg_upstream_ms",
    ],
)
def _(spark, sf):
    return rollups.api_performance(hits(spark, sf))


@roll(
    "r02_service_level",
    ["stat_hour", "tenant", "environment", "platform", "access_type", "service", "upstream_addr", TEAM, TIER, "split_part(upstream_addr, ':', 1) AS node"],
    [
        f"{N} AS requests", "count(DISTINCT client_ip) AS clients", pct("duration_ms", 0.95, "p95"), pct("duration_ms", 0.99, "p99"), f"{n_if('has_anomaly')} AS anomalies",
        f"{N} / 3600e0 AS qps", f"{r(OK)} AS availability", f"{r(n_if('CAST(status AS INT) < 400'))} AS below_400_rate", "avg(duration_ms) AS avg_ms",
        f"{r(n_if('duration_ms <= 3000'))} AS performance_sla", f"{isum('duration_ms')} AS total_ms", f"{r(n_if('has_anomaly'))} AS anomaly_rate",
        f"{r(n_if('is_business_success'))} AS business_rate", "avg(value_score) AS avg_value",
    ],
)
def _(spark, sf):
    return rollups.service_level(hits(spark, sf))


SIZE = "CASE WHEN body_bytes > 1048576 THEN 'large_response' WHEN body_bytes > 102400 THEN 'medium_response' ELSE 'small_response' END AS size_class"
AGENT = "CASE WHEN is_bot THEN 'bot' WHEN device = '手机' THEN 'mobile' ELSE 'desktop' END AS agent_class"


@roll(
    "r03_slow_requests",
    [
        "stat_hour", "platform", "access_type", "uri", "upstream_addr",
        "CASE WHEN response_ms > 5000 THEN 'database_slow' WHEN connect_ms > 1000 THEN 'connection_slow' WHEN process_ms > 3000 THEN 'processing_slow' ELSE 'network_slow' END AS reason",
        "CASE WHEN response_ms::DOUBLE / duration_ms > 0.8 THEN 'backend_bottleneck' WHEN network_ms::DOUBLE / duration_ms > 0.3 THEN 'network_bottleneck' ELSE 'application_bottleneck' END AS bottleneck",
        "'low_concurrency' AS connection_class", SIZE, AGENT,
    ],
    [
        f"{N} AS requests", "count(DISTINCT client_ip) AS clients", f"{n_if('duration_ms > 10000')} AS very_slow", f"{n_if('duration_ms > 30000')} AS timeout", "max(duration_ms) AS max_ms",
        pct("duration_ms", 0.95, "p95"), f"{r(n_if('duration_ms > 10000'))} AS very_slow_rate", f"{r(n_if('duration_ms > 30000'))} AS timeout_rate", "avg(duration_ms) AS avg_ms",
        "avg(performance_level) AS avg_level", "avg(value_score) AS avg_value", "avg(response_ms) AS avg_upstream_ms", "avg(network_ms) AS avg_network_ms", "avg(process_ms) AS avg_process_ms",
    ],
    "WHERE duration_ms > 3000",
)
def _(spark, sf):
    return rollups.slow_requests(hits(spark, sf))


@register(
    "r04_status_codes",
    """, g AS (SELECT stat_hour, platform, access_type, uri, module, api_category, business_domain, status, CASE left(status, 1) WHEN '4' THEN 'client_error' WHEN '5' THEN 'server_error'
      WHEN '3' THEN 'redirection' ELSE 'success' END AS kind, count(*) AS requests FROM hits GROUP BY ALL)
    SELECT *, requests * 1e2 / sum(requests) OVER (PARTITION BY stat_hour, platform, access_type)::DOUBLE AS share FROM g""",
)
def _(spark, sf):
    return rollups.status_codes(hits(spark, sf))


@register(
    "r05_time_dimension",
    f""", g AS (SELECT stat_hour, CASE WHEN hour BETWEEN 9 AND 11 OR hour BETWEEN 14 AND 16 THEN 'peak_hours' WHEN hour BETWEEN 8 AND 18 THEN 'business_hours' ELSE 'off_hours' END AS peak_period,
      CASE WHEN weekday <= 5 AND hour BETWEEN 8 AND 18 THEN 'business_hours' ELSE 'non_business_hours' END AS business_hours, count(*) AS requests, count(DISTINCT client_ip) AS clients, {pct('duration_ms', .5, 'p50')},
      {pct('duration_ms', .95, 'p95')}, count(*) / 3600e0 AS qps, avg(duration_ms) AS avg_ms, {r(OK)} AS success_rate, {r(BAD)} AS error_rate, {r(n_if('is_slow'))} AS slow_rate FROM hits GROUP BY 1, 2, 3)
    SELECT *, max(requests) OVER (ORDER BY stat_hour ROWS 6 PRECEDING) AS peak_7h, avg(requests) OVER (ORDER BY stat_hour ROWS 23 PRECEDING) AS mean_24h FROM g""",
)
def _(spark, sf):
    return rollups.time_dimension(hits(spark, sf))


@roll(
    "r06_error_drilldown",
    [
        "stat_hour", "platform", "access_type", "uri", "status", "upstream_addr",
        "CASE WHEN status < '5' THEN '4xx_client' ELSE '5xx_server' END AS error_group",
        "CASE WHEN status IN ('500', '502', '503', '504') THEN 'critical' WHEN status IN ('401', '403', '429') THEN 'high' ELSE 'medium' END AS severity",
        "CASE WHEN status IN ('502', '503', '504') THEN 'gateway' WHEN upstream_addr <> '' THEN 'service' ELSE 'application' END AS location",
        "CASE WHEN regexp_matches(request_uri, 'login|auth') THEN 'login' WHEN regexp_matches(request_uri, 'pay|order') THEN 'payment' ELSE 'other' END AS operation_class",
        "CASE WHEN regexp_matches(request_uri, 'login|pay') THEN 'critical' ELSE 'normal' END AS importance",
        "CASE WHEN is_internal THEN 'internal' ELSE 'external' END AS address", AGENT, "journey_stage", "user_type", IMPORTANCE,
        "CASE left(status, 1) WHEN '4' THEN 'client_error' ELSE 'server_error' END AS http_class",
        "CASE WHEN hour BETWEEN 9 AND 17 THEN 'business_hours' ELSE 'off_hours' END AS time_pattern",
    ],
    [f"{N} AS errors", "count(DISTINCT client_ip) AS clients", "count(DISTINCT session_id) AS sessions"],
    "WHERE CAST(status AS INT) >= 400",
)
def _(spark, sf):
    return rollups.error_drilldown(hits(spark, sf))


REF = "CASE WHEN regexp_matches(referer_domain, 'google\\.|baidu\\.|bing\\.') THEN 'search' WHEN referer_domain IS NOT NULL THEN 'referral' ELSE 'direct' END AS referer_type"


@register(
    "r07_request_headers",
    f""", g AS (SELECT stat_hour, platform, browser, os, device, sdk_type, referer_domain, search_engine, {REF}, {PLATFORM_VERSION}, {OS_VERSION}, {SDK_VERSION}, {APP_VERSION}, count(*) AS requests, count(DISTINCT client_ip) AS clients, avg(duration_ms) AS avg_ms,
      {r(n_if('is_error'))} AS error_rate, {r(n_if('is_slow'))} AS slow_rate FROM hits GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13)
    SELECT *, requests * 1e2 / sum(requests) OVER (PARTITION BY stat_hour, platform)::DOUBLE AS market_share FROM g""",
)
def _(spark, sf):
    return rollups.request_headers(hits(spark, sf))


@register(
    "r08_api_errors",
    f""", t AS (SELECT stat_hour, count(*) AS n FROM hits GROUP BY 1), g AS (SELECT stat_hour, platform, uri, module, status, count(*) AS requests, {n_if("status LIKE '4%'")} AS client_errors, {n_if("status LIKE '5%'")} AS server_errors,
      {n_if('duration_ms > 3000')} AS slow, {n_if('duration_ms > 30000')} AS timeout, min(log_time) AS first_error, max(log_time) AS last_error, max(duration_ms) AS max_ms, count(DISTINCT client_ip) AS clients,
      avg(duration_ms) AS avg_ms, avg(response_ms) AS avg_upstream_ms FROM hits WHERE NOT is_success GROUP BY 1, 2, 3, 4, 5)
    SELECT g.*, requests * 1e2 / n AS share_of_hour FROM g JOIN t USING (stat_hour)""",
)
def _(spark, sf):
    return rollups.api_errors(hits(spark, sf))


@roll(
    "r09_ip_source",
    ["stat_hour", "client_ip", "CASE WHEN ip_kind = '内网IP' THEN 'internal' ELSE 'external' END AS address"],
    [
        f"{N} AS requests", f"{OK} AS successes", f"{BAD} AS errors", f"{n_if('is_slow')} AS slow", f"{n_if("status = '404'")} AS not_found", f"{n_if("status = '403'")} AS forbidden",
        f"{n_if("status LIKE '5%'")} AS server_errors", "min(log_time) AS first_seen", "max(log_time) AS last_seen", pct("duration_ms", 0.95, "p95"), "count(DISTINCT uri) AS apis",
        "count(DISTINCT user_agent) AS agents", "avg(duration_ms) AS avg_ms", f"{r(OK)} AS success_rate",
        f"CASE WHEN {r(BAD)} > 50 THEN 'high_risk' WHEN {r(BAD)} > 20 THEN 'medium_risk' WHEN {r(BAD)} > 5 THEN 'low_risk' ELSE 'normal' END AS risk_level",
    ],
)
def _(spark, sf):
    return rollups.ip_source(hits(spark, sf))


@roll(
    "r10_service_stability",
    ["stat_hour", "platform", "service", "module"],
    [
        f"{N} AS requests", f"{OK} AS successes", f"{BAD} AS errors", f"{n_if('is_slow')} AS slow", f"{n_if('duration_ms > 10000')} AS very_slow", f"{n_if('duration_ms > 30000')} AS timeout",
        f"{n_if("status LIKE '5%'")} AS server_errors", f"{n_if("status LIKE '4%'")} AS client_errors", P3, "avg(duration_ms) AS avg_ms", "round(stddev_pop(duration_ms), 3) AS deviation_ms", f"{r(OK)} AS success_rate",
        f"{r(n_if('is_slow'))} AS slow_rate", "avg(response_ms) AS avg_upstream_ms",
        f"CASE WHEN {r(OK)} >= 99.99 THEN '99.99%' WHEN {r(OK)} >= 99.95 THEN '99.95%' WHEN {r(OK)} >= 99.9 THEN '99.9%' WHEN {r(OK)} >= 99 THEN '99.0%' ELSE 'below_99%' END AS sla_level",
        f"CASE WHEN {r(OK)} >= 99.95 AND avg(duration_ms) <= 1000 THEN 'excellent' WHEN {r(OK)} >= 99.9 AND avg(duration_ms) <= 2000 THEN 'good' WHEN {r(OK)} >= 99 AND avg(duration_ms) <= 5000 THEN 'fair' ELSE 'poor' END AS grade",
    ],
)
def _(spark, sf):
    return rollups.service_stability(hits(spark, sf))


@roll(
    "r11_header_performance",
    ["stat_hour", "browser", "os", "device", "referer_domain", REF, PLATFORM_VERSION, OS_VERSION],
    [
        f"{N} AS requests", f"{OK} AS successes", f"{BAD} AS errors", f"{n_if('is_slow')} AS slow", f"{n_if("status LIKE '4%'")} AS client_errors", f"{n_if("status LIKE '5%'")} AS server_errors",
        f"{n_if("regexp_matches(user_agent, 'bot|Bot|spider')")} AS bots", f"{n_if("regexp_matches(user_agent, 'mobile|Mobile')")} AS mobile", "max(duration_ms) AS max_ms", P3, "avg(duration_ms) AS avg_ms",
        f"{r(OK)} AS success_rate", f"{r(n_if('is_slow'))} AS slow_rate", f"{r(n_if("regexp_matches(user_agent, 'bot|Bot|spider')"))} AS bot_rate", f"{APDEX} AS apdex",
    ],
    "WHERE user_agent <> ''",
)
def _(spark, sf):
    return rollups.header_performance(hits(spark, sf))


@roll(
    "r12_comprehensive",
    ["stat_hour"],
    [
        f"{N} AS requests", f"{OK} AS successes", f"{BAD} AS errors", f"{n_if("status LIKE '4%'")} AS client_errors", f"{n_if("status LIKE '5%'")} AS server_errors", f"{n_if('is_slow')} AS slow",
        f"{n_if('duration_ms > 10000')} AS very_slow", f"{n_if('duration_ms > 30000')} AS timeout", f"{n_if("access_type = 'Browser'")} AS web", f"{n_if("access_type IN ('APP_Native', 'H5_WebView')")} AS mobile",
        f"{n_if("access_type = 'API'")} AS api", f"{n_if('response_ms > duration_ms * 0.8e0')} AS upstream_bound", "max(duration_ms) AS max_ms", P3, "count(DISTINCT client_ip) AS clients", "count(DISTINCT uri) AS apis",
        f"{N} / 3600e0 AS qps", "avg(duration_ms) AS avg_ms", f"{r(OK)} AS success_rate", f"{r(BAD)} AS error_rate", f"{r(n_if('is_slow'))} AS slow_rate", "avg(response_ms) AS avg_upstream_ms", f"{APDEX} AS apdex",
        f"round(least(100e0, greatest(0e0, {r(OK)} * 0.4e0 + greatest(0e0, 100 - avg(duration_ms) / 1000 * 20) * 0.3e0 + greatest(0e0, 100 - {r(n_if('is_slow'))} * 2) * 0.2e0 + CASE WHEN count(*) > 1000 THEN 10e0 ELSE count(*) / 1e2 END * 0.1e0)), 6) AS health",
        f"{N} / 1e4 AS utilisation",
        "CASE WHEN hour(stat_hour) < 6 THEN 'night' WHEN hour(stat_hour) < 12 THEN 'morning' WHEN hour(stat_hour) < 18 THEN 'afternoon' ELSE 'evening' END AS period",
    ],
)
def _(spark, sf):
    return rollups.comprehensive(hits(spark, sf))


@register(
    "r14_platform_entry",
    f""", g AS (SELECT stat_hour, tenant, platform, entry_point, channel, client_type, count(*) AS requests, count(DISTINCT fingerprint) AS users, {pct('duration_ms', .95, 'p95')}, avg(duration_ms) AS avg_ms, {r(OK)} AS success_rate,
      {r(BAD)} AS error_rate, {r(n_if("operation IN ('payment', 'order')"))} AS conversion_rate, {r(n_if("journey_stage = 'discovery'"))} AS bounce_rate, avg(value_score) AS engagement,
      round(greatest(0e0, 100 - avg(duration_ms) / 1000 * 20), 6) AS effectiveness, round(avg(value_score) * {OK} / count(*), 6) AS channel_return FROM hits GROUP BY 1, 2, 3, 4, 5, 6)
    SELECT *, requests * 1e2 / sum(requests) OVER (PARTITION BY stat_hour, tenant)::DOUBLE AS market_share FROM g""",
)
def _(spark, sf):
    return rollups.platform_entry(hits(spark, sf))


@roll(
    "r15_business_process",
    ["stat_hour", "tenant", "business_domain", "operation", "journey_stage"],
    [
        f"{N} AS requests", f"{n_if('is_business_success')} AS completed", f"{BAD} AS failed", f"{n_if("journey_stage = 'consideration'")} AS abandoned", f"{isum('value_score')} AS value", pct("duration_ms", 0.95, "p95"),
        f"{r(n_if('is_business_success'))} AS completion_rate", f"{r(BAD)} AS failure_rate", f"{r(n_if("journey_stage = 'consideration'"))} AS abandonment_rate", "avg(duration_ms) AS avg_ms",
        "avg(process_ms) AS avg_process_ms", "avg(value_score) AS avg_value",
    ],
    "WHERE operation <> ''",
)
def _(spark, sf):
    return rollups.business_process(hits(spark, sf))


@roll(
    "r16_user_behaviour",
    ["stat_hour", "tenant", "user_type", "user_tier"],
    [
        f"{N} AS requests", "count(DISTINCT fingerprint) AS users", "count(DISTINCT fingerprint) FILTER (WHERE journey_stage = 'discovery') AS new_users",
        "count(DISTINCT fingerprint) FILTER (WHERE journey_stage <> 'discovery') AS returning_users", "avg(process_ms + transfer_ms) AS avg_session_ms", "count(*)::DOUBLE / count(DISTINCT fingerprint) AS pages_per_user",
        f"{r(n_if("operation IN ('payment', 'order')"))} AS conversion_rate", "count(DISTINCT fingerprint) FILTER (WHERE journey_stage = 'retention') * 1e2 / count(DISTINCT fingerprint) AS retention_rate",
        f"{SAT} AS satisfaction", f"{r(BAD)} AS complaint_rate", f"{r(n_if("status = '500'"))} AS ticket_rate", "sum(value_score)::DOUBLE / count(DISTINCT fingerprint) AS value_per_user",
    ],
)
def _(spark, sf):
    return rollups.user_behaviour(hits(spark, sf))


@roll(
    "r17_security",
    ["stat_hour", "tenant", "risk_level", "threat", "reputation"],
    [
        f"{N} AS requests", f"{n_if("risk_level IN ('high', 'critical')")} AS high_risk", f"{n_if("threat = 'sql_injection'")} AS injections", f"{n_if("threat = 'xss'")} AS cross_site", "avg(duration_ms) AS avg_ms",
        "avg(process_ms) AS avg_process_ms", "least(100e0, greatest(0e0, 100 - avg(least(100, risk_score)))) AS posture",
    ],
    "WHERE risk_score > 0",
)
def _(spark, sf):
    return rollups.security(hits(spark, sf))


@roll(
    "r18_tenant_access",
    ["stat_hour", "tenant", "environment"],
    [
        f"{N} AS requests", f"{OK} AS authorized", f"{n_if("status IN ('401', '403')")} AS unauthorized", f"{n_if("status = '403'")} AS denied", f"{n_if("status IN ('401', '403', '429')")} AS violations",
        f"least(100e0, {r(OK)}) AS compliance", f"{N} / 1e4 AS utilisation",
    ],
)
def _(spark, sf):
    return rollups.tenant_access(hits(spark, sf))


@roll(
    "r19_platform_projection",
    ["stat_hour", "tenant", "platform", "entry_point", "api_category"],
    [f"{N} AS requests", f"{OK} AS successes", f"{BAD} AS errors", pct("duration_ms", 0.95, "p95"), "avg(duration_ms) AS avg_ms"],
)
def _(spark, sf):
    return rollups.platform_projection(hits(spark, sf))


@roll(
    "r19_error_projection",
    [
        "stat_hour", "tenant", "operation", "CASE left(status, 1) WHEN '4' THEN '4xx_client' WHEN '5' THEN '5xx_server' ELSE '' END AS error_group",
        "CASE left(status, 1) WHEN '4' THEN 'medium' WHEN '5' THEN 'critical' ELSE 'low' END AS severity",
    ],
    [f"{N} AS requests", "count(DISTINCT client_ip) AS clients", "count(DISTINCT session_id) AS sessions"],
)
def _(spark, sf):
    return rollups.error_projection(hits(spark, sf))


@roll(
    "r19_domain_projection",
    ["stat_hour", "tenant", "business_domain", "api_category", "operation"],
    [f"{N} AS requests", f"{isum('value_score')} AS value", "avg(duration_ms) AS avg_ms"],
)
def _(spark, sf):
    return rollups.domain_projection(hits(spark, sf))
