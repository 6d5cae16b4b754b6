"""Light rollups (L1-L14), interactive questions (L15-L46) and dashboard panels (D1-D24) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitlens.catalog.base import hits, pct, register
from hitlens.catalog.reports import isum, n_if
from hitlens.operators import filters
from hitlens.plans import insight, panels, realtime, rollups

OK, BAD, ERR, SLOW = n_if("is_success"), n_if("NOT is_success"), n_if("is_error"), n_if("is_slow")
AVG = "avg(duration_ms) AS avg_ms"
P95 = pct("duration_ms", 0.95, "p95")
P99 = pct("duration_ms", 0.99, "p99")
P50 = pct("duration_ms", 0.5, "p50")
CLI = "count(DISTINCT client_ip) AS clients"
N = "count(*) AS requests"
BASE = f"{N}, {OK} AS successes, {ERR} AS errors, {SLOW} AS slow"
RATES = f"{OK} * 1e2 / count(*) AS success_rate, {ERR} * 1e2 / count(*) AS error_rate, {SLOW} * 1e2 / count(*) AS slow_rate, {AVG}"
PG = "regexp_replace(regexp_replace(regexp_replace(split_part(request_uri, '?', 1), '/\\d+', '/{id}', 'g'), '/[a-f0-9]{8,}', '/{uuid}', 'g'), '/v\\d+/', '/v{n}/', 'g')"
GROUPED = f", gp AS (SELECT *, {PG} AS path_group, date_trunc('minute', log_time) AS minute, CAST(log_time AS DATE) AS day FROM hits)"

L1_SQL = GROUPED + f""", l1 AS (SELECT stat_hour, path_group, platform, api_category, {BASE}, max(duration_ms) AS max_ms, {P50}, {pct('duration_ms', .9, 'p90')}, {P95}, {P99}, {pct('connect_ms', .5, 'connect_p50')},
    {pct('connect_ms', .95, 'connect_p95')}, {pct('process_ms', .5, 'process_p50')}, {pct('process_ms', .95, 'process_p95')}, {pct('body_bytes', .5, 'body_p50')}, {pct('body_bytes', .95, 'body_p95')}, {RATES},
    {n_if("cache_status = 'HIT'")} * 1e2 / count(*) AS cache_hit_rate FROM gp GROUP BY 1, 2, 3, 4)"""


@register("l01_api_percentiles", L1_SQL + " SELECT * FROM l1")
def _(spark, sf):
    return realtime.api_percentiles(hits(spark, sf))


@register(
    "l02_qps_ranking",
    GROUPED
    + f""", g AS (SELECT minute, path_group, platform, api_category, {N}, {P95}, count(*) / 60e0 AS qps, {AVG}, {ERR} * 1e2 / count(*) AS error_rate FROM gp GROUP BY 1, 2, 3, 4),
    k AS (SELECT *, CAST(row_number() OVER (PARTITION BY minute ORDER BY qps DESC, path_group, platform, api_category) AS INT) AS qps_rank,
      CAST(row_number() OVER (PARTITION BY minute ORDER BY avg_ms DESC, path_group, platform, api_category) AS INT) AS latency_rank FROM g) SELECT *, qps_rank <= 5 AS is_hot, latency_rank <= 5 AS is_slow_api FROM k""",
)
def _(spark, sf):
    return realtime.qps_ranking(hits(spark, sf))


@register(
    "l03_error_monitoring",
    GROUPED
    + f""", m AS (SELECT stat_hour, path_group, platform, status, count(*) AS n FROM gp WHERE is_error GROUP BY ALL), mm AS (SELECT stat_hour, path_group, platform, arg_min(status, (-n, status)) AS main_code FROM m GROUP BY ALL),
    g AS (SELECT stat_hour, path_group, platform, count(*) AS errors, min(log_time) AS first_error, max(log_time) AS last_error, {CLI}, count(DISTINCT uri) AS apis, date_diff('minute', min(log_time), max(log_time)) AS minutes, {AVG},
      {n_if("upstream_addr <> ''")} * 1e2 / count(*) AS upstream_rate FROM gp WHERE is_error GROUP BY 1, 2, 3) SELECT g.*, main_code FROM g JOIN mm USING (stat_hour, path_group, platform)""",
)
def _(spark, sf):
    return realtime.error_monitoring(hits(spark, sf))


L4_SQL = f""", l4a AS (SELECT stat_hour, upstream_addr, service, {N}, {OK} AS successes, {ERR} AS errors, {n_if('duration_ms > 30000')} AS timeouts, {n_if('connect_ms <= 0 OR connect_ms > 5000')} AS connect_errors, {P95}, {P99},
      {pct('connect_ms', .95, 'connect_p95', 'connect_ms > 0')}, CASE WHEN {n_if('connect_ms > 0')} > 0 THEN {n_if('connect_ms > 0 AND connect_ms < 5000')} * 1e2 / {n_if('connect_ms > 0')} ELSE 0 END AS connect_rate,
      avg(connect_ms) FILTER (WHERE connect_ms > 0) AS avg_connect_ms, {AVG}, {n_if('duration_ms > 30000')} * 1e2 / count(*) AS timeout_rate, {OK} * 1e2 / count(*) AS availability FROM hits WHERE upstream_addr <> '' GROUP BY 1, 2, 3),
    l4b AS (SELECT *, round(connect_rate * 0.3e0 + (100 - errors * 1e2 / requests) * 0.4e0 + (100 - timeout_rate) * 0.3e0, 6) AS health FROM l4a),
    l4 AS (SELECT *, health >= 80 AS is_healthy, CASE WHEN health >= 90 THEN 'OK' WHEN health >= 70 THEN 'WARNING' ELSE 'CRITICAL' END AS alert FROM l4b)"""


@register("l04_upstream_health", L4_SQL + " SELECT * FROM l4")
def _(spark, sf):
    return realtime.upstream_health(hits(spark, sf))


@register(
    "l05_client_behaviour",
    GROUPED
    + f""", kk AS (SELECT stat_hour, client_ip, platform, device, browser, os, entry_source, path_group, count(*) AS n FROM gp GROUP BY ALL),
    mm AS (SELECT stat_hour, client_ip, platform, device, browser, os, entry_source, arg_min(path_group, (-n, path_group)) AS top_path FROM kk GROUP BY ALL),
    g AS (SELECT stat_hour, client_ip, platform, device, browser, os, entry_source, {BASE}, {isum('body_bytes')} AS bytes, {P95}, count(DISTINCT path_group) AS apis, (epoch_us(max(log_time)) - epoch_us(min(log_time))) / 60e6 AS span_minutes, {AVG},
      CASE WHEN count(bot_type) > 0 THEN 0.9e0 WHEN count(*) > 500 THEN 0.6e0 ELSE 0.1e0 END AS bot_probability FROM gp GROUP BY 1, 2, 3, 4, 5, 6, 7),
    s AS (SELECT *, CASE WHEN requests > 1000 OR apis > 50 THEN 100 WHEN requests > 500 OR apis > 20 THEN 70 WHEN requests > 100 THEN 30 ELSE 0 END AS risk_score FROM g)
    SELECT s.*, risk_score >= 70 AS is_suspicious, top_path FROM s JOIN mm USING (stat_hour, client_ip, platform, device, browser, os, entry_source)""",
)
def _(spark, sf):
    return realtime.client_behaviour(hits(spark, sf))


@register(
    "l06_traces",
    f"""SELECT session_id, count(*) AS spans, count(DISTINCT service) AS services, {ERR} AS error_spans, min(log_time) AS start_time, max(log_time) AS end_time, max(duration_ms) AS critical_ms, {AVG},
    (count(*) - {ERR}) * 1e2 / count(*) AS success_rate, arg_min(service, (-duration_ms, service, uri)) AS bottleneck_service, arg_min(uri, (-duration_ms, service, uri)) AS slowest_api, arg_min(uri, (log_time, uri)) AS entry_api
    FROM hits GROUP BY session_id""",
)
def _(spark, sf):
    return realtime.traces(hits(spark, sf), "session_id")


@register(
    "l07_dashboard_totals",
    f"SELECT {N}, {RATES}, count(DISTINCT uri) AS apis, {CLI}, count(*) / 3600e0 AS qps FROM hits WHERE stat_hour = TIMESTAMP '2024-01-10 10:00:00'",
)
def _(spark, sf):
    return realtime.dashboard_totals(hits(spark, sf), "2024-01-10 10:00:00")


@register(
    "l08_slow_and_hot",
    L1_SQL
    + """, a AS (SELECT path_group, platform, stat_hour, requests, success_rate, p95, CAST(row_number() OVER (ORDER BY p95 DESC, path_group, platform, stat_hour) AS INT) AS position, 'slow' AS kind FROM l1),
    b AS (SELECT path_group, platform, stat_hour, requests, success_rate, p95, CAST(row_number() OVER (ORDER BY requests DESC, path_group, platform, stat_hour) AS INT) AS position, 'hot' AS kind FROM l1)
    SELECT * FROM a WHERE position <= 10 UNION ALL SELECT * FROM b WHERE position <= 10""",
)
def _(spark, sf):
    return realtime.slow_and_hot(realtime.api_percentiles(hits(spark, sf)))


@register(
    "l09_anomalies",
    L1_SQL
    + L4_SQL
    + """ SELECT stat_hour, path_group AS subject, platform AS scope, 'high_error_rate' AS kind, error_rate AS value, CASE WHEN error_rate > 10 THEN 'CRITICAL' ELSE 'WARNING' END AS severity FROM l1 WHERE error_rate > 5
    UNION ALL SELECT stat_hour, path_group, platform, 'high_response_time', p95, CASE WHEN p95 > 10000 THEN 'CRITICAL' WHEN p95 > 5000 THEN 'WARNING' ELSE 'OK' END FROM l1 WHERE p95 > 3000
    UNION ALL SELECT stat_hour, upstream_addr, service, 'low_health', health, alert FROM l4 WHERE health < 80""",
)
def _(spark, sf):
    df = hits(spark, sf)
    return realtime.anomalies(realtime.api_percentiles(df), realtime.upstream_health(df))


@register(
    "l09_simple_anomalies",
    f""", g AS (SELECT stat_hour, platform, api_category, {N}, {P95}, {RATES} FROM hits GROUP BY 1, 2, 3 HAVING count(*) >= 3)
    SELECT stat_hour, platform, api_category, requests, avg_ms, p95, error_rate, slow_rate, CASE WHEN avg_ms > 5000 THEN 'high_response_time' WHEN error_rate > 10 THEN 'high_error_rate' WHEN slow_rate > 20 THEN 'high_slow_rate' ELSE 'normal' END AS anomaly FROM g""",
)
def _(spark, sf):
    return realtime.simple_anomalies(hits(spark, sf), min_requests=3)


def _platform_sql(keys: str) -> str:
    return f"""SELECT {keys}, {BASE}, {n_if('has_anomaly')} AS anomalies, {isum('body_bytes')} AS bytes, min(duration_ms) AS min_ms, max(duration_ms) AS max_ms, {P50}, {P95}, {P99}, {CLI}, {RATES},
    {n_if('has_anomaly')} * 1e2 / count(*) AS anomaly_rate FROM hits GROUP BY {keys}"""


@register("l10_platform_hourly", _platform_sql("stat_hour, platform"))
def _(spark, sf):
    return realtime.platform_hourly(hits(spark, sf))


@register(
    "l10_api_hourly",
    f"SELECT stat_hour, uri, platform, api_category, {BASE}, min(application) AS application, min(service) AS service, max(duration_ms) AS max_ms, {P95}, {RATES} FROM hits GROUP BY 1, 2, 3, 4",
)
def _(spark, sf):
    return realtime.api_hourly(hits(spark, sf))


@register("l10_platform_realtime", ", hits2 AS (SELECT * FROM hits) " + _platform_sql("platform").replace("FROM hits GROUP", "FROM hits2 WHERE log_time >= TIMESTAMP '2024-01-30 12:00:00' GROUP"))
def _(spark, sf):
    recent = filters.recent_or_all(hits(spark, sf), "log_time", 12, "2024-01-31 00:00:00")
    return realtime.platform_hourly(recent, ["platform"])


@register(
    "l11_realtime_metrics",
    f""", g AS (SELECT stat_hour, platform, {N}, {RATES}, {P95}, {P99}, {n_if('has_anomaly')} * 1e2 / count(*) AS anomaly_rate FROM hits GROUP BY 1, 2)
    SELECT *, CASE WHEN avg_ms > 3000 THEN 'critical' WHEN avg_ms > 1000 THEN 'warning' ELSE 'normal' END AS alert FROM g""",
)
def _(spark, sf):
    return realtime.realtime_metrics(hits(spark, sf))


@register("l11_platform_analysis", _platform_sql("stat_hour, platform, entry_source, api_category"))
def _(spark, sf):
    return realtime.platform_hourly(hits(spark, sf), ["stat_hour", "platform", "entry_source", "api_category"])


@register(
    "l12_minute_rollup",
    GROUPED
    + f""" SELECT minute, uri, platform, api_category, {BASE}, {isum('sent_bytes')} AS sent, min(duration_ms) AS min_ms, max(duration_ms) AS max_ms, {P50}, {P95}, {P99}, {AVG}, avg(connect_ms) AS avg_connect_ms, avg(header_ms) AS avg_header_ms,
    avg(response_ms) AS avg_upstream_ms, avg(network_ms) AS avg_network_ms FROM gp GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    return realtime.minute_rollup(hits(spark, sf))


@register(
    "l12_ip_behaviour",
    f"""SELECT stat_hour, client_ip, platform, {BASE}, {n_if('has_anomaly')} AS anomalies, {isum('sent_bytes')} AS sent, max(duration_ms) AS max_ms, count(DISTINCT uri) AS apis, count(DISTINCT user_agent) AS agents, {AVG},
    CASE WHEN {ERR} * 1e2 / count(*) > 20 THEN 80e0 WHEN count(*) > 1000 THEN 60e0 ELSE 20e0 END AS risk_score, CASE WHEN {ERR} * 1e2 / count(*) > 20 THEN 'high' WHEN count(*) > 1000 THEN 'medium' ELSE 'low' END AS risk_level
    FROM hits GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    return realtime.ip_behaviour(hits(spark, sf))


@register(
    "l13_daily_clients",
    GROUPED + f" SELECT day, client_ip, platform, {N}, count(DISTINCT uri) AS apis, {ERR} AS errors, max(duration_ms) AS max_ms, {isum('body_bytes')} AS bytes, {AVG} FROM gp GROUP BY 1, 2, 3 HAVING count(*) >= 2",
)
def _(spark, sf):
    return realtime.daily_clients(hits(spark, sf))


@register(
    "l13_daily_errors",
    f""", k AS (SELECT stat_hour, status, api_category, count(*) AS errors, {CLI} FROM hits WHERE NOT is_success GROUP BY 1, 2, 3)
    SELECT stat_hour, status, api_category, uri, count(*) AS uri_errors, any_value(errors) AS errors, any_value(clients) AS clients FROM hits JOIN k USING (stat_hour, status, api_category) WHERE NOT is_success GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    return realtime.daily_errors(hits(spark, sf))


@register("l14_hot_daily", GROUPED + f" SELECT day, uri, platform, {N}, {OK} AS successes, {isum('body_bytes')} AS bytes, count(DISTINCT client_ip) AS visitors, {AVG} FROM gp GROUP BY 1, 2, 3")
def _(spark, sf):
    return realtime.hot_daily(hits(spark, sf))


@register("l14_slow_daily", GROUPED + f" SELECT day, uri, platform, {N}, {SLOW} AS slow, {P95}, {AVG} FROM gp WHERE duration_ms >= 1000 GROUP BY 1, 2, 3")
def _(spark, sf):
    return realtime.slow_daily(hits(spark, sf))


@register(
    "l14_cache_daily",
    GROUPED + f" SELECT day, api_category, {N}, {n_if('duration_ms < 100')} AS cache_hits, {n_if('duration_ms >= 100')} AS cache_misses, {n_if('duration_ms < 100')} * 1e2 / count(*) AS hit_rate FROM gp GROUP BY 1, 2",
)
def _(spark, sf):
    return realtime.cache_daily(hits(spark, sf))


@register("l14_cluster_daily", GROUPED + f" SELECT day, server_name, {N}, {OK} AS successes, {P95}, {AVG}, {OK} * 1e2 / count(*) AS success_rate FROM gp GROUP BY 1, 2")
def _(spark, sf):
    return realtime.cluster_daily(hits(spark, sf))


@register(
    "l15_overview",
    f"SELECT {N}, {CLI}, {AVG}, {OK} * 1e2 / count(*) AS success_rate, {ERR} * 1e2 / count(*) AS error_rate, {SLOW} AS slow, {n_if("status = '404'")} AS not_found, {n_if("status = '500'")} AS failed FROM hits",
)
def _(spark, sf):
    return insight.overview(hits(spark, sf))


L16_SQL = f""", l16 AS (SELECT uri, api_category, platform, {N}, {AVG}, {P95}, {OK} * 1e2 / count(*) AS success_rate, {ERR} * 1e2 / count(*) AS error_rate FROM hits GROUP BY 1, 2, 3)"""
L16_TAIL = """ SELECT *, CASE WHEN avg_ms = 0 THEN 'Unknown' WHEN avg_ms > 3000 THEN 'Critical' WHEN avg_ms > 1000 OR error_rate > 5 THEN 'Warning' ELSE 'Healthy' END AS health FROM l16 ORDER BY requests DESC, uri, api_category, platform LIMIT """


@register("l16_hottest_apis", L16_SQL + L16_TAIL + "10")
def _(spark, sf):
    return insight.hottest_apis(hits(spark, sf))


@register("l16_all_apis", L16_SQL + L16_TAIL + "1000000")
def _(spark, sf):
    return insight.hottest_apis(hits(spark, sf), 1_000_000)


L17_SQL = f""", l17 AS (SELECT uri, platform, {N}, {AVG}, {P95}, {OK} * 1e2 / count(*) AS success_rate, {SLOW} AS slow, avg(process_ms) AS avg_process_ms, avg(front_ms) AS avg_transfer_ms FROM hits WHERE duration_ms > 0 GROUP BY 1, 2),
    l17b AS (SELECT *, CASE WHEN avg_process_ms = 0 AND avg_transfer_ms = 0 THEN 'Unknown' WHEN avg_process_ms > 1000 THEN '后端处理慢' WHEN avg_transfer_ms > 500 THEN '数据传输慢' WHEN avg_ms > 3000 THEN '整体响应慢' ELSE '正常' END AS problem FROM l17)"""


@register("l17_slowest_apis", L17_SQL + " SELECT * FROM l17b ORDER BY avg_ms DESC, uri, platform LIMIT 10")
def _(spark, sf):
    return insight.slowest_apis(hits(spark, sf))


@register("l18_platforms", f"SELECT platform, {N}, {CLI}, count(*) * 1e2 / (SELECT count(*) FROM hits) AS share, {AVG}, {OK} * 1e2 / count(*) AS success_rate FROM hits GROUP BY 1")
def _(spark, sf):
    return insight.platforms(hits(spark, sf))


L19_SQL = f"""SELECT uri, status, platform, {N}, {ERR} AS errors, {ERR} * 1e2 / count(*) AS error_rate, CASE WHEN {ERR} * 1e2 / count(*) > 20 THEN 'HIGH' ELSE 'MEDIUM' END AS alert FROM hits WHERE duration_ms > 0
    GROUP BY 1, 2, 3 HAVING {ERR} * 1e2 / count(*) >= 5"""


@register("l19_error_alerts", L19_SQL)
def _(spark, sf):
    return insight.error_alerts(hits(spark, sf))


@register(
    "l20_status_distribution",
    f""", g AS (SELECT status, {N}, count(*) * 1e2 / (SELECT count(*) FROM hits) AS share, {AVG}, {CLI} FROM hits GROUP BY 1)
    SELECT *, CASE left(status, 1) WHEN '2' THEN 'Success' WHEN '3' THEN 'Redirect' WHEN '4' THEN 'Client Error' WHEN '5' THEN 'Server Error' ELSE 'Info' END AS kind,
    CASE WHEN status LIKE '5%' AND share > 1 THEN 'Critical' WHEN status LIKE '4%' AND share > 10 THEN 'High' WHEN share > 50 THEN 'Medium' ELSE 'Low' END AS severity FROM g""",
)
def _(spark, sf):
    return insight.status_distribution(hits(spark, sf))


@register(
    "l21_error_trend",
    f""", g AS (SELECT hour, {N}, {n_if("status LIKE '4%'")} AS client_errors, {n_if("status LIKE '5%'")} AS server_errors, {ERR} AS errors, {ERR} * 1e2 / count(*) AS error_rate FROM hits GROUP BY 1)
    SELECT *, CASE WHEN error_rate < 1 THEN 'Excellent' WHEN error_rate < 5 THEN 'Good' WHEN error_rate < 10 THEN 'Warning' ELSE 'Critical' END AS health FROM g""",
)
def _(spark, sf):
    return insight.error_trend(hits(spark, sf))


L22_SQL = f""", l22 AS (SELECT status, uri, platform, count(*) AS errors, max(log_time) AS last_seen, {CLI} FROM hits WHERE status IN ('500', '502', '503', '504', '404') GROUP BY 1, 2, 3),
    l22b AS (SELECT *, CASE WHEN status <> '404' AND errors > 10 THEN 'P0' WHEN status <> '404' THEN 'P1' WHEN errors > 50 THEN 'P2' ELSE 'P3' END AS priority, CASE WHEN clients > 100 THEN 'High' WHEN clients > 10 THEN 'Medium' ELSE 'Low' END AS impact FROM l22
    ORDER BY errors DESC, status, uri, platform LIMIT 20)"""


@register("l22_critical_errors", L22_SQL + " SELECT * FROM l22b")
def _(spark, sf):
    return insight.critical_errors(hits(spark, sf))


_PERIOD = "CASE WHEN hour < 6 THEN '深夜/凌晨' WHEN hour < 9 THEN '早高峰' WHEN hour < 12 THEN '上午业务' WHEN hour < 14 THEN '午休时段' WHEN hour < 18 THEN '下午业务' WHEN hour < 21 THEN '晚高峰' ELSE '夜间活跃' END AS period"


@register(
    "l23_day_pattern",
    f""", g AS (SELECT hour, {N}, {CLI}, count(DISTINCT uri) AS apis, {AVG}, {OK} * 1e2 / count(*) AS success_rate, {SLOW} AS slow FROM hits GROUP BY 1) SELECT *, requests * 1e2 / (SELECT max(requests) FROM g) AS intensity, {_PERIOD} FROM g""",
)
def _(spark, sf):
    return insight.day_pattern(hits(spark, sf))


@register(
    "l24_peaks",
    """, g AS (SELECT hour, count(*) AS n FROM hits GROUP BY 1), p AS (SELECT max(n) AS peak, min(n) AS valley, avg(n) AS average, arg_min(hour, (-n, hour)) AS peak_hour, arg_min(hour, (n, hour)) AS valley_hour, max(n)::DOUBLE / min(n) AS ratio FROM g)
    SELECT *, CASE WHEN ratio > 10 THEN 'High' WHEN ratio > 5 THEN 'Medium' WHEN ratio > 2 THEN 'Low' ELSE 'Stable' END AS volatility FROM p""",
)
def _(spark, sf):
    return insight.peaks(hits(spark, sf))


@register(
    "l25_latency_trend",
    f""", g AS (SELECT hour, {N}, max(duration_ms) AS max_ms, {P50}, {P95}, {P99}, {AVG} FROM hits WHERE duration_ms > 0 GROUP BY 1)
    SELECT *, CASE WHEN avg_ms < 100 AND p95 < 500 THEN 'A' WHEN avg_ms < 500 AND p95 < 1000 THEN 'B' WHEN avg_ms < 1000 AND p95 < 2000 THEN 'C' ELSE 'D' END AS grade FROM g""",
)
def _(spark, sf):
    return insight.latency_trend(hits(spark, sf))


_IN = "hour BETWEEN 9 AND 18"


@register(
    "l26_business_hours",
    f""", g AS (SELECT {n_if(_IN)} AS business_requests, {n_if('NOT ' + '(' + _IN + ')')} AS off_requests, count(DISTINCT client_ip) FILTER (WHERE {_IN}) AS business_clients, count(DISTINCT client_ip) FILTER (WHERE NOT ({_IN})) AS off_clients,
      avg(duration_ms) FILTER (WHERE {_IN}) AS business_ms, avg(duration_ms) FILTER (WHERE NOT ({_IN})) AS off_ms FROM hits)
    SELECT *, business_requests::DOUBLE / off_requests AS load_ratio, CASE WHEN business_clients > off_clients * 3 THEN '典型工作日模式' WHEN business_clients > off_clients THEN '轻度工作日模式' WHEN business_clients = off_clients THEN '全天均衡模式' ELSE '非工作时间活跃' END AS pattern FROM g""",
)
def _(spark, sf):
    return insight.business_hours(hits(spark, sf))


_ENG = "CASE WHEN depth >= 10 THEN 'High' WHEN depth >= 5 THEN 'Medium' ELSE 'Low' END AS engagement"


@register(
    "l27_traffic_overview",
    f""", g AS (SELECT {N}, count(DISTINCT client_ip) AS visitors, count(DISTINCT session_id) AS sessions, count(DISTINCT platform) AS platforms, count(DISTINCT api_category) AS categories, count(*)::DOUBLE / count(DISTINCT session_id) AS depth FROM hits) SELECT *, {_ENG} FROM g""",
)
def _(spark, sf):
    return insight.traffic_overview(hits(spark, sf))


@register(
    "l28_platform_mix",
    f""", g AS (SELECT platform, device, entry_source, {N}, {CLI}, {AVG}, {OK} * 1e2 / count(*) AS success_rate, count(*)::DOUBLE / count(DISTINCT session_id) AS depth FROM hits GROUP BY 1, 2, 3) SELECT *, {_ENG} FROM g""",
)
def _(spark, sf):
    return insight.platform_mix(hits(spark, sf))


@register("l29_categories", f"SELECT api_category, {N}, count(*) * 1e2 / (SELECT count(*) FROM hits) AS share, {CLI}, {AVG}, {SLOW} AS slow, {SLOW} * 1e2 / count(*) AS slow_rate FROM hits GROUP BY 1")
def _(spark, sf):
    return insight.categories(hits(spark, sf))


@register(
    "l30_hourly_traffic",
    f"SELECT hour, {N}, {CLI}, {AVG}, {ERR} * 1e2 / count(*) AS error_rate, CASE WHEN count(*) >= 1000 THEN 'Peak' WHEN count(*) >= 500 THEN 'High' WHEN count(*) >= 100 THEN 'Medium' ELSE 'Low' END AS level FROM hits GROUP BY 1",
)
def _(spark, sf):
    return insight.hourly_traffic(hits(spark, sf))


_REGION = "CASE WHEN regexp_matches(client_ip, '^(10\\.|192\\.168\\.|172\\.(1[6-9]|2\\d|3[01])\\.)') THEN 'Internal' WHEN client_ip LIKE '127.%' THEN 'Localhost' WHEN client_ip LIKE '169.254.%' THEN 'Link-Local' ELSE 'External' END AS region"


@register(
    "l31_top_clients",
    f""", g AS (SELECT client_ip, {N}, count(DISTINCT uri) AS apis, count(DISTINCT platform) AS platforms, {AVG}, {OK} * 1e2 / count(*) AS success_rate, {ERR} AS errors, min(log_time) AS first_seen, max(log_time) AS last_seen FROM hits GROUP BY 1)
    SELECT *, {_REGION}, CASE WHEN requests > 1000 THEN 'High Volume' WHEN apis > 20 THEN 'API Explorer' WHEN platforms > 3 THEN 'Multi-Platform' WHEN requests > 100 THEN 'Active User' ELSE 'Normal User' END AS behaviour,
    least(100, CASE WHEN requests > 10000 THEN 40 WHEN requests > 1000 THEN 20 WHEN requests > 100 THEN 5 ELSE 0 END + CASE WHEN success_rate < 50 THEN 30 WHEN success_rate < 80 THEN 15 WHEN success_rate < 95 THEN 5 ELSE 0 END
      + CASE WHEN errors > 100 THEN 30 WHEN errors > 50 THEN 15 WHEN errors > 10 THEN 5 ELSE 0 END) AS risk FROM g ORDER BY requests DESC, client_ip LIMIT 20""",
)
def _(spark, sf):
    return insight.top_clients(hits(spark, sf))


@register(
    "l32_regions",
    f""", x AS (SELECT *, {_REGION} FROM hits), g AS (SELECT region, {N}, count(*) * 1e2 / (SELECT count(*) FROM hits) AS share, {CLI}, count(DISTINCT platform) AS platforms, {AVG}, {OK} * 1e2 / count(*) AS success_rate FROM x GROUP BY 1)
    SELECT *, CASE WHEN region IN ('Internal', 'Localhost') THEN 'Trusted' WHEN region = 'External' THEN 'Monitor' ELSE 'Caution' END AS trust FROM g""",
)
def _(spark, sf):
    return insight.regions(hits(spark, sf))


L33_SQL = f""", s0 AS (SELECT client_ip, {N}, count(DISTINCT uri) AS paths, {ERR} AS errors, {n_if("status = '404'")} AS not_found, {SLOW} AS slow, max(log_time) AS last_seen, {AVG} FROM hits GROUP BY 1),
    sus AS (SELECT *, CASE WHEN requests > 10000 OR errors > 1000 THEN 'High' WHEN requests > 1000 OR errors > 100 OR not_found > 500 THEN 'Medium' WHEN requests > 100 OR errors > 10 THEN 'Low' ELSE 'Minimal' END AS threat,
      CASE WHEN not_found > requests * 0.5 THEN 'Scanner/Crawler' WHEN errors > requests * 0.3 THEN 'Error Generator' WHEN paths > requests * 0.8 THEN 'Path Explorer' WHEN requests > 1000 THEN 'Heavy User' ELSE 'Normal Activity' END AS activity
      FROM s0 WHERE requests > 50 OR errors > 10 OR not_found > 20)"""


@register("l33_suspicious_clients", L33_SQL + " SELECT * FROM sus")
def _(spark, sf):
    return insight.suspicious_clients(hits(spark, sf), None)


@register("l33_suspicious_top", L33_SQL + " SELECT * FROM sus ORDER BY requests DESC, client_ip LIMIT 20")
def _(spark, sf):
    return insight.suspicious_clients(hits(spark, sf))


@register(
    "l34_client_diversity",
    f""", g AS (SELECT {N}, {CLI}, count(DISTINCT platform) AS platforms, count(DISTINCT api_category) AS categories, {AVG}, count(*)::DOUBLE / count(DISTINCT client_ip) AS requests_per_client, least(100e0, count(DISTINCT client_ip) * 1e2 / count(*)) AS diversity FROM hits)
    SELECT *, CASE WHEN requests_per_client > 1000 THEN 'Highly Concentrated' WHEN requests_per_client > 100 THEN 'Concentrated' WHEN requests_per_client > 10 THEN 'Moderate' ELSE 'Distributed' END AS concentration FROM g""",
)
def _(spark, sf):
    return insight.client_diversity(hits(spark, sf))


@register(
    "l35_agent_analysis",
    f""", g AS (SELECT platform, device, {N}, count(*) * 1e2 / (SELECT count(*) FROM hits) AS share, {CLI}, {AVG}, {OK} * 1e2 / count(*) AS success_rate, {SLOW} AS slow, {ERR} AS errors, lower(platform) AS p, {SLOW} * 1e2 / count(*) AS sr FROM hits GROUP BY 1, 2)
    SELECT * EXCLUDE (p, sr), CASE WHEN regexp_matches(p, 'bot|crawler') THEN 'Bot' ELSE 'Normal' END AS category,
    CASE WHEN regexp_matches(p, 'chrome|android') THEN 'Webkit-based' WHEN contains(p, 'firefox') THEN 'Gecko-based' WHEN regexp_matches(p, 'safari|ios') THEN 'WebKit-Safari' WHEN contains(p, 'sdk') THEN 'Native-SDK' ELSE 'Other' END AS engine,
    CASE WHEN contains(p, 'windows') THEN 'Windows' WHEN regexp_matches(p, 'mac|osx') THEN 'macOS' WHEN contains(p, 'linux') THEN 'Linux' WHEN contains(p, 'android') THEN 'Android' WHEN regexp_matches(p, 'ios|iphone') THEN 'iOS' ELSE 'Unknown' END AS system,
    CASE WHEN avg_ms < 500 AND sr < 5 THEN 'Excellent' WHEN avg_ms < 1000 AND sr < 10 THEN 'Good' WHEN avg_ms < 2000 AND sr < 20 THEN 'Fair' ELSE 'Poor' END AS grade FROM g""",
)
def _(spark, sf):
    return insight.agent_analysis(hits(spark, sf))


@register("l36_agent_counts", "SELECT count(DISTINCT platform) AS platforms, count(DISTINCT browser) AS browsers, count(DISTINCT os) AS systems, count(DISTINCT device) AS devices FROM hits")
def _(spark, sf):
    return insight.agent_counts(hits(spark, sf))


@register(
    "l37_referer_analysis",
    f""", g AS (SELECT entry_source, {N}, count(*) * 1e2 / (SELECT count(*) FROM hits) AS share, {CLI}, count(DISTINCT uri) AS apis, {AVG}, {OK} * 1e2 / count(*) AS success_rate, count(*)::DOUBLE / count(DISTINCT session_id) AS depth FROM hits GROUP BY 1),
    p AS (SELECT *, CASE WHEN success_rate > 95 THEN 30 WHEN success_rate > 90 THEN 20 WHEN success_rate > 80 THEN 10 ELSE 0 END + CASE WHEN depth > 5 THEN 30 WHEN depth > 2 THEN 20 WHEN depth > 1 THEN 10 ELSE 0 END
      + CASE WHEN apis > 10 THEN 40 WHEN apis > 5 THEN 30 WHEN apis > 2 THEN 20 ELSE 0 END AS pts FROM g)
    SELECT * EXCLUDE (pts), CASE WHEN entry_source = 'Direct' THEN 'Direct' WHEN regexp_matches(lower(entry_source), 'google|baidu') THEN 'Search Engine' WHEN regexp_matches(lower(entry_source), 'social|wechat') THEN 'Social Media'
      WHEN regexp_matches(lower(entry_source), 'api|app') THEN 'API/App' ELSE 'External Link' END AS kind, CASE WHEN depth >= 10 THEN 'Very High' WHEN depth >= 5 THEN 'High' WHEN depth >= 2 THEN 'Medium' ELSE 'Low' END AS engagement,
    CASE WHEN pts >= 80 THEN 'Excellent' WHEN pts >= 60 THEN 'Good' WHEN pts >= 40 THEN 'Fair' ELSE 'Poor' END AS quality FROM p""",
)
def _(spark, sf):
    return insight.referer_analysis(hits(spark, sf))


@register(
    "l38_platform_performance",
    f""", g AS (SELECT platform, device, {N}, {CLI}, {AVG}, {P50}, {P95}, {P99}, {SLOW} AS slow, {SLOW} * 1e2 / count(*) AS slow_rate, {OK} * 1e2 / count(*) AS success_rate, avg(process_ms) AS backend_ms, avg(front_ms) AS transfer_ms FROM hits WHERE duration_ms > 0 GROUP BY 1, 2)
    SELECT *, greatest(0, 100 - CASE WHEN avg_ms > 3000 THEN 40 WHEN avg_ms > 1000 THEN 20 WHEN avg_ms > 500 THEN 10 ELSE 0 END - CASE WHEN p95 > 5000 THEN 30 WHEN p95 > 2000 THEN 15 WHEN p95 > 1000 THEN 5 ELSE 0 END
      - CASE WHEN success_rate < 90 THEN 20 WHEN success_rate < 95 THEN 10 WHEN success_rate < 99 THEN 5 ELSE 0 END) AS score,
    CASE WHEN backend_ms = 0 OR transfer_ms = 0 THEN 'Unknown' WHEN backend_ms / avg_ms > 0.7 THEN 'Backend Processing' WHEN transfer_ms / avg_ms > 0.3 THEN 'Network Transfer' WHEN avg_ms > 3000 THEN 'Overall Slow' ELSE 'Balanced' END AS bottleneck,
    CASE WHEN requests * 0.3e0 + slow * 0.5e0 + avg_ms / 1000 * 0.2e0 > 1000 THEN 'Critical' WHEN requests * 0.3e0 + slow * 0.5e0 + avg_ms / 1000 * 0.2e0 > 500 THEN 'High' WHEN requests * 0.3e0 + slow * 0.5e0 + avg_ms / 1000 * 0.2e0 > 100 THEN 'Medium' ELSE 'Low' END AS priority FROM g""",
)
def _(spark, sf):
    return insight.platform_performance(hits(spark, sf))


@register("l39_performance_overview", f"SELECT count(DISTINCT platform) AS platforms, {SLOW} AS slow, {AVG}, round(stddev_pop(duration_ms) / avg(duration_ms) * 100, 4) AS variation FROM hits")
def _(spark, sf):
    return insight.performance_overview(hits(spark, sf))


@register(
    "l40_bots",
    f""", g AS (SELECT bot_type, {N}, {AVG}, count(*) / 30e0 AS per_day, {OK} * 1e2 / count(*) AS success_rate, lower(bot_type) AS b FROM hits WHERE bot_type IS NOT NULL GROUP BY 1)
    SELECT * EXCLUDE (b), CASE WHEN regexp_matches(b, 'google|bingbot') THEN 'Search' WHEN regexp_matches(b, 'monitor|check') THEN 'Monitor' WHEN regexp_matches(b, 'facebook|twitter') THEN 'Social' ELSE 'Other' END AS kind,
    CASE WHEN requests * (avg_ms / 1000) > 10000 THEN 'High' WHEN requests * (avg_ms / 1000) > 1000 THEN 'Medium' ELSE 'Low' END AS load,
    CASE WHEN success_rate > 90 AND per_day < 100 THEN 'Positive' WHEN success_rate < 70 OR per_day > 1000 THEN 'Negative' ELSE 'Neutral' END AS effect FROM g ORDER BY requests DESC, bot_type LIMIT 10""",
)
def _(spark, sf):
    return insight.bots(hits(spark, sf), 720)


L41_SQL = f""", r0 AS (SELECT platform, entry_source, device, {N}, {CLI}, count(DISTINCT uri) AS paths, {ERR} AS errors, {AVG}, count(*)::DOUBLE / count(DISTINCT client_ip) AS per_client, {ERR} * 1e2 / count(*) AS error_rate FROM hits GROUP BY 1, 2, 3 HAVING count(*) > 10),
    r1 AS (SELECT *, least(100, CASE WHEN per_client > 1000 THEN 40 WHEN per_client > 100 THEN 20 WHEN per_client > 50 THEN 10 ELSE 0 END + CASE WHEN error_rate > 50 THEN 30 WHEN error_rate > 20 THEN 15 WHEN error_rate > 10 THEN 5 ELSE 0 END
      + CASE WHEN paths::DOUBLE / requests > 0.5 THEN 20 ELSE 0 END + CASE WHEN platform = 'Unknown' OR contains(lower(platform), 'bot') THEN 15 ELSE 0 END) AS risk FROM r0)"""


@register("l41_header_risks", L41_SQL + " SELECT *, CASE WHEN risk > 80 THEN 'Critical' WHEN risk > 60 THEN 'High' WHEN risk > 40 THEN 'Medium' WHEN risk > 20 THEN 'Low' ELSE 'Minimal' END AS level FROM r1")
def _(spark, sf):
    return insight.header_risks(hits(spark, sf))


@register(
    "l41_header_risk_summary",
    L41_SQL + f" SELECT count(*) AS patterns, {n_if('risk > 50')} AS suspicious, {n_if('risk > 80')} AS high, {n_if('risk > 50 AND risk <= 80')} AS medium, {n_if('risk <= 50 AND risk > 20')} AS low FROM r1",
)
def _(spark, sf):
    return insight.header_risk_summary(insight.header_risks(hits(spark, sf)))


@register(
    "l42_table_statistics",
    f"""SELECT {N}, min(log_time) AS first_time, max(log_time) AS last_time, {OK} * 1e2 / count(*) AS success_rate, {SLOW} * 1e2 / count(*) AS slow_rate, {n_if('has_anomaly')} * 1e2 / count(*) AS anomaly_rate,
    round(avg(CASE WHEN referer = '' THEN 90e0 ELSE 100e0 END), 6) AS avg_quality FROM hits""",
)
def _(spark, sf):
    return insight.table_statistics(hits(spark, sf), F.when(F.col("referer") == "", 90.0).otherwise(100.0))


_L43D = ["platform", "entry_source", "api_category"]


def _dims_sql(dims, where="") -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS label, {BASE}, {n_if('has_anomaly')} AS anomalies, {RATES}, {n_if('has_anomaly')} * 1e2 / count(*) AS anomaly_rate FROM hits {where} GROUP BY {d}" for d in dims
    )


@register("l43_dimension_analysis", _dims_sql(_L43D))
def _(spark, sf):
    return insight.dimension_analysis(hits(spark, sf), _L43D)


@register(
    "l44_platform_detail",
    f", x AS ({_dims_sql(['platform', 'api_category', 'status'], "WHERE platform = 'Android'")}) SELECT dimension, label, requests, avg_ms, success_rate, slow_rate FROM x",
)
def _(spark, sf):
    return insight.platform_detail(hits(spark, sf), "Android")


@register(
    "l45_security_score",
    L33_SQL
    + L22_SQL
    + """, z AS (SELECT (SELECT count(*) FROM sus) AS suspicious, (SELECT count(*) FROM l22) AS critical) SELECT suspicious, critical, greatest(0e0, 100 - suspicious * 2 - critical * 1.5e0) AS security_score FROM z""",
)
def _(spark, sf):
    return insight.security_score(hits(spark, sf))


@register(
    "l46_combined_report",
    L16_SQL
    + L17_SQL
    + f""", o AS (SELECT count(*)::DOUBLE AS requests, count(DISTINCT client_ip)::DOUBLE AS clients, avg(duration_ms) AS avg_ms, {OK} * 1e2 / count(*) AS success_rate, {ERR} * 1e2 / count(*) AS error_rate FROM hits), al AS ({L19_SQL})
    SELECT 'overview' AS section, name, round(value, 6) AS value FROM (UNPIVOT (SELECT requests, clients, avg_ms, success_rate, error_rate, least(100e0, success_rate) AS stability_score, greatest(0e0, 100 - avg_ms / 30) AS latency_score FROM o)
      ON requests, clients, avg_ms, success_rate, error_rate, stability_score, latency_score INTO NAME name VALUE value)
    UNION ALL (SELECT 'hot', uri, requests::DOUBLE FROM l16 ORDER BY requests DESC, uri, api_category, platform LIMIT 5)
    UNION ALL (SELECT 'slow', uri, round(avg_ms, 6) FROM l17 ORDER BY avg_ms DESC, uri, platform LIMIT 5)
    UNION ALL SELECT 'alerts', 'count', count(*)::DOUBLE FROM al""",
)
def _(spark, sf):
    return insight.combined_report(hits(spark, sf))


# ---------------------------------------------------------------- panels


@register("d01_uri_top", f"SELECT uri, {N}, {P95}, {AVG} FROM hits GROUP BY 1 HAVING count(*) >= 10 ORDER BY requests DESC, uri LIMIT 50")
def _(spark, sf):
    return panels.uri_latency(hits(spark, sf))


@register("d02_uri_slowest", f"SELECT uri, {N}, {P95}, {AVG} FROM hits GROUP BY 1 HAVING count(*) >= 5 ORDER BY p95 DESC, uri LIMIT 10")
def _(spark, sf):
    return panels.uri_latency(hits(spark, sf), min_requests=5, n=10, by="p95")


def slot(seconds: int) -> str:
    return f"make_timestamp(epoch_us(log_time) // {seconds * 1000000} * {seconds * 1000000})"


@register("d03_interval_uri", f"SELECT {slot(3600)} AS slot, uri, {N}, avg(duration_ms) AS avg_duration_ms FROM hits GROUP BY 1, 2")
def _(spark, sf):
    return panels.mean_by(hits(spark, sf), {"slot": panels.interval(3600), "uri": F.col("uri")})


_LAT = ["connect_ms", "header_ms", "response_ms", "duration_ms"]


@register("d04_interval_phases", f"SELECT {slot(300)} AS slot, {N}, {', '.join(f'avg({m}) AS avg_{m}' for m in _LAT)} FROM hits GROUP BY 1")
def _(spark, sf):
    return panels.mean_by(hits(spark, sf), {"slot": panels.interval(300)}, _LAT)


@register("d05_status_share", f"SELECT status, {N}, count(*) * 1e2 / (SELECT count(*) FROM hits) AS share, {AVG} FROM hits GROUP BY 1")
def _(spark, sf):
    return panels.status_share(hits(spark, sf))


@register("d06_method_latency", f"SELECT request_method, {N}, avg(duration_ms) AS avg_duration_ms FROM hits GROUP BY 1")
def _(spark, sf):
    return panels.mean_by(hits(spark, sf), {"request_method": F.col("request_method")})


@register("d07_agent_prefixes", f"SELECT left(user_agent, 20) AS agent, {N} FROM hits GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(spark, sf):
    return panels.agent_prefixes(hits(spark, sf))


_R1 = f", r1 AS (SELECT stat_hour, tenant, environment, platform, access_type, entry_point, channel, client_type, uri, api_category, module, business_domain, operation, {N}, {OK} AS successes, {BAD} AS errors, {SLOW} AS slow, {P95} FROM hits GROUP BY ALL)"


@register(
    "d08_rollup_means",
    _R1 + " SELECT sum(requests)::DOUBLE / (count(DISTINCT stat_hour) * 3600e0) AS avg_qps, sum(successes)::DOUBLE * 1e2 / sum(requests)::DOUBLE AS availability, sum(errors)::DOUBLE * 1e2 / sum(requests)::DOUBLE AS error_rate, round(avg(p95), 4) AS avg_p95 FROM r1",
)
def _(spark, sf):
    return panels.rollup_means(rollups.api_performance(hits(spark, sf)))


@register("d09_rollup_series", _R1 + " SELECT stat_hour, sum(requests)::DOUBLE / 3600e0 AS qps, max(p95) AS p95 FROM r1 GROUP BY 1")
def _(spark, sf):
    return panels.rollup_series(rollups.api_performance(hits(spark, sf)))


@register("d10_rollup_top_requests", _R1 + f" SELECT uri, {isum('requests')} AS requests, {isum('slow')} AS slow FROM r1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(spark, sf):
    return panels.rollup_top(rollups.api_performance(hits(spark, sf)), "requests")


@register("d10_rollup_top_slow", _R1 + f" SELECT uri, {isum('requests')} AS requests, {isum('slow')} AS slow FROM r1 GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10")
def _(spark, sf):
    return panels.rollup_top(rollups.api_performance(hits(spark, sf)), "slow")


@register("d11_error_totals", f"SELECT {N}, {ERR} AS errors, count(DISTINCT client_ip) FILTER (WHERE is_error) AS clients, {ERR} * 1e2 / count(*) AS error_rate FROM hits")
def _(spark, sf):
    return panels.error_totals(hits(spark, sf))


@register("d12_status_counts", f"SELECT status, {N} FROM hits GROUP BY 1")
def _(spark, sf):
    return panels.status_counts(hits(spark, sf))


@register("d13_error_series", f"SELECT {slot(300)} AS slot, {N}, {ERR} AS errors, {ERR} * 1e2 / count(*) AS error_rate FROM hits GROUP BY 1")
def _(spark, sf):
    return panels.error_series(hits(spark, sf), 300)


@register("d13_status_series", f"SELECT {slot(300)} AS slot, status, {N} FROM hits GROUP BY 1, 2")
def _(spark, sf):
    return panels.status_series(hits(spark, sf), 300)


@register("d14_top_errors", "SELECT uri, status, count(*) AS errors, count(*) * 1e2 / (SELECT count(*) FROM hits WHERE is_error) AS share FROM hits WHERE is_error GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20")
def _(spark, sf):
    return panels.top_errors(hits(spark, sf))


@register("d15_error_clients", f"SELECT client_ip, count(*) AS errors, count(DISTINCT uri) AS apis, {AVG} FROM hits WHERE is_error GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def _(spark, sf):
    return panels.error_clients(hits(spark, sf))


@register("d16_hourly_errors", f"SELECT stat_hour, {N}, {ERR} AS errors, {n_if("status = '404'")} AS not_found, {n_if("status LIKE '5%'")} AS server_errors FROM hits GROUP BY 1")
def _(spark, sf):
    return panels.hourly_errors(hits(spark, sf))


@register(
    "d17_last_minutes",
    f"SELECT {N}, count(*) / 3600e0 AS qps, {AVG}, CASE WHEN count(*) > 0 THEN {ERR} * 1e2 / count(*) ELSE 0 END AS error_rate FROM hits WHERE log_time > TIMESTAMP '2024-01-30 11:00:00' AND log_time <= TIMESTAMP '2024-01-30 12:00:00'",
)
def _(spark, sf):
    return panels.last_minute(hits(spark, sf), "2024-01-30 12:00:00", 3600)


@register("d18_suspicious_ips", f"SELECT client_ip, {N}, max(status) AS max_status FROM hits WHERE status = '404' OR status >= '500' GROUP BY 1 HAVING count(*) > 10")
def _(spark, sf):
    return panels.suspicious_ips(hits(spark, sf))


@register("d19_attacked_paths", f"SELECT uri, {N}, {CLI} FROM hits WHERE regexp_matches(request_uri, 'admin|\\.php|sql|script') GROUP BY 1")
def _(spark, sf):
    return panels.attacked(hits(spark, sf))


@register("d20_availability", f"SELECT {n_if('CAST(status AS INT) < 400')} * 1e2 / count(*) AS availability, {AVG}, {CLI} FROM hits")
def _(spark, sf):
    return panels.availability(hits(spark, sf))


@register("d21_observed_qps", "SELECT count(*) AS n, count(*)::DOUBLE / date_diff('second', min(log_time), max(log_time)) AS qps FROM hits")
def _(spark, sf):
    return panels.observed_qps(hits(spark, sf))


@register("d22_qps_series", f"SELECT {slot(60)} AS slot, {N}, count(*) / 60e0 AS qps FROM hits GROUP BY 1")
def _(spark, sf):
    return panels.qps_series(hits(spark, sf), 60)


@register("d23_latency_series", f"SELECT {slot(300)} AS slot, {N}, {P50}, {P95}, {P99}, {AVG} FROM hits GROUP BY 1")
def _(spark, sf):
    return panels.latency_series(hits(spark, sf), 300)


@register("d24_hour_histogram", f"SELECT hour, {N} FROM hits GROUP BY 1")
def _(spark, sf):
    return panels.histogram(hits(spark, sf), "hour")


@register("d24_weekday_histogram", f"SELECT weekday, {N} FROM hits GROUP BY 1")
def _(spark, sf):
    return panels.histogram(hits(spark, sf), "weekday")
