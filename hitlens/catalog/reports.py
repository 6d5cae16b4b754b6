"""Aggregate reports (A1-A54) with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.catalog.base import ORACLES, access, hits, pct, register, sql_case, table
from hitlens.functions import clock
from hitlens.operators import measures, occupancy, sequence
from hitlens.plans import api, cdn, clients, errors, headers, service, slow, stability, status, summary, timeline

c = F.col


def n_if(test: str) -> str:
    return f"count(*) FILTER (WHERE {test})"


def isum(expr: str) -> str:
    return f"CAST(sum({expr}) AS BIGINT)"


def srate(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {a} * 1e2 / {b} ELSE 0e0 END"


PH = ["connect_ms", "process_ms", "backend_transfer_ms", "front_ms"]
OKW = "is_success"

A1_SQL = f""", g AS (SELECT uri, min(application) AS application, min(service) AS service, count(*) AS requests, {n_if(OKW)} AS successes, {n_if('is_success AND is_slow')} AS slow,
    avg(duration_ms) FILTER (WHERE is_success) AS avg_ms, avg(body_bytes) FILTER (WHERE is_success) AS avg_body,
    {", ".join(f"{isum(p)[:-11]} FILTER (WHERE is_success) AS BIGINT) AS s_{p}" for p in PH)},
    {pct('duration_ms', .5, 'p50', OKW)}, {pct('duration_ms', .9, 'p90', OKW)}, {pct('duration_ms', .95, 'p95', OKW)}, {pct('duration_ms', .99, 'p99', OKW)},
    {pct('body_bytes', .5, 'body_p50', OKW)}, {pct('body_bytes', .95, 'body_p95', OKW)} FROM hits GROUP BY uri HAVING {n_if(OKW)} > 0),
    t AS (SELECT {n_if('is_success AND is_slow')} AS all_slow, {n_if(OKW)} AS all_ok FROM hits),
    r AS (SELECT uri, application, service, requests, successes, slow, p50, p90, p95, p99, body_p50, body_p95, avg_ms, avg_body, {srate('successes', 'requests')} AS success_rate,
      {srate('slow', 'successes')} AS slow_rate, {srate('slow', 'all_slow')} AS share_of_slow, {srate('successes', 'all_ok')} AS share_of_success,
      {", ".join(f"{srate(f's_{p}', '(' + ' + '.join('s_' + x for x in PH) + ')')} AS share_{p}" for p in PH)} FROM g, t),
    api AS (SELECT *, avg_ms > 3000 OR slow_rate > 10 AS is_slow_api FROM r)"""


@register("a01_api_performance", A1_SQL + " SELECT * FROM api")
def _(spark, sf):
    return api.api_performance(hits(spark, sf))


@register(
    "a02_api_transfer",
    """, m AS (SELECT uri, CASE WHEN backend_transfer_ms > 0 THEN (body_bytes / 1024::DOUBLE) / (response_ms / 1000::DOUBLE - header_ms / 1000::DOUBLE) ELSE 0 END AS rs,
      CASE WHEN response_ms > 0 THEN (connect_ms / 1000::DOUBLE) / (response_ms / 1000::DOUBLE) * 100 ELSE 0 END AS cc FROM hits WHERE is_success)
    SELECT uri, count(*) AS requests, round(quantile_cont(rs, 0.9), 6) AS p90_response_speed, round(avg(cc), 6) AS avg_connection_cost, avg(cc) > 30 AS costly_connect FROM m GROUP BY uri""",
)
def _(spark, sf):
    out = api.api_transfer(hits(spark, sf))
    return out.select(
        "uri", "requests", "p90_response_speed",
        "avg_connection_cost", "costly_connect",
    )


@register(
    "a03_api_bottlenecks",
    A1_SQL
    + """, e AS (SELECT uri, successes, 'connect_ms' AS phase, share_connect_ms AS share FROM api WHERE share_connect_ms > 20
      UNION ALL SELECT uri, successes, 'process_ms', share_process_ms FROM api WHERE share_process_ms > 60
      UNION ALL SELECT uri, successes, 'backend_transfer_ms', share_backend_transfer_ms FROM api WHERE share_backend_transfer_ms > 30),
    k AS (SELECT *, CAST(row_number() OVER (PARTITION BY phase ORDER BY share DESC, successes DESC, uri) AS INT) AS rank FROM e) SELECT * FROM k WHERE rank <= 10""",
)
def _(spark, sf):
    return api.api_bottlenecks(api.api_performance(hits(spark, sf)))


@register(
    "a04_api_frequency",
    f"""SELECT uri, count(*) AS requests, {pct('duration_ms', .5, 'p50')}, {pct('duration_ms', .95, 'p95')},
    CASE WHEN count(*) > 1000 THEN '高频' WHEN count(*) > 100 THEN '中频' ELSE '低频' END AS frequency FROM hits GROUP BY uri""",
)
def _(spark, sf):
    return api.api_frequency(hits(spark, sf))


_M = ["duration_ms", "response_ms", "process_ms", "body_bytes"]


def _describe_sql(by: str, metrics, source: str = "hits") -> str:
    cols = []
    for m in metrics:
        cols += [f"avg({m}) AS avg_{m}", f"min({m}) AS min_{m}", f"max({m}) AS max_{m}"]
        cols += [pct(m, p, f"p{int(p * 100)}_{m}") for p in (0.5, 0.9, 0.95, 0.99)]
    return f"SELECT {by}, count(*) AS requests, {', '.join(cols)} FROM {source} GROUP BY {by}"


@register(
    "a05_service_report",
    f""", d AS ({_describe_sql('service', _M)}), f AS (SELECT service, {", ".join(f"{n_if(f"status LIKE '{k}%'")} AS n_{k}xx" for k in (2, 3, 4, 5))} FROM hits GROUP BY service)
    SELECT d.*, n_2xx, n_3xx, n_4xx, n_5xx FROM d JOIN f USING (service)""",
)
def _(spark, sf):
    return service.service_report(hits(spark, sf))


@register("a52_describe_lineitem", None)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_discount")
    out = measures.describe(df, ["l_returnflag"], ["l_quantity", "l_discount"], unbounded=["l_discount"])
    return out.withColumns({f"avg_{m}": F.round(f"avg_{m}", 6) for m in ("l_quantity", "l_discount")})


ORACLES["a52_describe_lineitem"] = (
    _describe_sql("l_returnflag", ["l_quantity", "l_discount"], "lineitem")
    .replace("avg(l_quantity)", "round(avg(l_quantity), 6)")
    .replace("avg(l_discount)", "round(avg(l_discount), 6)")
)


@register(
    "a06_applications",
    f""", s AS (SELECT application, service, avg(duration_ms) AS m FROM hits WHERE is_success GROUP BY 1, 2),
    k AS (SELECT application, count(*) AS services, avg(m) AS ma, stddev_pop(m) AS ms FROM s GROUP BY 1),
    b AS (SELECT application, count(*) AS requests, {n_if(OKW)} AS successes, {n_if('NOT is_success')} AS errors, {n_if('is_success AND is_slow')} AS slow,
      {pct('duration_ms', .5, 'p50', OKW)}, {pct('duration_ms', .95, 'p95', OKW)}, {pct('duration_ms', .99, 'p99', OKW)} FROM hits GROUP BY 1 HAVING {n_if(OKW)} > 0)
    SELECT b.*, services, {srate('successes', 'requests')} AS success_rate, {srate('slow', 'successes')} AS slow_rate,
      round(CASE WHEN services > 1 AND ma > 0 THEN greatest(0e0, 100 - ms / ma * 100) ELSE 100 END, 4) AS consistency FROM b JOIN k USING (application)""",
)
def _(spark, sf):
    return service.applications(hits(spark, sf))


@register(
    "a07_service_derived",
    f"""SELECT service, count(*) AS requests, CASE WHEN sum(backend_transfer_ms) > 0 THEN sum(body_bytes) / 1024e0 / (sum(backend_transfer_ms) / 1000e0) ELSE 0 END AS response_speed,
    {srate('sum(connect_ms)::DOUBLE', 'sum(duration_ms)::DOUBLE')} AS connect_share, {srate('sum(process_ms)::DOUBLE', 'sum(duration_ms)::DOUBLE')} AS process_share,
    round(CASE WHEN stddev_pop(duration_ms) > 0 THEN greatest(0e0, 100 - stddev_pop(duration_ms) / avg(duration_ms) * 100) ELSE 100 END, 6) AS stability, round(stddev_pop(duration_ms), 4) AS deviation
    FROM hits WHERE is_success GROUP BY service""",
)
def _(spark, sf):
    return service.derived_metrics(hits(spark, sf))


_OUT = """, f AS (SELECT round(quantile_cont(duration_ms, 0.25), 6) AS q1, round(quantile_cont(duration_ms, 0.75), 6) AS q3 FROM {src}),
    o AS (SELECT service, count(*) FILTER (WHERE duration_ms < q1 - 3 * (q3 - q1) OR duration_ms > q3 + 3 * (q3 - q1)) AS outliers FROM {src}, f GROUP BY service)"""


@register("a09_outliers", _OUT.format(src="hits") + " SELECT * FROM o")
def _(spark, sf):
    return service.outliers(hits(spark, sf))


@register(
    "a08_service_health",
    ", okh AS (SELECT * FROM hits WHERE is_success)"
    + _OUT.format(src="okh")
    + f""", b AS (SELECT service, count(*) AS requests, {n_if(OKW)} AS successes, {n_if('is_success AND is_slow')} AS slow,
      avg(duration_ms) FILTER (WHERE is_success) / 1000e0 AS a, stddev_pop(duration_ms) FILTER (WHERE is_success) / 1000e0 AS s FROM hits GROUP BY service)
    SELECT service, requests, successes, slow, coalesce(outliers, 0) AS outliers, round(greatest(0e0, 100e0 - (1 - successes * 1e0 / requests) * 30 - coalesce(slow * 1e0 / nullif(successes, 0), 0) * 25
      - coalesce(coalesce(outliers, 0) * 1e0 / nullif(successes, 0), 0) * 20 - CASE WHEN a > 3 THEN least(15e0, (a - 3) * 5) ELSE 0 END
      - CASE WHEN successes > 1 AND a > 0 THEN least(10e0, s / a * 10) ELSE 0 END), 4) AS health FROM b LEFT JOIN o USING (service)""",
)
def _(spark, sf):
    return service.health(hits(spark, sf))


@register(
    "a10_service_errors",
    f"""SELECT service, count(*) AS requests, {n_if('is_error')} AS errors, max(duration_ms) FILTER (WHERE is_error) AS max_error_ms,
    avg(duration_ms) FILTER (WHERE is_error) AS avg_error_ms FROM hits GROUP BY service""",
)
def _(spark, sf):
    return service.errors(hits(spark, sf), ["service"])


SLOW_SQL = """, base AS (SELECT round(quantile_cont(duration_ms, 0.95), 6) AS p95 FROM hits),
    d0 AS (SELECT h.*, duration_ms / p95 AS ratio_to_p95,
      CASE WHEN (CASE WHEN connect_ms > 1000 THEN 1 ELSE 0 END + CASE WHEN process_ms > 3000 THEN 1 ELSE 0 END + CASE WHEN backend_transfer_ms > 2000 THEN 1 ELSE 0 END) > 1 THEN '混合型'
        WHEN connect_ms > 1000 THEN '连接慢' WHEN process_ms > 3000 THEN '处理慢' WHEN backend_transfer_ms > 2000 THEN '传输慢' ELSE '其他' END AS cause,
      CASE WHEN hour BETWEEN 8 AND 12 OR hour BETWEEN 14 AND 18 THEN '高峰期' WHEN hour <= 6 OR hour >= 22 THEN '低峰期' ELSE '平峰期' END AS period FROM hits h, base WHERE duration_ms > 3000),
    d1 AS (SELECT *, CASE WHEN ratio_to_p95 >= 5 THEN '极严重' WHEN ratio_to_p95 >= 3 THEN '严重' WHEN ratio_to_p95 >= 2 THEN '中度' ELSE '轻度' END AS severity FROM d0),
    diag AS (SELECT *, CASE WHEN severity = '极严重' OR duration_ms > 10000 THEN '高' WHEN severity = '严重' OR duration_ms > 5000 THEN '中' ELSE '低' END AS impact,
      CASE WHEN duration_ms > 9000 THEN '严重违规' WHEN duration_ms > 6000 THEN '中等违规' ELSE '轻微违规' END AS sla_breach,
      CASE severity WHEN '极严重' THEN 4e0 WHEN '严重' THEN 3e0 WHEN '中度' THEN 2e0 ELSE 1e0 END * CASE cause WHEN '处理慢' THEN 3e0 WHEN '连接慢' THEN 2.5e0 WHEN '传输慢' THEN 2e0
        WHEN '混合型' THEN 3.5e0 ELSE 1e0 END AS weight FROM d1)"""
_DCOLS = ["event_id", "uri", "duration_ms", "cause", "severity", "period", "ratio_to_p95", "impact", "sla_breach", "weight"]


@register("a11_slow_diagnosis", SLOW_SQL + f" SELECT {', '.join(_DCOLS)} FROM diag")
def _(spark, sf):
    return slow.diagnose(hits(spark, sf)).select(*_DCOLS)


@register(
    "a11_slow_list",
    SLOW_SQL
    + " SELECT event_id, severity, duration_ms FROM diag ORDER BY CASE severity WHEN '极严重' THEN 1 WHEN '严重' THEN 2 WHEN '中度' THEN 3 ELSE 4 END, duration_ms DESC, event_id LIMIT 100",
)
def _(spark, sf):
    return slow.slow_list(hits(spark, sf), 100).select("event_id", "severity", "duration_ms")


@register(
    "a11_slow_frequency",
    SLOW_SQL
    + """, n AS (SELECT uri, count(*) AS api_requests FROM hits GROUP BY uri)
    SELECT event_id, api_requests, CASE WHEN api_requests > 1000 THEN '高频' WHEN api_requests > 100 THEN '中频' ELSE '低频' END AS frequency FROM diag JOIN n USING (uri)""",
)
def _(spark, sf):
    df = hits(spark, sf)
    return slow.with_frequency(slow.diagnose(df), df).select("event_id", "api_requests", "frequency")


_STATS = [*slow.STATISTICS, *slow.WIDE_STATISTICS]


@register(
    "a12_slow_statistics",
    f""", s AS (SELECT uri, is_slow, {", ".join(n for n in _STATS if n not in timeline.RATIOS)}, duration_ms / 1000::DOUBLE AS t, connect_ms / 1000::DOUBLE AS a, header_ms / 1000::DOUBLE AS h, response_ms / 1000::DOUBLE AS r FROM hits),
    p AS (SELECT *, greatest(0::DOUBLE, h - a) AS pr, greatest(0::DOUBLE, r - h) AS bt, greatest(0::DOUBLE, t - r) AS ft FROM s),
    l AS (SELECT *, CASE WHEN r > 0 THEN pr / r * 100 ELSE 0 END AS backend_efficiency, CASE WHEN t > 0 THEN (a + ft) / t * 100 ELSE 0 END AS network_overhead,
      CASE WHEN t > 0 THEN (bt + ft) / t * 100 ELSE 0 END AS transfer_ratio, CASE WHEN r > 0 THEN a / r * 100 ELSE 0 END AS connection_cost FROM p)
    SELECT uri, count(*) AS requests, {n_if('is_slow')} AS slow, {n_if('is_slow')} * 1e2 / count(*) AS share_in_api, {n_if('is_slow')} * 1e2 / (SELECT count(*) FROM hits WHERE is_slow) AS share_of_slow,
    {", ".join(f"min({m}) FILTER (WHERE is_slow) AS min_{m}, max({m}) FILTER (WHERE is_slow) AS max_{m}, round(avg({m}) FILTER (WHERE is_slow), 6) AS avg_{m}" for m in _STATS)},
    {", ".join(pct(m, p, f"p{int(p * 100)}_{m}", "is_slow") for m in _STATS for p in (.5, .9, .95, .99))}
    FROM l GROUP BY uri HAVING {n_if('is_slow')} > 0""",
)
def _(spark, sf):
    out = slow.api_statistics(hits(spark, sf))
    return out.withColumns({f"avg_{m}": F.round(f"avg_{m}", 6) for m in _STATS})


@register(
    "a12_slow_by_api",
    f"""SELECT uri, count(*) AS requests, {n_if('is_slow')} AS slow, min(duration_ms) FILTER (WHERE is_slow) AS min_ms, max(duration_ms) FILTER (WHERE is_slow) AS max_ms,
    {", ".join(pct('duration_ms', p, f'p{int(p * 100)}', 'is_slow') for p in (.5, .9, .95, .99))}, {pct('process_ms', .5, 'process_p50', 'is_slow')}, {pct('process_ms', .95, 'process_p95', 'is_slow')},
    avg(duration_ms) FILTER (WHERE is_slow) AS avg_ms, {n_if('is_slow')} * 1e2 / count(*) AS share_in_api, {n_if('is_slow')} * 1e2 / (SELECT count(*) FROM hits WHERE is_slow) AS share_of_slow
    FROM hits GROUP BY uri HAVING {n_if('is_slow')} > 0""",
)
def _(spark, sf):
    return slow.api_summary(hits(spark, sf))


@register(
    "a13_slow_distribution",
    SLOW_SQL
    + " ".join(
        f"{'UNION ALL' if i else ''} SELECT '{d}' AS dimension, {d} AS label, count(*) AS requests, avg(duration_ms) AS avg_ms FROM diag GROUP BY {d}"
        for i, d in enumerate(("cause", "severity", "period"))
    ),
)
def _(spark, sf):
    return slow.distribution(slow.diagnose(hits(spark, sf)))


@register(
    "a13_slow_insights",
    SLOW_SQL
    + """, g AS (SELECT cause, count(*) AS n FROM diag GROUP BY cause)
    SELECT (SELECT cause FROM g ORDER BY n DESC, cause LIMIT 1) AS main_cause, (SELECT max(n) * 1e2 / sum(n) FROM g) AS main_share,
    count(*) FILTER (WHERE severity IN ('极严重', '严重')) * 1e2 / count(*) AS severe_share, count(*) FILTER (WHERE sla_breach <> '未违规') * 1e2 / count(*) AS breach_share FROM diag""",
)
def _(spark, sf):
    return slow.insights(slow.diagnose(hits(spark, sf)))


@register(
    "a14_slow_phases",
    ", p AS ("
    + " UNION ALL ".join(f"SELECT '{p}' AS phase, {p} AS ms, duration_ms FROM hits WHERE is_slow" for p in PH)
    + f""") SELECT phase, avg(ms) AS avg_ms, sum(ms)::DOUBLE * 1e2 / sum(duration_ms)::DOUBLE AS share, {", ".join(pct('ms', x, f'p{int(x * 100)}') for x in (.5, .9, .95, .99))} FROM p GROUP BY phase""",
)
def _(spark, sf):
    return slow.phase_summary(hits(spark, sf))


@register(
    "a14_slow_efficiency",
    """, r AS (SELECT service, round(network_ms * 1e2 / duration_ms, 4) AS overhead, round(transfer_ms * 1e2 / duration_ms, 4) AS transfer FROM hits WHERE is_slow)
    SELECT service, count(*) AS requests, """
    + ", ".join(
        f"round(avg({m}), 9) AS avg_{m}, min({m}) AS min_{m}, max({m}) AS max_{m}, {pct(m, .5, 'p50_' + m)}, {pct(m, .9, 'p90_' + m)}, {pct(m, .95, 'p95_' + m)}"
        for m in ("overhead", "transfer")
    )
    + " FROM r GROUP BY service",
)
def _(spark, sf):
    return slow.efficiency_summary(hits(spark, sf))


@register(
    "a53_period_by_severity",
    SLOW_SQL
    + " SELECT period, "
    + ", ".join(f"count(*) FILTER (WHERE severity = '{s}') AS severity_{i}" for i, s in enumerate(slow.SEVERITIES))
    + " FROM diag GROUP BY period",
)
def _(spark, sf):
    return slow.period_by_severity(slow.diagnose(hits(spark, sf)))


A15_SQL = f""", dist AS (SELECT status, count(*) AS requests, {n_if('is_slow')} AS slow, min(duration_ms) AS min_ms, max(duration_ms) AS max_ms, {", ".join(pct('duration_ms', x, f'p{int(x * 100)}') for x in (.5, .95, .99))},
    count(*) * 1e2 / (SELECT count(*) FROM hits) AS share, avg(duration_ms) AS avg_ms, {", ".join(f'avg({p}) AS avg_{p}' for p in PH)} FROM hits GROUP BY status)"""


@register("a15_status_distribution", A15_SQL + " SELECT * FROM dist")
def _(spark, sf):
    return status.distribution(hits(spark, sf))


_DIMS = ["application", "service", "request_method", "hour"]


@register(
    "a16_status_by_dimension",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS label, status, count(*) AS requests FROM hits GROUP BY {d}, status" for d in _DIMS
    ),
)
def _(spark, sf):
    return status.by_dimension(hits(spark, sf), _DIMS)


_CODES = ["200", "302", "404", "500", "503"]


@register(
    "a16_status_wide",
    f"SELECT service, count(*) AS requests, {', '.join(n_if(f'''status = '{s}' ''') + f' AS status_{s}' for s in _CODES)} FROM hits GROUP BY service",
)
def _(spark, sf):
    return status.wide_by(hits(spark, sf), "service", _CODES)


@register(
    "a17_status_families",
    "SELECT left(status, 1) || 'xx' AS family, count(*) AS requests, count(*) * 1e2 / (SELECT count(*) FROM hits) AS share, avg(duration_ms) AS avg_ms FROM hits GROUP BY 1",
)
def _(spark, sf):
    return status.families(hits(spark, sf))


@register(
    "a18_error_details",
    """, e AS (SELECT status, 'client_ip' AS kind, client_ip AS item FROM hits WHERE is_error UNION ALL SELECT status, 'uri', uri FROM hits WHERE is_error),
    g AS (SELECT status, kind, item, count(*) AS requests FROM e GROUP BY ALL),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY status, kind ORDER BY requests DESC, item) AS INT) AS rank FROM g) SELECT * FROM r WHERE rank <= 10""",
)
def _(spark, sf):
    return status.error_details(hits(spark, sf))


@register(
    "a19_slow_apis",
    f"SELECT uri, count(*) AS requests, {n_if('is_slow')} AS slow, {n_if('is_slow')} * 1e2 / count(*) AS slow_rate, avg(duration_ms) AS avg_ms FROM hits GROUP BY uri HAVING {n_if('is_slow')} > 0 ORDER BY slow DESC, uri LIMIT 20",
)
def _(spark, sf):
    return status.slow_apis(hits(spark, sf))


@register(
    "a20_status_spikes",
    """, b AS (SELECT date_trunc('day', log_time) AS bucket, status, count(*) AS n FROM hits GROUP BY ALL)
    SELECT bucket, 'server_error_spike' AS kind, status, n::DOUBLE AS value FROM b WHERE status LIKE '5%' AND n > 8
    UNION ALL SELECT bucket, 'client_error_spike', status, n::DOUBLE FROM b WHERE status LIKE '4%' AND n > 15
    UNION ALL SELECT date_trunc('day', log_time), 'slow_bucket', '*', avg(duration_ms) FROM hits GROUP BY 1 HAVING avg(duration_ms) > 5000""",
)
def _(spark, sf):
    return status.spikes(hits(spark, sf), "day", server=8, client=15, mean_ms=5000)


@register(
    "a21_estimated_lifecycle",
    A15_SQL
    + """ SELECT status, round(least(CASE left(status, 1) WHEN '4' THEN 0.05e0 WHEN '2' THEN 0.1e0 WHEN '5' THEN 0.1e0 ELSE 1e9 END, avg_ms / 1000 * 0.1e0), 6) AS connect_s,
    round(avg_ms / 1000 * CASE left(status, 1) WHEN '5' THEN 0.7e0 WHEN '4' THEN 0.6e0 ELSE 0.5e0 END, 6) AS process_s,
    round(avg_ms / 1000 * CASE left(status, 1) WHEN '5' THEN 0.15e0 WHEN '4' THEN 0.25e0 ELSE 0.3e0 END, 6) AS transfer_s,
    round(avg_ms / 1000 * CASE left(status, 1) WHEN '5' THEN 0.05e0 WHEN '4' THEN 0.05e0 ELSE 0.1e0 END, 6) AS front_s,
    CASE WHEN p95 > 10000 OR slow > 1000 THEN 'Critical' WHEN p95 > 5000 OR slow > 500 THEN 'Poor' WHEN p95 > 2000 OR slow > 100 THEN 'Fair' ELSE 'Good' END AS level FROM dist""",
)
def _(spark, sf):
    return status.estimated_lifecycle(status.distribution(hits(spark, sf)))


def bucket_sql(grain: str, ts: str = "log_time") -> str:
    sec = timeline.SECONDS[grain]
    return f""", b AS (SELECT date_trunc('{grain}', {ts}) AS bucket, count(*) AS requests, {n_if(OKW)} AS successes, {n_if('is_slow')} AS slow, {n_if("status LIKE '4%'")} AS client_errors,
      {n_if("status LIKE '5%'")} AS server_errors, count(DISTINCT client_ip) AS clients, {", ".join(pct('duration_ms', x, f'p{int(x * 100)}') for x in (.5, .9, .95, .99))},
      {", ".join(f"{pct(m, .5, m + '_p50')}, {pct(m, .95, m + '_p95')}" for m in ('response_ms', 'process_ms'))} FROM hits GROUP BY 1),
    rep AS (SELECT *, {srate('successes', 'requests')} AS success_rate, {srate('slow', 'requests')} AS slow_rate, {srate('(client_errors + server_errors)', 'requests')} AS error_rate, successes / {sec}e0 AS qps FROM b)"""


for _grain in ("day", "hour", "minute", "second"):

    @register(f"a22_time_{_grain}", bucket_sql(_grain) + " SELECT * FROM rep")
    def _(spark, sf, grain=_grain):
        return timeline.buckets(hits(spark, sf), grain)


@register("a22_time_by_arrival", bucket_sql("hour", "(log_time - to_milliseconds(duration_ms))") + " SELECT * FROM rep")
def _(spark, sf):
    return timeline.buckets(hits(spark, sf), "hour", ts=clock.arrival(c("log_time"), c("duration_ms")))


_FULL = [*timeline.TIMES, *timeline.RATIOS, *timeline.SIZES, *timeline.SPEEDS]


def full_sql(grain: str) -> str:
    """All columns of the full report over one bucket width; occupancy by a range join."""
    sec = timeline.SECONDS[grain]
    medians = ", ".join(pct(m, 0.5, f"{m}_p50") for m in _FULL)
    tails = ", ".join(f"{pct(t, .95, t + '_p95')}, {pct(t, .99, t + '_p99')}" for t in timeline.TAILS)
    return f""", s AS (SELECT *, duration_ms / 1000::DOUBLE AS t, connect_ms / 1000::DOUBLE AS a, header_ms / 1000::DOUBLE AS h, response_ms / 1000::DOUBLE AS r,
      body_bytes / 1024::DOUBLE AS body_kb, sent_bytes / 1024::DOUBLE AS sent_kb, date_trunc('{grain}', log_time) AS bucket FROM hits),
    p AS (SELECT *, greatest(0::DOUBLE, h - a) AS pr, greatest(0::DOUBLE, r - h) AS bt, greatest(0::DOUBLE, t - r) AS ft FROM s),
    l AS (SELECT *, CASE WHEN r > 0 THEN pr / r * 100 ELSE 0 END AS backend_efficiency, CASE WHEN t > 0 THEN (a + ft) / t * 100 ELSE 0 END AS network_overhead,
      CASE WHEN t > 0 THEN (bt + ft) / t * 100 ELSE 0 END AS transfer_ratio, CASE WHEN r > 0 THEN a / r * 100 ELSE 0 END AS connection_cost,
      CASE WHEN bt > 0 THEN body_kb / bt ELSE 0 END AS response_speed, CASE WHEN bt + ft > 0 THEN sent_kb / (bt + ft) ELSE 0 END AS total_speed, CASE WHEN ft > 0 THEN sent_kb / ft ELSE 0 END AS front_speed FROM p),
    b AS (SELECT bucket, count(*) AS requests, {n_if(OKW)} AS successes, {n_if('is_slow')} AS slow, {n_if("status LIKE '4%'")} AS client_errors, {n_if("status LIKE '5%'")} AS server_errors,
      count(DISTINCT client_ip) AS clients, {medians}, {tails} FROM l GROUP BY 1),
    x AS (SELECT epoch_us(log_time - to_milliseconds(duration_ms)) AS u, epoch_us(log_time) AS v FROM access),
    ni AS (SELECT make_timestamp(u // {sec}000000 * {sec}000000) AS at, count(*) AS new_requests FROM x GROUP BY 1),
    o AS (SELECT bucket, count(*) FILTER (WHERE u < e AND v >= e) AS concurrent, count(*) FILTER (WHERE u <= e AND v >= e - {sec}000000) AS active
      FROM (SELECT bucket, epoch_us(bucket) + {sec}000000 AS e FROM b) JOIN x ON u <= e AND v >= e - {sec}000000 GROUP BY 1),
    rep AS (SELECT b.*, connect_ms_p50 AS connect_phase_p50, response_ms_p50 AS backend_total_p50, process_ms_p50 AS processing_p50, {srate('successes', 'requests')} AS success_rate, {srate('slow', 'requests')} AS slow_rate,
      {srate('client_errors', 'requests')} AS client_error_rate, {srate('server_errors', 'requests')} AS server_error_rate, {srate('(client_errors + server_errors)', 'requests')} AS error_rate, successes / {sec}e0 AS qps,
      coalesce(new_requests, 0) AS new_requests, concurrent, active FROM b LEFT JOIN ni ON ni.at = b.bucket LEFT JOIN o USING (bucket))"""


for _grain in ("day", "hour"):

    @register(f"a22_full_{_grain}", full_sql(_grain) + " SELECT * FROM rep")
    def _(spark, sf, grain=_grain):
        return timeline.full_report(hits(spark, sf), grain)


_TREND = """, tr AS (SELECT *, {} FROM rep)""".format(
    ", ".join(
        f"CASE WHEN lag({m}) OVER (ORDER BY bucket) > 0 THEN ({m} - lag({m}) OVER (ORDER BY bucket)) / lag({m}) OVER (ORDER BY bucket) * 100 ELSE 0 END AS {m}_change"
        for m in ("qps", "p50", "error_rate")
    )
)


for _grain, _suffix in (("hour", ""), ("second", "_second")):

    @register("w05_trend" + _suffix, bucket_sql(_grain) + _TREND + " SELECT bucket, qps_change, p50_change, error_rate_change FROM tr")
    def _(spark, sf, grain=_grain):
        out = timeline.trend(timeline.buckets(hits(spark, sf), grain))
        return out.select("bucket", "qps_change", "p50_change", "error_rate_change")


_ANOM = (
    ", st AS (SELECT "
    + ", ".join(f"avg({m}) AS {m}_m, stddev_pop({m}) AS {m}_s" for m in ("qps", "error_rate", "slow_rate", "p50"))
    + " FROM rep), an AS (SELECT rep.*, round(("
    + " + ".join(
        f"CASE WHEN {m}_s > 0 THEN least(abs({m} - {m}_m) / {m}_s / 3, 1e0) ELSE 0 END * {w}"
        for m, w in (("qps", "1"), ("error_rate", "1.5e0"), ("slow_rate", "1"), ("p50", "1"))
    )
    + ") / 4 * 100, 4) AS anomaly_score FROM rep, st)"
)
_LEVEL = "CASE WHEN anomaly_score >= 80 THEN '严重异常' WHEN anomaly_score >= 60 THEN '中度异常' WHEN anomaly_score >= 40 THEN '轻微异常' ELSE '正常' END"


@register("w06_anomaly_score", bucket_sql("hour") + _ANOM + f" SELECT bucket, anomaly_score, {_LEVEL} AS anomaly_level FROM an")
def _(spark, sf):
    out = timeline.anomaly(timeline.buckets(hits(spark, sf), "hour"))
    return out.select("bucket", "anomaly_score", "anomaly_level")


@register(
    "w07_efficiency_index",
    bucket_sql("day")
    + _ANOM
    + """, mx AS (SELECT CASE WHEN max(qps) > 0 THEN max(qps) ELSE 1 END AS mq, CASE WHEN max(p50) > 0 THEN max(p50) ELSE 1 END AS mp,
      CASE WHEN max(error_rate) > 0 THEN max(error_rate) ELSE 1 END AS me, CASE WHEN max(slow_rate) > 0 THEN max(slow_rate) ELSE 1 END AS ms FROM an),
    ix AS (SELECT bucket, round(qps / mq * 100 * 0.25e0 + greatest(0e0, 100 - p50 / mp * 100) * 0.25e0 + CASE WHEN me > 1 THEN greatest(0e0, 100 - error_rate / me * 100) ELSE greatest(0e0, 100 - error_rate * 10) END * 0.2e0
      + CASE WHEN ms > 1 THEN greatest(0e0, 100 - slow_rate / ms * 100) ELSE greatest(0e0, 100 - slow_rate * 5) END * 0.15e0 + greatest(0e0, 100 - anomaly_score) * 0.15e0, 4) AS efficiency_index FROM an, mx)
    SELECT *, CASE WHEN efficiency_index >= 90 THEN '优秀' WHEN efficiency_index >= 80 THEN '良好' WHEN efficiency_index >= 70 THEN '一般' WHEN efficiency_index >= 60 THEN '较差' ELSE '很差' END AS efficiency_level FROM ix""",
)
def _(spark, sf):
    out = timeline.efficiency(timeline.anomaly(timeline.buckets(hits(spark, sf), "day")))
    return out.select("bucket", "efficiency_index", "efficiency_level")


for _grain, _suffix in (("hour", ""), ("second", "_second")):

    @register(
        "w02_rolling" + _suffix,
        bucket_sql(_grain)
        + " SELECT bucket, max(requests) OVER (ORDER BY bucket ROWS 6 PRECEDING) AS rolling_peak, avg(requests) OVER (ORDER BY bucket ROWS 23 PRECEDING) AS rolling_mean FROM rep",
    )
    def _(spark, sf, grain=_grain):
        return timeline.rolling(timeline.buckets(hits(spark, sf), grain), "requests").select("bucket", "rolling_peak", "rolling_mean")


_TM = ["requests", "p50", "error_rate"]


def _long_sql(source: str) -> str:
    return ", l AS (" + " UNION ALL ".join(f"SELECT bucket, '{m}' AS metric, {m}::DOUBLE AS v FROM {source}" for m in _TM) + ")"


for _grain, _suffix in (("day", ""), ("second", "_second")):

    @register(
        "w08_ends_trend" + _suffix,
        bucket_sql(_grain)
        + _long_sql("rep")
        + """, k AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY bucket) AS a, row_number() OVER (PARTITION BY metric ORDER BY bucket DESC) AS z FROM l),
    g AS (SELECT metric, count(*) AS points, avg(v) FILTER (WHERE a <= 3) AS e, avg(v) FILTER (WHERE z <= 3) AS r, stddev_pop(v) AS s FROM k GROUP BY metric),
    h AS (SELECT *, CASE WHEN e > 0 THEN (r - e) / e * 100 ELSE 0 END AS ch FROM g)
    SELECT metric, points, round(e, 6) AS early, round(r, 6) AS recent, round(s, 6) AS volatility, round(ch, 6) AS change, CASE WHEN abs(ch) < 5 THEN 'stable' WHEN ch > 0 THEN 'rising' ELSE 'falling' END AS direction FROM h""",
    )
    def _(spark, sf, grain=_grain):
        return timeline.ends_trend(timeline.buckets(hits(spark, sf), grain), _TM)

    @register(
        "w09_halves_trend" + _suffix,
        bucket_sql(_grain)
        + _long_sql("rep")
        + """, k AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY bucket) <= count(*) OVER (PARTITION BY metric) // 2 AS early FROM l),
    g AS (SELECT metric, avg(v) FILTER (WHERE early) AS a, avg(v) FILTER (WHERE NOT early) AS b FROM k GROUP BY metric)
    SELECT metric, round(a, 6) AS first_half, round(b, 6) AS second_half, round((b - a) / a * 100, 6) AS change,
    CASE WHEN (b - a) / a * 100 > 5 THEN 'rising' WHEN (b - a) / a * 100 < -5 THEN 'falling' ELSE 'stable' END AS direction FROM g WHERE a <> 0""",
    )
    def _(spark, sf, grain=_grain):
        return timeline.halves_trend(timeline.buckets(hits(spark, sf), grain), _TM)


_SCORES = {
    "throughput_score": "qps / mq * 100",
    "response_score": "greatest(0e0, 100 - p50 / mp * 100)",
    "reliability_score": "CASE WHEN me > 1 THEN greatest(0e0, 100 - error_rate / me * 100) ELSE greatest(0e0, 100 - error_rate * 10) END",
    "stability_score": "CASE WHEN ms > 1 THEN greatest(0e0, 100 - slow_rate / ms * 100) ELSE greatest(0e0, 100 - slow_rate * 5) END",
    "health_score": "greatest(0e0, 100 - anomaly_score)",
}


@register(
    "w07_efficiency_scores",
    bucket_sql("hour")
    + _ANOM
    + """, mx AS (SELECT CASE WHEN max(qps) > 0 THEN max(qps) ELSE 1 END AS mq, CASE WHEN max(p50) > 0 THEN max(p50) ELSE 1 END AS mp,
      CASE WHEN max(error_rate) > 0 THEN max(error_rate) ELSE 1 END AS me, CASE WHEN max(slow_rate) > 0 THEN max(slow_rate) ELSE 1 END AS ms FROM an)"""
    + f" SELECT bucket, {', '.join(f'round({v}, 4) AS {k}' for k, v in _SCORES.items())} FROM an, mx",
)
def _(spark, sf):
    out = timeline.efficiency(timeline.anomaly(timeline.buckets(hits(spark, sf), "hour")), scores=True)
    return out.select("bucket", *_SCORES)


@register(
    "a54_peak_summary",
    """, x AS (SELECT log_time - to_milliseconds(duration_ms) AS arrived, log_time AS done FROM access),
    ev AS (SELECT arrived AS t0, 1 AS step FROM x UNION ALL SELECT done, -1 FROM x),
    lv AS (SELECT t0, sum(step) OVER (ORDER BY t0, step DESC ROWS UNBOUNDED PRECEDING) AS level FROM ev),
    h AS (SELECT date_trunc('hour', log_time) AS bucket, avg(duration_ms) AS m, count(*) FILTER (WHERE status LIKE '5%') * 1e2 / count(*) AS e FROM hits GROUP BY 1),
    l AS (SELECT bucket, 'latency' AS peak, m AS value FROM h UNION ALL SELECT bucket, 'server_errors', e FROM h WHERE e > 1
      UNION ALL SELECT date_trunc('minute', t0), 'concurrency', max(level)::DOUBLE FROM lv GROUP BY 1),
    k AS (SELECT bucket, peak, value, CAST(row_number() OVER (PARTITION BY peak ORDER BY value DESC, bucket) AS INT) AS rank FROM l) SELECT * FROM k WHERE rank <= 3""",
)
def _(spark, sf):
    df = access(spark, sf).withColumn("arrived", clock.arrival(c("log_time"), c("duration_ms")))
    return timeline.peak_summary(timeline.hourly(hits(spark, sf)), occupancy.concurrency(df, "arrived", "log_time"))


@register(
    "a54_peaks",
    bucket_sql("hour")
    + _long_sql("rep")
    + """, k AS (SELECT bucket, metric, v AS value, CAST(row_number() OVER (PARTITION BY metric ORDER BY v DESC, bucket) AS INT) AS rank FROM l) SELECT * FROM k WHERE rank <= 3""",
)
def _(spark, sf):
    return timeline.peaks(timeline.buckets(hits(spark, sf), "hour"), _TM)


_ARR = ", x AS (SELECT log_time - to_milliseconds(duration_ms) AS arrived, log_time AS done FROM access)"


@register(
    "a23_occupancy",
    _ARR
    + """, sp AS (SELECT min(date_trunc('hour', arrived)) AS lo, max(date_trunc('hour', done)) AS hi FROM x),
    bk AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS s FROM sp)
    SELECT s AS bucket, count(*) FILTER (WHERE arrived >= s AND arrived < s + INTERVAL 1 HOUR) AS new_requests,
    count(*) FILTER (WHERE arrived < s + INTERVAL 1 HOUR AND done >= s + INTERVAL 1 HOUR) AS concurrent,
    count(*) FILTER (WHERE arrived <= s + INTERVAL 1 HOUR AND done >= s) AS active
    FROM bk JOIN x ON arrived <= s + INTERVAL 1 HOUR AND done >= s GROUP BY s""",
)
def _(spark, sf):
    df = access(spark, sf).withColumn("arrived", clock.arrival(c("log_time"), c("duration_ms")))
    return occupancy.occupancy(df, "arrived", "log_time", 3600)


@register(
    "a28_concurrency",
    _ARR
    + """, ev AS (SELECT arrived AS t0, 1 AS step FROM x UNION ALL SELECT done, -1 FROM x),
    lv AS (SELECT t0, sum(step) OVER (ORDER BY t0, step DESC ROWS UNBOUNDED PRECEDING) AS level FROM ev)
    SELECT date_trunc('minute', t0) AS bucket, count(*) AS events, avg(level) AS avg_concurrent, CAST(max(level) AS BIGINT) AS max_concurrent, CAST(min(level) AS BIGINT) AS min_concurrent,
    round(coalesce(stddev_samp(level), 0), 6) AS std_concurrent FROM lv GROUP BY 1""",
)
def _(spark, sf):
    df = access(spark, sf).withColumn("arrived", clock.arrival(c("log_time"), c("duration_ms")))
    return occupancy.concurrency(df, "arrived", "log_time")


A24_SQL = """, h AS (SELECT service, stat_hour, count(*) AS n, count(*) FILTER (WHERE is_success) AS ok FROM hits GROUP BY ALL),
    g AS (SELECT service, CAST(sum(n) AS BIGINT) AS requests, count(*) AS hours, sum(ok)::DOUBLE * 1e2 / sum(n)::DOUBLE AS success_rate, round(stddev_pop(ok::DOUBLE / n * 100), 6) AS deviation,
      round(min(ok::DOUBLE / n * 100), 6) AS min_rate, round(max(ok::DOUBLE / n * 100), 6) AS max_rate FROM h GROUP BY service),
    st AS (SELECT *, CASE WHEN success_rate < 99 THEN '成功率低' WHEN deviation > 5 THEN '波动较大' WHEN min_rate < 95 THEN '存在异常时段' ELSE '正常' END AS state FROM g)"""


@register("a24_success_stability", A24_SQL + " SELECT * FROM st")
def _(spark, sf):
    return stability.success_rate(hits(spark, sf))


@register("w14_state_anomaly", A24_SQL + f", z AS (SELECT *, CASE state WHEN '成功率低' THEN 80 WHEN '波动较大' THEN 60 WHEN '存在异常时段' THEN 40 ELSE 0 END AS anomaly_score FROM st) SELECT *, {_LEVEL} AS anomaly_level FROM z")
def _(spark, sf):
    return stability.state_anomaly(stability.success_rate(hits(spark, sf)))


@register(
    "a25_latency_stability",
    f""", g AS (SELECT service, count(*) AS requests, min(duration_ms) AS min_ms, max(duration_ms) AS max_ms, {pct('duration_ms', .5, 'p50')}, {pct('duration_ms', .95, 'p95')}, {pct('duration_ms', .99, 'p99')},
      round(round(quantile_cont(duration_ms, .75), 6) - round(quantile_cont(duration_ms, .25), 6), 6) AS iqr FROM hits GROUP BY service)
    SELECT *, CASE WHEN p50 > 500 THEN '响应时间长' WHEN p99 > p50 * 5 THEN '存在极值' WHEN iqr > p50 THEN '响应不稳定' ELSE '正常' END AS state FROM g""",
)
def _(spark, sf):
    return stability.response_time(hits(spark, sf))


@register(
    "a26_resource_use",
    """SELECT service, request_method, count(*) AS requests, sum(body_bytes)::DOUBLE / count(*) / 1024e0 AS avg_body_kb, sum(sent_bytes)::DOUBLE / count(*) / 1024e0 AS avg_sent_kb,
    sum(sent_bytes)::DOUBLE / 1048576e0 AS sent_mb, sum(body_bytes)::DOUBLE * 1e2 / sum(sent_bytes)::DOUBLE AS efficiency FROM hits GROUP BY 1, 2""",
)
def _(spark, sf):
    return stability.resource_use(hits(spark, sf))


@register(
    "a27_request_frequency",
    f""", m AS (SELECT service, date_trunc('minute', log_time) AS t, count(*) AS n FROM hits GROUP BY 1, 2)
    SELECT service, count(*) AS minutes, {isum('n')} AS requests, {pct('n', .95, 'p95')}, {pct('n', .99, 'p99')}, avg(n) AS avg_per_minute, round(stddev_pop(n), 6) AS deviation FROM m GROUP BY service""",
)
def _(spark, sf):
    return stability.request_frequency(hits(spark, sf))


A29_SQL = """, m AS (SELECT date_trunc('minute', log_time) AS minute, count(*) AS requests, round(avg(CASE WHEN response_ms > 0 THEN connect_ms::DOUBLE / response_ms * 100 ELSE 0 END), 6) AS avg_cost FROM hits GROUP BY 1)"""


@register("a29_connection_cost", A29_SQL + " SELECT * FROM m")
def _(spark, sf):
    return stability.connection_cost(hits(spark, sf))


@register(
    "a29_connection_summary",
    A29_SQL
    + " SELECT count(*) AS minutes, round(avg(requests), 6) AS avg_requests, max(requests) AS max_requests, round(stddev_samp(requests), 6) AS std_requests, round(avg(avg_cost), 4) AS avg_cost, round(max(avg_cost), 4) AS max_cost FROM m",
)
def _(spark, sf):
    return stability.connection_summary(stability.connection_cost(hits(spark, sf)))


@register(
    "a30_backend",
    f""", v AS (SELECT stat_hour, service, connect_ms, process_ms, round(CASE WHEN response_ms > 0 THEN process_ms::DOUBLE / response_ms * 100 ELSE 0 END, 2) AS eff FROM hits),
    g AS (SELECT stat_hour, service, count(*) AS requests, {pct('eff', .5, 'efficiency_p50')}, {pct('eff', .95, 'efficiency_p95')}, {pct('connect_ms', .5, 'connect_p50')}, {pct('connect_ms', .95, 'connect_p95')},
      {pct('process_ms', .5, 'process_p50')}, {pct('process_ms', .95, 'process_p95')} FROM v GROUP BY 1, 2)
    SELECT *, CASE WHEN efficiency_p50 < 60 THEN '处理效率低' WHEN connect_p95 > 100 THEN '连接延迟高' WHEN process_p95 > 1000 THEN '处理时间长' ELSE '正常' END AS state FROM g""",
)
def _(spark, sf):
    return stability.backend(hits(spark, sf))


@register(
    "a31_transfer",
    f""", s AS (SELECT stat_hour, service, duration_ms / 1e3 AS t, header_ms / 1e3 AS h, response_ms / 1e3 AS r, body_bytes / 1024e0 AS b, sent_bytes / 1024e0 AS z FROM hits),
    p AS (SELECT *, greatest(0e0, r - h) AS bt, greatest(0e0, t - r) AS ft FROM s),
    v AS (SELECT stat_hour, service, CASE WHEN bt > 0 THEN b / bt ELSE 0 END AS rs, CASE WHEN bt + ft > 0 THEN z / (bt + ft) ELSE 0 END AS ts, CASE WHEN ft > 0 THEN z / ft ELSE 0 END AS fs FROM p),
    g AS (SELECT stat_hour, service, count(*) AS requests, {pct('rs', .5, 'response_p50')}, {pct('rs', .05, 'response_p5')}, {pct('ts', .5, 'total_p50')}, {pct('ts', .05, 'total_p5')}, {pct('fs', .5, 'front_p50')} FROM v GROUP BY 1, 2)
    SELECT *, CASE WHEN total_p50 < 1000 THEN '传输速度慢' WHEN front_p50 < response_p50 * 0.8e0 THEN '前端传输瓶颈' WHEN response_p5 < total_p50 * 0.3e0 THEN '传输不稳定' ELSE '正常' END AS state FROM g""",
)
def _(spark, sf):
    return stability.transfer(hits(spark, sf))


@register(
    "a32_lifecycle",
    f""", v AS (SELECT stat_hour, service, front_ms, round(CASE WHEN duration_ms > 0 THEN network_ms::DOUBLE / duration_ms * 100 ELSE 0 END, 2) AS o, round(CASE WHEN duration_ms > 0 THEN transfer_ms::DOUBLE / duration_ms * 100 ELSE 0 END, 2) AS t FROM hits),
    g AS (SELECT stat_hour, service, count(*) AS requests, {pct('o', .5, 'overhead_p50')}, {pct('o', .95, 'overhead_p95')}, {pct('t', .5, 'transfer_p50')}, {pct('t', .95, 'transfer_p95')}, {pct('front_ms', .5, 'front_p50')} FROM v GROUP BY 1, 2)
    SELECT *, CASE WHEN overhead_p50 > 30 THEN '网络开销高' WHEN transfer_p50 > 60 THEN '传输时间占比高' WHEN overhead_p95 > overhead_p50 * 3 THEN '网络开销不稳定' ELSE '正常' END AS state FROM g""",
)
def _(spark, sf):
    return stability.lifecycle(hits(spark, sf))


A33_SQL = f""", md AS (SELECT client_ip, status, count(*) AS n FROM hits GROUP BY 1, 2), mh AS (SELECT client_ip, lpad(hour::VARCHAR, 2, '0') AS h, count(*) AS n FROM hits GROUP BY 1, 2),
    m1 AS (SELECT client_ip, arg_min(status, (-n, status)) AS top_status FROM md GROUP BY 1), m2 AS (SELECT client_ip, arg_min(h, (-n, h)) AS peak_hour FROM mh GROUP BY 1),
    g AS (SELECT client_ip, min(ip_kind) AS ip_kind, count(*) AS requests, {n_if("status LIKE '2%' OR status LIKE '3%'")} AS successes, {n_if('is_error')} AS errors, {n_if('is_slow')} AS slow,
      {n_if("status LIKE '4%'")} AS client_errors, {n_if('hour < 6')} AS night, {isum('sent_bytes')} AS bytes, avg(duration_ms) AS avg_ms, {pct('duration_ms', .5, 'p50')}, {pct('duration_ms', .95, 'p95')}, {pct('duration_ms', .99, 'p99')},
      count(DISTINCT uri) AS apis FROM hits WHERE client_ip NOT IN ('', '-') GROUP BY client_ip),
    rep AS (SELECT g.*, top_status, peak_hour, successes * 1e2 / requests AS success_rate, errors * 1e2 / requests AS error_rate, slow * 1e2 / requests AS slow_rate,
      client_errors * 1e2 / requests AS client_error_rate, night * 1e2 / requests AS night_rate FROM g JOIN m1 USING (client_ip) JOIN m2 USING (client_ip))"""


@register("a33_ip_report", A33_SQL + " SELECT * FROM rep")
def _(spark, sf):
    return clients.ip_report(hits(spark, sf))


def _band(v, steps):
    return "CASE " + " ".join(f"WHEN {v} > {b} THEN {p}" for b, p in steps) + " ELSE 0 END"


@register(
    "a34_ip_risk",
    A33_SQL
    + f""" SELECT client_ip, least(100, {_band('requests', [(50000, 40), (10000, 30), (1000, 15), (100, 5)])} + {_band('error_rate', [(50, 25), (20, 15), (10, 10)])} + {_band('slow_rate', [(30, 20), (10, 10)])}
      + {_band('apis', [(100, 20), (50, 15), (20, 10)])} + {_band('client_error_rate', [(30, 15), (10, 10)])} + {_band('night_rate', [(50, 15)])}) AS risk_score,
    array_to_string(list_filter([CASE WHEN requests > 50000 THEN '超高请求量' WHEN requests > 10000 THEN '高请求量' WHEN requests > 1000 THEN '中等请求量' END, CASE WHEN error_rate > 50 THEN '极高错误率' WHEN error_rate > 20 THEN '高错误率' WHEN error_rate > 10 THEN '中等错误率' END,
      CASE WHEN slow_rate > 30 THEN '极高慢请求率' WHEN slow_rate > 10 THEN '高慢请求率' END, CASE WHEN apis > 100 THEN 'API扫描行为' WHEN apis > 50 THEN '高API多样性' WHEN apis > 20 THEN '中等API多样性' END,
      CASE WHEN client_error_rate > 30 THEN '高4xx错误率' WHEN client_error_rate > 10 THEN '中等4xx错误率' END, CASE WHEN night_rate > 50 THEN '深夜异常活跃' END], lambda v: v IS NOT NULL), '; ') AS risk_factors,
    least(100, {_band('requests', [(10000, 30), (1000, 15), (100, 5)])} + {_band('error_rate', [(50, 25), (20, 15), (10, 10)])} + {_band('slow_rate', [(30, 20), (10, 10)])} + {_band('apis', [(50, 15), (20, 10)])} + {_band('client_error_rate', [(30, 10)])}) AS simple_risk FROM rep""",
)
def _(spark, sf):
    out = clients.simple_risk(clients.risk(clients.ip_report(hits(spark, sf))))
    return out.select("client_ip", "risk_score", "risk_factors", "simple_risk")


A35_SQL = A33_SQL + """, sc AS (SELECT *, CASE WHEN requests > 20000 THEN 30 ELSE 0 END + CASE WHEN success_rate < 50 THEN 40 ELSE 0 END + CASE WHEN p99 > 10000 THEN 30 ELSE 0 END + CASE WHEN error_rate > 20 THEN 25 ELSE 0 END AS anomaly_score,
    CASE WHEN apis > 50 AND requests > 1000 AND error_rate > 30 THEN '疑似恶意扫描' WHEN apis > 50 AND requests > 1000 THEN '深度访问用户' WHEN requests > 5000 AND apis < 5 THEN '高频单一访问' WHEN error_rate > 50 THEN '异常访问'
      WHEN requests < 10 THEN '轻度访问' ELSE '正常访问' END AS pattern FROM rep)"""


@register("a35_ip_anomaly", A35_SQL + f" SELECT client_ip, anomaly_score, pattern, {_LEVEL} AS anomaly_level FROM sc")
def _(spark, sf):
    return clients.anomaly(clients.ip_report(hits(spark, sf))).select("client_ip", "anomaly_score", "pattern", "anomaly_level")


@register(
    "a36_ip_kinds",
    A33_SQL
    + f" SELECT ip_kind, count(*) AS clients, {isum('requests')} AS requests, {isum('errors')} AS errors, sum(requests)::DOUBLE * 1e2 / (SELECT sum(requests) FROM rep)::DOUBLE AS share, sum(errors)::DOUBLE * 1e2 / sum(requests)::DOUBLE AS error_rate FROM rep GROUP BY ip_kind",
)
def _(spark, sf):
    return clients.kind_distribution(clients.ip_report(hits(spark, sf)))


@register("a36_ip_patterns", A35_SQL + f" SELECT pattern, count(*) AS clients, {isum('requests')} AS requests FROM sc GROUP BY pattern")
def _(spark, sf):
    return clients.pattern_distribution(clients.anomaly(clients.ip_report(hits(spark, sf))))


@register("a36_ip_hours", "SELECT hour, count(*) AS requests, count(DISTINCT client_ip) AS clients FROM hits GROUP BY hour")
def _(spark, sf):
    return clients.hour_distribution(hits(spark, sf))


@register(
    "a37_user_agents",
    f"""SELECT user_agent, count(*) AS requests, {n_if('is_success')} AS successes, {n_if('is_error')} AS errors, min(browser) AS browser, min(os) AS os, min(device) AS device, min(bot_type) AS bot_type,
    count(DISTINCT client_ip) AS clients, avg(duration_ms) AS avg_ms FROM hits WHERE user_agent NOT IN ('', '-') GROUP BY user_agent""",
)
def _(spark, sf):
    return headers.user_agents(hits(spark, sf))


_HD = ["browser", "os", "device", "bot_type"]


@register("a37_agent_counts", " UNION ALL ".join(f"SELECT '{d}' AS dimension, {d} AS label, count(*) AS requests FROM hits WHERE {d} IS NOT NULL GROUP BY {d}" for d in _HD))
def _(spark, sf):
    return headers.counts(hits(spark, sf), _HD)


@register(
    "a38_referers",
    f"""SELECT referer, count(*) AS requests, {n_if('is_success')} AS successes, min(referer_domain) AS referer_domain, min(search_engine) AS search_engine, min(social_network) AS social_network,
    count(DISTINCT client_ip) AS clients, avg(duration_ms) AS avg_ms FROM hits WHERE referer NOT IN ('', '-') GROUP BY referer""",
)
def _(spark, sf):
    return headers.referers(hits(spark, sf))


A39_SQL = (
    ", l AS ("
    + " UNION ALL ".join(f"SELECT '{d}' AS dimension, {d} AS label, duration_ms, is_slow, is_error, sent_bytes FROM hits WHERE {d} IS NOT NULL" for d in headers.DIMENSIONS)
    + f"""), hp AS (SELECT dimension, label, count(*) AS requests, {n_if('is_slow')} AS slow, {n_if('is_error')} AS errors, {isum('sent_bytes')} AS bytes, {pct('duration_ms', .5, 'p50')}, {pct('duration_ms', .95, 'p95')}, {pct('duration_ms', .99, 'p99')},
      {n_if('is_slow')} * 1e2 / count(*) AS slow_rate, {n_if('is_error')} * 1e2 / count(*) AS error_rate, avg(duration_ms) AS avg_ms FROM l GROUP BY 1, 2)"""
)


@register("a39_header_performance", A39_SQL + " SELECT * FROM hp")
def _(spark, sf):
    return headers.performance(hits(spark, sf))


@register(
    "a40_worst_headers",
    A39_SQL
    + """, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY dimension ORDER BY slow_rate DESC, requests DESC, label) AS INT) AS rank FROM hp)
    SELECT dimension, label, rank, requests, slow_rate, avg_ms FROM r WHERE rank <= CASE dimension WHEN 'referer_domain' THEN 5 ELSE 3 END""",
)
def _(spark, sf):
    return headers.worst(headers.performance(hits(spark, sf)))


A41_SQL = f""", mc AS (SELECT uri, status, count(*) AS n FROM hits WHERE is_error GROUP BY 1, 2), mm AS (SELECT uri, arg_min(status, (-n, status)) AS main_code FROM mc GROUP BY 1),
    g AS (SELECT uri, count(*) AS requests, {n_if('is_error')} AS errors, min(log_time) FILTER (WHERE is_error) AS first_error, max(log_time) FILTER (WHERE is_error) AS last_error,
      {", ".join(f"count(DISTINCT {col}) FILTER (WHERE is_error) AS {name}" for name, col in (('clients', 'client_ip'), ('applications', 'application'), ('services', 'service'), ('upstreams', 'upstream_addr'), ('codes', 'status')))}
      FROM hits GROUP BY uri HAVING {n_if('is_error')} > 0),
    ie AS (SELECT g.*, main_code, errors * 1e2 / requests AS error_rate FROM g JOIN mm USING (uri))"""


@register("a41_interface_errors", A41_SQL + " SELECT * FROM ie")
def _(spark, sf):
    return errors.interfaces(hits(spark, sf))


@register(
    "a42_top_error_interfaces",
    A41_SQL
    + """, c1 AS (SELECT CAST(row_number() OVER (ORDER BY errors DESC, uri) AS INT) AS rank, uri AS count_uri, errors::DOUBLE AS count_value FROM ie),
    c2 AS (SELECT CAST(row_number() OVER (ORDER BY error_rate DESC, uri) AS INT) AS rank, uri AS rate_uri, error_rate AS rate_value FROM ie WHERE requests >= 100),
    c3 AS (SELECT CAST(row_number() OVER (ORDER BY clients DESC, uri) AS INT) AS rank, uri AS clients_uri, clients::DOUBLE AS clients_value FROM ie)
    SELECT * FROM (SELECT * FROM c1 WHERE rank <= 10) FULL JOIN (SELECT * FROM c2 WHERE rank <= 10) USING (rank) FULL JOIN (SELECT * FROM c3 WHERE rank <= 10) USING (rank)""",
)
def _(spark, sf):
    return errors.top_interfaces(errors.interfaces(hits(spark, sf)))


def _listed_sql(by: str, where: str, k: int) -> str:
    return f""", n AS (SELECT {by}, uri, count(*) AS n FROM hits WHERE {where} GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY n DESC, uri) AS k FROM n),
    t AS (SELECT {by}, {isum('n')} AS errors, count(*) AS interfaces FROM n GROUP BY 1), s AS (SELECT {by}, string_agg(uri || '(' || n || ')', '; ' ORDER BY k) AS top FROM r WHERE k <= {k} GROUP BY 1)
    SELECT {by}, errors, interfaces, top FROM t JOIN s USING ({by})"""


@register("a43_critical_codes", _listed_sql("status", "status IN ('500', '502', '503', '504')", 5))
def _(spark, sf):
    return errors.critical_codes(hits(spark, sf))


@register(
    "a44_upstream_errors",
    """, mc AS (SELECT upstream_addr, status, count(*) AS n FROM hits WHERE is_error GROUP BY 1, 2), mm AS (SELECT upstream_addr, arg_min(status, (-n, status)) AS main_code FROM mc GROUP BY 1),
    g AS (SELECT upstream_addr, count(*) AS errors, count(DISTINCT uri) AS interfaces, avg(connect_ms) FILTER (WHERE connect_ms > 0) AS avg_connect_ms, avg(response_ms) FILTER (WHERE response_ms > 0) AS avg_response_ms FROM hits WHERE is_error GROUP BY 1)
    SELECT g.*, main_code FROM g JOIN mm USING (upstream_addr)""",
)
def _(spark, sf):
    return errors.upstreams(hits(spark, sf))


@register("a45_errors_by_hour", _listed_sql("stat_hour", "is_error", 3))
def _(spark, sf):
    return errors.by_hour(hits(spark, sf))


@register(
    "a46_error_impact",
    " UNION ALL ".join(
        f"SELECT '{k}' AS dimension, count(DISTINCT {v}) AS total, count(DISTINCT {v}) FILTER (WHERE is_error) AS affected, count(DISTINCT {v}) FILTER (WHERE is_error) * 1e2 / count(DISTINCT {v}) AS impact_rate FROM hits"
        for k, v in (("client", "client_ip"), ("application", "application"), ("service", "service"))
    ),
)
def _(spark, sf):
    return errors.impact(hits(spark, sf))


@register(
    "a47_error_samples",
    """, r AS (SELECT uri, log_time, event_id, status, duration_ms, client_ip, service, CAST(row_number() OVER (PARTITION BY uri ORDER BY log_time, event_id) AS INT) AS rank FROM hits WHERE is_error) SELECT * FROM r WHERE rank <= 50""",
)
def _(spark, sf):
    return errors.samples(hits(spark, sf))


_GAPS = """, l AS (SELECT uri, event_id, log_time, lag(log_time) OVER (PARTITION BY uri ORDER BY log_time, event_id) AS prev_log_time FROM hits WHERE is_error)"""


@register(
    "a48_error_bursts",
    _GAPS
    + """, g AS (SELECT *, epoch_us(log_time) - epoch_us(prev_log_time) AS gap FROM l)
    SELECT uri, count(*) AS errors, min(log_time) AS first_error, max(log_time) AS last_error, sum(gap)::DOUBLE / count(gap) / 1e6 AS avg_gap, min(gap) / 1e6 AS min_gap, max(gap) / 1e6 AS max_gap,
    count(*) FILTER (WHERE gap < 300000000) AS bursts FROM g GROUP BY uri HAVING count(*) >= 2""",
)
def _(spark, sf):
    return errors.bursts(hits(spark, sf))


@register("w11_error_gaps", _GAPS + " SELECT event_id, prev_log_time FROM l")
def _(spark, sf):
    rows = hits(spark, sf).filter("is_error").select("uri", "log_time", "event_id")
    out = sequence.with_previous(rows, ["uri"], ["log_time", "event_id"], ["log_time"], slice_of=F.date_trunc("minute", "log_time"))
    return out.select("event_id", "prev_log_time")


@register(
    "a49_cdn_buckets",
    """, h AS (SELECT date_trunc('hour', log_time) AS bucket, list(duration_ms ORDER BY duration_ms) AS v, count(*) AS requests, count(*) FILTER (WHERE CAST(status AS INT) BETWEEN 200 AND 399) AS successes,
      count(*) FILTER (WHERE duration_ms > 5000) AS slow, avg(duration_ms) AS avg_ms, max(duration_ms) AS max_ms, min(duration_ms) AS min_ms FROM access GROUP BY 1)
    SELECT bucket, requests, successes, slow, avg_ms, max_ms, min_ms, v[CAST(least(floor(requests * 0.95e0), requests - 1) AS BIGINT) + 1] AS p95_ms, v[CAST(least(floor(requests * 0.99e0), requests - 1) AS BIGINT) + 1] AS p99_ms, successes / 3600e0 AS qps FROM h""",
)
def _(spark, sf):
    return cdn.buckets(access(spark, sf), "hour")


_OK34 = "CAST(status AS INT) BETWEEN 200 AND 399"


@register(
    "a49_cdn_tallies",
    f"""SELECT 'status' AS dimension, status AS label, count(*) AS requests, {n_if(_OK34)} AS successes FROM hits GROUP BY status
    UNION ALL SELECT 'client', client_ip, count(*), {n_if(_OK34)} FROM hits GROUP BY client_ip UNION ALL SELECT 'uri', uri, count(*), {n_if(_OK34)} FROM hits GROUP BY uri
    UNION ALL SELECT 'agent', coalesce({sql_case('ua', K.AGENT_FAMILY, None)}, left(user_agent, 50) || CASE WHEN length(user_agent) > 50 THEN '...' ELSE '' END), count(*), {n_if(_OK34)} FROM hits WHERE user_agent NOT IN ('', '-') GROUP BY 2""",
)
def _(spark, sf):
    return cdn.tallies(hits(spark, sf))


A51_SQL = f""", k AS (SELECT count(*) AS requests, count(DISTINCT client_ip) AS clients, count(DISTINCT uri) AS apis, {isum('sent_bytes')} AS bytes, {pct('duration_ms', .5, 'p50')}, {pct('duration_ms', .95, 'p95')}, {pct('duration_ms', .99, 'p99')},
    {n_if('is_success')} * 1e2 / count(*) AS success_rate, {n_if('is_error')} * 1e2 / count(*) AS error_rate, {n_if("status LIKE '5%'")} * 1e2 / count(*) AS server_error_rate, {n_if('is_slow')} * 1e2 / count(*) AS slow_rate,
    {n_if('has_anomaly')} * 1e2 / count(*) AS anomaly_rate, avg(duration_ms) AS avg_ms, round(stddev_pop(duration_ms), 4) AS std_ms, sum(process_ms)::DOUBLE * 1e2 / sum(response_ms)::DOUBLE AS backend_efficiency,
    sum(network_ms)::DOUBLE * 1e2 / sum(duration_ms)::DOUBLE AS network_share, sum(transfer_ms)::DOUBLE * 1e2 / sum(duration_ms)::DOUBLE AS transfer_share, sum(connect_ms)::DOUBLE * 1e2 / sum(response_ms)::DOUBLE AS connection_cost FROM hits)"""


@register("a51_key_metrics", A51_SQL + " SELECT * FROM k")
def _(spark, sf):
    return summary.key_metrics(hits(spark, sf))


@register(
    "a51_diagnosis",
    A51_SQL
    + """, d AS (SELECT list_filter([CASE WHEN backend_efficiency < 60 THEN 'backend' END, CASE WHEN network_share > 30 THEN 'network' END, CASE WHEN transfer_share > 60 THEN 'transfer' END, CASE WHEN connection_cost > 20 THEN 'connection' END,
      CASE WHEN error_rate > 5 THEN 'errors' END, CASE WHEN slow_rate > 10 THEN 'slow' END], lambda v: v IS NOT NULL) AS f FROM k) SELECT array_to_string(f, ',') AS bottlenecks, CAST(len(f) AS INT) AS found FROM d""",
)
def _(spark, sf):
    return summary.diagnosis(summary.key_metrics(hits(spark, sf)))


@register(
    "a50_health_score",
    A51_SQL
    + bucket_sql("day")
    + ", tl AS (" + " UNION ALL ".join(f"SELECT bucket, '{m}' AS metric, {m}::DOUBLE AS v FROM rep" for m in ("p50", "error_rate", "qps")) + ")"
    + """, th AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY bucket) <= count(*) OVER (PARTITION BY metric) // 2 AS early FROM tl),
    tg AS (SELECT metric, avg(v) FILTER (WHERE early) AS x, avg(v) FILTER (WHERE NOT early) AS y FROM th GROUP BY metric), tc AS (SELECT metric, round((y - x) / x * 100, 6) AS ch FROM tg WHERE x <> 0),
    tp AS (SELECT coalesce(sum(CASE WHEN metric IN ('p50', 'error_rate') AND ch > 5 THEN least(20e0, abs(ch)) WHEN metric = 'qps' AND ch < -5 THEN least(15e0, abs(ch)) END), 0) AS lost FROM tc),
    s AS (SELECT greatest(0e0, 100 - server_error_rate * 20) AS e, greatest(0e0, 100 - greatest(0e0, avg_ms / 1000 - 0.5e0) * 50) AS l, (least(100e0, backend_efficiency) + (100 - connection_cost) + (100 - transfer_share)) / 3 AS f,
      greatest(0e0, 100 - CASE WHEN std_ms / 1000 > 0.5 THEN least(30e0, std_ms / 1000 * 20) ELSE 0 END - CASE WHEN server_error_rate > 0.5 THEN least(40e0, server_error_rate * 15) ELSE 0 END) AS s,
      greatest(0e0, 100 - (CASE WHEN server_error_rate > 2 THEN least(50e0, server_error_rate * 10) ELSE 0 END + CASE WHEN avg_ms / 1000 > 2 THEN least(30e0, (avg_ms / 1000 - 2) * 15) ELSE 0 END)) AS a,
      greatest(0e0, 80 - (SELECT lost FROM tp)) AS t FROM k),
    o AS (SELECT *, round(e * 0.25e0 + l * 0.2e0 + f * 0.2e0 + s * 0.15e0 + a * 0.1e0 + t * 0.1e0, 4) AS overall FROM s)
    SELECT round(e, 4) AS error_score, round(l, 4) AS latency_score, round(f, 4) AS efficiency_score, round(s, 4) AS stability_score, round(a, 4) AS anomaly_score, round(t, 4) AS trend_score, overall,
    CASE WHEN overall >= 90 THEN '优秀' WHEN overall >= 80 THEN '良好' WHEN overall >= 70 THEN '一般' WHEN overall >= 60 THEN '需要关注' ELSE '需要紧急处理' END AS grade FROM o""",
)
def _(spark, sf):
    rows = hits(spark, sf)
    trends = timeline.halves_trend(timeline.buckets(rows, "day"), ["p50", "error_rate", "qps"])
    return summary.health(summary.key_metrics(rows), trends)


_RAW_TIMES = """, m AS (SELECT event_id, duration_ms - event_id % 3 AS d, connect_ms, header_ms - event_id % 50 AS h, response_ms FROM access)"""


def _messy(spark, sf):
    df = access(spark, sf)
    return df.withColumns({"duration_ms": c("duration_ms") - c("event_id") % 3, "header_ms": c("header_ms") - c("event_id") % 50})


@register(
    "e52_lifecycle_check",
    _RAW_TIMES
    + """, g AS (SELECT count(*) AS requests, count(*) FILTER (WHERE connect_ms > h OR h > response_ms OR response_ms > d) AS disordered FROM m) SELECT *, disordered <= requests * 0.1e0 AS passed FROM g""",
)
def _(spark, sf):
    return summary.lifecycle_check(_messy(spark, sf))


@register(
    "e53_lifecycle_clean",
    _RAW_TIMES
    + """ SELECT event_id, greatest(h, connect_ms) AS header_ms, greatest(response_ms, h, connect_ms) AS response_ms, greatest(d, response_ms, h, connect_ms) AS duration_ms FROM m
    WHERE connect_ms >= 0 AND h >= 0 AND response_ms >= 0 AND d >= 0 AND d <= 600000""",
)
def _(spark, sf):
    return summary.lifecycle_clean(_messy(spark, sf)).select("event_id", "header_ms", "response_ms", "duration_ms")
