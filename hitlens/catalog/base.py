"""Registry of checked queries, the request view over ``events`` and its SQL twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.functions.network import _bounds
from hitlens.plans.enrich import enrich

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Linux; Android 11; V2164A Build/RP1A) AppleWebKit/537.36 Chrome/87.0.4280.141 Mobile Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_4 like Mac OS X) AppleWebKit/605.1.15 MicroMessenger/8.0.37 NetType/WIFI",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 Version/16.1 Safari/605.1.15",
    "WST-SDK-iOS 1.0.0",
    "WST-SDK-ANDROID/1.0.0",
    "zgt-ios/1.4.2 (iPhone; iOS 18.5; Scale/3.00)",
    "Dalvik/2.1.0 (Linux; U; Android 11; V2164A)",
    "Mozilla/5.0 (compatible; Baiduspider/2.0; +http://www.baidu.com/search/spider.html)",
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
    "curl/7.68.0",
    "python-requests/2.28.1",
    "okhttp/4.9.3",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/115.0",
    "sqlmap/1.7",
    "-",
]
REFERERS = [
    "-",
    "https://www.baidu.com/s?wd=%E5%85%AC%E7%A7%AF%E9%87%91&rn=10",
    "https://www.google.com/search?q=spark+sql",
    "https://servicewechat.com/wx12345/page.html",
    "https://mp.weixin.qq.com/s/abc",
    "https://www.gx.gov.cn/index.html",
    "http://news.example.com:8080/a?utm_source=mail",
    "https://weibo.com/u/1",
    "https://www.zhihu.com/question/1",
    "",
    "https://cs.tsinghua.edu.cn/x",
    "direct",
]
ADDRESSES = [
    "10.0.0.",
    "192.168.1.",
    "172.20.5.",
    "8.8.4.",
    "114.114.114.",
    "45.12.7.",
    "185.220.101.",
    "52.10.3.",
    "111.13.9.",
    "59.255.4.",
]
SERVERS = [
    "gateway.gx.gov.cn",
    "cdn.beijing.gov.cn",
    "dev-api.zj.example.com",
    "test.mof.gov.cn",
    "lb-01.example.com",
    "www.example.com",
]
METHODS = ["GET", "GET", "GET", "POST", "GET", "PUT", "GET", "POST", "GET", "DELETE"]
# '#' stands for the number in the event's properties, '~' for the event type
URIS = [
    "/api/~/#",
    "/api/v1/~/#?id=#&name=x&flag",
    "/scmp-gateway/gxrz-rest/newUser/loginBy~",
    "/scmp-gateway/alipay/pay/#",
    "/scmp-gateway/zww/query~/list",
    "/zgt-h5/js/app.min.js",
    "/group1/M00/06/a#.png",
    "/static/css/main.css?v=#",
    "/admin/login.php?user=a or 1=1 or #",
    "/search?q=<script>alert(#)</script>",
    "/user/0123abcdef#/orders/",
    "/api/x/config/settings",
    "/",
    "/certificate/apply/#",
    "/api/user-service/order/#",
    "/files/../.env?x=;drop table ~",
]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw web requests (durations ms, wall clock in UTC)."""
    # the test table is one row group, which no split setting can divide; it is dealt out by the place of a row, since
    # the task that reads it would sort all its rows in memory before it deals them by round robin
    e = table(spark, sf_dir, "events")
    return requests_from(e.repartitionById(parts(e), F.hash(F.monotonically_increasing_id())))


def parts(e: DataFrame) -> int:
    """Partitions for a table: enough that no task gets more rows as the table grows (the count reads Parquet footers).

    A shuffle into few enough partitions writes its rows through; into more, a task that reads a large row group keeps
    all of it in memory. So their number stays there until tasks reach ``MOST_ROWS_PER_PART``.
    """
    rows = e.count()
    written_through = int(e.sparkSession.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return max(PARTS, min(-(-rows // ROWS_PER_PART), written_through), -(-rows // MOST_ROWS_PER_PART))


def requests_from(e: DataFrame) -> DataFrame:
    i, user = F.col("event_id"), F.col("user_id")
    number = F.regexp_extract("props", r"(\d+)", 1)
    template = _pick(URIS, i % 16)
    failed = F.col("event_type") == "error"
    status = (
        F.when(failed & (i % 2 == 0), _pick(["500", "502", "503", "504"], F.floor(i / 2) % 4))
        .when(failed, _pick(["404", "403", "404", "429"], F.floor(i / 2) % 4))
        .when(i % 17 == 0, F.lit("302"))
        .otherwise(F.lit("200"))
    )
    ms = F.floor(F.col("value") * 100).cast("long")

    def part(share: int) -> Column:
        return F.floor(F.col("duration_ms") * share / 100).cast("long")

    body = F.when(i % 100 == 0, (i % 5000) * 5000).otherwise(i % 5000)
    out = e.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("log_time"),
        F.concat(_pick(ADDRESSES, user % 10), (user % 256).cast("string")).alias("client_ip"),
        _pick(METHODS, i % 10).alias("request_method"),
        F.replace(F.replace(template, F.lit("#"), number), F.lit("~"), F.col("event_type")).alias("request_uri"),
        status.alias("status"),
        ms.alias("duration_ms"),
        body.alias("body_bytes"),
        (body + 200).alias("sent_bytes"),
        _pick(AGENTS, F.floor(i / 3) % 16).alias("user_agent"),
        _pick(REFERERS, F.floor(i / 5) % 12).alias("referer"),
        _pick(SERVERS, F.floor(i / 7) % 6).alias("server_name"),
        F.concat(F.lit("10.1.0."), (i % 4).cast("string"), F.lit(":8080")).alias("upstream_addr"),
    )
    return out.withColumns({"connect_ms": part(5), "header_ms": part(15), "response_ms": part(70)})


PARTS = 8
ROWS_PER_PART = 50_000
MOST_ROWS_PER_PART = 200_000

_PLANS: dict[tuple[str, str], DataFrame] = {}


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched requests; the analysed plan (not the data) is kept per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PLANS:
        _PLANS[key] = enrich(access(spark, sf_dir))
    return _PLANS[key]


@contextmanager
def enriched_from(spark: SparkSession, sf_dir: str, stored: DataFrame) -> Iterator[None]:
    """Within this context the reports read a stored enriched table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    before = _PLANS.get(key)
    _PLANS[key] = stored
    try:
        yield
    finally:
        _PLANS.pop(key) if before is None else _PLANS.update({key: before})


def scratch(spark: SparkSession, name: str) -> str:
    """New folder for a job's files that every executor reaches: under the shared folder that the session
    names, else under its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/hitlens/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- SQL twin


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def sql_case(subject: str, rules, default: str | None) -> str:
    arms = " ".join(f"WHEN regexp_matches({subject}, {q(pattern)}) THEN {q(label)}" for label, pattern in rules)
    return f"CASE {arms} ELSE {'NULL' if default is None else q(default)} END"


def sql_map(subject: str, mapping, default) -> str:
    def lit(v):
        return q(v) if isinstance(v, str) else str(v)

    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {subject} {arms} ELSE {lit(default)} END"


def sql_prefix(subject: str, prefixes) -> str:
    return "(" + " OR ".join(f"starts_with({subject}, {q(p)})" for p in prefixes) + ")"


_IP = "(" + " + ".join(
    f"CAST(split_part(client_ip, '.', {n + 1}) AS BIGINT) * {256 ** (3 - n)}" for n in range(4)
) + ")"


def sql_networks(cidrs) -> str:
    return "(" + " OR ".join("{} BETWEEN {} AND {}".format(_IP, *_bounds(c)) for c in cidrs) + ")"


ACCESS_SQL = f"""
SELECT *, duration_ms * 5 // 100 AS connect_ms, duration_ms * 15 // 100 AS header_ms,
  duration_ms * 70 // 100 AS response_ms, body_bytes + 200 AS sent_bytes
FROM (SELECT event_id, ts AS log_time,
  {sql_list(ADDRESSES)}[user_id % 10 + 1] || (user_id % 256) AS client_ip,
  {sql_list(METHODS)}[event_id % 10 + 1] AS request_method,
  replace(replace({sql_list(URIS)}[event_id % 16 + 1], '#', regexp_extract(props, '(\\d+)', 1)), '~', event_type) AS request_uri,
  CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN ['500', '502', '503', '504'][event_id // 2 % 4 + 1]
    WHEN event_type = 'error' THEN ['404', '403', '404', '429'][event_id // 2 % 4 + 1]
    WHEN event_id % 17 = 0 THEN '302' ELSE '200' END AS status,
  CAST(floor(value * 100) AS BIGINT) AS duration_ms,
  CASE WHEN event_id % 100 = 0 THEN event_id % 5000 * 5000 ELSE event_id % 5000 END AS body_bytes,
  {sql_list(AGENTS)}[event_id // 3 % 16 + 1] AS user_agent,
  {sql_list(REFERERS)}[event_id // 5 % 12 + 1] AS referer,
  {sql_list(SERVERS)}[event_id // 7 % 6 + 1] AS server_name,
  '10.1.0.' || (event_id % 4) || ':8080' AS upstream_addr
FROM events)"""

_SEG = "string_split(regexp_replace(split_part(request_uri, '?', 1), '^/+|/+$', '', 'g'), '/')"
_INTERNAL = f"regexp_matches(client_ip, {q(K.INTERNAL_ADDRESS)})"
_AUTHORITY = "nullif(regexp_extract(referer, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '')"
_STEP1 = f"""
SELECT *, len(seg) AS seg_n,
  CASE WHEN seg[1] = '' THEN 0 ELSE len(seg) END AS depth,
  (regexp_matches(request_uri, {q(K.STATIC_RESOURCE)}) OR (seg[1] = {q(K.STORE_APP)} AND len(seg) >= 2)) AS is_static
FROM (SELECT *, {_SEG} AS seg, lower(user_agent) AS ua, lower(referer) AS lref, lower(request_uri) AS luri,
  {_AUTHORITY} AS authority FROM access)"""
_STEP2 = f"""
SELECT *,
  CASE WHEN length(split_part(request_uri, '?', 1)) > 1
    THEN regexp_replace(split_part(request_uri, '?', 1), '/$', '') ELSE split_part(request_uri, '?', 1) END AS uri,
  date_trunc('hour', log_time) AS stat_hour, CAST(hour(log_time) AS INT) AS hour,
  CAST(isodow(log_time) AS INT) AS weekday,
  {sql_case('ua', K.PLATFORM, 'Other')} AS platform,
  {sql_case('ua', K.DEVICE, K.DESKTOP)} AS device,
  {sql_case('ua', K.OPERATING_SYSTEM, K.OTHER_SYSTEM)} AS os,
  {sql_case('ua', K.BROWSER, K.OTHER_BROWSER)} AS browser,
  {sql_case('ua', K.BOT, None)} AS bot_type,
  regexp_matches(ua, 'bot|crawler|spider|scraper') AS is_bot,
  CASE WHEN regexp_matches(ua, 'wst-sdk-(ios|android)') THEN 'WST-SDK-' || upper(regexp_extract(ua, 'wst-sdk-(ios|android)', 1))
    WHEN regexp_matches(ua, 'zgt-(ios|android)') THEN 'ZGT-' || upper(regexp_extract(ua, 'zgt-(ios|android)', 1))
    ELSE '' END AS sdk_type,
  regexp_replace(authority, '^www\\.', '') AS referer_domain,
  {sql_case('lref', K.SEARCH_ENGINE, None)} AS search_engine,
  {sql_case('lref', K.SOCIAL_NETWORK, None)} AS social_network,
  CASE WHEN referer IN ('', '-') THEN 'Direct' ELSE {sql_case('lref', K.ENTRY_SOURCE, 'Unknown')} END AS entry_source,
  CASE WHEN depth > 0 THEN seg[1] ELSE 'unknown' END AS application,
  CASE WHEN depth >= 2 THEN seg[2] ELSE 'unknown' END AS service,
  CASE WHEN depth < 2 THEN 'unknown' WHEN seg[1] = {q(K.STORE_APP)} THEN 'files'
    WHEN seg[1] = {q(K.PORTAL_APP)} AND is_static AND depth >= 3 THEN replace(split_part(seg[len(seg)], '.', 1), '.min', '')
    WHEN depth >= 3 THEN seg[3] ELSE 'unknown' END AS module,
  {sql_case('request_uri', K.API_CATEGORY, 'Other')} AS api_category,
  {sql_case('luri', K.OPERATION, 'other')} AS operation,
  {sql_case('luri', K.JOURNEY_STAGE, 'active')} AS journey_stage,
  status LIKE '2%' AS is_success, (status LIKE '4%' OR status LIKE '5%') AS is_error,
  duration_ms > 3000 AS is_slow,
  CASE WHEN status LIKE '5%' THEN 'error' WHEN duration_ms > 10000 THEN 'performance'
    WHEN body_bytes > 10485760 THEN 'data' ELSE '' END AS anomaly_type,
  {_INTERNAL} AS is_internal,
  CASE WHEN {sql_networks(K.PRIVATE_NETWORKS)} THEN '内网IP' WHEN {sql_networks([K.MULTICAST_NETWORK])} THEN '组播IP'
    ELSE '公网IP' END AS ip_kind,
  CASE WHEN {sql_prefix('client_ip', K.TOR_PREFIXES)} THEN 30 ELSE 0 END
    + CASE WHEN {sql_prefix('client_ip', K.VPN_PREFIXES)} THEN 20 ELSE 0 END
    + CASE WHEN {sql_prefix('client_ip', K.DATACENTER_PREFIXES)} THEN 10 ELSE 0 END
    + CASE WHEN regexp_matches(luri, {q(K.SQL_INJECTION)}) THEN 50
        WHEN regexp_matches(luri, {q(K.CROSS_SITE)}) THEN 40 ELSE 0 END AS risk_score,
  regexp_matches(luri, {q(K.SQL_INJECTION)}) AS is_sql_injection,
  regexp_matches(luri, {q(K.CROSS_SITE)}) AS is_cross_site,
  {sql_case('server_name', K.TENANT, 'government')} AS tenant,
  {sql_case('server_name', K.ENVIRONMENT, 'prod')} AS environment,
  greatest(0, header_ms - connect_ms) AS process_ms, greatest(0, response_ms - header_ms) AS backend_transfer_ms,
  greatest(0, duration_ms - response_ms) AS front_ms,
  CASE WHEN duration_ms <= 200 THEN 1 WHEN duration_ms <= 500 THEN 2 WHEN duration_ms <= 1000 THEN 3
    WHEN duration_ms <= 3000 THEN 4 WHEN duration_ms <= 10000 THEN 5 ELSE 6 END AS performance_level,
  CASE WHEN duration_ms < 10 THEN 'HIT' WHEN duration_ms > 3000 THEN 'MISS' ELSE 'BYPASS' END AS cache_status,
  substr(md5(client_ip || '-' || user_agent), 1, 16) AS fingerprint
FROM step1"""
_KNOWN = f"browser NOT IN ({q(K.NO_BROWSER)}, {q(K.OTHER_BROWSER)})"
HITS_SQL = f"""
SELECT *, is_success AND body_bytes > 0 AS is_business_success, anomaly_type <> '' AS has_anomaly,
  connect_ms + front_ms AS network_ms, backend_transfer_ms + front_ms AS transfer_ms,
  CASE WHEN is_static THEN 'static'
    WHEN application = {q(K.GATEWAY_APP)} THEN CASE service WHEN 'gxrz-rest' THEN 'auth' WHEN 'alipay' THEN 'payment'
      WHEN 'zww' THEN 'government' ELSE 'gateway' END
    WHEN application = {q(K.PORTAL_APP)} THEN 'webapp' WHEN application = {q(K.STORE_APP)} THEN 'storage'
    ELSE 'service' END AS api_group,
  CASE WHEN application = {q(K.GATEWAY_APP)} THEN
      CASE WHEN service = 'gxrz-rest' THEN {sql_case('lower(module)', K.IDENTITY_DOMAIN, 'government-identity-service')}
        WHEN service = 'zww' THEN {sql_case('lower(module)', K.PORTAL_DOMAIN, 'government-portal-service')}
        ELSE {sql_map('service', K.GATEWAY_DOMAIN, 'government-gateway-service')} END
    WHEN application = {q(K.PORTAL_APP)} THEN CASE WHEN service IN ('js', 'css', 'images', 'fonts') THEN 'government-static-assets'
      WHEN service = 'pages' THEN 'government-h5-pages' ELSE 'government-h5-service' END
    WHEN application = {q(K.STORE_APP)} THEN 'government-file-storage'
    ELSE {sql_case("lower(application || '/' || service || '/' || module)", K.WORD_DOMAIN, 'general-service')} END AS business_domain,
  CASE WHEN sdk_type <> '' THEN 'APP_Native' WHEN platform IN ('iOS', 'Android') AND {_KNOWN} THEN 'H5_WebView'
    WHEN platform IN ('iOS', 'Android') THEN 'APP_Native' WHEN {_KNOWN} THEN 'Browser' WHEN is_bot THEN 'Bot' ELSE 'API' END AS access_type,
  CASE WHEN is_bot THEN 'Bot' WHEN device = '手机' THEN 'Mobile_App' WHEN device = {q(K.DESKTOP)} THEN 'Desktop_Web'
    WHEN sdk_type <> '' THEN 'SDK_Client' ELSE 'Unknown' END AS client_category,
  CASE WHEN sdk_type <> '' THEN 'official' WHEN is_bot THEN 'automated' ELSE 'standard' END AS client_type,
  CASE WHEN platform IN ('iOS', 'Android') THEN 'official' WHEN platform = 'Bot/Spider' THEN 'automated' ELSE 'web' END AS channel,
  substr(md5(fingerprint || '-' || CAST(floor(epoch(date_trunc('second', log_time)) / 1800) AS BIGINT)), 1, 16) AS session_id,
  {sql_case('server_name', K.ENTRY_POINT, 'direct')} AS entry_point,
  CASE WHEN risk_score >= 80 THEN 'critical' WHEN risk_score >= 60 THEN 'high' WHEN risk_score >= 40 THEN 'medium' WHEN risk_score >= 20 THEN 'low' ELSE 'none' END AS risk_level,
  CASE WHEN is_sql_injection THEN 'sql_injection' WHEN is_cross_site THEN 'xss' ELSE '' END AS threat,
  CASE WHEN is_internal THEN 'trusted' WHEN {sql_prefix('client_ip', K.SUSPECT_PREFIXES)} THEN 'suspicious' ELSE 'neutral' END AS reputation,
  CASE WHEN sdk_type LIKE 'WST%' THEN 'government_user' WHEN sdk_type <> '' THEN 'registered' ELSE 'guest' END AS user_type,
  CASE WHEN sdk_type LIKE 'WST%' THEN 'verified' WHEN sdk_type <> '' THEN 'standard' ELSE 'free' END AS user_tier
FROM step2"""
_VALUE = f"""
SELECT * EXCLUDE (b0, b1, b2), least(100, greatest(1, CAST(trunc(b2 * CASE WHEN duration_ms < 500 THEN 1.2e0 WHEN duration_ms > 5000 THEN 0.8e0 ELSE 1e0 END) AS INT))) AS value_score
FROM (SELECT *, CAST(trunc(b1 * CASE left(status, 1) WHEN '2' THEN 1.1e0 WHEN '4' THEN 0.7e0 WHEN '5' THEN 0.5e0 ELSE 1e0 END) AS INT) AS b2
FROM (SELECT *, CASE WHEN service IN ('gxrz-rest', 'zww') THEN least(100, b0 + 15) ELSE b0 END AS b1
FROM (SELECT *, CASE WHEN contains(business_domain, 'government') THEN 60 + {sql_map('business_domain', K.DOMAIN_BONUS, 0)}
  ELSE {sql_map('api_group', K.CATEGORY_WEIGHT, 50)} END AS b0 FROM step3)))"""
VIEWS = f"WITH access AS ({ACCESS_SQL}), step1 AS ({_STEP1}), step2 AS ({_STEP2}), step3 AS ({HITS_SQL}), hits AS ({_VALUE})"


def oracle(body: str) -> str:
    """Prefix the request views; ``body`` starts with SELECT or with ``, name AS (...)``."""
    return VIEWS + " " + body.strip()


def pct(column: str, p: float, name: str, where: str = "") -> str:
    tail = f" FILTER (WHERE {where})" if where else ""
    return f"round(quantile_cont({column}, {p}){tail}, 6) AS {name}"


def register(name: str, sql: str | None = None, *, raw: bool = False):
    """Decorator: add a query and, if SQL can say it, its oracle (``raw`` keeps the SQL as is)."""

    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql if raw else oracle(sql)
        return build

    return add
