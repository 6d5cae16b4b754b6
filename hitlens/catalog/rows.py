"""Row-level derivations (E1-E55)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.catalog.base import (
    _IP,
    access,
    hits,
    q,
    register,
    sql_case,
    sql_map,
    sql_prefix,
    table,
)
from hitlens.functions import agent, business, clock, identity, network, quality, referer, security, status, timing, uri
from hitlens.plans.enrich import day_parts

c = F.col


def _cols(df, **cols):
    return df.select("event_id", *[v.alias(k) for k, v in cols.items()])


@register(
    "e01_request_line",
    """SELECT event_id, request_method AS method, replace(request_uri, ' ', '+') AS uri, 'HTTP/1.1' AS protocol FROM access""",
)
def _(spark, sf):
    df = access(spark, sf)
    line = F.concat_ws(" ", "request_method", F.replace("request_uri", F.lit(" "), F.lit("+")), F.lit("HTTP/1.1"))
    m, u, p = uri.request_parts(line)
    return _cols(df, method=m, uri=u, protocol=p)


@register(
    "e02_path_and_query",
    """SELECT event_id, split_part(request_uri, '?', 1) AS path,
    CASE WHEN contains(request_uri, '?') THEN substr(request_uri, instr(request_uri, '?') + 1) ELSE '' END AS query, uri AS trimmed
    FROM hits""",
)
def _(spark, sf):
    u = c("request_uri")
    return _cols(access(spark, sf), path=uri.path(u), query=uri.query(u), trimmed=uri.trimmed_path(u))


@register(
    "e03_uri_grouping",
    """SELECT event_id, regexp_replace(regexp_replace(regexp_replace(split_part(request_uri, '?', 1), '/\\d+', '/{id}', 'g'),
    '/[a-f0-9]{8,}', '/{uuid}', 'g'), '/v\\d+/', '/v{n}/', 'g') AS grouped FROM access""",
)
def _(spark, sf):
    return _cols(access(spark, sf), grouped=uri.grouping_path(c("request_uri")))


@register(
    "e04_query_masking",
    """SELECT event_id, split_part(request_uri, '?', 1) || CASE WHEN contains(request_uri, '?') THEN '?' ||
    array_to_string(list_transform(list_filter(string_split(split_part(request_uri, '?', 2), '&'), lambda x: contains(x, '=')),
      lambda x: split_part(x, '=', 1) || '=***'), '&') ELSE '' END AS masked FROM access""",
)
def _(spark, sf):
    return _cols(access(spark, sf), masked=uri.masked(c("request_uri")))


@register(
    "e05_service_from_path",
    """SELECT event_id, CASE WHEN seg[1] = 'api' AND len(seg) > 1 THEN seg[2] ELSE seg[1] END AS service_of,
    seg[1] AS primary_service, coalesce(seg[2], '') AS secondary_service FROM step1""",
)
def _(spark, sf):
    u = c("request_uri")
    a, b = uri.service_pair(uri.path(u))
    return _cols(access(spark, sf), service_of=uri.service_of(u), primary_service=a, secondary_service=b)


@register(
    "e06_inferred_names",
    """SELECT event_id, CASE WHEN seg[1] IN ('api', 'v1', 'v2') THEN coalesce(seg[2], '') ELSE seg[1] END AS app,
    coalesce(list_filter(seg, lambda x: regexp_matches(x, '(?i)gateway|service|api|rest'))[1], '') AS service FROM step1""",
)
def _(spark, sf):
    u = c("request_uri")
    return _cols(access(spark, sf), app=uri.inferred_application(u), service=uri.inferred_service(u))


@register(
    "e07_uri_structure",
    """SELECT event_id, application, service, module, CAST(depth AS INT) AS path_depth,
    CASE WHEN depth >= 4 AND application NOT IN ('zgt-h5', 'group1') THEN seg[4] ELSE '' END AS endpoint FROM hits""",
)
def _(spark, sf):
    s = uri.structure(c("request_uri"))
    return _cols(access(spark, sf), **{k: s[k] for k in ("application", "service", "module", "path_depth", "endpoint")})


@register(
    "e08_resource_and_types",
    f"""SELECT event_id, is_static, CASE WHEN seg[1] = 'group1' AND len(seg) >= 2 THEN 'file' WHEN is_static
      THEN {sql_case('luri', K.RESOURCE_TYPE, 'other')} ELSE 'unknown' END AS resource_type,
    {sql_case('luri', K.CONTENT_TYPE, 'application/octet-stream')} AS content_type,
    CASE WHEN regexp_matches(request_uri, '(?i)/v(\\d+(?:\\.\\d+)?)') THEN 'v' || regexp_extract(request_uri, '(?i)/v(\\d+(?:\\.\\d+)?)', 1) ELSE '' END AS api_version,
    {sql_map('request_method', K.ENDPOINT_TYPE, 'unknown')} AS endpoint_type,
    {sql_map('request_method', K.TRANSACTION_TYPE, 'unknown')} AS transaction_type FROM step1""",
)
def _(spark, sf):
    s, u, m = uri.structure(c("request_uri")), c("request_uri"), c("request_method")
    return _cols(
        access(spark, sf),
        is_static=s["is_static"],
        resource_type=s["resource_type"],
        content_type=uri.content_type(u),
        api_version=uri.api_version(u),
        endpoint_type=uri.endpoint_type(m),
        transaction_type=uri.transaction_type(m),
    )


@register(
    "e09_api_category",
    f"""SELECT event_id, api_category, api_group, {sql_case('uri', K.PATH_CLASS, 'Page')} AS path_class FROM hits""",
)
def _(spark, sf):
    return _cols(hits(spark, sf), api_category=c("api_category"), api_group=c("api_group"), path_class=uri.path_class(c("uri")))


@register(
    "e10_business_domain",
    """SELECT event_id, business_domain, CASE WHEN is_static THEN 'frontend' WHEN contains(application, 'gateway') THEN 'middleware'
    WHEN contains(application, 'api') THEN 'backend' ELSE 'service' END AS area,
    CASE WHEN is_static THEN 'web' WHEN contains(application, 'gateway') THEN 'api' WHEN contains(service, 'service') THEN 'service' ELSE 'data' END AS tier
    FROM hits""",
)
def _(spark, sf):
    a, s, st = c("application"), c("service"), c("is_static")
    return _cols(
        hits(spark, sf),
        business_domain=c("business_domain"),
        area=business.functional_area(a, st),
        tier=business.service_tier(a, s, st),
    )


@register("e11_operation", f"SELECT event_id, {sql_case('luri', K.OPERATION, 'other')} AS operation FROM step1")
def _(spark, sf):
    return _cols(access(spark, sf), operation=uri.operation(c("request_uri")))


@register("e12_journey_stage", f"SELECT event_id, {sql_case('luri', K.JOURNEY_STAGE, 'active')} AS stage FROM step1")
def _(spark, sf):
    return _cols(access(spark, sf), stage=uri.journey_stage(c("request_uri")))


@register(
    "e13_value_score",
    f""", s1 AS (SELECT *, CASE WHEN contains(business_domain, 'government') THEN 60 + {sql_map('business_domain', K.DOMAIN_BONUS, 0)}
      ELSE {sql_map('api_group', K.CATEGORY_WEIGHT, 50)} END AS b0 FROM hits),
    s2 AS (SELECT *, CASE WHEN service IN ('gxrz-rest', 'zww') THEN least(100, b0 + 15) ELSE b0 END AS b1 FROM s1),
    s3 AS (SELECT *, CAST(trunc(b1 * CASE left(status, 1) WHEN '2' THEN 1.1::DOUBLE WHEN '4' THEN 0.7::DOUBLE WHEN '5' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) AS INT) AS b2 FROM s2),
    s4 AS (SELECT *, CAST(trunc(b2 * CASE WHEN duration_ms < 500 THEN 1.2::DOUBLE WHEN duration_ms > 5000 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END) AS INT) AS b3 FROM s3),
    i AS (SELECT *, CASE WHEN regexp_matches(service, 'gxrz-rest|alipay|payment') THEN 9 WHEN regexp_matches(lower(module), 'user|auth|order') THEN 7
      WHEN is_static THEN 3 ELSE 5 END + CASE WHEN duration_ms <= 100 THEN 1 WHEN duration_ms > 10000 THEN -1 ELSE 0 END AS small FROM s4)
    SELECT event_id, least(100, greatest(1, b3)) AS value_score, least(10, greatest(1, small)) AS small_score FROM i""",
)
def _(spark, sf):
    weight = business.importance(c("service"), c("module"), c("is_static"))
    return _cols(
        hits(spark, sf),
        value_score=business.value_score(c("business_domain"), c("api_group"), c("service"), c("status"), c("duration_ms")),
        small_score=business.small_value_score(weight, c("duration_ms")),
    )


@register(
    "e14_importance",
    """, i AS (SELECT *, CASE WHEN regexp_matches(service, 'gxrz-rest|alipay|payment') THEN 'critical'
      WHEN regexp_matches(lower(module), 'user|auth|order') THEN 'important' WHEN is_static THEN 'optional' ELSE 'normal' END AS importance FROM hits)
    SELECT event_id, importance, CASE importance WHEN 'critical' THEN 'mission_critical' WHEN 'important' THEN 'business_critical'
      WHEN 'normal' THEN 'important' ELSE 'standard' END AS criticality,
    CASE WHEN regexp_matches(service, 'alipay|payment') THEN 'high' WHEN contains(service, 'order') THEN 'medium' ELSE 'low' END AS revenue,
    CASE WHEN is_static THEN 'low' WHEN regexp_matches(service, 'user|auth') THEN 'high' ELSE 'medium' END AS customer FROM i""",
)
def _(spark, sf):
    imp = business.importance(c("service"), c("module"), c("is_static"))
    return _cols(
        hits(spark, sf),
        importance=imp,
        criticality=business.criticality(imp),
        revenue=business.revenue_impact(c("service")),
        customer=business.customer_impact(c("service"), c("is_static")),
    )


@register("e15_platform", f"SELECT event_id, {sql_case('ua', K.PLATFORM, 'Other')} AS platform FROM step1")
def _(spark, sf):
    return _cols(access(spark, sf), platform=agent.platform(c("user_agent")))


@register(
    "e16_versions",
    """SELECT event_id, nullif(CASE platform WHEN 'iOS_SDK' THEN regexp_extract(user_agent, 'zgt-ios/([0-9.]+)', 1)
      WHEN 'iOS' THEN replace(regexp_extract(user_agent, 'iOS ([0-9_.]+)', 1), '_', '.')
      WHEN 'Android' THEN regexp_extract(user_agent, 'Android ([0-9.]+)', 1) END, '') AS platform_version, sdk_type,
    regexp_extract(user_agent, '(?i)WST-SDK-(?:iOS|Android)/([0-9.]+)', 1) AS sdk_version,
    regexp_extract(user_agent, '(?i)zgt-(?:ios|android)[/\\s]?([0-9.]+)', 1) AS app_version FROM hits""",
)
def _(spark, sf):
    a = c("user_agent")
    return _cols(
        hits(spark, sf),
        platform_version=agent.platform_version(a, c("platform")),
        sdk_type=c("sdk_type"),
        sdk_version=agent.sdk_version(a),
        app_version=agent.app_version(a),
    )


@register(
    "e17_browser",
    "SELECT event_id, CASE "
    + " ".join(
        f"WHEN regexp_matches(ua, {q(p)}) THEN " + (f"{q(n + ' ')} || regexp_extract(ua, {q(p)}, 1)" if "(" in p else q(n))
        for n, p in K.BROWSER
    )
    + f" ELSE {q(K.OTHER_BROWSER)} END AS browser FROM step1",
)
def _(spark, sf):
    return _cols(access(spark, sf), browser=agent.browser(c("user_agent")))


@register("e18_operating_system", "SELECT event_id, os FROM hits")
def _(spark, sf):
    return _cols(access(spark, sf), os=agent.operating_system(c("user_agent")))


@register("e19_device", "SELECT event_id, device FROM hits")
def _(spark, sf):
    return _cols(access(spark, sf), device=agent.device(c("user_agent")))


@register("e20_bot", "SELECT event_id, bot_type FROM hits")
def _(spark, sf):
    return _cols(access(spark, sf), bot_type=agent.bot(c("user_agent")))


@register(
    "e21_agent_family",
    f"""SELECT event_id, coalesce({sql_case('ua', K.AGENT_FAMILY, None)}, left(user_agent, 50) ||
    CASE WHEN length(user_agent) > 50 THEN '...' ELSE '' END) AS family FROM step1""",
)
def _(spark, sf):
    return _cols(access(spark, sf), family=agent.family(c("user_agent")))


@register("e22_referer_domain", "SELECT event_id, authority, referer_domain FROM hits")
def _(spark, sf):
    return _cols(access(spark, sf), authority=referer.authority(c("referer")), referer_domain=referer.domain(c("referer")))


@register(
    "e22_page_domain",
    "SELECT page_id, nullif(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '') AS authority FROM pages",
    raw=True,
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", referer.authority(c("url")).alias("authority"))


@register("e23_search_engine", f"SELECT event_id, search_engine, {sql_case('lower(authority)', K.DOMAIN_SEARCH, None)} AS by_domain FROM hits")
def _(spark, sf):
    r = c("referer")
    return _cols(access(spark, sf), search_engine=referer.search_engine(r), by_domain=referer.domain_search(r))


@register(
    "e24_search_keywords",
    """, k AS (SELECT event_id, regexp_extract(referer, '\\?([^#]*)', 1) AS p FROM access)
    SELECT event_id, url_decode(replace(coalesce("""
    + ", ".join(f"nullif(regexp_extract(p, '(?:^|&){n}=([^&]*)', 1), '')" for n in K.SEARCH_PARAMETERS)
    + "), '+', ' ')) AS keywords FROM k",
)
def _(spark, sf):
    return _cols(access(spark, sf), keywords=referer.search_keywords(c("referer")))


@register(
    "e25_social_network",
    f""", s AS (SELECT *, {sql_case('lower(authority)', K.DOMAIN_SOCIAL, None)} AS by_domain FROM hits)
    SELECT event_id, social_network, by_domain, CASE WHEN by_domain IS NOT NULL THEN {sql_map('by_domain', K.SOCIAL_KIND, 'social_network')} END AS kind FROM s""",
)
def _(spark, sf):
    r = c("referer")
    return _cols(
        access(spark, sf),
        social_network=referer.social_network(r),
        by_domain=referer.domain_social(r),
        kind=referer.social_kind(referer.domain_social(r)),
    )


_SRC = f"""SELECT *, {sql_case('lower(authority)', K.DOMAIN_SEARCH, None)} AS se, {sql_case('lower(authority)', K.DOMAIN_SOCIAL, None)} AS so FROM hits"""


@register(
    "e26_entry_source",
    f""", s AS ({_SRC}) SELECT event_id, entry_source, CASE WHEN referer IN ('', '-') THEN 'Direct' WHEN se IS NOT NULL THEN 'Search'
    WHEN so IS NOT NULL THEN 'Social' WHEN contains(lower(authority), 'gov.cn') THEN 'Government' ELSE 'Referral' END AS entry_kind FROM s""",
)
def _(spark, sf):
    r = c("referer")
    return _cols(access(spark, sf), entry_source=referer.entry_source(r), entry_kind=referer.entry_kind(r))


@register(
    "e27_traffic_source",
    f""", s AS ({_SRC}) SELECT event_id, CASE WHEN referer IN ('', '-') THEN 'direct' WHEN se IS NOT NULL THEN 'organic'
    WHEN so IS NOT NULL THEN 'social' WHEN contains(referer, 'utm_') THEN 'paid' ELSE 'referral' END AS source,
    CASE WHEN authority IS NULL THEN 'unknown' WHEN contains(authority, 'gov.cn') THEN 'government' WHEN regexp_matches(authority, 'edu\\.cn|\\.edu') THEN 'education'
    WHEN se IS NOT NULL THEN 'search' WHEN so IS NOT NULL THEN 'social' WHEN regexp_matches(authority, 'news|xinhua|people|cctv') THEN 'news' ELSE 'general' END AS domain_type FROM s""",
)
def _(spark, sf):
    r = c("referer")
    return _cols(access(spark, sf), source=referer.traffic_source(r), domain_type=referer.domain_type(r))


@register(
    "e28_client_classes",
    f"""SELECT event_id, access_type, client_category, client_type, channel,
    CASE WHEN is_internal THEN 'trusted' WHEN is_bot THEN 'unverified' WHEN sdk_type <> '' THEN 'verified' ELSE 'standard' END AS client_class,
    {sql_case('server_name', K.ENTRY_POINT, 'direct')} AS entry_point FROM hits""",
)
def _(spark, sf):
    return _cols(
        hits(spark, sf),
        access_type=c("access_type"),
        client_category=c("client_category"),
        client_type=c("client_type"),
        channel=c("channel"),
        client_class=agent.client_class(c("is_internal"), c("is_bot"), c("sdk_type")),
        entry_point=business.entry_point(c("server_name")),
    )


@register("e29_ip_kind", f"SELECT event_id, ip_kind, {_IP} AS ip_long FROM hits")
def _(spark, sf):
    return _cols(access(spark, sf), ip_kind=network.ip_kind(c("client_ip")), ip_long=network.ipv4_long(c("client_ip")))


@register(
    "e30_ip_reputation",
    f"""SELECT event_id, is_internal, CASE WHEN is_internal THEN 'internal' ELSE 'external' END AS address_class,
    CASE WHEN is_internal THEN 'trusted' WHEN {sql_prefix('client_ip', K.SUSPECT_PREFIXES)} THEN 'suspicious' ELSE 'neutral' END AS reputation,
    {sql_prefix('client_ip', K.TOR_PREFIXES)} AS tor, {sql_prefix('client_ip', K.PROXY_PREFIXES)} AS proxy,
    {sql_prefix('client_ip', K.VPN_PREFIXES)} AS vpn, {sql_prefix('client_ip', K.DATACENTER_PREFIXES)} AS datacenter FROM hits""",
)
def _(spark, sf):
    ip = c("client_ip")
    return _cols(
        access(spark, sf),
        is_internal=network.is_internal(ip),
        address_class=network.address_class(ip),
        reputation=network.reputation(ip),
        tor=network.is_tor(ip),
        proxy=network.is_proxy(ip, ip),
        vpn=network.is_vpn(ip),
        datacenter=network.is_datacenter(ip),
    )


_NETS = ", ".join(
    "({}, {}, {}, {}, {})".format(i, *network._bounds(n), q(isp), q(reg)) for i, (n, isp, reg) in enumerate(K.CARRIER_NETWORKS)
)
_LOCATE = f""", nets(position, lo, hi, isp, region) AS (VALUES {_NETS}),
    m AS (SELECT event_id, arg_min(isp, position) AS isp, arg_min(region, position) AS region FROM access
      JOIN nets ON {_IP} BETWEEN lo AND hi GROUP BY event_id)"""


@register(
    "e31_geo_rules",
    _LOCATE + f""" SELECT h.event_id, CASE WHEN is_internal THEN 'unknown' ELSE {sql_case('client_ip', K.CARRIER_PREFIXES, 'unknown')} END AS carrier,
    CASE WHEN is_internal THEN 'internal' WHEN {sql_case('client_ip', K.CARRIER_PREFIXES, None)} IS NOT NULL THEN 'China' ELSE 'unknown' END AS carrier_region,
    m.isp, m.region, coalesce(m.isp = 'Government Network', false) AS trusted FROM hits h LEFT JOIN m USING (event_id)""",
)
def _(spark, sf):
    isp, region = network.network_carrier(c("client_ip"))
    return _cols(
        access(spark, sf),
        carrier=network.carrier(c("client_ip")),
        carrier_region=network.carrier_region(c("client_ip")),
        isp=isp,
        region=region,
        trusted=network.trusted_network(isp),
    )


@register("j03_ip_range_join", _LOCATE + " SELECT a.event_id, a.client_ip, m.isp, m.region FROM access a LEFT JOIN m USING (event_id)")
def _(spark, sf):
    rows = [(i, *network._bounds(n), isp, reg) for i, (n, isp, reg) in enumerate(K.CARRIER_NETWORKS)]
    ranges = spark.createDataFrame(rows, "position int, lo long, hi long, isp string, region string")
    return network.locate(access(spark, sf).select("event_id", "client_ip"), "client_ip", ranges, ["isp", "region"])


_V6 = ["2001:db8::/32", "2001:db8:3::/48", "fd00::/8", "fd00:0:0:5::/64"]
_ADDRESS = "CASE event_id % 4 WHEN 1 THEN '2001:db8:' || (event_id % 7) || '::' || (event_id % 1000) WHEN 2 THEN '::ffff:' || client_ip WHEN 3 THEN 'FD00:0:0:' || (event_id % 9) || ':1:2:3:4' ELSE client_ip END"


@register(
    "j03_networks",
    _LOCATE
    + f""", w AS (SELECT event_id, arg_min(isp, (hi - lo) * 1000 + position) AS isp FROM access JOIN nets ON {_IP} BETWEEN lo AND hi GROUP BY event_id)
    SELECT a.event_id, {_ADDRESS} AS address,
    CASE event_id % 4 WHEN 1 THEN '{_V6[0]}' WHEN 3 THEN '{_V6[2]}' ELSE m.isp END AS first,
    CASE WHEN event_id % 4 = 1 AND event_id % 7 = 3 THEN '{_V6[1]}' WHEN event_id % 4 = 1 THEN '{_V6[0]}'
      WHEN event_id % 4 = 3 AND event_id % 9 = 5 THEN '{_V6[3]}' WHEN event_id % 4 = 3 THEN '{_V6[2]}' ELSE w.isp END AS longest
    FROM access a LEFT JOIN m USING (event_id) LEFT JOIN w USING (event_id)""",
)
def _(spark, sf):
    """Addresses of both families, and IPv4 written as IPv6, against one list of networks."""
    listed = [(i, cidr, isp) for i, (cidr, isp, _) in enumerate(K.CARRIER_NETWORKS)] + [(100 + i, cidr, cidr) for i, cidr in enumerate(_V6)]
    networks = spark.createDataFrame(listed, "position int, cidr string, isp string")
    rows = access(spark, sf).select("event_id", F.expr(_ADDRESS).alias("address"))
    first = network.locate_networks(rows, "address", networks, ["isp"]).withColumnRenamed("isp", "first")
    return network.locate_networks(first, "address", networks, ["isp"], longest=True).withColumnRenamed("isp", "longest")


@register(
    "e32_tenant",
    """SELECT event_id, environment, tenant, CASE WHEN contains(application, 'gateway') THEN 'gateway' WHEN is_static THEN 'direct' ELSE 'mesh' END AS pattern FROM hits""",
)
def _(spark, sf):
    return _cols(
        hits(spark, sf),
        environment=c("environment"),
        tenant=c("tenant"),
        pattern=business.integration_pattern(c("application"), c("is_static")),
    )


@register(
    "e33_status_classes",
    f"""SELECT event_id, left(status, 1) || 'xx' AS status_class, CASE left(status, 1) WHEN '4' THEN '4xx_client' WHEN '5' THEN '5xx_server' ELSE '' END AS error_group,
    CASE left(status, 1) WHEN '2' THEN 'success' WHEN '3' THEN 'redirection' WHEN '4' THEN 'client_error' ELSE 'server_error' END AS http_class,
    CASE left(status, 1) WHEN '4' THEN 'medium' WHEN '5' THEN 'critical' ELSE 'low' END AS severity,
    {sql_map('status', K.ERROR_CATEGORY, 'other')} AS category,
    CASE WHEN status LIKE '4%' THEN 'client' WHEN status IN ('502', '504') THEN 'gateway' WHEN status LIKE '5%' THEN 'service' ELSE '' END AS source FROM access""",
)
def _(spark, sf):
    s = c("status")
    return _cols(
        access(spark, sf),
        status_class=status.status_class(s),
        error_group=status.error_group(s),
        http_class=status.http_class(s),
        severity=status.severity(s),
        category=status.error_category(s),
        source=status.error_source(s),
    )


@register("e34_injection_flags", "SELECT event_id, is_sql_injection AS sqli, is_cross_site AS xss FROM hits")
def _(spark, sf):
    u = c("request_uri")
    return _cols(access(spark, sf), sqli=security.sql_injection(u), xss=security.cross_site(u))


_T = ", ".join(f"CASE WHEN regexp_matches(t, {q(p)}) THEN {q(n)} END" for n, p, _ in K.THREATS)
_TS = " + ".join(f"CASE WHEN regexp_matches(t, {q(p)}) THEN {s} ELSE 0 END" for _, p, s in K.THREATS)


@register(
    "e35_threats",
    f""", x AS (SELECT event_id, length(user_agent) AS n, lower(split_part(request_uri, '?', 1) || ' ' || CASE WHEN contains(request_uri, '?')
      THEN substr(request_uri, instr(request_uri, '?') + 1) ELSE '' END) AS t FROM access),
    y AS (SELECT event_id, list_filter([{_T}, CASE WHEN n < 10 OR n > 500 THEN 'suspicious_ua' END], lambda v: v IS NOT NULL) AS f,
      {_TS} + CASE WHEN n < 10 OR n > 500 THEN 20 ELSE 0 END AS score FROM x)
    SELECT event_id, f[1] AS category, CAST(len(f) AS INT) AS found, array_to_string(f, '|') AS names, CAST(score AS INT) AS score FROM y""",
)
def _(spark, sf):
    u = c("request_uri")
    df = access(spark, sf).withColumn("t", security.threats(uri.path(u), uri.query(u), c("user_agent")))
    return _cols(
        df,
        category=F.get(F.col("t.type"), F.lit(0)),
        found=F.size("t"),
        names=F.array_join("t.type", "|"),
        score=security.threat_score(c("t")),
    )


@register(
    "e36_risk_score",
    """SELECT event_id, least(100, risk_score) AS score, CASE WHEN risk_score >= 80 THEN 'critical' WHEN risk_score >= 60 THEN 'high'
    WHEN risk_score >= 40 THEN 'medium' WHEN risk_score >= 20 THEN 'low' ELSE 'none' END AS level, risk_score / 100::DOUBLE AS fraud FROM hits""",
)
def _(spark, sf):
    r = c("risk_score")
    return _cols(hits(spark, sf), score=F.least(F.lit(100), r), level=security.risk_level(r), fraud=r / F.lit(100.0))


@register(
    "e37_complexity_trust",
    f"""SELECT event_id, round(least(1.0::DOUBLE, least(length(request_uri) / 200::DOUBLE, 0.3::DOUBLE) + least(length(regexp_replace(request_uri, '[^?]', '', 'g')) * 0.1::DOUBLE, 0.1::DOUBLE)
      + least(length(regexp_replace(request_uri, '[^/]', '', 'g')) * 0.05::DOUBLE, 0.2::DOUBLE) + least(length(user_agent) / 500::DOUBLE, 0.2::DOUBLE)
      + CASE WHEN regexp_matches(ua, 'script|tool|api|client') THEN 0.2::DOUBLE ELSE 0::DOUBLE END), 6) AS complexity,
    round(greatest(0::DOUBLE, least(1::DOUBLE, 0.5::DOUBLE + CASE WHEN regexp_matches(lref, 'google|baidu') THEN 0.2::DOUBLE ELSE 0::DOUBLE END
      + CASE WHEN regexp_matches(ua, 'chrome|firefox|safari|edge') THEN 0.2::DOUBLE ELSE 0::DOUBLE END + CASE WHEN regexp_matches(request_uri, '\\.gov|政府') THEN 0.1::DOUBLE ELSE 0::DOUBLE END
      - CASE WHEN regexp_matches(luri, 'admin|config|\\.env|backup') THEN 0.3::DOUBLE ELSE 0::DOUBLE END - CASE WHEN regexp_matches(ua, 'curl|wget|python|script') THEN 0.2::DOUBLE ELSE 0::DOUBLE END)), 6) AS trust,
    {sql_case('ua', K.AGENT_RISK, 'normal')} AS agent_risk FROM step1""",
)
def _(spark, sf):
    u, a = c("request_uri"), c("user_agent")
    return _cols(
        access(spark, sf),
        complexity=F.round(security.complexity(u, a), 6),
        trust=F.round(security.trust(u, a, c("referer")), 6),
        agent_risk=agent.risk_level(a),
    )


@register(
    "e38_lifecycle",
    """, s AS (SELECT event_id, duration_ms / 1000::DOUBLE AS t, connect_ms / 1000::DOUBLE AS a, header_ms / 1000::DOUBLE AS h, response_ms / 1000::DOUBLE AS r,
      body_bytes / 1024::DOUBLE AS b, sent_bytes / 1024::DOUBLE AS z FROM access),
    p AS (SELECT *, greatest(0::DOUBLE, h - a) AS pr, greatest(0::DOUBLE, r - h) AS bt, greatest(0::DOUBLE, t - r) AS ft FROM s),
    n AS (SELECT *, a + ft AS nw, bt + ft AS tr FROM p)
    SELECT event_id, round(a, 6) AS backend_connect_phase, round(pr, 6) AS backend_process_phase, round(bt, 6) AS backend_transfer_phase,
    round(ft, 6) AS front_transfer_phase, round(nw, 6) AS network_phase, round(tr, 6) AS transfer_phase,
    CASE WHEN r > 0 THEN pr / r * 100 ELSE 0 END AS eff, CASE WHEN t > 0 THEN nw / t * 100 ELSE 0 END AS overhead,
    CASE WHEN bt > 0 THEN b / bt ELSE 0 END AS response_speed, CASE WHEN a > 0 THEN pr / a * 100 ELSE 1 END AS idx FROM n""",
)
def _(spark, sf):
    cols = timing.lifecycle(*[c(n) for n in ("duration_ms", "connect_ms", "header_ms", "response_ms", "body_bytes", "sent_bytes")])
    s = {k: c(k) / F.lit(1000.0) for k in ("duration_ms", "connect_ms", "header_ms", "response_ms")}
    process = F.greatest(F.lit(0.0), s["header_ms"] - s["connect_ms"])
    back = F.greatest(F.lit(0.0), s["response_ms"] - s["header_ms"])
    front = F.greatest(F.lit(0.0), s["duration_ms"] - s["response_ms"])
    keep = ["backend_connect_phase", "backend_process_phase", "backend_transfer_phase", "front_transfer_phase", "network_phase", "transfer_phase"]
    return _cols(
        access(spark, sf),
        **{k: cols[k] for k in keep},
        eff=timing.percent(process, s["response_ms"]),
        overhead=timing.percent(s["connect_ms"] + front, s["duration_ms"]),
        response_speed=timing.over(c("body_bytes") / F.lit(1024.0), back),
        idx=timing.percent(process, s["connect_ms"], 1.0),
    )


@register(
    "e39_estimated_phases",
    """, e AS (SELECT event_id, duration_ms, CAST(trunc(duration_ms * 0.7::DOUBLE) AS BIGINT) AS r, CAST(trunc(duration_ms * 0.05::DOUBLE) AS BIGINT) AS k,
      CAST(trunc(duration_ms * 0.15::DOUBLE) AS BIGINT) AS h, CAST(trunc(duration_ms * CASE WHEN is_static THEN 0.1::DOUBLE WHEN contains(application, 'gateway') AND contains(module, 'auth') THEN 0.85::DOUBLE
      WHEN contains(application, 'gateway') THEN 0.75::DOUBLE WHEN cache_status = 'HIT' THEN 0.0::DOUBLE ELSE 0.7::DOUBLE END) AS BIGINT) AS by_resource FROM hits)
    SELECT event_id, r AS est_response_ms, k AS est_connect_ms, h AS est_header_ms, h - k AS est_process_ms, r - h AS est_transfer_ms,
    duration_ms - r AS est_front_ms, CAST(trunc(duration_ms * 0.2::DOUBLE) AS BIGINT) AS est_network_ms, by_resource FROM e""",
)
def _(spark, sf):
    ms = c("duration_ms")
    other = timing.estimated_phases_by_resource(ms, c("is_static"), c("application"), c("module"), c("cache_status"))
    return _cols(hits(spark, sf), **timing.estimated_phases(ms), by_resource=other["est_response_ms"])


@register(
    "e40_performance",
    """SELECT event_id, performance_level AS level, ['A','B','C','D','F','F'][performance_level] AS rating,
    ['Excellent','Good','Fair','Poor','Unacceptable','Timeout'][performance_level] AS experience,
    duration_ms > 500 AS perf_attention, duration_ms > 1000 AS perf_warning, duration_ms > 3000 AS perf_slow, duration_ms > 10000 AS perf_very_slow, duration_ms > 30000 AS perf_timeout,
    CASE WHEN duration_ms <= 0 THEN 100::DOUBLE WHEN duration_ms <= 100 THEN 95 WHEN duration_ms <= 500 THEN 85 WHEN duration_ms <= 1000 THEN 70 WHEN duration_ms <= 3000 THEN 50
      WHEN duration_ms <= 10000 THEN 30 ELSE 10 END AS score,
    CASE WHEN duration_ms <= 500 THEN 'Satisfied' WHEN duration_ms <= 2000 THEN 'Tolerating' ELSE 'Frustrated' END AS apdex FROM hits""",
)
def _(spark, sf):
    ms = c("duration_ms")
    return _cols(
        access(spark, sf),
        level=timing.performance_level(ms),
        rating=timing.performance_rating(ms),
        experience=timing.experience_level(ms),
        **timing.performance_flags(ms),
        score=timing.performance_score(ms),
        apdex=timing.apdex_class(ms),
    )


@register(
    "e41_transfer",
    """SELECT event_id, round(CASE WHEN duration_ms > 0 AND body_bytes > 0 THEN (body_bytes / 1024::DOUBLE) / (duration_ms / 1000::DOUBLE) ELSE 0 END, 6) AS transfer_speed,
    round(CASE WHEN duration_ms > 0 THEN (1::DOUBLE - response_ms / duration_ms::DOUBLE) * 100 ELSE 100 END, 6) AS front_efficiency,
    round(CASE WHEN duration_ms > 0 THEN network_ms / duration_ms::DOUBLE * 100 ELSE 0 END, 6) AS network_share,
    round(CASE WHEN duration_ms > 0 THEN transfer_ms / duration_ms::DOUBLE * 100 ELSE 0 END, 6) AS transfer_share,
    round(CASE WHEN duration_ms > 0 THEN connect_ms / duration_ms::DOUBLE * 100 ELSE 0 END, 6) AS connect_share FROM hits""",
)
def _(spark, sf):
    cols = timing.transfer_metrics(*[c(n) for n in ("duration_ms", "body_bytes", "response_ms", "network_ms", "transfer_ms", "connect_ms")])
    return _cols(hits(spark, sf), **{k: F.round(v, 6) for k, v in cols.items()})


@register("e42_cache_status", "SELECT event_id, cache_status FROM hits")
def _(spark, sf):
    return _cols(access(spark, sf), cache_status=timing.cache_status(c("duration_ms")))


@register(
    "e43_outcome_flags",
    """SELECT event_id, is_success, is_business_success, NOT is_success AS is_error, status LIKE '4%' AS is_client_error, status LIKE '5%' AS is_server_error,
    CAST(status AS INT) BETWEEN 200 AND 399 AS below_400, status = '200' AS only_200, is_error AS error_4xx_5xx FROM hits""",
)
def _(spark, sf):
    s = c("status")
    return _cols(
        access(spark, sf),
        **status.outcome_flags(s, c("body_bytes")),
        below_400=status.success(s, "below_400"),
        only_200=status.success(s, "200"),
        error_4xx_5xx=status.error(s),
    )


@register(
    "e44_anomalies",
    """SELECT event_id, anomaly_type, CASE WHEN duration_ms > 30000 THEN 'timeout' WHEN body_bytes > 10485760 THEN 'large_response'
      WHEN NOT is_success AND duration_ms > 10000 THEN 'error_response' ELSE '' END AS kind,
    CASE WHEN duration_ms > 60000 THEN 'extreme_slow_response' WHEN status IN ('500', '502', '503', '504') THEN 'server_error' END AS reason,
    array_to_string(list_filter([CASE WHEN duration_ms > 30000 THEN '超长响应时间' WHEN duration_ms > 10000 THEN '异常响应时间' END,
      CASE WHEN body_bytes > 52428800 THEN '超大响应体' WHEN body_bytes > 10485760 THEN '大响应体' END,
      CASE WHEN status LIKE '5%' THEN '服务器错误' WHEN status IN ('404', '403') THEN '资源访问异常' WHEN status = '429' THEN '频率限制' END], lambda v: v IS NOT NULL), ',') AS listed FROM hits""",
)
def _(spark, sf):
    s, ms, b = c("status"), c("duration_ms"), c("body_bytes")
    return _cols(
        access(spark, sf),
        anomaly_type=status.anomaly_type(s, ms, b),
        kind=status.anomaly_kind(s, ms, b),
        reason=status.anomaly_reason(s, ms, c("user_agent"), c("client_ip")),
        listed=F.array_join(status.anomaly_list(s, ms, b), ","),
    )


@register(
    "e45_sla",
    """SELECT event_id, NOT is_slow AND is_success AS compliant, CASE WHEN is_slow THEN 'performance' WHEN NOT is_success THEN 'availability' ELSE '' END AS violation FROM hits""",
)
def _(spark, sf):
    v = status.sla_violation(c("status"), c("duration_ms"))
    return _cols(access(spark, sf), compliant=v == "", violation=v)


@register(
    "e46_quality_score",
    """SELECT event_id, ((CASE WHEN client_ip <> '' THEN 1 ELSE 0 END + CASE WHEN request_uri <> '' THEN 1 ELSE 0 END + CASE WHEN status <> '' THEN 1 ELSE 0 END + CASE WHEN duration_ms <> 0 THEN 1 ELSE 0 END
      + CASE WHEN body_bytes <> 0 THEN 1 ELSE 0 END + CASE WHEN referer <> '' THEN 1 ELSE 0 END) / 6::DOUBLE) AS completeness,
    100::DOUBLE - CASE WHEN referer = '' THEN 10 ELSE 0 END AS deducted, CASE WHEN referer = '' THEN 8 ELSE 10 END / 10::DOUBLE AS unit,
    100 - 20 * CASE WHEN referer = '' THEN 1 ELSE 0 END AS issue_score FROM access""",
)
def _(spark, sf):
    df = access(spark, sf)
    names = ["client_ip", "request_uri", "status", "duration_ms", "body_bytes", "referer"]
    need = [c("log_time"), c("client_ip"), c("request_uri"), c("referer")]
    found = quality.issues({n: c(n) for n in ("client_ip", "request_uri", "referer")}, c("duration_ms"), c("body_bytes"))
    return _cols(
        df,
        completeness=quality.completeness(df.schema, names),
        deducted=quality.deduction_score(need, c("duration_ms"), c("body_bytes")),
        unit=quality.unit_score(need, c("duration_ms") / F.lit(1000.0), c("status")),
        issue_score=quality.issue_score(found),
    )


@register(
    "e47_time_parts",
    """SELECT event_id, CAST(log_time AS DATE) AS date, hour, CAST(minute(log_time) AS INT) AS minute, CAST(second(log_time) AS INT) AS second, CAST(quarter(log_time) AS INT) AS quarter,
    CAST(weekofyear(log_time) AS INT) AS week, CAST(dayofyear(log_time) AS INT) AS day_of_year, weekday, weekday >= 6 AS is_weekend,
    strftime(log_time, '%Y-%m-%d %H') AS date_hour, strftime(log_time, '%Y-%m-%d %H:%M') AS date_hour_minute FROM hits""",
)
def _(spark, sf):
    return _cols(access(spark, sf), **clock.parts(c("log_time")))


@register(
    "e48_day_classes",
    """SELECT event_id, CASE WHEN hour < 6 THEN 'Dawn' WHEN hour < 9 THEN 'EarlyMorning' WHEN hour < 12 THEN 'Morning' WHEN hour < 14 THEN 'Noon' WHEN hour < 17 THEN 'Afternoon'
      WHEN hour < 19 THEN 'EarlyEvening' WHEN hour < 22 THEN 'Evening' ELSE 'Night' END AS period,
    CASE WHEN weekday <= 5 AND hour >= 9 AND hour <= 17 THEN 'business_hours' WHEN weekday <= 5 AND (hour >= 7 AND hour < 9 OR hour > 17 AND hour <= 20) THEN 'extended_hours'
      WHEN weekday > 5 AND hour >= 10 AND hour <= 18 THEN 'weekend_hours' ELSE 'off_hours' END AS business_hours,
    CASE WHEN weekday <= 5 AND (hour >= 9 AND hour <= 11 OR hour >= 14 AND hour <= 16) THEN 'peak' WHEN weekday <= 5 AND hour >= 8 AND hour <= 18 THEN 'normal' ELSE 'off_peak' END AS pattern,
    CASE WHEN hour < 6 THEN '深夜/凌晨' WHEN hour < 9 THEN '早高峰' WHEN hour < 12 THEN '上午业务' WHEN hour < 14 THEN '午休时段' WHEN hour < 18 THEN '下午业务' WHEN hour < 21 THEN '晚高峰' ELSE '夜间活跃' END AS business_period
    FROM hits""",
)
def _(spark, sf):
    df = day_parts(access(spark, sf))
    return _cols(
        df,
        period=c("day_period"),
        business_hours=c("business_hours_type"),
        pattern=c("traffic_pattern"),
        business_period=clock.business_period(c("hour")),
    )


@register("e49_arrival", "SELECT event_id, log_time - to_milliseconds(duration_ms) AS arrived FROM access")
def _(spark, sf):
    return _cols(access(spark, sf), arrived=clock.arrival(c("log_time"), c("duration_ms")))


@register(
    "e50_sessions",
    """SELECT event_id, fingerprint, session_id, CASE WHEN sdk_type LIKE 'WST%' THEN 'government_user' WHEN sdk_type <> '' THEN 'registered' ELSE 'guest' END AS user_type,
    CASE WHEN sdk_type LIKE 'WST%' THEN 'verified' WHEN sdk_type <> '' THEN 'standard' ELSE 'free' END AS user_tier FROM hits""",
)
def _(spark, sf):
    kind, tier = identity.user_kind(c("sdk_type"))
    return _cols(hits(spark, sf), fingerprint=c("fingerprint"), session_id=c("session_id"), user_type=kind, user_tier=tier)


@register(
    "e51_row_id",
    """, t AS (SELECT *, strftime(log_time, '%Y-%m-%d %H:%M:%S') AS s FROM access) SELECT event_id, CAST('0x' || substr(md5(s || request_uri), 1, 15) AS BIGINT) AS row_id,
    substr(md5(s || '-' || client_ip), 1, 16) AS trace_id FROM t""",
)
def _(spark, sf):
    t = F.date_format("log_time", "yyyy-MM-dd HH:mm:ss")
    return _cols(access(spark, sf), row_id=identity.row_id(t, c("request_uri")), trace_id=identity.trace_id(t, c("client_ip")))


@register(
    "e54_ip_risk_label",
    """, s AS (SELECT event_id, is_internal, CASE WHEN is_bot THEN 30 ELSE 0 END + CASE WHEN event_id % 150 > 100 THEN 40 ELSE 0 END + CASE WHEN is_error THEN 20 ELSE 0 END AS r FROM hits),
    z AS (SELECT event_id, CASE WHEN is_internal THEN greatest(0, r - 20) ELSE r END AS r FROM s)
    SELECT event_id, CASE WHEN r >= 70 THEN 'High' WHEN r >= 40 THEN 'Medium' ELSE 'Low' END AS risk FROM z""",
)
def _(spark, sf):
    return _cols(hits(spark, sf), risk=network.risk_label(c("is_bot"), c("event_id") % 150, c("is_error"), c("is_internal")))


@register(
    "e55_phase_shares",
    """SELECT event_id, round(CASE WHEN connect_ms + process_ms + backend_transfer_ms + front_ms > 0 THEN connect_ms::DOUBLE / (connect_ms + process_ms + backend_transfer_ms + front_ms) * 100 ELSE 0 END, 6) AS connect_ms,
    round(CASE WHEN connect_ms + process_ms + backend_transfer_ms + front_ms > 0 THEN front_ms::DOUBLE / (connect_ms + process_ms + backend_transfer_ms + front_ms) * 100 ELSE 0 END, 6) AS front_ms FROM hits""",
)
def _(spark, sf):
    parts = timing.shares({n: c(n) for n in ("connect_ms", "process_ms", "backend_transfer_ms", "front_ms")})
    return _cols(hits(spark, sf), connect_ms=F.round(parts["connect_ms"], 6), front_ms=F.round(parts["front_ms"], 6))
