"""Second rule schemes of the row derivations, and round trips through written tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.catalog.base import access, hits, q, register, scratch, sql_case, sql_prefix, table
from hitlens.functions import agent, network, referer, status, timing, uri
from hitlens.rules import first_match
from hitlens.sources import files, lines, sinks

c = F.col


def _cols(df, **cols):
    return df.select("event_id", *[v.alias(k) for k, v in cols.items()])


@register(
    "e15_compact_agent",
    f"""SELECT event_id, {sql_case('ua', K.COMPACT_PLATFORM, 'Other')} AS platform, {sql_case('ua', K.COMPACT_DEVICE, 'Desktop')} AS device,
    CASE WHEN contains(ua, 'chrome') AND NOT contains(ua, 'edg') THEN 'Chrome' WHEN contains(ua, 'firefox') THEN 'Firefox' WHEN contains(ua, 'safari') AND NOT contains(ua, 'chrome') THEN 'Safari'
      WHEN contains(ua, 'edg') THEN 'Edge' WHEN contains(ua, 'opera') THEN 'Opera' ELSE 'Other' END AS browser,
    {sql_case('ua', K.COMPACT_SYSTEM, 'Other')} AS system, {sql_case('ua', K.COMPACT_BOT, '')} AS bot_kind,
    replace(coalesce(nullif(regexp_extract(user_agent, 'OS (\\d+[_\\.]\\d+)', 1), ''), nullif(regexp_extract(user_agent, 'Android (\\d+\\.\\d+)', 1), ''), nullif(regexp_extract(user_agent, 'Chrome/(\\d+\\.\\d+)', 1), ''), ''), '_', '.') AS version
    FROM step1""",
)
def _(spark, sf):
    return _cols(access(spark, sf), **agent.compact(c("user_agent")))


@register(
    "e26_compact_referer",
    f"""SELECT event_id, CASE WHEN referer IN ('', '-') AND {sql_case('ua', K.COMPACT_BOT, None)} IS NOT NULL THEN 'Bot' WHEN referer IN ('', '-') THEN 'Direct' ELSE {sql_case('lref', K.COMPACT_ENTRY, 'External')} END AS entry,
    {sql_case('lref', K.COMPACT_SEARCH, '')} AS engine, {sql_case('lref', K.COMPACT_SOCIAL, '')} AS network FROM step1""",
)
def _(spark, sf):
    return _cols(access(spark, sf), **referer.compact(c("referer"), c("user_agent")))


@register(
    "e09_other_categories",
    f"""SELECT event_id, {sql_case('luri', K.COMPACT_CATEGORY, 'Other')} AS compact_category, """
    + ", ".join(
        "CASE " + " ".join(f"WHEN contains(luri, {q(row[0])}) THEN {q(row[i])}" for row in K.KEYWORD_CATEGORY) + f" ELSE {q(other)} END AS {name}"
        for i, name, other in ((1, "category", "general"), (2, "module", "unknown"), (3, "importance", "Medium"))
    )
    + " FROM step1",
)
def _(spark, sf):
    u = c("request_uri")
    return _cols(access(spark, sf), compact_category=first_match(F.lower(u), K.COMPACT_CATEGORY, "Other"), **uri.keyword_class(u))


def _prefix_case(rules) -> str:
    return "CASE " + " ".join(f"WHEN {sql_prefix('client_ip', p)} THEN {q(label)}" for label, p in rules.items()) + " ELSE 'Other' END"


@register(
    "e31_prefix_regions",
    f"SELECT event_id, {_prefix_case(K.REGION_PREFIXES)} AS region, {_prefix_case(K.ISP_PREFIXES)} AS isp, {_prefix_case(K.CARRIER_RANGES)} AS carrier FROM access",
)
def _(spark, sf):
    ip = c("client_ip")
    return _cols(
        access(spark, sf),
        region=network.by_prefix(ip, K.REGION_PREFIXES),
        isp=network.by_prefix(ip, K.ISP_PREFIXES),
        carrier=network.by_prefix(ip, K.CARRIER_RANGES),
    )


@register(
    "e37_request_features",
    """, x AS (SELECT *, CASE WHEN contains(request_uri, '?') THEN substr(request_uri, instr(request_uri, '?') + 1) ELSE '' END AS qs FROM access)
    SELECT event_id, CAST(length(request_uri) AS INT) AS uri_length, contains(request_uri, '?') AS has_query,
    CAST(len(list_distinct(list_transform(list_filter(string_split(qs, '&'), lambda p: regexp_matches(p, '^[^=]+=.+')), lambda p: split_part(p, '=', 1)))) AS INT) AS query_count,
    CAST(length(regexp_replace(request_uri, '[^/]', '', 'g')) AS INT) AS slashes, regexp_matches(split_part(request_uri, '?', 1), '\\.([a-zA-Z0-9]+)$') AS has_extension,
    regexp_extract(split_part(request_uri, '?', 1), '\\.([a-zA-Z0-9]+)$', 1) AS extension FROM x""",
)
def _(spark, sf):
    return _cols(access(spark, sf), **uri.features(c("request_uri")))


@register(
    "e40_coarse_experience",
    """SELECT event_id, CASE WHEN duration_ms <= 100 THEN 'Excellent' WHEN duration_ms <= 1000 THEN 'Good' WHEN duration_ms <= 3000 THEN 'Fair' WHEN duration_ms <= 10000 THEN 'Poor' ELSE 'Unacceptable' END AS experience,
    CASE WHEN duration_ms <= 1000 THEN 'Satisfied' WHEN duration_ms <= 3000 THEN 'Tolerating' ELSE 'Frustrated' END AS apdex FROM access""",
)
def _(spark, sf):
    experience, apdex = timing.coarse_experience(c("duration_ms"))
    return _cols(access(spark, sf), experience=experience, apdex=apdex)


@register(
    "e44_anomaly_codes",
    """SELECT event_id, array_to_string(list_filter([CASE WHEN duration_ms > 5000 THEN 'slow_response' END, CASE WHEN length(request_uri) > 40 THEN 'suspicious_uri_length' END, CASE WHEN status >= '500' THEN 'server_error' END], lambda v: v IS NOT NULL), ',') AS codes FROM access""",
)
def _(spark, sf):
    found = status.anomaly_codes(c("status"), c("duration_ms"), c("request_uri"), long_uri=40)
    return _cols(access(spark, sf), codes=F.array_join(found, ","))


# ---------------------------------------------------------------- round trips


@register("s07_staged_csv", "SELECT date_trunc('second', log_time) AS log_time, client_ip, status, body_bytes, user_agent FROM access")
def _(spark, sf):
    folder = scratch(spark, "csv")
    staged = access(spark, sf).select(
        F.date_format("log_time", "yyyy-MM-dd HH:mm:ss").alias("raw_time"),
        c("client_ip").alias("client_ip_address"),
        c("status").alias("response_status_code"),
        c("body_bytes").alias("response_body_size"),
        c("user_agent").alias("user_agent_string"),
    )
    sinks.write_csv(staged, f"{folder}/staged")
    return files.read_staged_csv(spark, f"{folder}/staged").select("log_time", "client_ip", "status", "body_bytes", "user_agent")


@register(
    "s11_folder_scan",
    "SELECT event_id, status, request_method FROM access",
)
def _(spark, sf):
    folder = scratch(spark, "logs")
    raw = lines.as_pairs(access(spark, sf)).select(
        F.concat(c("value"), F.lit(' id:"'), c("event_id").cast("string"), F.lit('"')).alias("value"), c("status").alias("family")
    )
    raw.write.partitionBy("family").option("compression", "gzip").text(f"{folder}/tree")
    read = files.read_lines(spark, f"{folder}/tree", glob="*.gz")
    tagged = read.select("value", lines.pair_value(lines.padded(c("value")), ["id"]).cast("long").alias("event_id"))
    return lines.accepted(lines.parse_pairs(tagged)).select("event_id", "status", "request_method")


@register(
    "s15_partitioned_table",
    "SELECT tenant, environment, count(*) AS requests, min(log_time) AS first_time FROM hits WHERE CAST(log_time AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY 1, 2",
)
def _(spark, sf):
    folder = scratch(spark, "table")
    columns = ["event_id", "log_time", "tenant", "environment", "uri", "status", "duration_ms"]
    sinks.write_table(hits(spark, sf).select(*columns), f"{folder}/enriched", mode="overwrite")
    back = spark.read.parquet(f"{folder}/enriched").filter("date BETWEEN '2024-01-10' AND '2024-01-12'")
    return back.groupBy("tenant", "environment").agg(F.count(F.lit(1)).alias("requests"), F.min("log_time").alias("first_time"))


@register("s19_metric_table", "SELECT event_type AS metric, count(*) AS samples, max(value) AS peak FROM events GROUP BY 1", raw=True)
def _(spark, sf):
    folder = scratch(spark, "metrics")
    rows = table(spark, sf, "events").select(
        c("event_type").alias("metric"), F.lit("c").alias("cluster"), F.lit("i").alias("instance"), c("ts").cast("timestamp").alias("ts"), "value"
    )
    rows.write.parquet(f"{folder}/samples")
    return files.read_metrics(spark, f"{folder}/samples").groupBy("metric").agg(F.count(F.lit(1)).alias("samples"), F.max("value").alias("peak"))
