"""Sources and parsers (S1-S20), manifest join, streaming (X1-X10) with oracles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from hitlens.catalog.base import access, enrich, hits, parts, register, requests_from, scratch, table
from hitlens.operators import measures, ranking
from hitlens.plans import quality
from hitlens.schema import coerce
from hitlens.sources import files, lines, sinks
from hitlens.streaming import jobs, state

c = F.col
SEC = "date_trunc('second', log_time)"
URI = "replace(request_uri, ' ', '+')"


def _nul(col: str) -> str:
    return f"CASE WHEN {col} IN ('-', '') THEN NULL ELSE {col} END"


@register(
    "s01_json_lines",
    f"""SELECT event_id, {SEC} AS log_time, client_ip, request_method, request_uri, status, duration_ms, connect_ms, header_ms, response_ms, body_bytes, sent_bytes, user_agent, referer, server_name, upstream_addr FROM access""",
)
def _(spark, sf):
    raw = lines.as_json(access(spark, sf)).select("event_id", "value")
    return lines.parse_json(raw).drop("protocol", "upstream_cache", "trace_id", "connection_requests")


@register(
    "s02_pair_lines",
    f"""SELECT event_id, {SEC} AS log_time, client_ip, request_method, {URI} AS request_uri, 'HTTP/1.1' AS protocol, status, duration_ms, 0::BIGINT AS connect_ms, duration_ms AS response_ms, body_bytes, body_bytes + 200 AS sent_bytes,
    {_nul('user_agent')} AS user_agent, {_nul('referer')} AS referer, server_name FROM access""",
)
def _(spark, sf):
    raw = lines.as_pairs(access(spark, sf)).select("event_id", "value")
    return lines.accepted(lines.parse_pairs(raw)).drop("parsing_errors", "remote_addr", "header_ms", "upstream_addr")


@register(
    "s03_combined_lines",
    f"SELECT event_id, {SEC} AS log_time, client_ip, request_method, {URI} AS request_uri, 'HTTP/1.1' AS protocol, status, body_bytes, user_agent, referer FROM access",
)
def _(spark, sf):
    raw = lines.as_combined(access(spark, sf)).select("event_id", "value")
    out = lines.parse_combined(raw)
    return out.select("event_id", "log_time", "client_ip", "request_method", "request_uri", "protocol", "status", "body_bytes", "user_agent", "referer")


def _spoilt(spark, sf):
    """JSON lines, three in ten of them broken off or no JSON at all."""
    raw = lines.as_json(access(spark, sf))
    i = c("event_id") % 10
    line = F.when(i == 0, F.lit("{broken")).when(i == 1, F.substr("value", F.lit(1), F.lit(40))).when(i == 2, F.lit("noise"))
    return raw.select("event_id", line.otherwise(c("value")).alias("value"))


@register("s01_broken_lines", "SELECT event_id, event_id % 10 > 2 AS kept FROM access")
def _(spark, sf):
    raw = _spoilt(spark, sf)
    good = lines.parse_json(raw).filter(c("status").isNotNull() & c("log_time").isNotNull())
    return ranking.stack_up([part.select("event_id", F.lit(kept).alias("kept")) for part, kept in ((good, True), (lines.broken(raw, "json"), False))])


@register(
    "q05_json_statistics",
    "SELECT count(*) AS total, count(*) FILTER (WHERE event_id % 10 > 2) AS parsed, count(*) FILTER (WHERE event_id % 10 <= 2) AS errors, 0::BIGINT AS empty, count(*) FILTER (WHERE event_id % 10 > 2)::DOUBLE / count(*) AS success_rate FROM access",
)
def _(spark, sf):
    return lines.parse_statistics(_spoilt(spark, sf), "json")


@register("s03_extended_lines", "SELECT event_id, status, body_bytes, referer, user_agent FROM access")
def _(spark, sf):
    raw = lines.as_combined(access(spark, sf))
    more = F.when(c("event_id") % 3 == 0, F.lit(' "203.0.113.7"')).when(c("event_id") % 3 == 1, F.lit(' "-" 0.125 "x y"')).otherwise(F.lit(""))
    return lines.parse_combined(raw.select("event_id", F.concat("value", more).alias("value"))).select("event_id", "status", "body_bytes", "referer", "user_agent")


@register(
    "s04_cdn_lines",
    f"""SELECT event_id, {SEC} AS log_time, client_ip, '-' AS proxy_ip, duration_ms, referer, request_method, 'https://' || server_name || {URI} AS url, split_part({URI}, '?', 1) AS uri, status, 512::BIGINT AS request_bytes,
    body_bytes, 'HIT' AS cache_status, user_agent, 'text/html' AS content_type, '198.51.100.4' AS end_ip FROM access""",
)
def _(spark, sf):
    return lines.parse_cdn(lines.as_cdn(access(spark, sf)).select("event_id", "value"))


@register("s05_pair_map", "SELECT event_id, server_name AS host, client_ip AS ip, status AS code, CAST(body_bytes AS VARCHAR) AS body, 10 AS n FROM access")
def _(spark, sf):
    m = lines.pairs_map(c("value"))
    raw = lines.as_pairs(access(spark, sf)).select("event_id", "value").withColumn("m", m)
    return raw.select(
        "event_id", c("m")["http_host"].alias("host"), c("m")["RealIp"].alias("ip"), c("m")["code"].alias("code"),
        c("m")["body"].alias("body"), F.size("m").alias("n"),
    )


_FMT = "CASE event_id % 3 WHEN 0 THEN 'json' WHEN 1 THEN 'pairs' END"


def _mixed(spark, sf):
    df = lines.as_pairs(lines.as_json(access(spark, sf)).withColumnRenamed("value", "j"))
    value = F.when(c("event_id") % 3 == 0, c("j")).when(c("event_id") % 3 == 1, c("value")).otherwise(F.lit("noise"))
    return df.select("event_id", "client_ip", value.alias("value"))


@register("s06_line_format", f"SELECT event_id, {_FMT} AS format FROM access")
def _(spark, sf):
    return _mixed(spark, sf).select("event_id", lines.line_format(c("value")).alias("format"))


@register(
    "s06_file_format",
    f""", n AS (SELECT client_ip, event_id, {_FMT} AS f, row_number() OVER (PARTITION BY client_ip ORDER BY event_id) AS line_no FROM access)
    SELECT client_ip AS source_file, coalesce(arg_min(f, line_no) FILTER (WHERE f IS NOT NULL), 'json') AS format FROM n WHERE line_no <= 5 GROUP BY 1""",
)
def _(spark, sf):
    df = _mixed(spark, sf).withColumnRenamed("client_ip", "source_file")
    head = ranking.top_per_group(df, ["source_file"], [F.asc("event_id")], 5, "line_no")
    return lines.file_formats(head)


@register("s06_files", "SELECT DISTINCT ['json', 'pairs', 'combined', 'cdn'][event_id % 4 + 1] AS written, ['json', 'pairs', 'combined', 'cdn'][event_id % 4 + 1] AS format, true AS all_files FROM access")
def _(spark, sf):
    """Files of all four formats, told apart by their first lines; one row per file, counted per format."""
    folder = scratch(spark, "formats")
    rows = access(spark, sf)
    makers = [("json", lines.as_json), ("pairs", lines.as_pairs), ("combined", lines.as_combined), ("cdn", lines.as_cdn)]
    for k, (form, make) in enumerate(makers):
        make(rows.filter(c("event_id") % 4 == k)).select(F.lit(form).alias("written"), "value").write.mode("append").partitionBy("written").text(folder)
    found = lines.file_formats(files.first_lines(files.read_lines(spark, folder)), every=True)
    found = found.withColumn("written", F.regexp_extract("source_file", "written=([^/]*)", 1))
    listed = files.list_files(spark, folder, glob="*.txt").groupBy(F.regexp_extract("file", "written=([^/]*)", 1).alias("of")).agg(F.count(F.lit(1)).alias("files"))
    counted = found.groupBy("written", "format").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(listed, c("written") == c("of")).select("written", "format", (c("n") == c("files")).alias("all_files"))


@register("s08_archive_date", "SELECT event_id, CAST(log_time AS DATE) - 1 AS log_date FROM access")
def _(spark, sf):
    name = F.concat(F.date_format("log_time", "yyyyMMdd"), F.lit("093000.zip"))
    return access(spark, sf).select("event_id", files.archive_log_date(name).alias("log_date"))


@register(
    "s10_application_from_file",
    "SELECT event_id, CASE event_id % 3 WHEN 0 THEN request_method || '_' || status WHEN 1 THEN request_method ELSE 'app' END AS application FROM access",
)
def _(spark, sf):
    name = (
        F.when(c("event_id") % 3 == 0, F.concat_ws("_", "request_method", "status", F.lit("20240101.log")))
        .when(c("event_id") % 3 == 1, F.concat_ws("_", "request_method", F.lit("20240101"), F.lit("1")))
        .otherwise(F.lit("app.log.gz"))
    )
    return access(spark, sf).select("event_id", files.application_from_file(name).alias("application"))


def _broken(spark, sf):
    """key:value lines, some without a key field, with a bad time or a bad code, some blank."""
    raw = lines.as_pairs(access(spark, sf))
    i = c("event_id") % 20
    line = (
        F.when(i == 0, F.regexp_replace("value", ' code:"[^"]*"', ""))
        .when(i == 1, F.regexp_replace("value", ' time:"[^"]*"', ""))
        .when(i == 2, F.regexp_replace("value", ' code:"[^"]*"', ' code:"999"'))
        .when(i == 3, F.regexp_replace("value", ' time:"[^"]*"', ' time:"yesterday"'))
        .when(i == 4, F.lit("   "))
        .otherwise(c("value"))
    )
    return raw.select("event_id", line.alias("value"))


@register(
    "s12_parse_errors",
    """SELECT event_id, CASE event_id % 20 WHEN 0 THEN 'missing_code' WHEN 1 THEN 'missing_time' WHEN 2 THEN 'bad_code' WHEN 3 THEN 'bad_time' ELSE '' END AS errors, event_id % 20 NOT IN (0, 1) AS kept
    FROM access WHERE event_id % 20 <> 4""",
)
def _(spark, sf):
    parsed = lines.parse_pairs(_broken(spark, sf))
    both = [
        part.select("event_id", F.array_join("parsing_errors", ",").alias("errors"), F.lit(kept).alias("kept"))
        for part, kept in ((lines.accepted(parsed), True), (lines.rejected(parsed), False))
    ]
    return ranking.stack_up(both)


@register(
    "q05_parse_statistics",
    """SELECT count(*) AS total, count(*) FILTER (WHERE event_id % 20 NOT IN (0, 1, 4)) AS parsed, count(*) FILTER (WHERE event_id % 20 IN (0, 1)) AS errors, count(*) FILTER (WHERE event_id % 20 = 4) AS empty,
    count(*) FILTER (WHERE event_id % 20 NOT IN (0, 1, 4))::DOUBLE / count(*) AS success_rate FROM access""",
)
def _(spark, sf):
    return lines.parse_statistics(_broken(spark, sf))


@register(
    "s13_fallbacks",
    "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '0.0.0.0' ELSE client_ip END AS client_ip, CASE WHEN event_id % 7 = 0 THEN '0' ELSE status END AS status, CASE WHEN event_id % 9 = 0 OR event_id % 7 = 0 THEN 'fallback' ELSE 'complete' END AS enrichment_status FROM access",
)
def _(spark, sf):
    df = access(spark, sf).select(
        "event_id",
        F.when(c("event_id") % 9 != 0, c("client_ip")).alias("client_ip"),
        F.when(c("event_id") % 7 != 0, c("status")).alias("status"),
    )
    return sinks.with_fallbacks(df, {"client_ip": "0.0.0.0", "status": "0"})


@register(
    "s14_coercion",
    "SELECT log_time, client_ip, CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN body_bytes ELSE body_bytes END AS body_bytes, 0::BIGINT AS connect_ms, '' AS referer FROM access",
)
def _(spark, sf):
    body = (
        F.when(c("event_id") % 4 == 0, F.lit("-"))
        .when(c("event_id") % 4 == 1, F.lit("abc"))
        .when(c("event_id") % 4 == 2, F.concat(c("body_bytes").cast("string"), F.lit(".0")))
        .otherwise(c("body_bytes").cast("string"))
    )
    raw = access(spark, sf).select(c("log_time").cast("string").alias("log_time"), "client_ip", body.alias("body_bytes"))
    return coerce(raw).select("log_time", "client_ip", "body_bytes", "connect_ms", "referer")


@register("s17_retention", "SELECT count(*) AS kept FROM access WHERE CAST(log_time AS DATE) >= DATE '2024-01-24'")
def _(spark, sf):
    df = access(spark, sf).withColumn("date", F.to_date("log_time"))
    return sinks.retain(df, "date", "ranking_short", date(2024, 1, 31)).agg(F.count(F.lit(1)).alias("kept"))


@register("s18_delete_range", "SELECT CAST(log_time AS DATE) AS date, count(*) AS kept FROM access WHERE CAST(log_time AS DATE) NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' GROUP BY 1")
def _(spark, sf):
    df = access(spark, sf).withColumn("date", F.to_date("log_time"))
    return sinks.kept_after_delete(df, "date", date(2024, 1, 5), date(2024, 1, 9)).groupBy("date").agg(F.count(F.lit(1)).alias("kept"))


_FILES = """, f AS (SELECT DISTINCT strftime(log_time, 'cdn_%Y_%m_%d_%H0000_%H5959.log') AS file, date_trunc('hour', log_time) AS range_start FROM access)"""


def _hour_files(spark, sf):
    name = F.concat(
        F.lit("cdn_"), F.date_format("log_time", "yyyy_MM_dd_HH"), F.lit("0000_"), F.date_format("log_time", "HH"), F.lit("5959.log")
    )
    return access(spark, sf).select(name.alias("file")).distinct()


@register("s20_file_ranges", _FILES + " SELECT file, range_start, range_start + INTERVAL 3599 SECOND AS range_end FROM f")
def _(spark, sf):
    lo, hi = files.name_range(c("file"))
    return _hour_files(spark, sf).select("file", lo.alias("range_start"), hi.alias("range_end"))


@register(
    "w10_file_gaps",
    _FILES
    + """, n AS (SELECT file, range_start, range_start + INTERVAL 3599 SECOND AS range_end, lead(range_start) OVER (ORDER BY range_start, file) AS next_start FROM f)
    SELECT *, CASE WHEN date_diff('second', range_end, next_start) > 0 THEN date_diff('second', range_end, next_start) ELSE 0 END AS gap_seconds FROM n""",
)
def _(spark, sf):
    return files.continuity(_hour_files(spark, sf))


def _file_table(spark, sf):
    """One file per client and day, its hash from the rows in it."""
    df = access(spark, sf).withColumn("file", F.concat_ws("/", c("client_ip"), F.date_format("log_time", "yyyy-MM-dd")))
    return df.groupBy("file").agg(F.sum("body_bytes").cast("string").alias("hash"), F.max("log_time").alias("at"), F.max("event_id").alias("i"))


@register(
    "s09_pending_files",
    """, f AS (SELECT client_ip || '/' || strftime(log_time, '%Y-%m-%d') AS file, CAST(CAST(sum(body_bytes) AS BIGINT) AS VARCHAR) AS hash, max(event_id) AS i FROM access GROUP BY 1)
    SELECT file, hash FROM f WHERE i % 3 <> 0 OR i % 15 = 0""",
)
def _(spark, sf):
    f = _file_table(spark, sf)
    day = F.make_interval(days=F.lit(1))
    done = files.manifest_rows(f.filter(c("i") % 3 == 0), "completed", c("at"))
    failed = files.manifest_rows(f.filter(c("i") % 15 == 0), "failed", c("at") + day)
    started = files.manifest_rows(f.filter(c("i") % 3 == 1), "processing", c("at"))
    manifest = ranking.stack_up([done, failed, started])
    return files.pending(f.select("file", "hash"), manifest)


@register("s09_incremental_load", "SELECT '3' AS family, count(*) AS lines FROM access WHERE event_id % 4 = 3")
def _(spark, sf):
    """List, fingerprint, record as done; then a part is added to the folder: only its files are pending."""
    folder = scratch(spark, "grown")
    rows = lines.as_pairs(access(spark, sf)).select("value", (c("event_id") % 4).cast("string").alias("family"))

    def prints():
        return files.content_fingerprints(files.read_lines(spark, f"{folder}/tree"))

    rows.filter("family <> '3'").write.partitionBy("family").text(f"{folder}/tree")
    files.manifest_rows(prints(), "completed", F.current_timestamp()).write.parquet(f"{folder}/manifest")
    rows.filter("family = '3'").write.mode("append").partitionBy("family").text(f"{folder}/tree")
    waiting = files.pending(prints(), spark.read.parquet(f"{folder}/manifest"))
    return waiting.groupBy(F.regexp_extract("file", "family=([^/]*)", 1).alias("family")).agg(F.sum("lines").alias("lines"))


@register(
    "s09_reset_failed",
    """, f AS (SELECT client_ip || '/' || strftime(log_time, '%Y-%m-%d') AS file, CAST(CAST(sum(body_bytes) AS BIGINT) AS VARCHAR) AS hash, max(event_id) AS i FROM access GROUP BY 1)
    SELECT file, hash, 'pending' AS state FROM f WHERE i % 5 = 0""",
)
def _(spark, sf):
    f = _file_table(spark, sf)
    manifest = ranking.stack_up(
        [files.manifest_rows(f, "processing", c("at")), files.manifest_rows(f.filter(c("i") % 5 == 0), "failed", c("at") + F.make_interval(days=F.lit(1)))]
    )
    return files.reset_failed(manifest, F.current_timestamp()).drop("updated_at")


# ---------------------------------------------------------------- streaming and mergeable state

_KEYS = ["stat_hour", "platform"]
_STATE_SQL = """SELECT stat_hour, platform, count(*) AS requests, count(*) FILTER (WHERE is_success) AS successes, count(*) FILTER (WHERE is_error) AS errors, count(*) FILTER (WHERE is_slow) AS slow, CAST(sum(body_bytes) AS BIGINT) AS bytes,
    max(duration_ms) AS max_ms, min(log_time) AS first_time, max(log_time) AS last_time, count(*) FILTER (WHERE is_success) * 1e2 / count(*) AS success_rate, count(*) FILTER (WHERE is_error) * 1e2 / count(*) AS error_rate,
    count(*) FILTER (WHERE is_slow) * 1e2 / count(*) AS slow_rate, avg(duration_ms) AS avg_ms, round(stddev_pop(duration_ms), 3) AS std_ms FROM hits GROUP BY 1, 2"""


@register("x03_merged_state", _STATE_SQL)
def _(spark, sf):
    keys = [*_KEYS, "slice"]
    parts = state.partial(hits(spark, sf).withColumn("slice", c("event_id") % 7), keys).drop("slice")
    return state.report(state.merge(parts, _KEYS), _KEYS).drop("clients_estimate", "p95_estimate")


@register(
    "x03_days_from_hours",
    """SELECT CAST(log_time AS DATE) AS day, count(*) AS requests, count(*) FILTER (WHERE is_error) AS errors, max(duration_ms) AS max_ms, avg(duration_ms) AS avg_ms,
    true AS clients_close, true AS p95_close FROM hits GROUP BY 1""",
)
def _(spark, sf):
    """Day report from the state of hours and platforms, its estimates held against the exact values."""
    rows = hits(spark, sf)
    days = state.report(state.coarser(state.partial(rows, _KEYS), {"day": F.to_date("stat_hour")}), ["day"])
    ms = c("duration_ms")
    exact = measures.summarise(rows, {"of": F.to_date("log_time")}, nearest=[(ms, {"lo": 0.93, "hi": 0.97})], distinct={"users": c("client_ip")})
    both = days.join(exact, c("day") == c("of"))
    near = F.abs(c("clients_estimate") - c("users")) <= F.greatest(F.lit(2.0), c("users") * 0.06)
    return both.select("day", "requests", "errors", "max_ms", "avg_ms", near.alias("clients_close"), c("p95_estimate").between(c("lo"), c("hi")).alias("p95_close"))


def _arriving(rows, folder, **options):
    """Requests of a folder of events as a stream, dealt out over as many tasks as ``rows``, all of them, need."""
    events = rows.sparkSession.readStream.schema(rows.schema).options(**options).parquet(folder)
    return requests_from(events.repartition(parts(rows), "event_id"))


@register("x02_stream_rollup", _STATE_SQL)
def _(spark, sf):
    events = _arriving(table(spark, sf, "events"), sf, pathGlobFilter="events.parquet")
    folder = scratch(spark, "stream")
    query = jobs.start_rollup(events, _KEYS, f"{folder}/state", f"{folder}/checkpoint", derive=enrich)
    query.awaitTermination()
    return jobs.read_rollup(spark, f"{folder}/state", _KEYS).drop("clients_estimate", "p95_estimate")


@register("x01_watched_folder", "SELECT status, count(*) AS requests, CAST(sum(event_id) AS BIGINT) AS ids FROM access GROUP BY 1")
def _(spark, sf):
    """A folder of log files that grows between two runs of one job: every line is taken once."""
    folder = scratch(spark, "watched")
    tagged = F.concat(c("value"), F.lit(' id:"'), c("event_id").cast("string"), F.lit('"'))
    rows = lines.as_pairs(access(spark, sf)).select(tagged.alias("value"), (c("event_id") % 2).alias("half"))

    def parsed(batch, batch_id):
        ids = lines.pair_value(lines.padded(c("value")), ["id"]).cast("long").alias("event_id")
        found = lines.accepted(lines.parse_pairs(batch.select("value", ids)))
        found.select("event_id", "status").write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")

    for half in (0, 1):
        rows.filter(c("half") == half).select("value").write.mode("append").text(f"{folder}/logs")
        stream = jobs.watch_lines(spark, f"{folder}/logs", glob="*.txt").writeStream.foreachBatch(parsed)
        stream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(f"{folder}/rows")
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("requests"), F.sum("event_id").alias("ids"))


@register("x08_late_rows", _STATE_SQL)
def _(spark, sf):
    """Rows of hours long past arrive in a later run, after a fold; none is lost or counted twice."""
    folder = scratch(spark, "late")
    rows = table(spark, sf, "events")
    for late in (False, True):
        rows.filter((c("event_id") % 10 == 0) == late).write.mode("append").parquet(f"{folder}/events")
        events = _arriving(rows, f"{folder}/events")
        jobs.start_rollup(events, _KEYS, f"{folder}/state", f"{folder}/checkpoint", derive=enrich).awaitTermination()
        if not late:
            jobs.compact(spark, f"{folder}/state", _KEYS, f"{folder}/folded")
    return jobs.read_rollup(spark, f"{folder}/state", _KEYS, f"{folder}/folded").drop("clients_estimate", "p95_estimate")


_LATE = "event_id % 10 = 0 AND log_time < TIMESTAMP '2024-01-21'"
_BATCH = f"CASE WHEN {_LATE} THEN 1 WHEN log_time < TIMESTAMP '2024-01-21' THEN 0 ELSE 2 END"


def _in_three_runs(spark, sf, folder, start):
    """Rows up to the 20th but a tenth of them, then that tenth, then the rest, each taken up by a run of its own."""
    rows = table(spark, sf, "events")
    first = c("ts") < F.lit("2024-01-21").cast("timestamp_ntz")
    late = first & (c("event_id") % 10 == 0)
    for part in (first & ~late, late, ~first):
        rows.filter(part).write.mode("append").parquet(f"{folder}/events")
        start(_arriving(rows, f"{folder}/events")).awaitTermination()


@register(
    "x08_append_windows",
    f""", e AS (SELECT *, {_BATCH} AS b, make_timestamp(epoch_us(log_time) // 3600000000 * 3600000000 + 3600000000) AS window_end FROM hits),
    m AS (SELECT max(log_time) FILTER (WHERE b = 0) - INTERVAL 1 DAY AS w0, max(log_time) - INTERVAL 1 DAY AS w2 FROM e)
    SELECT window_end, count(*) AS requests, count(*) FILTER (WHERE is_error) * 1e2 / count(*) AS error_rate FROM e, m
    WHERE NOT (b = 1 AND window_end <= w0) AND window_end <= w2 GROUP BY 1""",
)
def _(spark, sf):
    """Hourly windows in append mode: late rows count while their window is open, and are left out after it."""
    folder = scratch(spark, "append")

    def start(events):
        windows = jobs.windowed(enrich(events), "1 hour", late="1 day")
        stream = windows.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/windows")
        return stream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()

    _in_three_runs(spark, sf, folder, start)
    return spark.read.parquet(f"{folder}/windows").select("window_end", "requests", "error_rate")


@register(
    "x08_late_apart",
    f""", e AS (SELECT *, {_BATCH} AS b FROM hits), m AS (SELECT max(log_time) FILTER (WHERE b = 0) - INTERVAL 1 DAY AS w0 FROM e)
    SELECT CASE WHEN b = 1 AND log_time < w0 THEN 'late' ELSE 'in_time' END AS kind, CAST(log_time AS DATE) AS day, count(*) AS requests FROM e, m GROUP BY 1, 2""",
)
def _(spark, sf):
    """Rows behind the watermark go to a table of their own, the others to the rollup; none is lost."""
    folder = scratch(spark, "apart")

    def start(events):
        return jobs.start_event_time(events, _KEYS, folder, f"{folder}/checkpoint", late_seconds=86400, derive=enrich)

    _in_three_runs(spark, sf, folder, start)
    rolled = jobs.read_rollup(spark, f"{folder}/state", _KEYS).groupBy(F.to_date("stat_hour").alias("day")).agg(F.sum("requests").alias("requests"))
    late = spark.read.parquet(f"{folder}/late").groupBy(F.to_date("log_time").alias("day")).agg(F.count(F.lit(1)).alias("requests"))
    return ranking.stack_up([rolled.withColumn("kind", F.lit("in_time")), late.withColumn("kind", F.lit("late"))]).select("kind", "day", "requests")


@register("x04_stream_unique", "SELECT status, count(*) AS requests, CAST(sum(event_id) AS BIGINT) AS ids FROM access GROUP BY 1")
def _(spark, sf):
    """Every third row comes a second time in a later run; each counts once."""
    folder = scratch(spark, "unique")
    rows = table(spark, sf, "events")
    for part in (rows, rows.filter(c("event_id") % 3 == 0)):
        part.write.mode("append").parquet(f"{folder}/events")
        events = _arriving(rows, f"{folder}/events")
        stream = jobs.unique(events, ["event_id"], "60 days").select("event_id", "status").writeStream.format("parquet").option("path", f"{folder}/rows")
        stream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(f"{folder}/rows")
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("requests"), F.sum("event_id").alias("ids"))


def _forget_commit(spark: SparkSession, checkpoint: str) -> None:
    """Take back the commit of a stopped job's last batch, as if it had crashed before: the next run does it again."""
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = log.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath() for f in fs.listStatus(log) if f.getPath().getName().isdigit()]
    fs.delete(max(done, key=lambda p: int(p.getName())), False)


@register("x09_replayed_batch", _STATE_SQL)
def _(spark, sf):
    """The last batch of a job runs again after a crash that lost its commit; the report stays the same."""
    folder = scratch(spark, "replayed")
    rows = table(spark, sf, "events")
    for half in (0, 1):
        rows.filter(c("event_id") % 2 == half).write.mode("append").parquet(f"{folder}/events")
        start = _arriving(rows, f"{folder}/events")
        jobs.start_rollup(start, _KEYS, f"{folder}/state", f"{folder}/checkpoint", derive=enrich).awaitTermination()
    _forget_commit(spark, f"{folder}/checkpoint")
    jobs.start_rollup(start, _KEYS, f"{folder}/state", f"{folder}/checkpoint", derive=enrich).awaitTermination()
    return jobs.read_rollup(spark, f"{folder}/state", _KEYS).drop("clients_estimate", "p95_estimate")


@register("x04_latest_version", "SELECT client_ip, arg_max(event_id, (log_time, event_id)) AS event_id, arg_max(status, (log_time, event_id)) AS status, max(log_time) AS log_time FROM access GROUP BY 1")
def _(spark, sf):
    df = access(spark, sf).select("client_ip", "event_id", "status", "log_time", F.struct("log_time", "event_id").alias("version"))
    return ranking.latest(df, ["client_ip"], "version").drop("version")


_WIN = """count(*) AS requests, count(*) FILTER (WHERE is_error) * 1e2 / count(*) AS error_rate, count(*) FILTER (WHERE is_slow) * 1e2 / count(*) AS slow_rate, avg(duration_ms) AS avg_ms"""


@register("x05_tumbling", f"SELECT make_timestamp(epoch_us(log_time) // 900000000 * 900000000) AS window_start, make_timestamp(epoch_us(log_time) // 900000000 * 900000000 + 900000000) AS window_end, {_WIN} FROM hits GROUP BY 1, 2")
def _(spark, sf):
    return jobs.windowed(hits(spark, sf), "15 minutes")


_SLIDE = f""", w AS (SELECT *, unnest([0, 1, 2, 3, 4]) AS k FROM hits), s AS (SELECT *, (epoch_us(log_time) // 60000000 - k) * 60000000 AS ws FROM w)
    SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + 300000000) AS window_end, platform, {_WIN} FROM s GROUP BY 1, 2, 3"""


@register("x06_sliding", _SLIDE)
def _(spark, sf):
    return jobs.windowed(hits(spark, sf), "5 minutes", slide="1 minute", by=["platform"])


@register(
    "x10_alerts",
    f""", w AS (SELECT make_timestamp(epoch_us(log_time) // 3600000000 * 3600000000) AS window_start, make_timestamp(epoch_us(log_time) // 3600000000 * 3600000000 + 3600000000) AS window_end, {_WIN} FROM hits GROUP BY 1, 2)
    SELECT *, 'error_rate' AS alert FROM w WHERE error_rate > 20 UNION ALL SELECT *, 'response_time' FROM w WHERE avg_ms > 5000""",
)
def _(spark, sf):
    return jobs.alerts(jobs.windowed(hits(spark, sf), "1 hour"), error_rate=20, mean_ms=5000)


_EPISODES = f""", w AS (SELECT platform, make_timestamp(epoch_us(log_time) // 3600000000 * 3600000000) AS window_start, make_timestamp(epoch_us(log_time) // 3600000000 * 3600000000 + 3600000000) AS window_end, {_WIN} FROM hits GROUP BY 1, 2, 3),
    a AS (SELECT platform, window_start, window_end, 'error_rate' AS alert, error_rate AS v FROM w WHERE error_rate > 20 UNION ALL SELECT platform, window_start, window_end, 'response_time', avg_ms FROM w WHERE avg_ms > 5000),
    g AS (SELECT *, window_start > lag(window_end) OVER (PARTITION BY platform, alert ORDER BY window_start) + INTERVAL 1 HOUR AS apart FROM a WHERE {{}}),
    i AS (SELECT *, sum(CASE WHEN coalesce(apart, true) THEN 1 ELSE 0 END) OVER (PARTITION BY platform, alert ORDER BY window_start) AS k FROM g),
    ep AS (SELECT platform, alert, min(window_start) AS raised, max(window_end) AS until, count(*) AS windows, max(v) AS worst FROM i GROUP BY platform, alert, k)"""


@register("x10_episodes", _EPISODES.format("true") + " SELECT * FROM ep")
def _(spark, sf):
    parts = jobs.pieces(jobs.windowed(hits(spark, sf), "1 hour", by=["platform"]), ["platform"], error_rate=20, mean_ms=5000)
    return jobs.joined_up(parts, ["platform"], hold_seconds=3600)


@register(
    "x10_stream_episodes",
    """, t AS (SELECT max(log_time) - INTERVAL 2 HOUR AS w FROM access)"""
    + _EPISODES.format("window_end <= (SELECT w FROM t)")
    + """, k AS (SELECT max(window_end) AS clock FROM w WHERE window_end <= (SELECT w FROM t))
    SELECT ep.*, CASE WHEN until + INTERVAL 2 HOUR <= clock THEN 'cleared' ELSE 'open' END AS state FROM ep, k""",
)
def _(spark, sf):
    """The same episodes from a stream of closed windows, in two runs: one row when an alert is cleared, the rest still open."""
    folder = scratch(spark, "episodes")
    rows = table(spark, sf, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (c("ts") < cut, c("ts") >= cut):
        rows.filter(part).write.mode("append").parquet(f"{folder}/events")
        events = enrich(_arriving(rows, f"{folder}/events"))
        windows = jobs.windowed(events, "1 hour", late="2 hours", by=["platform"])
        jobs.start_episodes(
            windows, ["platform"], folder, f"{folder}/checkpoint", width_seconds=3600, hold_seconds=3600, error_rate=20, mean_ms=5000
        ).awaitTermination()
    return jobs.read_episodes(spark, folder)


# ---------------------------------------------------------------- table quality


@register(
    "q01_layer_ratio",
    "SELECT count(*) AS raw_rows, count(*) FILTER (WHERE event_id % 20 <> 4 AND event_id % 20 NOT IN (0, 1)) AS enriched_rows, count(*) FILTER (WHERE event_id % 20 NOT IN (0, 1, 4)) * 1e2 / count(*) AS ratio, 'degraded' AS state FROM access",
)
def _(spark, sf):
    raw = _broken(spark, sf)
    return quality.layer_ratio(raw, lines.accepted(lines.parse_pairs(raw)))


@register("q02_time_span", "SELECT CAST(min(log_time) AS DATE) AS first_day, CAST(max(log_time) AS DATE) AS last_day, CAST(date_diff('day', min(log_time), max(log_time)) AS INT) AS days FROM access")
def _(spark, sf):
    return quality.time_span(access(spark, sf))


@register(
    "q03_issue_counts",
    "SELECT 'missing_referer' AS issue, count(*) AS rows FROM access WHERE referer = '' UNION ALL SELECT 'excessive_duration', count(*) FROM access WHERE duration_ms * 3 > 60000",
)
def _(spark, sf):
    df = access(spark, sf).withColumn("duration_ms", c("duration_ms") * 3)
    return quality.issue_counts(df, {n: c(n) for n in ("client_ip", "request_uri", "referer")})


@register(
    "q04_metric_rows",
    "SELECT 'success_rate' AS metric, count(*) FILTER (WHERE is_success) * 1e2 / count(*) AS value, 95e0 AS threshold, count(*) FILTER (WHERE is_success) * 1e2 / count(*) >= 95 AS passed FROM hits UNION ALL SELECT 'slow_requests', count(*) FILTER (WHERE is_slow)::DOUBLE, 100000e0, count(*) FILTER (WHERE is_slow) <= 100000 FROM hits",
)
def _(spark, sf):
    n = F.count(F.lit(1))
    checks = {
        "success_rate": (F.count_if("is_success") * 100.0 / n, 95.0, True),
        "slow_requests": (F.count_if("is_slow"), 100000.0, False),
    }
    return quality.metric_rows(hits(spark, sf), checks)
