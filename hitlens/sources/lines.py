"""Log line formats -> request columns. Input: a text DataFrame with a ``value`` column.

Other columns (file name, line id) pass through. Every parser is one projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlens.functions.clock import wall_clock
from hitlens.functions.uri import path, request_parts
from hitlens.rules import settled

HEADER_BYTES = 200


def _v() -> Column:
    return F.col("value")


# --- fixed values: key names of the two JSON dialects and the two key:value dialects
JSON_KEYS = {
    "time": ["time", "timestamp", "log_time"],
    "client_ip": ["remote_addr", "client_ip"],
    "request_method": ["request_method", "method"],
    "request_uri": ["request_uri", "uri"],
    "query": ["query_string", "request_args"],
    "protocol": ["request_protocol", "server_protocol"],
    "status": ["status", "response_status"],
    "duration": ["request_time", "response_time"],
    "connect": ["upstream_connect_time"],
    "header": ["upstream_header_time"],
    "response": ["upstream_response_time", "upstream_time"],
    "body": ["body_bytes_sent", "response_size"],
    "sent": ["bytes_sent", "body_bytes_sent"],
    "user_agent": ["http_user_agent", "user_agent"],
    "referer": ["http_referer", "referer"],
    "server_name": ["server_name", "host", "http_host"],
    "upstream_addr": ["upstream_addr"],
    "cache": ["upstream_cache_status"],
    "trace": ["trace_id", "x_trace_id"],
    "connection": ["connection_requests"],
}
PAIR_KEYS = {
    "server_name": ["http_host"],
    "remote_addr": ["remote_addr"],
    "real_ip": ["RealIp"],
    "time": ["time"],
    "request": ["request"],
    "status": ["code", "status"],
    "body": ["body", "body_bytes_sent"],
    "duration": ["ar_time", "response_time"],
    "upstream": ["upstream_response_time"],
    "referer": ["http_referer"],
    "user_agent": ["agent", "http_user_agent"],
}
# --- line formats, written from their field lists: QUOTED is free text, WORD has no blanks
_WORD, _NUMBER, _QUOTED, _BRACKETS = r"(\S+)", r"(\d+)", r'"([^"]*)"', r"\[([^\]]*)\]"
# address, "-", user, time, request, status, bytes, referer, user agent; further fields may follow
COMBINED = r"^" + r"\s+".join([_WORD, "-", r"(\S*)", _BRACKETS, r'"([^"]+)"', _NUMBER, _NUMBER, _QUOTED, _QUOTED]) + r".*$"
# time, address, proxy, ms, referer, request, status, bytes in, bytes out, cache, user agent, type, end address
CDN = r"^" + r"\s+".join(
    [_BRACKETS, _WORD, _WORD, _NUMBER, _QUOTED, _QUOTED, _NUMBER, _NUMBER, _NUMBER, r'([^"]*?)', _QUOTED, _QUOTED, r"(.*)$"]
)
EMPTY_VALUES = ["-", '""', "''", "null", "NULL", ""]
TIME_FORMS = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}[+-]\d{2}:\d{2}| \d{2}:\d{2}:\d{2})"


def millis(seconds: Column) -> Column:
    """Seconds as text -> whole milliseconds, 0 when unreadable (decimal, so no binary rounding)."""
    return F.coalesce((seconds.try_cast("decimal(20,6)") * 1000).cast("long"), F.lit(0).cast("long"))


def whole(number: Column) -> Column:
    """Integer text, ``3.0`` included; 0 when empty or unreadable."""
    return F.coalesce(number.try_cast("double").cast("long"), F.lit(0).cast("long"))


def _keep(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "value"]


BAD_JSON = "_bad"


def _json(line: Column) -> Column:
    """The known keys of a JSON object; ``BAD_JSON`` holds the line if it is not well formed."""
    names = sorted({n for group in JSON_KEYS.values() for n in group})
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, BAD_JSON)])
    return F.from_json(line, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_JSON})


def parse_json(df: DataFrame) -> DataFrame:
    """JSON lines in either dialect; lines that are no JSON object are dropped.

    A query string logged apart from the URI is appended to it.
    """
    kept = _keep(df)
    parsed = settled(df.filter(F.ltrim(_v()).startswith("{")), {"_j": _json(_v())}, kept)
    parsed = parsed.filter(F.col("_j")[BAD_JSON].isNull())

    def field(name: str) -> Column:
        return F.coalesce(*[F.col("_j")[k] for k in JSON_KEYS[name]])

    uri, args = field("request_uri"), field("query")
    apart = (args != "") & (args != "-") & ~uri.contains("?")
    return parsed.select(
        *_keep(df),
        wall_clock(field("time")).alias("log_time"),
        field("client_ip").alias("client_ip"),
        field("request_method").alias("request_method"),
        F.when(apart, F.concat(uri, F.lit("?"), args)).otherwise(uri).alias("request_uri"),
        field("protocol").alias("protocol"),
        field("status").alias("status"),
        millis(field("duration")).alias("duration_ms"),
        millis(field("connect")).alias("connect_ms"),
        millis(field("header")).alias("header_ms"),
        millis(field("response")).alias("response_ms"),
        whole(field("body")).alias("body_bytes"),
        whole(field("sent")).alias("sent_bytes"),
        field("user_agent").alias("user_agent"),
        field("referer").alias("referer"),
        field("server_name").alias("server_name"),
        field("upstream_addr").alias("upstream_addr"),
        F.coalesce(field("cache"), F.lit("")).alias("upstream_cache"),
        F.coalesce(field("trace"), F.lit("")).alias("trace_id"),
        F.coalesce(field("connection").try_cast("long"), F.lit(1).cast("long")).alias("connection_requests"),
    )


def _unquoted(token: Column, after: Column) -> Column:
    return F.btrim(F.substr(token, after), F.lit('"'))


def padded(line: Column) -> Column:
    """Line with white space as single blanks in front of every key, the first one included."""
    return F.concat(F.lit(" "), F.translate(F.trim(line), "\t", " "))


def pair_value(line: Column, keys: list[str]) -> Column:
    """Raw value of the first of ``keys`` in a padded line, quoted form first; NULL if absent.

    Plain byte searches: a quoted value ends at the next quote, a bare one at the next blank.
    """

    def of(key: str) -> list[Column]:
        quoted, bare = f' {key}:"', f" {key}:"
        at, at_bare = F.instr(line, quoted), F.instr(line, bare)
        return [
            F.when(at > 0, F.substring_index(F.substr(line, at + len(quoted)), '"', 1)),
            F.when(at_bare > 0, F.substring_index(F.substr(line, at_bare + len(bare)), " ", 1)),
        ]

    return F.coalesce(*[value for key in keys for value in of(key)])


def _clean(name: str) -> Column:
    """Value column, NULL for the empty placeholders."""
    return F.when(~F.col(name).isin(*EMPTY_VALUES), F.col(name))


def parse_pairs(df: DataFrame) -> DataFrame:
    """key:"value" lines. Adds ``parsing_errors``; :func:`accepted` and :func:`rejected` split them.

    Sent bytes = body + 200; connect and header times are 0; the upstream time is the whole duration
    unless the line states it.
    """
    kept = _keep(df)
    raw = df.filter(F.trim(_v()) != "").select(*kept, padded(_v()).alias("_line"))
    raw = raw.select(*kept, *[pair_value(F.col("_line"), k).alias(f"_{n}") for n, k in PAIR_KEYS.items()])
    raw = settled(raw, {f"_{n}": _clean(f"_{n}") for n in PAIR_KEYS}, kept)
    method, uri, protocol = request_parts(F.coalesce(F.col("_request"), F.lit("")))
    ms = millis(F.col("_duration"))
    code = F.col("_status").try_cast("int")
    errors = F.array_compact(
        F.array(
            F.when(F.col("_time").isNull(), F.lit("missing_time")),
            F.when(F.col("_remote_addr").isNull(), F.lit("missing_remote_addr")),
            F.when(F.col("_status").isNull(), F.lit("missing_code")),
            F.when(F.col("_time").isNotNull() & ~F.col("_time").rlike(TIME_FORMS), F.lit("bad_time")),
            F.when(
                F.col("_status").isNotNull() & ~F.coalesce(code.between(100, 599), F.lit(False)), F.lit("bad_code")
            ),
        )
    )
    return raw.select(
        *kept,
        wall_clock(F.col("_time")).alias("log_time"),
        F.coalesce("_real_ip", "_remote_addr").alias("client_ip"),
        F.col("_remote_addr").alias("remote_addr"),
        method.alias("request_method"),
        uri.alias("request_uri"),
        protocol.alias("protocol"),
        F.col("_status").alias("status"),
        ms.alias("duration_ms"),
        F.lit(0).cast("long").alias("connect_ms"),
        F.lit(0).cast("long").alias("header_ms"),
        F.when(F.col("_upstream").isNotNull(), millis(F.col("_upstream"))).otherwise(ms).alias("response_ms"),
        whole(F.col("_body")).alias("body_bytes"),
        (whole(F.col("_body")) + HEADER_BYTES).alias("sent_bytes"),
        F.col("_user_agent").alias("user_agent"),
        F.col("_referer").alias("referer"),
        F.col("_server_name").alias("server_name"),
        F.lit("").alias("upstream_addr"),
        errors.alias("parsing_errors"),
    )


def _is_rejected() -> Column:
    return F.exists("parsing_errors", lambda e: e.startswith("missing_"))


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows with all key fields; a bad time or status stays, listed in ``parsing_errors``."""
    return parsed.filter(~_is_rejected())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(_is_rejected())


def _groups(df: DataFrame, line: Column, pattern: str, n: int) -> DataFrame:
    """Matching lines with all groups in one array column, so the pattern runs once per line."""
    joined = F.regexp_replace(line, pattern, "\u0001".join(f"${i}" for i in range(1, n + 1)))
    out = df.select(*_keep(df), F.when(line.rlike(pattern), joined).alias("_joined"))
    return settled(out, {"_g": F.split("_joined", "\u0001")}, _keep(df)).filter("_g is not null")


def parse_combined(df: DataFrame) -> DataFrame:
    """Combined format; other lines are dropped."""

    def group(i: int) -> Column:
        return F.get(F.col("_g"), F.lit(i - 1))

    method, uri, protocol = request_parts(group(4))
    stamp = F.regexp_replace(group(3), r" [+-]\d{4}$", "")
    zero = F.lit(0).cast("long")
    return _groups(df, _v(), COMBINED, 8).select(
        *_keep(df),
        F.try_to_timestamp(stamp, F.lit("dd/MMM/yyyy:HH:mm:ss")).alias("log_time"),
        group(1).alias("client_ip"),
        method.alias("request_method"),
        uri.alias("request_uri"),
        protocol.alias("protocol"),
        group(5).alias("status"),
        zero.alias("duration_ms"),
        zero.alias("connect_ms"),
        zero.alias("header_ms"),
        zero.alias("response_ms"),
        whole(group(6)).alias("body_bytes"),
        whole(group(6)).alias("sent_bytes"),
        group(8).alias("user_agent"),
        group(7).alias("referer"),
        F.lit("default").alias("server_name"),
        F.lit("").alias("upstream_addr"),
    )


def parse_cdn(df: DataFrame) -> DataFrame:
    """CDN lines of 13 groups; other lines are dropped."""

    def group(i: int) -> Column:
        return F.get(F.col("_g"), F.lit(i - 1))

    stamp = F.regexp_replace(group(1), r" [+-]\d{4}$", "")
    url = F.regexp_extract(group(6), r"^\w+\s+(https?://\S+)", 1)
    return _groups(df, F.trim(_v()), CDN, 13).select(
        *_keep(df),
        F.try_to_timestamp(stamp, F.lit("d/MMM/yyyy:HH:mm:ss")).alias("log_time"),
        group(2).alias("client_ip"),
        group(3).alias("proxy_ip"),
        whole(group(4)).alias("duration_ms"),
        group(5).alias("referer"),
        F.regexp_extract(group(6), r"^(\w+)\s", 1).alias("request_method"),
        url.alias("url"),
        F.regexp_extract(path(url), r"^https?://[^/]+(/.*)?$", 1).alias("uri"),
        group(7).alias("status"),
        whole(group(8)).alias("request_bytes"),
        whole(group(9)).alias("body_bytes"),
        group(10).alias("cache_status"),
        group(11).alias("user_agent"),
        group(12).alias("content_type"),
        group(13).alias("end_ip"),
    )


def pairs_map(line: Column) -> Column:
    """Every ``key:"v"`` / ``key:v`` of a line as a map; the last of equal keys wins."""
    found = F.regexp_extract_all(line, F.lit(r'\b\w+:(?:"[^"]*"|[^\s"]\S*)'), F.lit(0))
    pairs = F.transform(
        found,
        lambda t: F.struct(F.substring_index(t, ":", 1).alias("k"), _unquoted(t, F.instr(t, ":") + 1).alias("v")),
    )
    keys = F.transform(found, lambda t: F.substring_index(t, ":", 1))
    last = F.filter(
        pairs, lambda p, i: i == F.size(keys) - F.array_position(F.reverse(keys), p["k"]).cast("int")
    )
    return F.map_from_entries(last)


def line_format(line: Column, *, every: bool = False) -> Column:
    """``json``, ``pairs`` or NULL; with ``every`` also ``combined`` and ``cdn``."""
    out = F.when(F.get_json_object(line, "$").isNotNull(), F.lit("json")).when(
        line.contains("http_host:") & line.contains("remote_addr:"), F.lit("pairs")
    )
    if every:
        out = out.when(line.rlike(COMBINED), F.lit("combined")).when(F.trim(line).rlike(CDN), F.lit("cdn"))
    return out


def file_formats(
    df: DataFrame, file: str = "source_file", position: str = "line_no", *, look: int = 5, every: bool = False
) -> DataFrame:
    """Format per file from its first five lines; JSON when none of them tells."""
    head = df.filter(F.col(position) <= look)
    form = line_format(_v(), every=every)
    first = F.min_by(form, F.when(form.isNotNull(), F.col(position)))
    return head.groupBy(file).agg(F.coalesce(first, F.lit("json")).alias("format"))


PAIR_NEEDED = ["time", "remote_addr", "status"]


def _has_all(values: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [v.isNotNull() & ~v.isin(*EMPTY_VALUES) for v in values])


def _complete(form: str) -> Column:
    """Whether a line is a request in a format: json, pairs, combined or cdn."""
    if form == "json":
        return F.ltrim(_v()).startswith("{") & _json(_v())[BAD_JSON].isNull()
    if form == "pairs":
        return _has_all([pair_value(padded(_v()), PAIR_KEYS[n]) for n in PAIR_NEEDED])
    return F.trim(_v()).rlike({"combined": COMBINED, "cdn": CDN}[form])


def broken(df: DataFrame, form: str) -> DataFrame:
    """The lines with text in them that are no request in a format, as they are."""
    return df.filter((F.trim(_v()) != "") & ~F.coalesce(_complete(form), F.lit(False)))


def parse_statistics(df: DataFrame, form: str = "pairs") -> DataFrame:
    """Total, parsed, error and empty lines of a source in one pass."""
    if form == "pairs":  # blanks and fields of a line are worked out once, not once for each search and each test
        df = settled(df, {"_line": padded(_v()), "_empty": F.trim(_v()) == ""}, [])
        df = settled(df, {f"_{n}": pair_value(F.col("_line"), PAIR_KEYS[n]) for n in PAIR_NEEDED}, ["_empty"])
        parts = settled(df, {"_complete": _has_all([F.col(f"_{n}") for n in PAIR_NEEDED])}, ["_empty"])
    else:
        parts = settled(df, {"_complete": F.coalesce(_complete(form), F.lit(False)), "_empty": F.trim(_v()) == ""}, [])
    complete, empty = F.col("_complete"), F.col("_empty")
    out = parts.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(complete).alias("parsed"),
        F.count_if(~complete & ~empty).alias("errors"),
        F.count_if(empty).alias("empty"),
    )
    return out.withColumn("success_rate", F.col("parsed") / F.col("total"))


# ---------------------------------------------------------------- the same formats, written


def as_json(df: DataFrame) -> DataFrame:
    """Request rows as JSON lines (seconds with three decimals)."""

    def seconds(name: str) -> Column:
        return (F.col(name) / 1000).cast("decimal(20,3)")

    line = F.to_json(
        F.struct(
            F.date_format("log_time", "yyyy-MM-dd'T'HH:mm:ss'+08:00'").alias("time"),
            "client_ip", "request_method", "request_uri", "status",
            F.col("body_bytes").alias("body_bytes_sent"),
            F.col("sent_bytes").alias("bytes_sent"),
            seconds("duration_ms").alias("request_time"),
            seconds("connect_ms").alias("upstream_connect_time"),
            seconds("header_ms").alias("upstream_header_time"),
            seconds("response_ms").alias("upstream_response_time"),
            "user_agent", "referer", "server_name", "upstream_addr",
        )
    )
    return df.withColumn("value", line)


def as_pairs(df: DataFrame) -> DataFrame:
    def part(key: str, value: Column) -> Column:
        return F.concat(F.lit(f' {key}:"'), value.cast("string"), F.lit('"'))

    line = F.concat(
        F.lit("http_host:"),
        F.col("server_name"),
        part("remote_addr", F.col("client_ip")),
        part("ar_time", (F.col("duration_ms") / 1000).cast("decimal(20,3)")),
        part("time", F.date_format("log_time", "yyyy-MM-dd'T'HH:mm:ss'+08:00'")),
        part("request", F.concat_ws(" ", "request_method", F.replace("request_uri", F.lit(" "), F.lit("+")), F.lit("HTTP/1.1"))),
        part("code", F.col("status")),
        part("body", F.col("body_bytes")),
        part("http_referer", F.col("referer")),
        part("RealIp", F.col("client_ip")),
        part("agent", F.col("user_agent")),
    )
    return df.withColumn("value", line)


def as_combined(df: DataFrame) -> DataFrame:
    line = F.format_string(
        '%s - - [%s +0800] "%s %s HTTP/1.1" %s %d "%s" "%s"',
        "client_ip",
        F.date_format("log_time", "dd/MMM/yyyy:HH:mm:ss"),
        "request_method",
        F.replace("request_uri", F.lit(" "), F.lit("+")),
        "status", "body_bytes", "referer", "user_agent",
    )
    return df.withColumn("value", line)


def as_cdn(df: DataFrame) -> DataFrame:
    line = F.format_string(
        '[%s +0800] %s - %d "%s" "%s https://%s%s" %s 512 %d HIT "%s" "text/html" 198.51.100.4',
        F.date_format("log_time", "d/MMM/yyyy:HH:mm:ss"),
        "client_ip", "duration_ms", "referer", "request_method", "server_name",
        F.replace("request_uri", F.lit(" "), F.lit("+")),
        "status", "body_bytes", "user_agent",
    )
    return df.withColumn("value", line)
