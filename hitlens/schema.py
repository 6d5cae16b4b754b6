"""Canonical request schema, thresholds and the boundary helper for other column names.

All durations are integer milliseconds, sizes are bytes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HIT_SCHEMA = T.StructType(
    [
        T.StructField("log_time", T.TimestampType()),
        T.StructField("client_ip", T.StringType()),
        T.StructField("request_method", T.StringType()),
        T.StructField("request_uri", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("connect_ms", T.LongType()),
        T.StructField("header_ms", T.LongType()),
        T.StructField("response_ms", T.LongType()),
        T.StructField("body_bytes", T.LongType()),
        T.StructField("sent_bytes", T.LongType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("referer", T.StringType()),
        T.StructField("server_name", T.StringType()),
        T.StructField("upstream_addr", T.StringType()),
    ]
)

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("cluster", T.StringType()),
        T.StructField("instance", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# --- fixed values: names other sources use for the canonical columns
COLUMN_ALIASES = {
    "log_time": ["log_time", "time", "timestamp", "raw_time"],
    "client_ip": ["client_ip", "client_ip_address", "RealIp", "remote_addr"],
    "request_method": ["request_method", "http_method", "method"],
    "request_uri": ["request_uri", "request_full_uri", "uri", "request_path"],
    "status": ["status", "response_status_code", "code", "status_code"],
    "duration_ms": ["duration_ms", "total_request_duration_ms", "response_time"],
    "body_bytes": ["body_bytes", "response_body_size", "body_bytes_sent", "body"],
    "user_agent": ["user_agent", "user_agent_string", "http_user_agent", "agent"],
    "referer": ["referer", "referer_url", "http_referer"],
}


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs in ms and percent; every report takes them as a parameter."""

    slow_ms: int = 3000
    slow_share: float = 10.0
    apdex_ms: int = 1500
    apdex_tolerated_ms: int = 6000
    row_apdex_ms: int = 500
    row_apdex_tolerated_ms: int = 2000
    error_rate: float = 5.0
    min_requests: int = 100


DEFAULTS = Thresholds()


def resolve_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate name that exists, else None."""
    have = set(columns)
    return next((name for name in candidates if name in have), None)


def canonical(df: DataFrame, aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES) -> DataFrame:
    """Rename known foreign names to the canonical ones; unknown columns pass through."""
    out = df
    for target, candidates in aliases.items():
        found = resolve_column(out.columns, candidates)
        if found is not None and found != target:
            out = out.withColumnRenamed(found, target)
    return out


def coerce(df: DataFrame, schema: T.StructType = HIT_SCHEMA) -> DataFrame:
    """Cast to ``schema`` without failing: bad numbers become 0, missing columns get defaults."""
    have = set(df.columns)
    cols = []
    for field in schema:
        kind = field.dataType
        value = F.col(field.name) if field.name in have else F.lit(None)
        if isinstance(kind, T.IntegralType):
            value = F.coalesce(value.try_cast("double").cast(kind), F.lit(0).cast(kind))
        elif isinstance(kind, T.FractionalType):
            value = F.coalesce(value.try_cast(kind), F.lit(0.0).cast(kind))
        elif isinstance(kind, T.StringType):
            value = F.coalesce(value.cast("string"), F.lit(""))
        else:
            value = value.try_cast(kind)
        cols.append(value.alias(field.name))
    return df.select(*cols)
