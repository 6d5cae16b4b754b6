"""Request table -> enriched table: every derived column the reports read, as one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.functions import agent, business, clock, identity, network, referer, security, status, timing, uri
from hitlens.schema import DEFAULTS, Thresholds


def enrich(df: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Add derived columns; a report that uses few of them pays for few (column pruning)."""
    c = F.col
    ms = c("duration_ms")
    # shared intermediates: computed once per row, then read as plain columns
    base = df.withColumns(
        {
            "_agent": F.lower("user_agent"),
            "_from": F.lower("referer"),
            "_text": F.lower("request_uri"),
            "_server": F.lower("server_name"),
            "_parts": uri.segments(c("request_uri")),
            "_number": network.ipv4_long(c("client_ip")),
            "is_internal": network.is_internal(c("client_ip")),
        }
    )
    path = uri.structure(c("request_uri"), c("_parts"))
    first = {
        "uri": uri.trimmed_path(c("request_uri")),
        "stat_hour": F.date_trunc("hour", "log_time"),
        "hour": F.hour("log_time"),
        "weekday": F.weekday("log_time") + 1,
        "platform": agent.platform("_agent", lowered=True),
        "device": agent.device("_agent", lowered=True),
        "os": agent.operating_system("_agent", lowered=True),
        "browser": agent.browser_name("_agent", lowered=True),
        "bot_type": agent.bot("_agent", lowered=True),
        "is_bot": agent.is_bot("_agent", lowered=True),
        "sdk_type": agent.sdk_type(c("user_agent")),
        "referer_domain": referer.domain(c("referer")),
        "search_engine": referer.search_engine("_from", lowered=True),
        "social_network": referer.social_network("_from", lowered=True),
        "entry_source": referer.entry_source("_from", lowered=True),
        "application": path["application"],
        "service": path["service"],
        "module": path["module"],
        "is_static": path["is_static"],
        "api_category": uri.api_category(c("request_uri")),
        "operation": uri.operation("_text", lowered=True),
        "journey_stage": uri.journey_stage("_text", lowered=True),
        "is_success": status.success(c("status")),
        "is_error": status.error(c("status")),
        "is_slow": ms > limits.slow_ms,
        "anomaly_type": status.anomaly_type(c("status"), ms, c("body_bytes")),
        "ip_kind": network.ip_kind(c("client_ip"), c("_number")),
        "is_sql_injection": security.sql_injection("_text", lowered=True),
        "is_cross_site": security.cross_site("_text", lowered=True),
        "tenant": business.tenant("_server", lowered=True),
        "environment": business.environment("_server", lowered=True),
        "entry_point": business.entry_point("_server", lowered=True),
        "reputation": network.reputation(c("client_ip")),
        "process_ms": F.greatest(F.lit(0), c("header_ms") - c("connect_ms")),
        "backend_transfer_ms": F.greatest(F.lit(0), c("response_ms") - c("header_ms")),
        "front_ms": F.greatest(F.lit(0), ms - c("response_ms")),
        "performance_level": timing.performance_level(ms),
        "cache_status": timing.cache_status(ms),
        "fingerprint": identity.fingerprint(c("client_ip"), c("user_agent")),
    }
    kind, tier = identity.user_kind(c("sdk_type"))
    second = {
        "is_business_success": c("is_success") & (c("body_bytes") > 0),
        "has_anomaly": c("anomaly_type") != "",
        "network_ms": c("connect_ms") + c("front_ms"),
        "transfer_ms": c("backend_transfer_ms") + c("front_ms"),
        "api_group": business.api_group(c("application"), c("service"), c("is_static")),
        "_word": F.lower("module"),
        "_words": F.lower(F.concat_ws("/", "application", "service", "module")),
        "access_type": agent.access_type(c("sdk_type"), c("platform"), c("browser"), c("is_bot")),
        "client_category": agent.client_category(c("is_bot"), c("device"), c("sdk_type")),
        "client_type": agent.client_type(c("is_bot"), c("sdk_type")),
        "channel": agent.channel(c("platform")),
        "session_id": identity.slot_session(c("fingerprint"), c("log_time")),
        "risk_score": security.raw_risk(
            network.is_tor(c("client_ip")),
            network.is_vpn(c("client_ip")),
            network.is_datacenter(c("client_ip")),
            c("is_sql_injection"),
            c("is_cross_site"),
        ),
        "threat": F.when(c("is_sql_injection"), F.lit("sql_injection"))
        .when(c("is_cross_site"), F.lit("xss"))
        .otherwise(F.lit("")),
        "user_type": kind,
        "user_tier": tier,
    }
    third = {
        "business_domain": business.domain(
            c("application"), c("service"), c("module"), word="_word", words="_words"
        ),
        "risk_level": security.risk_level(c("risk_score")),
    }
    fourth = {
        "value_score": business.value_score(
            c("business_domain"), c("api_group"), c("service"), c("status"), ms
        ),
    }
    out = base.withColumns(first).withColumns(second).withColumns(third).withColumns(fourth)
    return out.drop("_agent", "_from", "_text", "_server", "_parts", "_number", "_word", "_words")


def day_parts(df: DataFrame, ts: str = "log_time") -> DataFrame:
    """Calendar columns and day classes."""
    out = df.withColumns(clock.parts(F.col(ts)))
    return out.withColumns(
        {
            "day_period": clock.day_period(F.col("hour")),
            "business_hours_type": clock.business_hours(F.col("weekday"), F.col("hour")),
            "traffic_pattern": clock.traffic_pattern(F.col("weekday"), F.col("hour")),
        }
    )
