"""Status code classes, success and error definitions, anomalies and SLA."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.rules import lookup


def code(status: Column) -> Column:
    return status.try_cast("int")


def status_class(status: Column) -> Column:
    first = F.substring(status, 1, 1)
    return F.when(first.isin("2", "3", "4", "5"), F.concat(first, F.lit("xx"))).otherwise(F.lit("unknown"))


def error_group(status: Column) -> Column:
    c = code(status)
    return (
        F.when(c.between(400, 499), F.lit("4xx_client"))
        .when(c.between(500, 599), F.lit("5xx_server"))
        .when(c == 0, F.lit("network_error"))
        .otherwise(F.lit(""))
    )


def http_class(status: Column) -> Column:
    table = {"2": "success", "3": "redirection", "4": "client_error", "5": "server_error"}
    return lookup(F.substring(status, 1, 1), table, "unknown")


def severity(status: Column) -> Column:
    c = code(status)
    return F.when(c >= 500, F.lit("critical")).when(c >= 400, F.lit("medium")).otherwise(F.lit("low"))


def error_category(status: Column) -> Column:
    return lookup(status, K.ERROR_CATEGORY, "other")


def error_source(status: Column) -> Column:
    return (
        F.when(status.startswith("4"), F.lit("client"))
        .when(status.isin("502", "504"), F.lit("gateway"))
        .when(status.startswith("5"), F.lit("service"))
        .otherwise(F.lit(""))
    )


def success(status: Column, rule: str = "2xx") -> Column:
    """Success by one of the known definitions: ``200``, ``2xx``, ``below_400`` or ``2xx_3xx``."""
    tests = {
        "200": status == "200",
        "2xx": status.startswith("2"),
        "below_400": code(status).between(200, 399),
        "2xx_3xx": status.rlike("^[23]"),
    }
    return F.coalesce(tests[rule], F.lit(False))


def error(status: Column, rule: str = "4xx_5xx") -> Column:
    """Error: a 4xx/5xx code, or (``not_2xx``) anything that is no success."""
    if rule == "not_2xx":
        return ~success(status)
    return F.coalesce(status.rlike("^[45]"), F.lit(False))


def outcome_flags(status: Column, body: Column) -> dict[str, Column]:
    ok = success(status)
    return {
        "is_success": ok,
        "is_business_success": ok & (body > 0),
        "is_error": ~ok,
        "is_client_error": status.startswith("4"),
        "is_server_error": status.startswith("5"),
    }


_TEN_MB = 10 * 1024 * 1024


def anomaly_type(status: Column, ms: Column, body: Column) -> Column:
    """error, performance, data, or empty when nothing is odd."""
    return (
        F.when(status.startswith("5"), F.lit("error"))
        .when(ms > 10000, F.lit("performance"))
        .when(body > _TEN_MB, F.lit("data"))
        .otherwise(F.lit(""))
    )


def anomaly_kind(status: Column, ms: Column, body: Column) -> Column:
    """timeout, large_response, error_response (slow errors), or empty."""
    return (
        F.when(ms > 30000, F.lit("timeout"))
        .when(body > _TEN_MB, F.lit("large_response"))
        .when(~success(status) & (ms > 10000), F.lit("error_response"))
        .otherwise(F.lit(""))
    )


def anomaly_reason(status: Column, ms: Column, agent: Column, ip: Column) -> Column:
    """First odd thing: minute-long response, server error, huge user agent, no IPv4 form."""
    return (
        F.when(ms > 60000, F.lit("extreme_slow_response"))
        .when(status.isin("500", "502", "503", "504"), F.lit("server_error"))
        .when(F.length(agent) > 1000, F.lit("suspicious_user_agent"))
        .when((ip != "") & (F.size(F.split(ip, r"\.")) != 4), F.lit("invalid_ip_format"))
    )


def anomaly_list(status: Column, ms: Column, body: Column) -> Column:
    """All odd things as an array, graded by size."""
    tests = F.array(
        F.when(ms > 30000, F.lit("超长响应时间")).when(ms > 10000, F.lit("异常响应时间")),
        F.when(body > 5 * _TEN_MB, F.lit("超大响应体")).when(body > _TEN_MB, F.lit("大响应体")),
        F.when(status.startswith("5"), F.lit("服务器错误"))
        .when(status.isin("404", "403"), F.lit("资源访问异常"))
        .when(status == "429", F.lit("频率限制")),
    )
    return F.array_compact(tests)


def sla_violation(status: Column, ms: Column, slow_ms: int = 3000) -> Column:
    """performance, availability, or empty when the request complies."""
    return (
        F.when(ms > slow_ms, F.lit("performance"))
        .when(~success(status), F.lit("availability"))
        .otherwise(F.lit(""))
    )


def anomaly_codes(status: Column, ms: Column, uri: Column, *, slow_ms: int = 5000, long_uri: int = 500) -> Column:
    """Codes of slow answers, over-long URIs and server errors as an array."""
    return F.array_compact(
        F.array(
            F.when(ms > slow_ms, F.lit("slow_response")),
            F.when(F.length(uri) > long_uri, F.lit("suspicious_uri_length")),
            F.when(code(status) >= 500, F.lit("server_error")),
        )
    )
