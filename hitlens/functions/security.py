"""Attack patterns, risk scores and request trust."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.rules import descend, found, lowered_text


def sql_injection(uri: Column | str, *, lowered: bool = False) -> Column:
    return F.coalesce(found(lowered_text(uri, lowered), K.SQL_INJECTION), F.lit(False))


def cross_site(uri: Column | str, *, lowered: bool = False) -> Column:
    return F.coalesce(found(lowered_text(uri, lowered), K.CROSS_SITE), F.lit(False))


def threats(uri: Column, params: Column, agent: Column) -> Column:
    """Array of (type, score, signature) for every family found, agent length last."""
    text = F.lower(F.concat(uri, F.lit(" "), params))
    hits = [
        F.when(
            found(text, pattern),
            F.struct(F.lit(name).alias("type"), F.lit(score).alias("score"), F.lit(pattern).alias("signature")),
        )
        for name, pattern, score in K.THREATS
    ]
    size = F.length(agent)
    odd_agent = F.when(
        (size > 500) | (size < 10),
        F.struct(
            F.lit("suspicious_ua").alias("type"),
            F.lit(20).alias("score"),
            F.concat(F.lit("ua_length:"), size).alias("signature"),
        ),
    )
    return F.array_compact(F.array(*hits, odd_agent))


def threat_score(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0), lambda acc, t: acc + t["score"])


def raw_risk(tor: Column, vpn: Column, datacenter: Column, injection: Column, script: Column) -> Column:
    """Unclipped sum: Tor 30, VPN 20, data centre 10, SQL injection 50 else cross-site script 40."""
    attack = F.when(injection, 50).when(script, 40).otherwise(0)
    return (
        F.when(tor, 30).otherwise(0) + F.when(vpn, 20).otherwise(0) + F.when(datacenter, 10).otherwise(0) + attack
    )


def risk_level(score: Column) -> Column:
    return descend(score, [(80, "critical"), (60, "high"), (40, "medium"), (20, "low")], "none", strict=False)


def complexity(uri: Column, agent: Column) -> Column:
    """0-1 from URI length, query, depth, agent length and tool words."""

    def count(text: Column, pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    tool = F.when(F.lower(agent).rlike("script|tool|api|client"), 0.2).otherwise(0.0)
    total = (
        F.least(F.length(uri) / F.lit(200.0), F.lit(0.3))
        + F.least(count(uri, r"\?") * 0.1, F.lit(0.1))
        + F.least(count(uri, "/") * 0.05, F.lit(0.2))
        + F.least(F.length(agent) / F.lit(500.0), F.lit(0.2))
        + tool
    )
    return F.least(total, F.lit(1.0))


def trust(uri: Column, agent: Column, referer: Column) -> Column:
    """0-1: search referers and browsers raise it, tools and odd paths lower it."""

    def points(test: Column, value: float) -> Column:
        return F.when(test, F.lit(value)).otherwise(F.lit(0.0))

    total = (
        F.lit(0.5)
        + points(F.lower(referer).rlike("google|baidu"), 0.2)
        + points(F.lower(agent).rlike("chrome|firefox|safari|edge"), 0.2)
        + points(uri.rlike(r"\.gov|政府"), 0.1)
        - points(F.lower(uri).rlike(r"admin|config|\.env|backup"), 0.3)
        - points(F.lower(agent).rlike("curl|wget|python|script"), 0.2)
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))
