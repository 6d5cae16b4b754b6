"""Business meaning of a request, from its URI structure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.rules import first_match, lookup, lowered_text


def api_group(app: Column, service: Column, static: Column) -> Column:
    """auth / payment / government / gateway / webapp / storage / static / service."""
    gateway = (
        F.when(service == K.IDENTITY_SERVICE, F.lit("auth"))
        .when(service == K.PAY_SERVICE, F.lit("payment"))
        .when(service == K.PORTAL_SERVICE, F.lit("government"))
        .otherwise(F.lit("gateway"))
    )
    return (
        F.when(static, F.lit("static"))
        .when(app == K.GATEWAY_APP, gateway)
        .when(app == K.PORTAL_APP, F.lit("webapp"))
        .when(app == K.STORE_APP, F.lit("storage"))
        .otherwise(F.lit("service"))
    )


def domain(app: Column, service: Column, module: Column, *, word: Column | str | None = None, words: Column | str | None = None) -> Column:
    """Business domain. ``word`` and ``words``, the lower-cased module and ``app/service/module``, are read once
    per rule; a caller may pass them as columns."""
    word = F.lower(module) if word is None else word
    words = F.lower(F.concat_ws("/", app, service, module)) if words is None else words
    gateway = (
        F.when(service == K.IDENTITY_SERVICE, first_match(word, K.IDENTITY_DOMAIN, "government-identity-service"))
        .when(service == K.PORTAL_SERVICE, first_match(word, K.PORTAL_DOMAIN, "government-portal-service"))
        .otherwise(lookup(service, K.GATEWAY_DOMAIN, "government-gateway-service"))
    )
    portal = (
        F.when(service.isin(K.H5_ASSETS), F.lit("government-static-assets"))
        .when(service == "pages", F.lit("government-h5-pages"))
        .otherwise(F.lit("government-h5-service"))
    )
    return (
        F.when(app == K.GATEWAY_APP, gateway)
        .when(app == K.PORTAL_APP, portal)
        .when(app == K.STORE_APP, F.lit("government-file-storage"))
        .otherwise(first_match(words, K.WORD_DOMAIN, "general-service"))
    )


def functional_area(app: Column, static: Column) -> Column:
    return (
        F.when(static, F.lit("frontend"))
        .when(app.contains("gateway"), F.lit("middleware"))
        .when(app.contains("api"), F.lit("backend"))
        .otherwise(F.lit("service"))
    )


def service_tier(app: Column, service: Column, static: Column) -> Column:
    return (
        F.when(static, F.lit("web"))
        .when(app.contains("gateway"), F.lit("api"))
        .when(service.contains("service"), F.lit("service"))
        .otherwise(F.lit("data"))
    )


def value_score(domain_: Column, group: Column, service: Column, status: Column, duration_ms: Column) -> Column:
    """Business value 1-100; every weighting step truncates to an integer."""
    official = F.lit(60) + lookup(domain_, K.DOMAIN_BONUS, 0)
    score = F.when(domain_.contains("government"), official).otherwise(lookup(group, K.CATEGORY_WEIGHT, 50))
    score = F.when(
        service.isin(K.IDENTITY_SERVICE, K.PORTAL_SERVICE), F.least(F.lit(100), score + 15)
    ).otherwise(score)
    status_weight = (
        F.when(status.startswith("2"), F.lit(1.1))
        .when(status.startswith("4"), F.lit(0.7))
        .when(status.startswith("5"), F.lit(0.5))
        .otherwise(F.lit(1.0))
    )
    score = (score * status_weight).cast("int")
    speed_weight = F.when(duration_ms < 500, F.lit(1.2)).when(duration_ms > 5000, F.lit(0.8)).otherwise(F.lit(1.0))
    score = (score * speed_weight).cast("int")
    return F.least(F.lit(100), F.greatest(F.lit(1), score))


def importance(service: Column, module: Column, static: Column) -> Column:
    return (
        F.when(service.rlike("gxrz-rest|alipay|payment"), F.lit("critical"))
        .when(F.lower(module).rlike("user|auth|order"), F.lit("important"))
        .when(static, F.lit("optional"))
        .otherwise(F.lit("normal"))
    )


def criticality(importance_: Column) -> Column:
    table = {"critical": "mission_critical", "important": "business_critical", "normal": "important"}
    return lookup(importance_, table, "standard")


def small_value_score(importance_: Column, duration_ms: Column) -> Column:
    """The 1-10 variant: importance sets the base, the fastest gain 1, the slowest lose 1."""
    base = lookup(importance_, {"critical": 9, "important": 7, "normal": 5}, 3)
    step = F.when(duration_ms <= 100, F.lit(1)).when(duration_ms > 10000, F.lit(-1)).otherwise(F.lit(0))
    return F.least(F.lit(10), F.greatest(F.lit(1), base + step))


def revenue_impact(service: Column) -> Column:
    return first_match(service, [("high", "alipay|payment"), ("medium", "order")], "low")


def customer_impact(service: Column, static: Column) -> Column:
    return (
        F.when(static, F.lit("low")).when(service.rlike("user|auth"), F.lit("high")).otherwise(F.lit("medium"))
    )


def integration_pattern(app: Column, static: Column) -> Column:
    return (
        F.when(app.contains("gateway"), F.lit("gateway")).when(static, F.lit("direct")).otherwise(F.lit("mesh"))
    )


def environment(server: Column | str, *, lowered: bool = False) -> Column:
    return first_match(lowered_text(server, lowered), K.ENVIRONMENT, "prod")


def tenant(server: Column | str, *, lowered: bool = False) -> Column:
    return first_match(lowered_text(server, lowered), K.TENANT, "government")


def entry_point(server: Column | str, *, lowered: bool = False) -> Column:
    return first_match(lowered_text(server, lowered), K.ENTRY_POINT, "direct")


def team(server: Column, domain_: Column) -> Column:
    """Team behind a government site, ``default`` for others."""
    government = server.contains(".gov.cn") | domain_.contains("government")
    return F.when(F.coalesce(government, F.lit(False)), first_match(server, K.TEAM, "central_gov")).otherwise(F.lit("default"))
