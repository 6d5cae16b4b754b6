"""Where a request came from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.rules import column, first_match, lookup, lowered_text, present


def authority(referer: Column) -> Column:
    """Host with port, NULL if the referer is absent or no URL."""
    found = F.regexp_extract(referer, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    return F.when(found != "", found)


def domain(referer: Column) -> Column:
    return F.regexp_replace(authority(referer), r"^www\.", "")


def search_engine(referer: Column | str, *, lowered: bool = False) -> Column:
    return first_match(lowered_text(referer, lowered), K.SEARCH_ENGINE, None)


def social_network(referer: Column | str, *, lowered: bool = False) -> Column:
    return first_match(lowered_text(referer, lowered), K.SOCIAL_NETWORK, None)


def domain_search(referer: Column) -> Column:
    """Search engine by domain only, NULL if none."""
    return first_match(F.lower(authority(referer)), K.DOMAIN_SEARCH, None)


def domain_social(referer: Column) -> Column:
    return first_match(F.lower(authority(referer)), K.DOMAIN_SOCIAL, None)


def social_kind(network: Column) -> Column:
    return F.when(network.isNotNull(), lookup(network, K.SOCIAL_KIND, "social_network"))


def search_keywords(referer: Column) -> Column:
    """Decoded value of the first search parameter present, NULL if none."""
    q = F.regexp_extract(referer, r"\?([^#]*)", 1)
    raw = F.coalesce(
        *[
            F.nullif(F.regexp_extract(q, rf"(?:^|&){name}=([^&]*)", 1), F.lit(""))
            for name in K.SEARCH_PARAMETERS
        ]
    )
    return F.coalesce(F.try_url_decode(raw), raw)


def entry_source(referer: Column | str, *, lowered: bool = False) -> Column:
    """Internal, Search_Engine, Social_Media, Direct, External or Unknown by keyword."""
    return F.when(present(column(referer)).isNull(), F.lit("Direct")).otherwise(
        first_match(lowered_text(referer, lowered), K.ENTRY_SOURCE, "Unknown")
    )


def entry_kind(referer: Column) -> Column:
    """Direct, Search, Social, Government or Referral by domain."""
    return (
        F.when(present(referer).isNull(), F.lit("Direct"))
        .when(domain_search(referer).isNotNull(), F.lit("Search"))
        .when(domain_social(referer).isNotNull(), F.lit("Social"))
        .when(F.lower(authority(referer)).contains("gov.cn"), F.lit("Government"))
        .otherwise(F.lit("Referral"))
    )


def traffic_source(referer: Column) -> Column:
    return (
        F.when(present(referer).isNull(), F.lit("direct"))
        .when(domain_search(referer).isNotNull(), F.lit("organic"))
        .when(domain_social(referer).isNotNull(), F.lit("social"))
        .when(referer.contains("utm_"), F.lit("paid"))
        .otherwise(F.lit("referral"))
    )


def domain_type(referer: Column) -> Column:
    host = F.lower(authority(referer))
    return (
        F.when(host.isNull(), F.lit("unknown"))
        .when(host.contains("gov.cn"), F.lit("government"))
        .when(host.rlike(r"edu\.cn|\.edu"), F.lit("education"))
        .when(domain_search(referer).isNotNull(), F.lit("search"))
        .when(domain_social(referer).isNotNull(), F.lit("social"))
        .when(host.rlike("news|xinhua|people|cctv"), F.lit("news"))
        .otherwise(F.lit("general"))
    )


def compact(referer: Column, agent: Column) -> dict[str, Column]:
    """The compact class scheme: entry source (crawlers apart), search engine, social network."""
    text = F.lower(referer)
    crawler = first_match(F.lower(agent), K.COMPACT_BOT, None).isNotNull()
    return {
        "entry": F.when(present(referer).isNull() & crawler, F.lit("Bot"))
        .when(present(referer).isNull(), F.lit("Direct"))
        .otherwise(first_match(text, K.COMPACT_ENTRY, "External")),
        "engine": first_match(text, K.COMPACT_SEARCH, ""),
        "network": first_match(text, K.COMPACT_SOCIAL, ""),
    }
