"""Client software from the user agent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.rules import column, first_match, found, lowered_text


def _unless_empty(agent: Column | str, label: str, value: Column) -> Column:
    agent = column(agent)
    return F.when(agent.isNull() | (agent == ""), F.lit(label)).otherwise(value)


def platform(agent: Column | str, rules=K.PLATFORM, *, lowered: bool = False) -> Column:
    return _unless_empty(agent, "Unknown", first_match(lowered_text(agent, lowered), rules, "Other"))


def operating_system(agent: Column | str, *, lowered: bool = False) -> Column:
    return _unless_empty(agent, K.NO_SYSTEM, first_match(lowered_text(agent, lowered), K.OPERATING_SYSTEM, K.OTHER_SYSTEM))


def device(agent: Column | str, *, lowered: bool = False) -> Column:
    return _unless_empty(agent, K.NO_DEVICE, first_match(lowered_text(agent, lowered), K.DEVICE, K.DESKTOP))


def bot(agent: Column | str, *, lowered: bool = False) -> Column:
    """Crawler family, NULL for people."""
    return first_match(lowered_text(agent, lowered), K.BOT, None)


def is_bot(agent: Column | str, *, lowered: bool = False) -> Column:
    return F.coalesce(found(lowered_text(agent, lowered), r"bot|crawler|spider|scraper"), F.lit(False))


def browser(agent: Column) -> Column:
    """Browser name, with its major version where the pattern captures one."""
    text = F.lower(agent)
    out = None
    for name, pattern in K.BROWSER:
        value = F.lit(name)
        if "(" in pattern:
            value = F.concat(F.lit(name + " "), F.regexp_extract(text, pattern, 1))
        test = text.rlike(pattern)
        out = F.when(test, value) if out is None else out.when(test, value)
    return _unless_empty(agent, K.NO_BROWSER, out.otherwise(F.lit(K.OTHER_BROWSER)))


def browser_name(agent: Column | str, *, lowered: bool = False) -> Column:
    return _unless_empty(agent, K.NO_BROWSER, first_match(lowered_text(agent, lowered), K.BROWSER, K.OTHER_BROWSER))


def family(agent: Column) -> Column:
    """Tool family, else the first 50 characters."""
    short = F.concat(F.substring(agent, 1, 50), F.when(F.length(agent) > 50, F.lit("...")).otherwise(F.lit("")))
    return F.coalesce(first_match(F.lower(agent), K.AGENT_FAMILY, None), short)


def platform_version(agent: Column, platform_: Column) -> Column:
    """SDK or OS version for the platforms that state one, else NULL."""
    sdk = F.regexp_extract(agent, r"zgt-ios/([0-9.]+)", 1)
    ios = F.translate(F.regexp_extract(agent, r"iOS ([0-9_.]+)", 1), "_", ".")
    android = F.regexp_extract(agent, r"Android ([0-9.]+)", 1)
    found = F.when(platform_ == "iOS_SDK", sdk).when(platform_ == "iOS", ios).when(platform_ == "Android", android)
    return F.when(found != "", found)


def os_version(agent: Column) -> Column:
    """Version of the mobile system as the agent states it, empty if none."""
    android = F.regexp_extract(agent, r"(?i)android\s+([0-9.]+)", 1)
    ios = F.translate(F.regexp_extract(agent, r"(?i)os\s+([0-9_]+)", 1), "_", ".")
    low = F.lower(agent)
    return F.when(low.contains("android"), android).when(low.contains("iphone") | low.contains("ipad"), ios).otherwise(F.lit(""))


def platform_category(agent: Column) -> Column:
    """miniprogram, mobile, tablet, bot or desktop."""
    low = F.lower(agent)
    mini = low.contains("alipayclient") & low.rlike("miniprogram|ariver") | low.contains("micromessenger") & low.contains("miniprogram")
    return (
        F.when(mini, F.lit("miniprogram"))
        .when(low.contains("android") | low.contains("iphone"), F.lit("mobile"))
        .when(low.contains("ipad"), F.lit("tablet"))
        .when(is_bot(low, lowered=True), F.lit("bot"))
        .otherwise(F.lit("desktop"))
    )


def sdk_type(agent: Column) -> Column:
    """Official SDK or government app behind the request, empty if none."""
    sdk = F.upper(F.regexp_extract(agent, r"(?i)WST-SDK-(iOS|Android)", 1))
    app = F.upper(F.regexp_extract(agent, r"(?i)zgt-(ios|android)", 1))
    out = F.when(sdk != "", F.concat(F.lit("WST-SDK-"), sdk)).when(app != "", F.concat(F.lit("ZGT-"), app))
    for name in K.GOVERNMENT_APPS:
        out = out.when(F.lower(agent).contains(name.lower()), F.lit(f"GOV-{name}"))
    return out.otherwise(F.lit(""))


def sdk_version(agent: Column) -> Column:
    return F.regexp_extract(agent, r"(?i)WST-SDK-(?:iOS|Android)/([0-9.]+)", 1)


def app_version(agent: Column) -> Column:
    return F.regexp_extract(agent, r"(?i)zgt-(?:ios|android)[/\s]?([0-9.]+)", 1)


def risk_level(agent: Column) -> Column:
    return first_match(F.lower(agent), K.AGENT_RISK, "normal")


def access_type(sdk: Column, platform_: Column, browser_: Column, bot_: Column) -> Column:
    known = ~browser_.isin(K.NO_BROWSER, K.OTHER_BROWSER)
    return (
        F.when(sdk != "", F.lit("APP_Native"))
        .when(platform_.isin("iOS", "Android") & known, F.lit("H5_WebView"))
        .when(platform_.isin("iOS", "Android"), F.lit("APP_Native"))
        .when(known, F.lit("Browser"))
        .when(bot_, F.lit("Bot"))
        .otherwise(F.lit("API"))
    )


def client_category(bot_: Column, device_: Column, sdk: Column) -> Column:
    return (
        F.when(bot_, F.lit("Bot"))
        .when(device_ == "手机", F.lit("Mobile_App"))
        .when(device_ == K.DESKTOP, F.lit("Desktop_Web"))
        .when(sdk != "", F.lit("SDK_Client"))
        .otherwise(F.lit("Unknown"))
    )


def client_type(bot_: Column, sdk: Column) -> Column:
    return F.when(sdk != "", F.lit("official")).when(bot_, F.lit("automated")).otherwise(F.lit("standard"))


def client_class(internal: Column, bot_: Column, sdk: Column) -> Column:
    return (
        F.when(internal, F.lit("trusted"))
        .when(bot_, F.lit("unverified"))
        .when(sdk != "", F.lit("verified"))
        .otherwise(F.lit("standard"))
    )


def channel(platform_: Column) -> Column:
    return (
        F.when(platform_.isin("iOS", "Android"), F.lit("official"))
        .when(platform_ == "Bot/Spider", F.lit("automated"))
        .otherwise(F.lit("web"))
    )


def compact(agent: Column) -> dict[str, Column]:
    """The compact class scheme: platform, device, browser, system, bot kind and version."""
    text = F.lower(agent)
    browser_ = (
        F.when(text.contains("chrome") & ~text.contains("edg"), F.lit("Chrome"))
        .when(text.contains("firefox"), F.lit("Firefox"))
        .when(text.contains("safari") & ~text.contains("chrome"), F.lit("Safari"))
        .when(text.contains("edg"), F.lit("Edge"))
        .when(text.contains("opera"), F.lit("Opera"))
        .otherwise(F.lit("Other"))
    )
    versions = [r"OS (\d+[_\.]\d+)", r"Android (\d+\.\d+)", r"Chrome/(\d+\.\d+)"]
    version = F.coalesce(*[F.nullif(F.regexp_extract(agent, v, 1), F.lit("")) for v in versions], F.lit(""))
    return {
        "platform": _unless_empty(agent, "Unknown", first_match(text, K.COMPACT_PLATFORM, "Other")),
        "device": _unless_empty(agent, "Unknown", first_match(text, K.COMPACT_DEVICE, "Desktop")),
        "browser": _unless_empty(agent, "Unknown", browser_),
        "system": _unless_empty(agent, "Unknown", first_match(text, K.COMPACT_SYSTEM, "Other")),
        "bot_kind": first_match(text, K.COMPACT_BOT, ""),
        "version": F.translate(version, "_", "."),
    }
