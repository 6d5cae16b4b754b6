"""Rule helpers and classification ladders, with boundary rows."""

import re

import pytest
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.catalog.base import AGENTS, REFERERS, URIS
from hitlens.functions import agent, business, clock, network, quality, referer, security, status, timing, uri
from hitlens.rules import _alternatives, _literals, found

TEXTS = [t.lower() for t in AGENTS + REFERERS + URIS] + [
    "ios 15", "android 9.", "linux x android", "cfnetwork/1 darwin/2", "se 2.x metasr", "a.css", "css", "/", "x/home",
    "windows nt 6.1", "macintosh; intel mac os x", "cpu os 9 like mac os x", "or x = y or z", ";drop table", "1 union all select 2",
]
PATTERNS = sorted(
    {p for rules in (K.PLATFORM, K.OPERATING_SYSTEM, K.BROWSER, K.DEVICE, K.BOT, K.SEARCH_ENGINE, K.SOCIAL_NETWORK,
                     K.DOMAIN_SEARCH, K.API_CATEGORY, K.RESOURCE_TYPE, K.CONTENT_TYPE, K.OPERATION, K.JOURNEY_STAGE,
                     K.WORD_DOMAIN, K.PATH_CLASS, K.ENTRY_SOURCE, K.AGENT_RISK) for _, p in rules}
    | {K.SQL_INJECTION, K.CROSS_SITE, K.ATTACK_PATH} | {p for _, p, _ in K.THREATS}
)


def one(spark, expression, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expression.alias("x")).first()["x"]


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()
    return [r["x"] for r in rows]


def test_found_equals_rlike(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    cols = [(found(F.col("t"), p) == F.col("t").rlike(p)).alias(f"p{i}") for i, p in enumerate(PATTERNS)]
    for row in df.select("t", *cols).collect():
        for i, p in enumerate(PATTERNS):
            assert row[f"p{i}"], (row["t"], p)


@pytest.mark.parametrize(
    "part, runs, plain",
    [("curl", ["curl"], True), (r"so\.com", ["so.com"], True), (r"android \d+\.", ["android ", "."], False),
     ("yahoo.*slurp", ["yahoo", "slurp"], False), ("woff2?", ["woff"], False), (r"chrome/(\d+)", ["chrome/"], False)],
)
def test_literals(part, runs, plain):
    assert _literals(part) == (runs, plain)


def test_alternatives():
    assert _alternatives(r"(a|b(c|d)|[|]x|e\|f)") == ["a", "b(c|d)", "[|]x", r"e\|f"]


def test_platform_priority(spark):
    expected = {
        "WST-SDK-iOS 1.0.0": "iOS_SDK",
        "zgt-ios/1.4.2 (iPhone; iOS 18.5; Scale/3.00)": "iOS_SDK",
        "WST-SDK-ANDROID 1.0.0": "Android_SDK",
        "Mozilla/5.0 (Linux; Android 11; V2164A Build/RP1A)": "Android",
        "Dalvik/2.1.0 (Linux; U; Android 11; V2164A)": "Android",
        "YisouSpider/1.0": "Bot/Spider",
        "okhttp/4": "HTTP_Client",
        "": "Unknown",
        "something": "Other",
    }
    assert column(spark, list(expected), agent.platform) == list(expected.values())


def test_versions(spark):
    assert one(spark, agent.platform_version(F.col("a"), F.col("p")), a="zgt-ios/1.4.2 (iPhone)", p="iOS_SDK") == "1.4.2"
    assert one(spark, agent.platform_version(F.col("a"), F.col("p")), a="x iOS 15_4", p="iOS") == "15.4"
    assert one(spark, agent.browser(F.col("a")), a="Mozilla Chrome/120.0") == "chrome 120"
    assert one(spark, agent.browser(F.col("a")), a="SE 2.X MetaSr") == "搜狗浏览器"
    assert one(spark, agent.sdk_type(F.col("a")), a="App iGXRZ/2") == "GOV-iGXRZ"


def test_latency_ladders(spark):
    ms = [0, 100, 101, 200, 201, 500, 501, 1000, 1001, 3000, 3001, 10000, 10001, 30000, 30001]
    assert column(spark, ms, timing.performance_level, "long") == [1, 1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 6]
    assert column(spark, ms, timing.performance_score, "long") == [
        100.0, 95.0, 85.0, 85.0, 85.0, 85.0, 70.0, 70.0, 50.0, 50.0, 30.0, 30.0, 10.0, 10.0, 10.0]
    assert column(spark, [9, 10, 3000, 3001], timing.cache_status, "long") == ["HIT", "BYPASS", "BYPASS", "MISS"]
    assert column(spark, [500, 501, 2000, 2001], timing.apdex_class, "long") == [
        "Satisfied", "Tolerating", "Tolerating", "Frustrated"]


def test_status_rules(spark):
    codes = ["199", "200", "204", "302", "399", "400", "404", "429", "499", "500", "503", "-", ""]
    assert column(spark, codes, status.error_group) == [
        "", "", "", "", "", "4xx_client", "4xx_client", "4xx_client", "4xx_client", "5xx_server", "5xx_server", "", ""]
    assert column(spark, codes, lambda s: status.success(s, "below_400")) == [
        False, True, True, True, True, False, False, False, False, False, False, False, False]
    assert column(spark, codes, status.status_class)[-2:] == ["unknown", "unknown"]


def test_ip_kinds(spark):
    expected = {
        "10.1.2.3": "内网IP", "172.15.0.1": "公网IP", "172.16.0.1": "内网IP", "172.31.9.9": "内网IP", "172.32.0.1": "公网IP",
        "192.168.0.1": "内网IP", "127.0.0.1": "内网IP", "224.0.0.1": "组播IP", "8.8.8.8": "公网IP", "::1": "内网IP",
        "2001:db9::1": "公网IP", "abc": "无效IP", "1.2.3": "无效IP", "300.1.1.1": "无效IP", "": "无效IP",
    }
    assert column(spark, list(expected), network.ip_kind) == list(expected.values())


def test_uri_rules(spark):
    assert column(spark, ["/a/12/b", "/a/0123abcd9", "/x/v2/y", "/a?b=1"], uri.grouping_path) == [
        "/a/{id}/b", "/a/{id}abcd9", "/x/v2/y".replace("v2", "v{n}"), "/a"]
    assert one(spark, uri.masked(F.col("u")), u="/api/user/login?username=test&password=123") == "/api/user/login?username=***&password=***"
    assert column(spark, ["GET", "", "GET /a", "GET /a HTTP/1.1"], lambda r: F.array(*uri.request_parts(r))) == [
        ["GET", "", ""], ["", "", ""], ["GET", "/a", ""], ["GET", "/a", "HTTP/1.1"]]
    assert column(spark, ["/api/x/y", "/a/b", "/", "/api"], uri.service_of) == ["x", "a", "", "api"]


def test_referer_rules(spark):
    assert one(spark, referer.search_keywords(F.col("r")), r="https://www.baidu.com/s?wd=%E5%85%AC%E7%A7%AF&x=1") == "公积"
    assert column(spark, ["-", "", "https://mp.weixin.qq.com/a", "https://www.google.com/x", "foo"], referer.entry_source) == [
        "Direct", "Direct", "Internal", "Search_Engine", "Unknown"]
    assert one(spark, referer.domain(F.col("r")), r="http://www.a.com:8080/x") == "a.com:8080"


def test_time_classes(spark):
    hours = [0, 5, 6, 8, 9, 11, 12, 13, 14, 16, 17, 18, 19, 21, 22, 23]
    assert column(spark, hours, clock.day_period, "int") == [
        "Dawn", "Dawn", "EarlyMorning", "EarlyMorning", "Morning", "Morning", "Noon", "Noon", "Afternoon", "Afternoon",
        "EarlyEvening", "EarlyEvening", "Evening", "Evening", "Night", "Night"]
    assert one(spark, clock.wall_clock(F.col("t")).cast("string"), t="2025-04-23T00:00:02+08:00") == "2025-04-23 00:00:02"
    assert one(spark, clock.wall_clock(F.col("t")), t="yesterday") is None


def test_security_and_quality(spark):
    t = security.threats(F.col("u"), F.col("p"), F.col("a"))
    hits = one(spark, t, u="/a/../b", p="x=<script>", a="short")
    assert [h["type"] for h in hits] == ["xss", "path_traversal", "suspicious_ua"]
    assert one(spark, security.threat_score(t), u="/a/../b", p="x=<script>", a="short") == 100
    assert column(spark, [19, 20, 40, 60, 80], security.risk_level, "int") == ["none", "low", "medium", "high", "critical"]
    found_issues = quality.issues({"client_ip": F.col("ip")}, F.col("d"), F.col("b"))
    assert one(spark, found_issues, ip="", d=60001, b=0) == ["missing_client_ip", "excessive_duration"]
    assert one(spark, quality.unit_score([F.col("a")], F.col("d"), F.col("s")), a="x", d=-1.0, s="999") == 0.8


def test_value_score(spark):
    score = business.value_score(F.col("d"), F.col("g"), F.col("s"), F.col("c"), F.col("ms"))
    base = dict(d="government-authentication", g="auth", s="gxrz-rest", c="200", ms=100)
    assert one(spark, score, **base) == 100
    assert one(spark, score, **{**base, "c": "500", "ms": 6000}) == 40
    assert one(spark, score, **{**base, "d": "general-service", "g": "static", "s": "x", "c": "404", "ms": 600}) == 14


def test_legacy_speed_scale(spark):
    args = [F.col(n) for n in ("d", "c", "h", "r", "b", "s")]
    values = dict(d=1000, c=100, h=200, r=700, b=102400, s=204800)
    right = one(spark, timing.lifecycle(*args)["response_speed"], **values)
    legacy = one(spark, timing.lifecycle(*args, legacy_scale=True)["response_speed"], **values)
    assert right == 200.0 and legacy == 20000.0


def test_patterns_compile():
    for p in PATTERNS:
        re.compile(p)
