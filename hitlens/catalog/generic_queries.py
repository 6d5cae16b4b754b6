"""Filters, joins, windows, top-k, set operations, sampling and metric series with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitlens.catalog.base import access, hits, pct, register, table
from hitlens.catalog.reports import A1_SQL, SLOW_SQL
from hitlens.operators import filters, measures, ranking, sampling, sequence
from hitlens.plans import api, insight, metrics, slow
from hitlens.rules import lookup

c = F.col

# ---------------------------------------------------------------- filters


@register("f01_time_range", "SELECT event_id FROM access WHERE log_time >= TIMESTAMP '2024-01-05' AND log_time < TIMESTAMP '2024-01-08'")
def _(spark, sf):
    return filters.between_times(access(spark, sf), "log_time", "2024-01-05", "2024-01-07").select("event_id")


@register("f02_include_list", "SELECT event_id FROM hits WHERE client_ip IN ('10.0.0.10', '8.8.4.3', '45.12.7.5') AND uri IN (SELECT uri FROM hits GROUP BY uri HAVING count(*) > 100)")
def _(spark, sf):
    df = hits(spark, sf)
    busy = filters.at_least(df.groupBy("uri").agg(F.count(F.lit(1)).alias("n")), n=101).select("uri")
    return filters.one_of(filters.one_of(df, "client_ip", ["10.0.0.10", "8.8.4.3", "45.12.7.5"]), "uri", busy).select("event_id")


@register("f03_recent", "SELECT count(*) AS rows, min(log_time) AS oldest FROM access WHERE log_time >= TIMESTAMP '2024-01-30'")
def _(spark, sf):
    df = filters.recent_or_all(access(spark, sf), "log_time", 24, "2024-01-31 00:00:00")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min("log_time").alias("oldest"))


@register("f03_recent_empty_window", "SELECT count(*) AS rows, min(log_time) AS oldest FROM access")
def _(spark, sf):
    df = filters.recent_or_all(access(spark, sf), "log_time", 24, "2025-01-01 00:00:00")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min("log_time").alias("oldest"))


@register("f04_search", "SELECT event_id, platform, entry_source, uri FROM hits WHERE platform = 'Android' AND entry_source = 'Search_Engine' AND log_time >= TIMESTAMP '2024-01-10' AND log_time < TIMESTAMP '2024-01-21' ORDER BY log_time DESC, event_id DESC LIMIT 50")
def _(spark, sf):
    out = filters.search(hits(spark, sf), platform="Android", entry_source="Search_Engine", start="2024-01-10", end="2024-01-20", limit=50)
    return out.select("event_id", "platform", "entry_source", "uri")


@register("f06_attack_paths", "SELECT event_id, request_uri FROM access WHERE request_uri LIKE '%admin%' OR request_uri LIKE '%.php%' OR request_uri LIKE '%sql%' OR request_uri LIKE '%script%'")
def _(spark, sf):
    return filters.attack_paths(access(spark, sf)).select("event_id", "request_uri")


@register("f07_having", "SELECT uri, count(*) AS requests, count(*) FILTER (WHERE is_error) * 1e2 / count(*) AS error_rate FROM hits GROUP BY 1 HAVING count(*) >= 10 AND count(*) FILTER (WHERE is_error) * 1e2 / count(*) >= 25")
def _(spark, sf):
    out = measures.summarise(hits(spark, sf), ["uri"], sums={"requests": F.lit(1), "errors": measures.flag(c("is_error"))})
    out = out.withColumn("error_rate", measures.rate(c("errors"), c("requests"))).drop("errors")
    return filters.at_least(out, requests=10, error_rate=25)


@register("f08_min_traffic", "SELECT uri, count(*) AS requests FROM hits GROUP BY 1 HAVING count(*) >= 20")
def _(spark, sf):
    return filters.at_least(hits(spark, sf).groupBy("uri").agg(F.count(F.lit(1)).alias("requests")), requests=20)


@register("f09_known_headers", "SELECT event_id FROM access WHERE user_agent NOT IN ('', '-') AND referer NOT IN ('', '-')")
def _(spark, sf):
    return filters.known_clients(access(spark, sf), "user_agent", "referer").select("event_id")


# ---------------------------------------------------------------- joins, windows, top-k, sets


@register("j01_share_of_total", "SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) * 1e2 / (SELECT count(*) FROM lineitem) AS share FROM lineitem GROUP BY 1, 2", raw=True)
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    out = li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return ranking.share_of_total(out, "n", source=li)


@register("w01_share_in_group", "SELECT o_orderpriority, o_orderstatus, count(*) AS n, count(*) * 1e2 / sum(count(*)) OVER (PARTITION BY o_orderpriority)::DOUBLE AS share FROM orders GROUP BY 1, 2", raw=True)
def _(spark, sf):
    out = table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return ranking.share_in_group(out, ["o_orderpriority"], "n")


@register("w12_running_total", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY date_trunc('month', o_orderdate)) AS BIGINT) AS so_far FROM orders GROUP BY date_trunc('month', o_orderdate)", raw=True)
def _(spark, sf):
    months = table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return sequence.running_total(months, ["month"], "n", "so_far")


@register("j05_previous_row", "SELECT event_id, lag(event_id) OVER w AS prev_event_id, lag(value) OVER w AS prev_value FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)", raw=True)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", c("ts").cast("timestamp").alias("ts"), "value")
    out = sequence.with_previous(e, ["event_type"], ["ts", "event_id"], ["event_id", "value"], slice_of=F.date_trunc("minute", "ts"))
    return out.select("event_id", "prev_event_id", "prev_value")


@register("t01_top_n", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 25", raw=True)
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ranking.top(li, [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], 25)


@register("w04_ranked_top", "SELECT p_partkey, p_retailprice, CAST(row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS INT) AS rank FROM part QUALIFY rank <= 10", raw=True)
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return ranking.ranked_top(parts, [F.desc("p_retailprice"), F.asc("p_partkey")], 10)


@register("t02_top_per_group", "SELECT * FROM (SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS rank FROM orders) WHERE rank <= 5", raw=True)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ranking.top_per_group(o, ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 5)


@register("t03_largest_slow", "SELECT event_id, duration_ms FROM access WHERE duration_ms > 3000 ORDER BY duration_ms DESC, event_id LIMIT 50000")
def _(spark, sf):
    rows = access(spark, sf).filter(c("duration_ms") > 3000).select("event_id", "duration_ms")
    return ranking.top(rows, [F.desc("duration_ms"), F.asc("event_id")], 50000)


@register("t04_label_order", "SELECT o_orderpriority, count(*) AS n, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 0 END AS position FROM orders GROUP BY 1", raw=True)
def _(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return o.withColumn("position", ranking.label_order(c("o_orderpriority"), ["1-URGENT", "2-HIGH"]).cast("int"))


@register("t05_most_common", "SELECT l_returnflag, arg_min(l_quantity, (-n, q)) AS quantity FROM (SELECT l_returnflag, l_quantity, CAST(l_quantity AS VARCHAR) AS q, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1", raw=True)
def _(spark, sf):
    out = measures.summarise(table(spark, sf, "lineitem"), ["l_returnflag"], modes={"quantity": c("l_quantity")})
    return out.withColumn("quantity", c("quantity").cast("double"))


@register("t06_top_feeds_second", f", g AS (SELECT uri, avg(duration_ms) AS a FROM hits WHERE duration_ms > 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5) SELECT hour, count(*) AS requests, {pct('duration_ms', .95, 'p95')} FROM hits WHERE uri IN (SELECT uri FROM g) GROUP BY 1")
def _(spark, sf):
    df = hits(spark, sf)
    means = measures.summarise(df.filter(c("duration_ms") > 0), ["uri"], sums={"n": F.lit(1), "ms": c("duration_ms")})
    worst = ranking.top(means.withColumn("a", c("ms") / c("n")), [F.desc("a"), F.asc("uri")], 5).select("uri")
    picked = filters.one_of(df, "uri", worst)
    return measures.summarise(picked, ["hour"], sums={"requests": F.lit(1)}, quantiles=[(c("duration_ms"), {"p95": 0.95})])


@register("t07_newest_first", "SELECT event_id, log_time FROM access ORDER BY log_time DESC, event_id DESC LIMIT 100")
def _(spark, sf):
    return filters.search(access(spark, sf), limit=100).select("event_id", "log_time")


@register("u01_union_all", "SELECT 'order' AS kind, o_orderkey AS id FROM orders UNION ALL SELECT 'part', p_partkey FROM part", raw=True)
def _(spark, sf):
    a = table(spark, sf, "orders").select(F.lit("order").alias("kind"), c("o_orderkey").alias("id"))
    b = table(spark, sf, "part").select(F.lit("part").alias("kind"), c("p_partkey").alias("id"))
    return ranking.stack_up([a, b])


@register("u03_distinct_counts", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1", raw=True)
def _(spark, sf):
    return measures.summarise(table(spark, sf, "lineitem"), ["l_returnflag"], distinct={"parts": c("l_partkey"), "suppliers": c("l_suppkey")})


@register("u04_distinct_rows", "SELECT DISTINCT platform, entry_source FROM hits")
def _(spark, sf):
    return hits(spark, sf).select("platform", "entry_source").distinct()


# ---------------------------------------------------------------- sampling and sketches

_U = "(CAST('0x' || substr(md5('s' || event_id), 1, 8) AS BIGINT)::DOUBLE + 0.5e0) / 4294967296e0"


@register("k01_approx_percentiles", "SELECT event_type, count(*) AS n, true AS close FROM events GROUP BY 1", raw=True)
def _(spark, sf):
    e = table(spark, sf, "events")
    est = measures.summarise(e, ["event_type"], quantiles=[(c("value"), {"lo": 0.94, "hi": 0.96})])
    kll = sampling.quantile_estimate(
        sampling.quantile_state(e.withColumn("part", c("event_id") % 4), ["event_type", "part"], c("value")), ["event_type"], {"p95": 0.95}
    )
    fast = measures.summarise(e, ["event_type"], sums={"n": F.lit(1)}, quantiles=[(c("value"), {"quick": 0.95})], exact=False)
    both = est.join(kll, "event_type").join(fast, "event_type")
    ok = c("p95").between(c("lo"), c("hi")) & c("quick").between(c("lo"), c("hi"))
    return both.select("event_type", "n", ok.alias("close"))


@register("k02_sample_per_key", f"SELECT event_id, event_type FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {_U}, event_id) AS k FROM events) WHERE k <= 50", raw=True)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    return sampling.per_key(e, ["event_type"], "event_id", 50)


@register("k03_frequencies", "SELECT user_id, count(*) AS n FROM events GROUP BY 1", raw=True)
def _(spark, sf):
    return sampling.frequencies(table(spark, sf, "events"), "user_id")


@register("k03_frequency_sketch")
def _(spark, sf):
    return sampling.frequency_sketch(table(spark, sf, "events"), "user_id").select(F.length("sketch").alias("bytes"))


@register("k03_heavy_hitters", "SELECT user_id, count(*) AS n, true AS within FROM events GROUP BY 1 HAVING count(*) >= 0.0015e0 * (SELECT count(user_id) FROM events)", raw=True)
def _(spark, sf):
    out = sampling.heavy_hitters(table(spark, sf, "events").select("user_id"), "user_id", 0.0015)
    return out.select("user_id", "n", c("n").between(c("at_least"), c("at_most")).alias("within"))


@register("k03_merged_counters", "WITH g AS (SELECT o_orderpriority AS item, count(*) AS n FROM orders GROUP BY 1) SELECT item, true AS within, n >= 0.1e0 * sum(n) OVER () AS frequent FROM g", raw=True)
def _(spark, sf):
    """Counters per day, merged over all days, read back with their bounds."""
    orders = table(spark, sf, "orders")
    found = sampling.frequent_values(sampling.frequent_state(orders, ["o_orderdate"], "o_orderpriority", 0.01), [], 0.01)
    exact = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    both = exact.join(found, c("o_orderpriority") == c("item"))
    return both.select("item", c("n").between(c("at_least"), c("at_most")).alias("within"), (c("at_least") >= c("total") * 0.1).alias("frequent"))


@register("k04_approx_distinct", "SELECT event_type, true AS close FROM events GROUP BY 1", raw=True)
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("part", c("event_id") % 4)
    est = sampling.distinct_estimate(sampling.distinct_state(e, ["event_type", "part"], c("user_id")), ["event_type"])
    exact = measures.summarise(e, ["event_type"], distinct={"users": c("user_id")})
    close = F.abs(c("distinct_estimate") - c("users")) <= c("users") * 0.05
    return est.join(exact, "event_type").select("event_type", close.alias("close"))


@register("k05_stratified", f"SELECT event_id, event_type FROM events WHERE {_U} < CASE event_type WHEN 'error' THEN 0.5e0 WHEN 'view' THEN 0.1e0 ELSE 0 END", raw=True)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    return sampling.stratified(e, "event_type", "event_id", {"error": 0.5, "view": 0.1})


@register(
    "k06_adaptive_sizes",
    """WITH s AS (SELECT event_type, CAST(ts AS DATE) AS d, stddev_pop(value) AS sd FROM events GROUP BY 1, 2), g AS (SELECT event_type, CASE WHEN sd > lag(sd) OVER (PARTITION BY event_type ORDER BY d) * 1.2e0 THEN 1 ELSE 0 END AS grew FROM s)
    SELECT event_type, CAST(sum(grew) AS BIGINT) AS growths, CAST(least(5000, 1000 * pow(2, sum(grew))) AS BIGINT) AS sample_size FROM g GROUP BY 1""",
    raw=True,
)
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("d", F.to_date("ts"))
    return sampling.adaptive_sizes(e, "event_type", "d", "value")


@register(
    "k06_adaptive_sample",
    f"""WITH s AS (SELECT event_type, CAST(ts AS DATE) AS d, stddev_pop(value) AS sd FROM events GROUP BY 1, 2), g AS (SELECT event_type, CASE WHEN sd > lag(sd) OVER (PARTITION BY event_type ORDER BY d) * 1.2e0 THEN 1 ELSE 0 END AS grew FROM s),
    z AS (SELECT event_type, least(500, 20 * pow(2, sum(grew))) AS size FROM g GROUP BY 1), r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {_U}, event_id) AS k FROM events)
    SELECT event_id, event_type FROM r JOIN z USING (event_type) WHERE k <= size""",
    raw=True,
)
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("d", F.to_date("ts"))
    return sampling.adaptive_sample(e, "event_type", "d", "value", "event_id", start=20, cap=500).select("event_id", "event_type")


@register("k07_weighted", f"SELECT event_id FROM (SELECT event_id, -ln({_U}) / CASE event_type WHEN 'error' THEN 4e0 WHEN 'purchase' THEN 2e0 ELSE 1e0 END AS w FROM events) ORDER BY w, event_id LIMIT 200", raw=True)
def _(spark, sf):
    weight = lookup(c("event_type"), {"error": 4.0, "purchase": 2.0}, 1.0)
    return sampling.weighted(table(spark, sf, "events").select("event_id", "event_type"), weight, "event_id", 200).select("event_id")


@register("k07_slow_sample", SLOW_SQL + f" SELECT event_id, cause, severity, weight FROM diag ORDER BY -ln({_U}) / weight, event_id LIMIT 500")
def _(spark, sf):
    found = slow.diagnose(hits(spark, sf))
    return sampling.weighted(found, c("weight"), "event_id", 500).select("event_id", "cause", "severity", "weight")


# ---------------------------------------------------------------- metric series

_SER = "WITH m AS (SELECT event_type AS metric, 'c' || (user_id % 3) AS cluster, 'i' || (user_id % 5) AS instance, ts, value FROM events)"
_INC = _SER + """, g AS (SELECT *, lag(value) OVER (PARTITION BY metric, cluster, instance ORDER BY ts, value) AS p FROM m), inc AS (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS growth FROM g)"""


def samples(spark, sf, names=None):
    metric = c("event_type") if names is None else lookup(c("event_type"), names, "other")
    return table(spark, sf, "events").select(
        metric.alias("metric"),
        F.concat(F.lit("c"), (c("user_id") % 3).cast("string")).alias("cluster"),
        F.concat(F.lit("i"), (c("user_id") % 5).cast("string")).alias("instance"),
        c("ts").cast("timestamp").alias("ts"),
        "value",
    )


@register("m01_increase", _INC + " SELECT metric, cluster, instance, round(sum(growth), 4) AS increase, count(*) AS samples FROM inc GROUP BY 1, 2, 3", raw=True)
def _(spark, sf):
    return metrics.increase(samples(spark, sf)).withColumn("increase", F.round("increase", 4))


@register("m01_rates", _INC + " SELECT metric, cluster, make_timestamp(epoch_us(ts) // 3600000000 * 3600000000) AS slot, round(sum(growth) / 3600e0, 6) AS rate FROM inc GROUP BY 1, 2, 3", raw=True)
def _(spark, sf):
    return metrics.rates(samples(spark, sf), 3600).withColumn("rate", F.round("rate", 6))


_FIT = _INC + """, sl AS (SELECT metric, cluster, instance, regr_slope(value, epoch_us(ts) / 1e6 - 1700000000) AS slope, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS span FROM m GROUP BY 1, 2, 3)"""


@register("m02_slopes", _FIT + " SELECT metric, cluster, instance, round(slope * span, 4) AS fitted FROM sl", raw=True)
def _(spark, sf):
    return metrics.slopes(samples(spark, sf)).select(*metrics.SERIES, F.round("fitted", 4).alias("fitted"))


@register(
    "m02_guarded_increase",
    _FIT
    + """, r AS (SELECT metric, cluster, sum(growth) AS raw FROM inc GROUP BY 1, 2), f AS (SELECT metric, cluster, sum(slope * span) AS fb FROM sl GROUP BY 1, 2)
    SELECT metric, cluster, round(raw, 4) AS raw, round(CASE WHEN raw > 12000 AND fb > 0 AND fb < 12000 THEN fb ELSE raw END, 4) AS value, raw > 12000 AND fb > 0 AND fb < 12000 AS used_fallback FROM r JOIN f USING (metric, cluster)""",
    raw=True,
)
def _(spark, sf):
    out = metrics.guarded_increase(samples(spark, sf), 12000.0)
    return out.select("metric", "cluster", F.round("raw", 4).alias("raw"), F.round("value", 4).alias("value"), "used_fallback")


@register(
    "m00_ghost_resets",
    _FIT
    + """, r AS (SELECT metric, cluster, sum(growth) AS raw FROM inc GROUP BY 1, 2), f AS (SELECT metric, cluster, sum(slope * span) AS fb FROM sl GROUP BY 1, 2)
    SELECT cluster, round(CASE WHEN raw > 12000 AND fb > 0 AND fb < 12000 THEN fb ELSE raw END, 4) AS value FROM r JOIN f USING (metric, cluster) WHERE metric = 'click'""",
    raw=True,
)
def _(spark, sf):
    out = metrics.catalogue_report(samples(spark, sf, _CAT), seconds=3600, ghost={"total_requests": 12000.0})
    return out.filter(c("name") == "total_requests").select("cluster", F.round("value", 4).alias("value"))


@register("m03_peak", _SER + " SELECT metric, cluster, max(value) AS peak, arg_min(ts, (-value, ts)) AS peak_time FROM m GROUP BY 1, 2", raw=True)
def _(spark, sf):
    return metrics.peak(samples(spark, sf), ["metric", "cluster"], "value", "ts")


@register("m04_mean_and_last", _SER + " SELECT metric, cluster, round(avg(value), 6) AS mean, arg_max(value, (ts, instance, value)) AS last FROM m GROUP BY 1, 2", raw=True)
def _(spark, sf):
    return metrics.means_and_last(samples(spark, sf)).withColumn("mean", F.round("mean", 6))


@register(
    "m05_availability",
    _SER + ", n AS (SELECT metric, cluster, instance, arg_max(value, (ts, value)) - 20 AS v FROM m GROUP BY 1, 2, 3) SELECT metric, cluster, count(*) AS instances, count(*) FILTER (WHERE v > 0) AS up, count(*) FILTER (WHERE v > 30) AS over_limit, count(*) FILTER (WHERE v > 0) * 1e2 / count(*) AS availability FROM n GROUP BY 1, 2",
    raw=True,
)
def _(spark, sf):
    df = samples(spark, sf).withColumn("value", c("value") - 20)
    return metrics.availability(df, over=30.0)


_DAY = _INC + """, dy AS (SELECT metric, cluster, CAST(ts AS DATE) AS day, avg(value) AS mean, sum(growth) AS growth, max(value) AS peak, arg_min(ts, (-value, ts)) AS peak_time FROM inc GROUP BY 1, 2, 3)"""


@register("m06_threshold_status", _DAY + " SELECT metric, cluster, day, peak, CASE WHEN peak >= 200 THEN 'critical' WHEN peak >= 100 THEN 'warning' ELSE 'normal' END AS status FROM dy", raw=True)
def _(spark, sf):
    out = metrics.daily(samples(spark, sf))
    return out.select("metric", "cluster", "day", "peak", metrics.threshold_status(c("peak"), 200.0, 100.0).alias("status"))


@register("m07_daily", _DAY + " SELECT metric, cluster, day, round(mean, 9) AS mean, round(growth, 4) AS growth, peak, peak_time FROM dy", raw=True)
def _(spark, sf):
    out = metrics.daily(samples(spark, sf))
    return out.withColumns({"mean": F.round("mean", 9), "growth": F.round("growth", 4)})


_SUM = _DAY + """, sm AS (SELECT metric, cluster, count(*) AS days, min(peak) AS min, round(avg(peak), 6) AS avg, round(sum(peak), 4) AS sum, max(peak) AS max, arg_min(day, (-peak, day)) AS max_day, arg_min(peak_time, (-peak, day)) AS max_time FROM dy GROUP BY 1, 2)"""


@register("m07_period_summary", _SUM + " SELECT * FROM sm", raw=True)
def _(spark, sf):
    out = metrics.period_summary(metrics.daily(samples(spark, sf)))
    return out.withColumns({"avg": F.round("avg", 6), "sum": F.round("sum", 4)})


@register(
    "m08_against_previous",
    _DAY
    + """, z AS (SELECT metric, cluster, sum(growth) FILTER (WHERE day BETWEEN DATE '2024-01-15' AND DATE '2024-01-21') AS a, sum(growth) FILTER (WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14') AS b FROM dy GROUP BY 1, 2)
    SELECT metric, cluster, round(a, 4) AS current, round(b, 4) AS previous, round(CASE WHEN b > 0 THEN (a - b) / b * 100 ELSE 0 END, 6) AS change FROM z""",
    raw=True,
)
def _(spark, sf):
    out = metrics.against_previous(metrics.daily(samples(spark, sf)), "2024-01-15", 7)
    return out.withColumns({"current": F.round("current", 4), "previous": F.round("previous", 4), "change": F.round("change", 6)})


@register(
    "m09_trend",
    _DAY
    + """, f AS (SELECT metric, cluster, arg_min(peak, day) AS first, arg_max(peak, day) AS last FROM dy GROUP BY 1, 2), h AS (SELECT *, CASE WHEN first > 0 THEN (last - first) / first * 100 ELSE 0 END AS ch FROM f)
    SELECT metric, cluster, first, last, round(ch, 6) AS change, CASE WHEN ch > 20 THEN 'rising' WHEN ch < -20 THEN 'falling' ELSE 'stable' END AS direction FROM h""",
    raw=True,
)
def _(spark, sf):
    return metrics.trend(metrics.daily(samples(spark, sf))).withColumn("change", F.round("change", 6))


@register("m09_limit_breaches", _SUM + ' SELECT metric, cluster, max, max_day, CASE metric WHEN \'error\' THEN 300e0 ELSE 350e0 END AS "limit" FROM sm WHERE metric IN (\'error\', \'view\') AND max > CASE metric WHEN \'error\' THEN 300 ELSE 350 END', raw=True)
def _(spark, sf):
    out = metrics.period_summary(metrics.daily(samples(spark, sf)))
    return metrics.limit_breaches(out, {"error": 300.0, "view": 350.0})


_CAT = {"click": "nginx_requests", "view": "net_bytes_recv", "purchase": "net_bytes_sent", "signup": "nginx_active", "error": "cpu_usage_active"}


@register(
    "m00_catalogue",
    _INC
    + """, sl AS (SELECT metric, cluster, make_timestamp(epoch_us(ts) // 3600000000 * 3600000000) AS slot, sum(growth) / 3600 AS rate, avg(value) AS mean, sum(value) AS total FROM inc GROUP BY 1, 2, 3),
    s2 AS (SELECT 'view+purchase' AS metric, cluster, make_timestamp(epoch_us(ts) // 3600000000 * 3600000000) AS slot, sum(growth) / 3600 AS rate FROM inc WHERE metric IN ('view', 'purchase') GROUP BY 2, 3),
    nw AS (SELECT metric, cluster, instance, arg_max(value, (ts, value)) AS v FROM m GROUP BY 1, 2, 3),
    o AS (SELECT 'availability' AS name, cluster, count(*) FILTER (WHERE v > 0) * 1e2 / count(*) AS value, 'critical' AS status FROM nw WHERE metric = 'signup' GROUP BY 2
    UNION ALL SELECT 'total_requests', cluster, sum(growth), 'normal' FROM inc WHERE metric = 'click' GROUP BY 2
    UNION ALL SELECT 'qps_peak', cluster, max(rate), 'normal' FROM sl WHERE metric = 'click' GROUP BY 2
    UNION ALL SELECT 'bandwidth_in_peak', cluster, max(rate) / 125000000, 'normal' FROM sl WHERE metric = 'view' GROUP BY 2
    UNION ALL SELECT 'bandwidth_out_peak', cluster, max(rate) / 125000000, 'normal' FROM sl WHERE metric = 'purchase' GROUP BY 2
    UNION ALL SELECT 'bandwidth_total_peak', cluster, max(rate) / 125000000, 'normal' FROM s2 GROUP BY 2
    UNION ALL SELECT 'traffic_in_total', cluster, sum(growth) / 1073741824, 'normal' FROM inc WHERE metric = 'view' GROUP BY 2
    UNION ALL SELECT 'traffic_out_total', cluster, sum(growth) / 1073741824, 'normal' FROM inc WHERE metric = 'purchase' GROUP BY 2
    UNION ALL SELECT 'traffic_total', cluster, sum(growth) / 1073741824, 'normal' FROM inc WHERE metric IN ('view', 'purchase') GROUP BY 2
    UNION ALL SELECT 'cpu_usage_peak', cluster, max(mean), CASE WHEN max(mean) >= 85 THEN 'critical' WHEN max(mean) >= 70 THEN 'warning' ELSE 'normal' END FROM sl WHERE metric = 'error' GROUP BY 2
    UNION ALL SELECT 'conn_active_peak', cluster, max(total), 'normal' FROM sl WHERE metric = 'signup' GROUP BY 2
    UNION ALL SELECT 'high_cpu_nodes', cluster, count(*) FILTER (WHERE v > 85)::DOUBLE, CASE WHEN count(*) FILTER (WHERE v > 85) >= 1 THEN 'warning' ELSE 'normal' END FROM nw WHERE metric = 'error' GROUP BY 2)
    SELECT name, cluster, round(value, 9) AS value, status FROM o""",
    raw=True,
)
def _(spark, sf):
    out = metrics.catalogue_report(samples(spark, sf, _CAT), seconds=3600)
    return out.select("name", "cluster", F.round("value", 9).alias("value"), "status")


def flagship(spark, sf):
    """key:value lines parsed, enriched, and the hottest APIs."""
    from hitlens.plans.enrich import enrich
    from hitlens.sources import lines

    raw = lines.as_pairs(access(spark, sf)).select("event_id", "value")
    return insight.hottest_apis(enrich(lines.accepted(lines.parse_pairs(raw))))


@register(
    "flagship",
    """, h2 AS (SELECT *, CASE WHEN length(split_part(replace(request_uri, ' ', '+'), '?', 1)) > 1 THEN regexp_replace(split_part(replace(request_uri, ' ', '+'), '?', 1), '/$', '') ELSE split_part(request_uri, '?', 1) END AS u2,
      CASE WHEN user_agent = '-' THEN 'Unknown' ELSE platform END AS p2 FROM hits),
    g AS (SELECT u2 AS uri, api_category, p2 AS platform, count(*) AS requests, avg(duration_ms) AS avg_ms, round(quantile_cont(duration_ms, 0.95), 6) AS p95, count(*) FILTER (WHERE is_success) * 1e2 / count(*) AS success_rate,
      count(*) FILTER (WHERE is_error) * 1e2 / count(*) AS error_rate FROM h2 GROUP BY 1, 2, 3)
    SELECT *, CASE WHEN avg_ms = 0 THEN 'Unknown' WHEN avg_ms > 3000 THEN 'Critical' WHEN avg_ms > 1000 OR error_rate > 5 THEN 'Warning' ELSE 'Healthy' END AS health FROM g ORDER BY requests DESC, uri, api_category, platform LIMIT 10""",
)
def _(spark, sf):
    return flagship(spark, sf)


@register(
    "a03_largest_phase",
    A1_SQL
    + """ SELECT uri, greatest(share_connect_ms, share_process_ms, share_backend_transfer_ms, share_front_ms) AS share, CASE greatest(share_connect_ms, share_process_ms, share_backend_transfer_ms, share_front_ms)
    WHEN share_connect_ms THEN 'connect_ms' WHEN share_process_ms THEN 'process_ms' WHEN share_backend_transfer_ms THEN 'backend_transfer_ms' ELSE 'front_ms' END AS bottleneck FROM api""",
)
def _(spark, sf):
    return api.largest_phase(api.api_performance(hits(spark, sf)))


@register(
    "enrich_all",
    """SELECT event_id, uri, stat_hour, hour, weekday, platform, device, os, browser, bot_type, is_bot, sdk_type, referer_domain, search_engine, social_network, entry_source, application, service, module, is_static, api_category, operation,
    journey_stage, is_success, is_error, is_slow, anomaly_type, is_internal, ip_kind, risk_score, is_sql_injection, is_cross_site, tenant, environment, process_ms, backend_transfer_ms, front_ms, performance_level, cache_status, fingerprint,
    is_business_success, has_anomaly, network_ms, transfer_ms, api_group, business_domain, access_type, client_category, client_type, channel, session_id, entry_point, risk_level, threat, reputation, user_type, user_tier, value_score FROM hits""",
)
def _(spark, sf):
    df = hits(spark, sf)
    raw = set(access(spark, sf).columns) - {"event_id"}
    return df.select(*[n for n in df.columns if n not in raw])
