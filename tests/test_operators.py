"""Operators against brute force, sketch bounds, and streaming against batch."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hitlens.catalog.base import hits, requests_from, table
from hitlens.operators import filters, measures, occupancy, ranking, sampling, sequence
from hitlens.plans import insight, metrics, rollups, timeline
from hitlens.plans.enrich import enrich
from hitlens.schema import Thresholds
from hitlens.streaming import jobs, state

SF = "/root/testdata/sf0.001"
T0 = datetime(2025, 1, 1)


def spans(n, seed):
    """Whole-second intervals with ties and zero lengths."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        a = r.randrange(0, 600)
        out.append((T0 + timedelta(seconds=a), T0 + timedelta(seconds=a + r.choice([0, 0, 1, 5, 60, 200]))))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_occupancy_brute_force(spark, seed):
    data = spans(80, seed)
    df = spark.createDataFrame(data, "a timestamp, b timestamp")
    got = {r["bucket"]: (r["new_requests"], r["concurrent"], r["active"]) for r in occupancy.occupancy(df, "a", "b", 60).collect()}
    for k in range(-1, 20):
        s = T0 + timedelta(minutes=k)
        e = s + timedelta(minutes=1)
        want = (
            sum(s <= a < e for a, _ in data),
            sum(a < e and b >= e for a, b in data),
            sum(a <= e and b >= s for a, b in data),
        )
        if s in got:
            assert got[s] == want, s
        else:
            assert want[0] == 0 and want[2] <= sum(a == e for a, _ in data)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_concurrency_brute_force(spark, seed):
    data = spans(80, seed)
    df = spark.createDataFrame(data, "a timestamp, b timestamp")
    events = sorted([(a, -1) for a, _ in data] + [(b, 1) for _, b in data])
    level, seen = 0, {}
    for at, order in events:
        level -= order
        seen.setdefault(at.replace(second=0), []).append(level)
    for r in occupancy.concurrency(df, "a", "b").collect():
        levels = seen.pop(r["bucket"])
        assert r["events"] == len(levels) and r["max_concurrent"] == max(levels) and r["min_concurrent"] == min(levels)
        assert abs(r["avg_concurrent"] - sum(levels) / len(levels)) < 1e-9
    assert not seen


def test_nearest_rank(spark):
    r = random.Random(5)
    data = [(k, r.randrange(0, 50)) for k in ("x", "y") for _ in range(r.randrange(1, 90))]
    df = spark.createDataFrame(data, "k string, v long")
    for row in occupancy.nearest_rank(df, ["k"], "v", {"p95": 0.95, "p50": 0.5}).collect():
        values = sorted(v for k, v in data if k == row["k"])
        for name, p in (("p95", 0.95), ("p50", 0.5)):
            assert row[name] == values[min(int(len(values) * p), len(values) - 1)]


def test_with_previous_of_a_null_key(spark):
    rows = [(k, T0 + timedelta(days=d), d) for k in (None, "a") for d in (0, 3)]
    df = spark.createDataFrame(rows, "k string, t timestamp, i int")
    out = sequence.with_previous(df, ["k"], ["t", "i"], ["i"], slice_of=F.to_date("t"))
    assert sorted((str(r["k"]), r["i"], r["prev_i"] is None) for r in out.collect()) == [("None", 0, True), ("None", 3, False), ("a", 0, True), ("a", 3, False)]


def test_large_samples_per_key(spark):
    df = spark.range(20_000).withColumn("k", F.col("id") % 2)
    out = sampling.per_key(df, ["k"], "id", 2_000)
    assert {r["k"]: r["count"] for r in out.groupBy("k").count().collect()} == {0: 2_000, 1: 2_000}
    assert out.columns == df.columns


def test_with_previous_across_empty_slices(spark):
    data = [("a", T0 + timedelta(hours=h), i) for i, h in enumerate([0, 0, 1, 30, 31, 90])] + [("b", T0, 9)]
    df = spark.createDataFrame(data, "k string, t timestamp, i int")
    out = sequence.with_previous(df, ["k"], ["t", "i"], ["i"], slice_of=F.to_date("t"))
    assert {r["i"]: r["prev_i"] for r in out.collect()} == {0: None, 1: 0, 2: 1, 3: 2, 4: 3, 5: 4, 9: None}


def test_prefix_sums(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(40)], "s long, v long")
    out = sequence.prefix_sums(df, "s", ["v"], F.floor(F.col("s") / 7)).orderBy("s").collect()
    total = 0
    for r in out:
        total += r["v"]
        assert r["upto_v"] == total


def test_summarise_hot_key(spark):
    """One key with most rows: same result as plain Spark aggregates; the first shuffle is by value."""
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        (F.col("id") * 7919 % 1009).alias("v"),
        (F.col("id") % 77).alias("u"),
    )
    out = measures.summarise(
        df, ["k"], sums={"n": F.lit(1), "s": F.col("v")}, mins={"lo": F.col("v")}, maxs={"hi": F.col("v")},
        quantiles=[(F.col("v"), {"p50": 0.5, "p99": 0.99})], distinct={"d": F.col("u")}, modes={"m": F.lpad(F.col("u").cast("string"), 2, "0")},
    )
    want = df.groupBy("k").agg(
        F.count("*").alias("n"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.round(F.percentile("v", 0.5), 6).alias("p50"), F.round(F.percentile("v", 0.99), 6).alias("p99"), F.count_distinct("u").alias("d"),
    )
    cols = ["k", "n", "s", "lo", "hi", "p50", "p99", "d"]
    assert sorted(out.select(*cols).collect()) == sorted(want.select(*cols).collect())
    assert all(r["m"] is not None for r in out.collect())
    assert "hashpartitioning(k#" in out._jdf.queryExecution().executedPlan().toString()


def test_wide_quantiles(spark):
    r = random.Random(3)
    data = [(k, r.choice([-1, 0, 1, 1]) * 10 ** r.uniform(-6, 9)) for k in ("a", "b", None) for _ in range(r.randrange(1, 200))]
    df = spark.createDataFrame([*data, ("a", None)], "k string, v double")
    points = {"p0": 0.0, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = measures.wide_quantiles(df, ["k"], {"v": (F.col("v"), points)})
    want = measures.summarise(df, ["k"], quantiles=[(F.col("v"), points)])
    key = lambda row: str(row["k"])
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        for name in points:
            assert a[name] == pytest.approx(b[name], rel=1e-9, abs=1e-6)


def test_summarise_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "k string, v int")
    out = {r["k"]: r for r in measures.summarise(df, ["k"], sums={"n": F.lit(1)}, quantiles=[(F.col("v"), {"p": 0.5})], distinct={"d": F.col("v")}).collect()}
    assert (out["a"]["n"], out["a"]["p"], out["a"]["d"]) == (2, 1.0, 1)
    assert (out["b"]["n"], out["b"]["p"], out["b"]["d"]) == (1, None, 0)


def test_sketch_bounds(spark):
    df = spark.range(50000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 50000).alias("v"))
    q = sampling.quantile_estimate(sampling.quantile_state(df.withColumn("p", F.col("v") % 5), ["k", "p"], F.col("v")), ["k"], {"m": 0.5})
    assert all(abs(r["m"] - 25000) < 1500 for r in q.collect())
    d = sampling.distinct_estimate(sampling.distinct_state(df, ["k"], F.col("v")), ["k"])
    assert all(abs(r["distinct_estimate"] - 16667) < 850 for r in d.collect())
    s = sampling.per_key(df, ["k"], "v", 100)
    assert s.count() == 300 and sorted(s.collect()) == sorted(sampling.per_key(df, ["k"], "v", 100).collect())


def test_filters(spark):
    df = spark.createDataFrame([(1, T0), (2, T0 + timedelta(days=1, hours=23)), (3, None), (4, T0 + timedelta(days=2))], "i int, t timestamp")
    assert [r["i"] for r in filters.between_times(df, "t", "2025-01-01", "2025-01-02").orderBy("i").collect()] == [1, 2, 3]
    assert filters.recent_or_all(df, "t", 24, "2025-01-03 00:00:00").count() == 2
    assert filters.recent_or_all(df, "t", 24, "2026-01-03 00:00:00").count() == 4
    assert filters.one_of(df, "i", list(range(600))).count() == 4
    wide = spark.createDataFrame([(k, str(k)) for k in range(4000)], "i int, k string")
    for n in (3, 3000):
        picked = filters.one_of(wide, "k", [str(k) for k in range(n)])
        assert picked.columns == wide.columns and picked.count() == n
    listed = filters.one_of(wide, "k", spark.createDataFrame([("7",)], "k string"))
    assert listed.columns == wide.columns and listed.count() == 1
    now = datetime(2025, 1, 1, 12)
    assert filters.time_window(None, None, 6, now) == (datetime(2025, 1, 1, 6), now)
    assert filters.time_window("1735689600", "2025-01-02T00:00:00Z", 6, now) == (datetime(2025, 1, 1), datetime(2025, 1, 2))


def test_counter_resets(spark):
    values = [10, 15, 3, 3, 1e12, 5]
    df = spark.createDataFrame(
        [("m", "c", "i", T0 + timedelta(hours=20 * k), float(v)) for k, v in enumerate(values)], "metric string, cluster string, instance string, ts timestamp, value double"
    )
    row = metrics.increase(df).first()
    assert row["increase"] == 5 + 3 + 0 + (1e12 - 3) + 5
    peak = metrics.peak(df, ["metric"], "value", "ts").first()
    assert peak["peak"] == 1e12 and peak["peak_time"] == T0 + timedelta(hours=80)


def test_thresholds_are_parameters(spark):
    df = hits(spark, SF)
    low = timeline.buckets(df, "day", Thresholds(slow_ms=1000)).agg(F.sum("slow")).first()[0]
    high = timeline.buckets(df, "day", Thresholds(slow_ms=10000)).agg(F.sum("slow")).first()[0]
    assert low > high > 0


def test_exact_and_sketched_reports_agree(spark):
    df = hits(spark, SF)
    exact = {r["bucket"]: r for r in timeline.buckets(df, "day").collect()}
    for r in timeline.buckets(df, "day", exact=False).collect():
        assert r["requests"] == exact[r["bucket"]]["requests"]
        assert abs(r["p50"] - exact[r["bucket"]]["p50"]) <= 0.2 * exact[r["bucket"]]["p50"] + 200


def test_state_is_split_invariant(spark):
    df = hits(spark, SF)
    keys = ["platform"]
    whole = state.report(state.merge(state.partial(df, keys), keys), keys)
    parts = ranking.stack_up([state.partial(df.filter(F.col("event_id") % 3 == k), keys) for k in range(3)])
    split = state.report(state.merge(parts, keys), keys)
    drop = ["clients_estimate", "p95_estimate", "std_ms"]
    assert sorted(whole.drop(*drop).collect()) == sorted(split.drop(*drop).collect())


def test_streaming_rollup_equals_batch(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "job")
    events = table(spark, SF, "events")
    for k in range(3):
        events.filter(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    keys = ["stat_hour", "platform"]
    written = []
    query = jobs.start_rollup(enrich(requests_from(stream)), keys, f"{folder}/state", f"{folder}/check", also=lambda b, i: written.append(i))
    query.awaitTermination()
    assert len(written) == 3
    drop = ["clients_estimate", "p95_estimate", "std_ms"]
    batch = state.report(state.merge(state.partial(hits(spark, SF), keys), keys), keys).drop(*drop)
    assert sorted(jobs.read_rollup(spark, f"{folder}/state", keys).drop(*drop).collect()) == sorted(batch.collect())
    # a restart sees nothing new and a late file only adds to its hour
    jobs.start_rollup(enrich(requests_from(stream)), keys, f"{folder}/state", f"{folder}/check").awaitTermination()
    assert sorted(jobs.read_rollup(spark, f"{folder}/state", keys).drop(*drop).collect()) == sorted(batch.collect())
    events.limit(5).coalesce(1).write.mode("append").parquet(source)
    jobs.start_rollup(enrich(requests_from(stream)), keys, f"{folder}/state", f"{folder}/check").awaitTermination()
    after = jobs.read_rollup(spark, f"{folder}/state", keys)
    assert after.agg(F.sum("requests")).first()[0] == events.count() + 5
    jobs.compact(spark, f"{folder}/state", keys, f"{folder}/compact")
    assert jobs.read_rollup(spark, f"{folder}/compact", keys).count() == after.count()
    folded = jobs.read_rollup(spark, f"{folder}/state", keys, f"{folder}/compact")
    assert folded.agg(F.sum("requests")).first()[0] == events.count() + 5
    # what comes after a fold is added to it, and a second fold takes the first one's place
    events.limit(7).coalesce(1).write.mode("append").parquet(source)
    jobs.start_rollup(enrich(requests_from(stream)), keys, f"{folder}/state", f"{folder}/check").awaitTermination()
    for _ in range(2):
        folded = jobs.read_rollup(spark, f"{folder}/state", keys, f"{folder}/compact")
        assert folded.agg(F.sum("requests")).first()[0] == events.count() + 12
        jobs.compact(spark, f"{folder}/state", keys, f"{folder}/compact")


def test_streaming_alerts(spark, tmp_path):
    source = str(tmp_path / "in")
    table(spark, SF, "events").write.parquet(source)
    stream = spark.readStream.schema(table(spark, SF, "events").schema).parquet(source)
    windows = jobs.windowed(enrich(requests_from(stream)), "1 day", late="2 days")
    query = (
        jobs.alerts(windows, error_rate=1).writeStream.outputMode("append").format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("window_start", "alert", "requests")
    want = jobs.alerts(jobs.windowed(hits(spark, SF), "1 day"), error_rate=1).select("window_start", "alert", "requests")
    assert got.count() > 0 and not set(got.collect()) - set(want.collect())


def test_watch_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("x\ny\n")
    query = (
        jobs.watch_lines(spark, str(tmp_path / "in"), glob="*.log").writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_pruned_scan(spark):
    """A report reads only the columns it needs."""
    plan = insight.peaks(hits(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_top_lists_are_cut_before_the_shuffle(spark):
    df = table(spark, SF, "orders")
    plan = ranking.top_per_group(df, ["o_orderpriority"], [F.desc("o_totalprice")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rollup_windows_need_whole_hours(spark):
    out = rollups.time_dimension(hits(spark, SF)).orderBy("stat_hour").collect()
    for i, r in enumerate(out):
        assert r["peak_7h"] == max(x["requests"] for x in out[max(0, i - 6) : i + 1])


def test_deviation_of_sums_whose_square_leaves_64_bits(spark):
    """The sums of six million requests of 4 and 6 s."""
    row = spark.range(1).select(F.lit(30_000_000_000).alias("s"), F.lit(1.56e14).alias("ss"), F.lit(6_000_000).alias("n"))
    assert row.select(measures.deviation(F.col("s"), F.col("ss"), F.col("n"))).first()[0] == pytest.approx(1000.0)


def test_partitions_grow_with_the_table(spark):
    from hitlens.catalog.base import PARTS, ROWS_PER_PART, parts

    assert parts(spark.range(10)) == PARTS
    assert parts(spark.range(40 * ROWS_PER_PART + 1)) == 41


def test_pair_statistics_search_each_line_once(spark):
    from hitlens.sources import lines

    df = spark.createDataFrame([('http_host:a remote_addr:"1" time:"t" code:"200"',), (" ",), ('time:"t" code:"-"',)], "value string")
    out = lines.parse_statistics(df)
    assert tuple(out.first()) == (3, 1, 1, 1, 1 / 3)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1


def test_values_that_are_not_there_take_no_row(spark):
    """Of three measured values only the first slot has a row where nothing is measured; the report keeps the group."""
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "k string, v long")
    out = measures.summarise(df, ["k"], sums={"n": F.lit(1)}, quantiles=[(F.col("v"), {"p": 0.5}), (F.col("v"), {"q": 0.5})], unbounded=[(F.col("v") * 2, {"w": 0.5})], distinct={"d": F.col("v")})
    assert {tuple(r) for r in out.select("k", "n", "p", "q", "w", "d").collect()} == {("a", 2, 1.0, 1.0, 2.0, 1), ("b", 1, None, None, None, 0)}


def test_event_time_derives_only_what_each_table_keeps(spark, tmp_path):
    """Rows are enriched inside the batch: the state asks for its columns alone, late rows for all of them."""
    rows = table(spark, SF, "events").filter("event_id < 200")
    rows.coalesce(1).write.parquet(f"{tmp_path}/events")
    raw = requests_from(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/events"))
    jobs.start_event_time(raw, ["stat_hour"], f"{tmp_path}/job", f"{tmp_path}/checkpoint", derive=enrich).awaitTermination()
    got = jobs.read_rollup(spark, f"{tmp_path}/job/state", ["stat_hour"]).agg(F.sum("requests")).first()[0]
    assert got == rows.count()
    assert set(enrich(requests_from(rows)).columns) <= set(spark.read.parquet(f"{tmp_path}/job/late").columns)


def test_described_moments_come_from_counted_values(spark):
    """No column of a measure travels with the counted rows; means, extremes and types stay."""
    df = spark.createDataFrame([("a", 3, 0.5), ("a", 3, None), ("a", 9, 2.5), ("b", None, None)], "k string, v long, x double")
    out = measures.describe(df, ["k"], ["v", "x"], {"p50": 0.5}, unbounded=["x"])
    got = {r["k"]: (r["requests"], r["min_v"], r["max_v"], r["avg_v"], r["p50_v"], r["min_x"], r["max_x"], r["avg_x"]) for r in out.collect()}
    assert got == {"a": (3, 3, 9, 5.0, 3.0, 0.5, 2.5, 1.5), "b": (1,) + (None,) * 7}
    assert out.schema["min_v"].dataType.simpleString() == "bigint"
    assert "_v_sum_v" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_partitions_of_a_large_table_are_written_through(spark):
    """More than 200 would be kept in memory by the task that reads a row group."""
    from hitlens.catalog.base import MOST_ROWS_PER_PART, ROWS_PER_PART, parts

    assert parts(spark.range(300 * ROWS_PER_PART)) == 200
    assert parts(spark.range(200 * MOST_ROWS_PER_PART + 1)) == 201


@pytest.mark.parametrize("name", ["d09_rollup_series", "r09_ip_source", "l01_api_percentiles"])
def test_reading_the_events_keeps_no_rows(spark, name):
    """A deal by round robin sorts all rows of the task that reads them."""
    from hitlens.catalog import queries

    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan and "shufflepartitionidpassthrough" in plan


def test_the_deal_is_whole_and_even(spark):
    from hitlens.catalog.base import PARTS, access, table

    dealt = access(spark, SF)
    found = dealt.groupBy(F.spark_partition_id()).count().collect()
    n = table(spark, SF, "events").count()
    assert len(found) == PARTS and sum(r["count"] for r in found) == n
    assert max(r["count"] for r in found) < 1.3 * n / PARTS
    assert dealt.select("event_id").exceptAll(table(spark, SF, "events").select("event_id")).count() == 0
