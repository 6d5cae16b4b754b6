"""Ordered windows in blocks, totals that travel with the rows, and quantiles in one pass: results and plans."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitlens.catalog import queries
from hitlens.operators import measures, ordered, ranking

SF = "/root/testdata/sf0.001"


def physical(spark, name):
    """The physical plan without run-time changes, in which a shuffle that is used again shows once."""
    build = queries()[name]
    df = build(spark, SF)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def scans(plan):
    return len(re.findall(r"FileScan", plan))


def shuffles(plan):
    """Exchanges by key; the test table is dealt out once by round robin first."""
    return len(re.findall(r"(?<!Reused)Exchange (?:hash|range)partitioning", plan))


@pytest.fixture(scope="module")
def moments(spark):
    rng = random.Random(2)
    at = sorted(rng.sample(range(0, 3000), 400)) + sorted(rng.sample(range(50_000, 50_400), 300)) + [10**6, 2 * 10**6]
    rows = [(t, rng.random(), rng.choice([None, 1, 2])) for t in at]
    df = spark.createDataFrame([*rows, (None, 0.5, 3)], "t long, v double, w long").repartition(5)
    return df, [(None, 0.5, 3), *rows]


@pytest.mark.parametrize("block", [3, 50, 4096])
def test_windows_in_blocks(moments, block):
    df, rows = moments
    chunk = F.floor(F.col("t") / 1000)
    frames = {
        "peak": lambda w: F.max("v").over(w.rowsBetween(-6, 0)),
        "ahead": lambda w: F.sum("v").over(w.rowsBetween(-2, 4)),
        "was": lambda w: F.lag("w", 3).over(w),
    }
    got = {r.t: r for r in ordered.framed(df, ["t"], chunk, frames, before=6, after=4, block=block).collect()}
    assert len(got) == len(rows)
    for k, (t, _, _) in enumerate(rows):
        assert got[t].peak == max(v for _, v, _ in rows[max(0, k - 6) : k + 1])
        assert got[t].ahead == pytest.approx(sum(v for _, v, _ in rows[max(0, k - 2) : k + 5]))
        assert got[t].was == (rows[k - 3][2] if k >= 3 else None)


def test_numbers_and_neighbours(moments):
    df, rows = moments
    chunk = F.floor(F.col("t") / 1000)
    for r in ordered.numbered(df, ["t"], chunk, "place", total="n").collect():
        assert rows[r.place - 1][0] == r.t and r.n == len(rows)
    got = {r.t: r.next for r in ordered.lagged(df, ["t"], chunk, {"next": "v"}, -1).collect()}
    assert got == {t: rows[k + 1][1] if k + 1 < len(rows) else None for k, (t, _, _) in enumerate(rows)}
    none = df.limit(0)
    assert ordered.numbered(none, ["t"], chunk).count() == 0 and ordered.lagged(none, ["t"], chunk, {"was": "v"}).count() == 0


def test_totals_travel_with_rows(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2, 3]), rng.choice([None, 5, 7, 9])) for _ in range(300)]
    rows += [("hot", k, 1) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, k long, n long")
    got = ranking.with_totals(df, ["g"], {"of_n": "n", "of_k": "k"}).collect()
    assert sorted(((r.g, r.k, r.n) for r in got), key=str) == sorted(rows, key=str)
    for r in got:
        mine = [x for x in rows if x[0] == r.g]
        assert r.of_n == sum(x[2] or 0 for x in mine) and r.of_k == sum(x[1] or 0 for x in mine)
    whole = ranking.with_totals(df, [], {"all": "n"}).collect()
    assert len(whole) == len(rows) and {r["all"] for r in whole} == {sum(x[2] or 0 for x in rows)}
    assert ranking.share_in_group(df.limit(0), ["g"], "n").count() == 0


def test_quantiles_of_all_kinds_in_one_pass(spark):
    rng = np.random.default_rng(3)
    rows = [(k, int(d), float(x)) for k in ("a", "b", None) for d, x in zip(rng.integers(0, 50, 400), rng.normal(0, 10.0 ** rng.integers(-3, 6, 400)), strict=True)]
    rows += [("empty", None, None), ("one", 3, -2.5), ("zero", 0, 0.0)]
    df = spark.createDataFrame([(k, d, x, f"s{(d or 0) % 7}") for k, d, x in rows], "k string, d long, x double, s string").repartition(4)
    out = measures.summarise(
        df, ["k"], sums={"n": F.lit(1), "total": F.col("d")}, maxs={"top": F.col("x")},
        quantiles=[(F.col("d"), {"d50": 0.5})], unbounded=[(F.col("x"), {"x5": 0.05, "x95": 0.95}), (-F.col("x"), {"y50": 0.5})],
        nearest=[(F.col("d"), {"at90": 0.9})], distinct={"kinds": F.col("s")}, modes={"often": F.col("s")},
    )
    got = {r.k: r for r in out.collect()}
    assert len(got) == 6
    for k, r in got.items():
        d = sorted(x[1] for x in rows if x[0] == k and x[1] is not None)
        x = [x[2] for x in rows if x[0] == k and x[2] is not None]
        assert r.n == sum(x[0] == k for x in rows)
        if not d:
            assert (r.total, r.top, r.d50, r.x5, r.y50, r.at90) == (None,) * 6
            continue
        assert (r.total, r.top, r.d50) == (sum(d), max(x), np.quantile(d, 0.5))
        assert r.x5 == pytest.approx(np.quantile(x, 0.05), abs=1e-6) and r.x95 == pytest.approx(np.quantile(x, 0.95), abs=1e-6)
        assert r.y50 == pytest.approx(np.quantile([-v for v in x], 0.5), abs=1e-6)
        assert r.at90 == d[min(int(len(d) * 0.9), len(d) - 1)] and isinstance(r.at90, int)


@pytest.mark.parametrize("name", ["w05_trend_second", "w08_ends_trend_second", "w09_halves_trend_second", "w02_rolling_second", "w10_file_gaps"])
def test_ordered_windows_have_no_task_for_all_rows(spark, name):
    plan = physical(spark, name)
    assert scans(plan) == 1
    for line in plan.split("\n"):
        # without a partition there are only the windows over one row per chunk
        if " Window " in line and "windowspecdefinition(" in line:
            spec = line.split("windowspecdefinition(", 1)[1]
            assert spec.startswith(("_chunk", "_block")) or "_size" in line, line


@pytest.mark.parametrize(
    ("name", "most"),
    [("a01_api_performance", 7), ("a02_api_transfer", 5), ("a05_service_report", 5), ("a31_transfer", 5), ("a49_cdn_buckets", 5), ("l01_api_percentiles", 5)],
)
def test_quantile_reports_read_their_input_once(spark, name, most):
    plan = physical(spark, name)
    assert scans(plan) == 1 and shuffles(plan) <= most


@pytest.mark.parametrize("name", ["w01_share_in_group", "r04_status_codes", "r07_request_headers", "r08_api_errors", "r14_platform_entry"])
def test_shares_run_their_report_once(spark, name):
    plan = physical(spark, name)
    assert scans(plan) == 1 and "Join" not in plan


def test_slices_follow_the_hottest_series(spark):
    from datetime import datetime, timedelta

    from hitlens.operators import sequence
    from hitlens.plans import metrics

    rng = random.Random(6)
    t0 = datetime(2025, 4, 1)
    rows = [("m", "c", "slow", t0 + timedelta(minutes=10 * k), float(k)) for k in range(60)]
    rows += [("m", "c", "hot", t0 + timedelta(seconds=k), float(rng.randint(0, 50))) for k in range(7200)]
    df = spark.createDataFrame(rows, "metric string, cluster string, instance string, ts timestamp, value double").repartition(4)

    def width(n):
        return df.select(sequence.slice_seconds(df, metrics.SERIES, "ts", rows=n).alias("w")).first().w

    assert width(100_000) == 3600 and width(3600) == 3600 and width(600) == 600 and width(1) == 1
    want = {}
    for name in ("slow", "hot"):
        values = [v for _, _, i, _, v in rows if i == name]
        want[name] = sum(b if b < a else b - a for a, b in zip(values, values[1:], strict=False))
    for n in (100_000, 50):
        grown = metrics.increments(df, rows=n).groupBy("instance").agg(F.sum("growth").alias("g"))
        assert {r.instance: r.g for r in grown.collect()} == want
    assert metrics.increments(df.limit(0)).count() == 0
