"""Counters of frequent values, samples sized by their keys, and the concurrency sweep inside hot minutes."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hitlens.operators import occupancy, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(11)
    values = [min(int(rng.paretovariate(0.4)), 10**9) for _ in range(40_000)] + [7] * 20_000 + [None] * 500
    rng.shuffle(values)
    return spark.createDataFrame([(k % 13, v) for k, v in enumerate(values)], "part int, v long").repartition(6), Counter(v for v in values if v is not None)


@pytest.mark.parametrize("share", [0.3, 0.02, 0.005])
def test_heavy_hitters_are_all_found(skewed, share):
    df, counts = skewed
    total = sum(counts.values())
    want = {v: n for v, n in counts.items() if n >= share * total}
    got = sampling.heavy_hitters(df, "v", share).collect()
    assert {r.v: r.n for r in got} == want
    assert all(r.at_least <= r.n <= r.at_most for r in got)
    assert sampling.heavy_hitters(df.limit(0), "v", share).count() == 0


def test_merged_counters_bound_every_value(skewed):
    df, counts = skewed
    share, total = 0.02, sum(counts.values())
    assert len(counts) > 2 * sampling.counters(share)  # far more values than counters
    parts = sampling.frequent_state(df, ["part"], "v", share)
    for states in (parts, sampling.frequent_state(df, [], "v", share)):
        found = {r.item: r for r in sampling.frequent_values(states, [], share).collect()}
        assert {v for v, n in counts.items() if n >= share * total} <= set(found)
        assert all(r.at_least <= counts[v] <= r.at_most and r.total == total for v, r in found.items())
    folded = sampling.frequent_values(parts.withColumn("half", F.col("part") % 2), ["half"], share)
    assert {r.half for r in folded.collect()} == {0, 1}


def test_adaptive_sample(spark):
    rng = random.Random(5)
    spread = {"calm": [1, 1, 1, 1], "grows": [1, 2, 4, 8], None: [1, 5, 1, 5]}
    rows = [(k, s, rng.gauss(0, sd), i) for i, (k, s, sd) in enumerate((k, s, sd) for k, sds in spread.items() for s, sd in enumerate(sds) for _ in range(700))]
    rows += [("few", 0, 1.0, 10**6 + i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, s int, v double, id long").repartition(5)
    sizes = {r.k: r.sample_size for r in sampling.adaptive_sizes(df, "k", "s", "v", start=40, cap=200).collect()}
    assert sizes == {"calm": 40, "grows": 200, None: 160, "few": 40}
    got = sampling.adaptive_sample(df, "k", "s", "v", "id", start=40, cap=200)
    assert got.columns == df.columns
    order = {r.id: r.u for r in df.select("id", sampling.unit_hash(F.col("id"), "s").alias("u")).collect()}
    want = set()
    for k, size in sizes.items():
        want |= set(sorted((i for x, _, _, i in rows if x == k), key=lambda i: (order[i], i))[:size])
    found = [r.id for r in got.collect()]
    assert len(found) == len(want) and set(found) == want
    assert sampling.adaptive_sample(df.limit(0), "k", "s", "v", "id").count() == 0


def test_one_hot_minute_is_swept_by_second(spark):
    rng = random.Random(9)
    start = datetime(2025, 4, 1, 10, 0, 0)
    spans = []
    for _ in range(3000):
        a = start + timedelta(microseconds=rng.randrange(60_000_000))
        spans.append((a, a + timedelta(microseconds=rng.choice([0, 5, 700_000, 90_000_000, 400_000_000]))))
    df = spark.createDataFrame(spans, "a timestamp, b timestamp").repartition(4)
    events = sorted([(a, 0) for a, _ in spans] + [(b, 1) for _, b in spans])
    level, seen = 0, {}
    for at, leaves in events:
        level += -1 if leaves else 1
        seen.setdefault(at.replace(second=0, microsecond=0), []).append(level)
    out = occupancy.concurrency(df, "a", "b")
    got = {r.bucket: r for r in out.collect()}
    assert set(got) == set(seen)
    for minute, levels in seen.items():
        r = got[minute]
        assert (r.events, r.max_concurrent, r.min_concurrent) == (len(levels), max(levels), min(levels))
        assert r.avg_concurrent == pytest.approx(sum(levels) / len(levels))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"windowspecdefinition\((\w+)#", plan)
    assert "second" in keys and "bucket" not in keys
