"""Mergeable rollup state: counts, sums, sums of squares, distinct and quantile sketches.

Partial rows of the same key can be added in any order and any number of times split; rates,
means and quantiles are derived on read and never averaged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.operators.measures import deviation, rate

c = F.col
ADDED = ["requests", "successes", "errors", "slow", "ms", "ms2", "bytes"]


def partial(df: DataFrame, keys: Sequence[str], *, slow_ms: int = 3000) -> DataFrame:
    """State rows of one slice of the enriched table."""
    ms = c("duration_ms")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("is_success").alias("successes"),
        F.count_if("is_error").alias("errors"),
        F.count_if(ms > slow_ms).alias("slow"),
        F.sum(ms).alias("ms"),
        F.sum((ms * ms).cast("double")).alias("ms2"),
        F.sum("body_bytes").alias("bytes"),
        F.max(ms).alias("max_ms"),
        F.min("log_time").alias("first_time"),
        F.max("log_time").alias("last_time"),
        F.hll_sketch_agg("client_ip", F.lit(12)).alias("clients"),
        F.kll_sketch_agg_double(ms.cast("double"), F.lit(400)).alias("latency"),
    )


def merge(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state row per key from any number of partial rows."""
    return state.groupBy(*keys).agg(
        *[F.sum(a).alias(a) for a in ADDED],
        F.max("max_ms").alias("max_ms"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.hll_union_agg("clients", False).alias("clients"),
        F.kll_merge_agg_double("latency").alias("latency"),
    )


def coarser(state: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """State of a coarser grain or of fewer keys, from state rows alone: days from hours, all platforms from each."""
    held = [*ADDED, "max_ms", "first_time", "last_time", "clients", "latency"]
    return merge(state.select(*[value.alias(name) for name, value in keys.items()], *held), list(keys))


def report(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Readable report from merged state; distinct counts and percentiles are estimates."""
    n = c("requests")
    return merged.select(
        *keys,
        "requests", "successes", "errors", "slow", "bytes", "max_ms", "first_time", "last_time",
        rate(c("successes"), n).alias("success_rate"),
        rate(c("errors"), n).alias("error_rate"),
        rate(c("slow"), n).alias("slow_rate"),
        (c("ms") / n).alias("avg_ms"),
        F.round(deviation(c("ms"), c("ms2"), n), 3).alias("std_ms"),
        F.hll_sketch_estimate("clients").alias("clients_estimate"),
        F.kll_sketch_get_quantile_double("latency", F.lit(0.95)).alias("p95_estimate"),
    )
