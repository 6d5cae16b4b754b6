"""Requests in flight: bucket occupancy and the exact concurrency sweep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitlens.operators.measures import summarise
from hitlens.operators.ordered import pinned, spans
from hitlens.operators.sequence import prefix_sums

CHUNK = 4096


def occupancy(df: DataFrame, arrive: str, leave: str, bucket_seconds: int) -> DataFrame:
    """New, concurrent and active requests for every bucket [s, e) between first arrival and last completion.

    new = arrivals in [s, e); concurrent = arrived before e and completing at or after e;
    active = arrived at or before e and completing at or after s. Counting arrivals and
    completions per bucket and prefix-summing the bucket rows replaces the quadratic range join.
    """
    width = bucket_seconds * 1_000_000
    micros = {"a": F.unix_micros(F.col(arrive)), "c": F.unix_micros(F.col(leave))}
    # an arrival exactly on a bucket edge e also counts as active in the bucket that ends at e
    marks = df.select(
        F.explode(
            F.array(
                F.struct(
                    F.floor(micros["a"] / width).alias("slot"),
                    F.lit(1).alias("came"),
                    F.lit(0).alias("left"),
                    F.lit(0).alias("edge"),
                ),
                F.struct(
                    F.floor(micros["c"] / width).alias("slot"),
                    F.lit(0).alias("came"),
                    F.lit(1).alias("left"),
                    F.lit(0).alias("edge"),
                ),
                F.when(
                    micros["a"] % width == 0,
                    F.struct(
                        (F.floor(micros["a"] / width) - 1).alias("slot"),
                        F.lit(0).alias("came"),
                        F.lit(0).alias("left"),
                        F.lit(1).alias("edge"),
                    ),
                ),
            )
        ).alias("m")
    ).filter("m is not null")
    counts = marks.groupBy(F.col("m.slot").alias("slot")).agg(
        F.sum("m.came").alias("came"), F.sum("m.left").alias("gone"), F.sum("m.edge").alias("edge")
    )
    # every slot in between, in chunks, so that no row holds the whole range
    edges = counts.agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    chunks = edges.select(
        "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / CHUNK), F.floor(F.col("hi") / CHUNK))).alias("chunk")
    )
    dense = chunks.select(
        F.explode(
            F.sequence(
                F.greatest("lo", F.col("chunk") * CHUNK), F.least("hi", F.col("chunk") * CHUNK + (CHUNK - 1))
            )
        ).alias("slot")
    )
    full = dense.join(counts, "slot", "left").fillna(0, ["came", "gone", "edge"])
    summed = prefix_sums(full, "slot", ["came", "gone"], F.floor(F.col("slot") / CHUNK))
    arrived, completed = F.col("upto_came"), F.col("upto_gone")
    out = summed.select(
        "slot",
        F.col("came").alias("new_requests"),
        (arrived - completed).alias("concurrent"),
        (arrived + F.col("edge") - (completed - F.col("gone"))).alias("active"),
    )
    start = F.timestamp_micros(F.col("slot") * width).alias("bucket")
    return out.filter((F.col("active") > 0) | (F.col("new_requests") > 0)).select(
        start, "new_requests", "concurrent", "active"
    )


def concurrency(df: DataFrame, arrive: str, leave: str, grain: str = "minute") -> DataFrame:
    """Exact concurrency after every event, summarised per bucket: mean, max, min, sample deviation.

    The +1/-1 events are windowed inside each second and lifted by the running level at its start, a prefix sum over
    the seconds that have events. So a hot minute spreads over its seconds, and no task sorts all events. Arrivals
    sort before completions at equal times.
    """
    events = df.select(
        F.explode(
            F.array(
                F.struct(F.col(arrive).alias("at"), F.lit(1).alias("step")),
                F.struct(F.col(leave).alias("at"), F.lit(-1).alias("step")),
            )
        ).alias("e")
    ).select("e.at", "e.step", F.date_trunc("second", "e.at").alias("second"))
    # equal (time, step) events collapse first: the level steps through each unit of the block
    blocks = pinned(events.groupBy("second", "at", "step").agg(F.count(F.lit(1)).alias("n")))
    net = blocks.groupBy("second").agg(F.sum(F.col("step") * F.col("n")).alias("net"))
    base = prefix_sums(net, "second", ["net"], spans(F.col("second")))
    base = base.select(F.col("second").alias("of"), (F.col("upto_net") - F.col("net")).alias("base"))
    inner = Window.partitionBy("second").orderBy("at", F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        blocks.withColumn("prior", F.coalesce(F.sum(F.col("step") * F.col("n")).over(inner), F.lit(0)))
        .join(base, F.col("second") == F.col("of"))
        .withColumn("l0", F.col("base") + F.col("prior"))
        .withColumn("bucket", F.date_trunc(grain, "second"))
    )
    n, step, l0 = F.col("n"), F.col("step"), F.col("l0")
    # levels l0+step .. l0+n*step: closed forms for the sum and the sum of squares
    total = n * l0 + step * (n * (n + 1) / 2)
    squares = n * l0 * l0 + 2 * l0 * step * (n * (n + 1) / 2) + n * (n + 1) * (2 * n + 1) / 6
    stats = levels.groupBy("bucket").agg(
        F.sum("n").alias("events"),
        F.sum(total).alias("s"),
        F.sum(squares).alias("ss"),
        F.max(F.greatest(l0 + step, l0 + n * step)).alias("max_concurrent"),
        F.min(F.least(l0 + step, l0 + n * step)).alias("min_concurrent"),
    )
    centred = F.greatest(F.lit(0.0), F.col("ss") - F.col("s") * F.col("s") / F.col("events"))
    sd: Column = F.when(F.col("events") > 1, F.sqrt(centred / (F.col("events") - 1))).otherwise(F.lit(0.0))
    return stats.select(
        "bucket",
        "events",
        (F.col("s") / F.col("events")).alias("avg_concurrent"),
        "max_concurrent",
        "min_concurrent",
        F.round(sd, 6).alias("std_concurrent"),
    )


def nearest_rank(df: DataFrame, by: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Percentile as the element at index ``floor(n * p)`` of the sorted values."""
    return summarise(df, by, nearest=[(F.col(value), points)])
