"""CDN log report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.functions import agent
from hitlens.operators.measures import flag, summarise
from hitlens.plans.timeline import SECONDS


def buckets(df: DataFrame, grain: str, *, slow_ms: int = 5000) -> DataFrame:
    """Per bucket: totals, successes (200-399), slow, QPS, mean/max/min and nearest-rank p95, p99."""
    rows = df.select(
        F.date_trunc(grain, "log_time").alias("bucket"),
        F.col("status").try_cast("int").between(200, 399).alias("ok"),
        "duration_ms",
    )
    ms = F.col("duration_ms")
    out = summarise(
        rows,
        ["bucket"],
        sums={"requests": F.lit(1), "successes": flag(F.col("ok")), "slow": flag(ms > slow_ms), "ms": ms},
        maxs={"max_ms": ms},
        mins={"min_ms": ms},
        nearest=[(ms, {"p95_ms": 0.95, "p99_ms": 0.99})],
    )
    return out.withColumns(
        {"avg_ms": F.col("ms") / F.col("requests"), "qps": F.col("successes") / F.lit(float(SECONDS[grain]))}
    ).drop("ms")


def tallies(df: DataFrame) -> DataFrame:
    """Requests and successes per status, simplified agent, client and URI, one pass."""
    ok = flag(F.col("status").try_cast("int").between(200, 399))
    entries = F.array(
        F.struct(F.lit("status").alias("dimension"), F.col("status").alias("label")),
        F.struct(
            F.lit("agent").alias("dimension"),
            F.when(~F.col("user_agent").isin("", "-"), agent.family(F.col("user_agent"))).alias("label"),
        ),
        F.struct(F.lit("client").alias("dimension"), F.col("client_ip").alias("label")),
        F.struct(F.lit("uri").alias("dimension"), F.col("uri").alias("label")),
    )
    rows = df.select(ok.alias("ok"), F.explode(entries).alias("d")).filter("d.label is not null")
    return rows.groupBy("d.dimension", "d.label").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("ok").alias("successes")
    )
