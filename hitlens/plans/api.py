"""Per-API reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.functions import timing
from hitlens.operators.measures import flag, mean, rate, summarise
from hitlens.operators.ranking import top_per_group, with_totals
from hitlens.rules import descend
from hitlens.schema import DEFAULTS, Thresholds

PHASES = ["connect_ms", "process_ms", "backend_transfer_ms", "front_ms"]


def api_performance(df: DataFrame, limits: Thresholds = DEFAULTS, *, exact: bool = True) -> DataFrame:
    """Totals over all requests, latency, phase and size statistics over the successful ones.

    APIs without a success are left out. Totals for the shares of all slow and all successful requests
    travel with the rows.
    """
    ok = F.col("is_success")
    slow = ok & (F.col("duration_ms") > limits.slow_ms)

    def on_success(name: str):
        return F.when(ok, F.col(name))

    out = summarise(
        df,
        ["uri"],
        sums={
            "requests": F.lit(1),
            "successes": flag(ok),
            "slow": flag(slow),
            "sum_ms": on_success("duration_ms"),
            "sum_body": on_success("body_bytes"),
            **{f"sum_{p}": on_success(p) for p in PHASES},
        },
        mins={"application": F.col("application"), "service": F.col("service")},
        quantiles=[
            (on_success("duration_ms"), {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}),
        ],
        unbounded=[(on_success("body_bytes"), {"body_p50": 0.5, "body_p95": 0.95})],
        exact=exact,
    ).filter("successes > 0")
    out = with_totals(out, [], {"all_slow": "slow", "all_ok": "successes"})
    phase_sum = sum((F.col(f"sum_{p}") for p in PHASES), F.lit(0))
    out = out.withColumns(
        {
            "success_rate": rate(F.col("successes"), F.col("requests")),
            "slow_rate": rate(F.col("slow"), F.col("successes")),
            "share_of_slow": rate(F.col("slow"), F.col("all_slow")),
            "share_of_success": rate(F.col("successes"), F.col("all_ok")),
            "avg_ms": mean(F.col("sum_ms"), F.col("successes")),
            "avg_body": mean(F.col("sum_body"), F.col("successes")),
            **{f"share_{p}": rate(F.col(f"sum_{p}"), phase_sum) for p in PHASES},
        }
    )
    slow_api = (F.col("avg_ms") > limits.slow_ms) | (F.col("slow_rate") > limits.slow_share)
    return out.withColumn("is_slow_api", slow_api).drop("all_slow", "all_ok", "sum_ms", "sum_body", *[f"sum_{p}" for p in PHASES])


def api_transfer(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """Speeds, connection cost and processing index per API with a grade."""
    m = timing.lifecycle(
        *[F.col(n) for n in ("duration_ms", "connect_ms", "header_ms", "response_ms", "body_bytes", "sent_bytes")],
        rounded=False,
    )
    rows = df.filter("is_success").select(
        "uri", *[m[n].alias(n) for n in ("response_speed", "total_speed", "connection_cost")],
        (m["backend_efficiency"] / 100).alias("efficiency"),
    )
    names = ["response_speed", "total_speed", "connection_cost", "efficiency"]
    points = [(F.col(n), {f"p10_{n}": 0.1, f"p90_{n}": 0.9}) for n in names]
    sums = {"requests": F.lit(1), **{f"sum_{n}": F.col(n) for n in names}}
    out = summarise(rows, ["uri"], sums=sums, unbounded=points, exact=exact)
    out = out.withColumns({f"avg_{n}": F.round(F.col(f"sum_{n}") / F.col("requests"), 6) for n in names})
    grade = descend(
        F.col("avg_efficiency"), [(0.8, "优秀"), (0.6, "良好"), (0.4, "一般"), (0.2, "较差")], "很差", strict=False
    )
    return out.withColumns({"grade": grade, "costly_connect": F.col("avg_connection_cost") > 30}).drop(
        *[f"sum_{n}" for n in names]
    )


def api_bottlenecks(performance: DataFrame, *, k: int = 10) -> DataFrame:
    """Top APIs per phase whose share is too high: connect > 20, process > 60, transfer > 30 percent."""
    limits = {"connect_ms": 20.0, "process_ms": 60.0, "backend_transfer_ms": 30.0}
    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"share_{p}") > cut,
                    F.struct(F.lit(p).alias("phase"), F.col(f"share_{p}").alias("share")),
                )
                for p, cut in limits.items()
            ]
        )
    )
    rows = performance.select("uri", "successes", F.explode(entries).alias("e")).select(
        "uri", "successes", "e.phase", "e.share"
    )
    return top_per_group(rows, ["phase"], [F.desc("share"), F.desc("successes"), F.asc("uri")], k)


def largest_phase(performance: DataFrame) -> DataFrame:
    """The phase with the largest share per API (ties: the earlier phase)."""
    best = F.greatest(*[F.col(f"share_{p}") for p in PHASES])
    pick = None
    for p in PHASES:
        test = F.col(f"share_{p}") == best
        pick = F.when(test, F.lit(p)) if pick is None else pick.when(test, F.lit(p))
    return performance.select("uri", pick.alias("bottleneck"), best.alias("share"))


def api_frequency(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """Request count, latency percentiles and frequency class of every API."""
    out = summarise(
        df,
        ["uri"],
        sums={"requests": F.lit(1)},
        quantiles=[(F.col("duration_ms"), {"p50": 0.5, "p95": 0.95})],
        exact=exact,
    )
    level = descend(F.col("requests"), [(1000, "高频"), (100, "中频")], "低频")
    return out.withColumn("frequency", level)
