"""Repeatable samples and mergeable sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitlens.operators.measures import deviation
from hitlens.operators.ordered import pinned
from hitlens.operators.ranking import top_per_group


def unit_hash(key: Column, seed: str) -> Column:
    """Repeatable pseudo-random number in (0, 1) from a row key."""
    head = F.conv(F.substring(F.md5(F.concat(F.lit(seed), key.cast("string"))), 1, 8), 16, 10)
    return (head.cast("double") + 0.5) / F.lit(4294967296.0)


def per_key(df: DataFrame, by: Sequence[str], key: str, n: int, *, seed: str = "s") -> DataFrame:
    """Uniform sample of at most n rows per key; each of 64 slices of a key is cut to n rows first."""
    drawn = df.withColumn("_u", unit_hash(F.col(key), seed))
    slices = F.pmod(F.xxhash64(key), F.lit(64))
    return top_per_group(drawn, by, [F.col("_u"), F.col(key)], n, "_r", within=slices).drop("_u", "_r")


def stratified(df: DataFrame, stratum: str, key: str, fractions: dict[str, float], *, seed: str = "s") -> DataFrame:
    """Keep a fixed fraction per stratum, decided row by row without a shuffle."""
    keep = None
    for label, part in fractions.items():
        test = F.col(stratum) == F.lit(label)
        keep = F.when(test, F.lit(part)) if keep is None else keep.when(test, F.lit(part))
    return df.filter(unit_hash(F.col(key), seed) < keep.otherwise(F.lit(0.0)))


def weighted(df: DataFrame, weight: Column, key: str, n: int, *, seed: str = "s") -> DataFrame:
    """Weighted sample without replacement: the n smallest exponential keys ``-ln(u) / weight``."""
    drawn = df.withColumn("_w", -F.ln(unit_hash(F.col(key), seed)) / weight)
    return drawn.orderBy("_w", key).limit(n).drop("_w")


def adaptive_sizes(df: DataFrame, by: str, slice_col: str, value: str, *, start: int = 1000, cap: int = 5000) -> DataFrame:
    """Sample size per key: doubles up to ``cap`` whenever a slice's deviation exceeds the last by 20 %."""
    spread = df.groupBy(by, slice_col).agg(F.stddev_pop(value).alias("sd"))
    return _sizes(spread, by, slice_col, start, cap)


def _sizes(spread: DataFrame, by: str, slice_col: str, start: int, cap: int) -> DataFrame:
    before = F.lag("sd").over(Window.partitionBy(by).orderBy(slice_col))
    grew = spread.withColumn("grew", F.when(F.col("sd") > before * 1.2, 1).otherwise(0))
    return grew.groupBy(by).agg(F.sum("grew").alias("growths")).select(
        by,
        "growths",
        F.least(F.lit(cap), (F.lit(start) * F.pow(F.lit(2.0), F.col("growths"))).cast("long")).alias("sample_size"),
    )


BINS = 1024


def adaptive_sample(
    df: DataFrame, by: str, slice_col: str, value: str, key: str, *, start: int = 1000, cap: int = 5000, seed: str = "s"
) -> DataFrame:
    """The uniform sample that :func:`adaptive_sizes` sizes: the ``sample_size`` rows of a key with the smallest hashes.

    One pass over (key, slice, hash bin) gives both the size and the bin in which the size is reached; the second
    pass keeps the rows up to that bin, so only a key's share of the sample, and a bin, is ever put in order.
    """
    drawn = df.withColumn("_u", unit_hash(F.col(key), seed)).withColumn("_bin", F.floor(F.col("_u") * BINS).cast("int"))
    v = F.col(value).cast("double")
    fine = pinned(drawn.groupBy(by, slice_col, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.count(v).alias("_k"), F.sum(v).alias("_s"), F.sum(v * v).alias("_ss")))
    spread = fine.groupBy(by, slice_col).agg(deviation(F.sum("_s"), F.sum("_ss"), F.sum("_k")).alias("sd"))
    sizes = _sizes(spread, by, slice_col, start, cap).select(F.col(by).alias("_of"), "sample_size")
    upto = Window.partitionBy(by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = fine.groupBy(by, "_bin").agg(F.sum("_n").alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    reached = bins.join(sizes, F.col(by).eqNullSafe(F.col("_of"))).groupBy("_of", "sample_size")
    edges = reached.agg(F.min(F.when(F.col("_upto") >= F.col("sample_size"), F.col("_bin"))).alias("_edge"))
    rows = drawn.join(edges, F.col(by).eqNullSafe(F.col("_of"))).filter(F.col("_bin") <= F.coalesce("_edge", F.lit(BINS)))
    slices = F.pmod(F.xxhash64(key), F.lit(64))
    best = top_per_group(rows, [by], [F.col("_u"), F.col(key)], cap, "_r", within=slices)
    return best.filter(F.col("_r") <= F.col("sample_size")).select(*df.columns)


def frequencies(df: DataFrame, key: str) -> DataFrame:
    """Exact frequency of every key (map-side combined)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def frequency_sketch(df: DataFrame, key: str, eps: float = 0.001, confidence: float = 0.99, seed: int = 1) -> DataFrame:
    """Count-min sketch of a key column, as binary."""
    return df.agg(F.count_min_sketch(F.col(key), F.lit(eps), F.lit(confidence), F.lit(seed)).alias("sketch"))


def frequent_state(df: DataFrame, by: Sequence[str], key: str, share: float = 0.001) -> DataFrame:
    """Bounded, mergeable counters of the most frequent values of ``key``, one row per part, and the rows counted.

    ``8 / share`` counters are kept, so that every value with at least that share of the rows is among them.
    """
    state = F.expr(f"approx_top_k_accumulate(`{key}`, {counters(share)})").alias("state")
    return df.filter(F.col(key).isNotNull()).groupBy(*by).agg(state, F.count(F.lit(1)).alias("total"))


def counters(share: float) -> int:
    return int(8 / share) + 1


def frequent_values(states: DataFrame, by: Sequence[str], share: float = 0.001) -> DataFrame:
    """Values read back from merged states: ``item``, ``at_most`` and ``at_least`` rows with it, and the ``total``.

    The counters are an upper bound; they are too high by at most 3.5 rows in the size of the table, which is a power
    of two with a quarter to spare. Values that may have ``share`` of the rows are kept.
    """
    kept = counters(share)
    size = 1 << max(3, (-(-kept * 4 // 3) - 1).bit_length())
    merged = states.groupBy(*by).agg(F.expr(f"approx_top_k_combine(state, {kept})").alias("state"), F.sum("total").alias("total"))
    rows = merged.select(*by, "total", F.explode(F.expr(f"approx_top_k_estimate(state, {kept})")).alias("e"))
    error = F.ceil(F.col("total") * F.lit(3.5 / size))
    low = F.greatest(F.lit(1).cast("long"), F.col("e.count") - error)
    out = rows.select(*by, F.col("e.item").alias("item"), low.alias("at_least"), F.col("e.count").alias("at_most"), "total")
    return out.filter(F.col("at_most") >= F.col("total") * F.lit(share))


def heavy_hitters(df: DataFrame, key: str, share: float = 0.001) -> DataFrame:
    """Every value with at least ``share`` of the rows, with its exact count ``n`` and the bounds of the counters.

    The counters name at most ``8 / share`` candidates, few enough to send to all tasks; a second pass counts those only.
    """
    found = frequent_values(frequent_state(df, [], key, share), [], share)
    rows = df.join(F.broadcast(found), F.col(key) == F.col("item"))
    counted = rows.groupBy(key, "at_least", "at_most", "total").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= F.col("total") * F.lit(share)).select(key, "n", "at_least", "at_most")


def distinct_state(df: DataFrame, by: Sequence[str], value: Column, name: str = "hll") -> DataFrame:
    """Mergeable distinct-count state per key."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(14)).alias(name))


def distinct_estimate(state: DataFrame, by: Sequence[str], name: str = "hll") -> DataFrame:
    merged = F.hll_sketch_estimate(F.hll_union_agg(name, False))
    return state.groupBy(*by).agg(merged.alias("distinct_estimate"))


def quantile_state(df: DataFrame, by: Sequence[str], value: Column, name: str = "kll") -> DataFrame:
    """Mergeable quantile state per key."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(value.cast("double"), F.lit(800)).alias(name))


def quantile_estimate(state: DataFrame, by: Sequence[str], points: dict[str, float], name: str = "kll") -> DataFrame:
    merged = state.groupBy(*by).agg(F.kll_merge_agg_double(name).alias("_k"))
    picks = [F.kll_sketch_get_quantile_double("_k", F.lit(p)).alias(n) for n, p in points.items()]
    return merged.select(*by, *picks)
