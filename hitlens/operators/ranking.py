"""Sort, top-k, shares and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global top-n: each task keeps n rows, the rest never leaves it."""
    return df.orderBy(*order).limit(n)


def ranked_top(df: DataFrame, order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """Top-n with its rank; only the n kept rows are numbered."""
    return top(df, order, n).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "rank", *, within: Column | None = None
) -> DataFrame:
    """First k rows per group. Spark cuts each group to k rows before the shuffle, but only for small k.

    ``within`` cuts a group into slices (say, a hash of the row's id): each slice is reduced to k rows
    for itself first, whatever k is, so that no task holds more of a hot group than its slices' best.
    """
    if within is not None:
        df = top_per_group(df.withColumn("_within", within), [*by, "_within"], order, k, name).drop("_within", name)
    spec = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(spec)).filter(F.col(name) <= k)


def share_of_total(df: DataFrame, value: str, name: str = "share", *, source: DataFrame | None = None) -> DataFrame:
    """Percentage of the grand total, from a one-value subquery: no join, no single-task window.

    With ``source`` the total is that table's row count, which a columnar scan answers without
    reading data, instead of a second run of the report.
    """
    total = (df.agg(F.sum(value)) if source is None else source.agg(F.count(F.lit(1)))).scalar()
    return df.withColumn(name, F.col(value) * F.lit(100.0) / total)


def with_totals(df: DataFrame, by: Sequence[str], totals: Mapping[str, str], *, spread: int | None = None) -> DataFrame:
    """Add the group's total of columns (``{new name: column}``) to already aggregated rows, without a second run of the report.

    Subtotal rows travel with the rows: one aggregation by the whole row and by the group alone gives
    both, and the subtotal is handed to ``spread`` slices of its group, each of which is a window of its own. A
    hot group thus takes ``spread`` tasks, and nothing is joined. Equal rows are kept as often as they come.
    """
    spread = spread or (16 if by else 256)
    rest = [c for c in df.columns if c not in by]
    rows, names = df.select(*by, F.struct(*rest).alias("_row"), *[F.col(c).alias(f"_v{k}") for k, c in enumerate(totals.values())]), list(totals)
    sums = [F.sum(f"_v{k}").alias(f"_t{k}") for k in range(len(names))]
    both = rows.groupingSets([[*by, "_row"], [*by]], *by, "_row").agg(F.grouping("_row").alias("_sub"), F.count(F.lit(1)).alias("_times"), *sums)
    sub = F.col("_sub") == 1
    slices = F.when(sub, F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.pmod(F.xxhash64("_row"), F.lit(spread)).cast("int")))
    part = Window.partitionBy(*by, "_part")
    found = both.withColumn("_part", F.explode(slices)).withColumns({f"_t{k}": F.max(F.when(sub, F.col(f"_t{k}"))).over(part) for k in range(len(names))})
    found = found.filter(~sub).withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return found.select(*[F.col(c) if c in by else F.col("_row")[c].alias(c) for c in df.columns], *[F.col(f"_t{k}").alias(n) for k, n in enumerate(names)])


def share_in_group(df: DataFrame, by: Sequence[str], value: str, name: str = "share") -> DataFrame:
    """Percentage of the group's total over already aggregated rows, in one run of the report."""
    out = with_totals(df, by, {"_total": value})
    return out.select(*df.columns, (F.col(value) * F.lit(100.0) / F.col("_total")).alias(name))


def stack_up(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def label_order(label: Column, order: Sequence[str]) -> Column:
    """Position of a label in a fixed order, for sorting severities."""
    return F.array_position(F.array(*[F.lit(x) for x in order]), label)


def top_lists(df: DataFrame, lists: dict[str, Column], keep: Sequence[str], k: int, tie: Sequence[str]) -> DataFrame:
    """Several top-k lists of one table in a single pass: (list, rank, value, *keep).

    ``lists`` maps a list name to the value it ranks by (descending); NULL keeps a row out.
    """
    entries = F.array(
        *[F.struct(F.lit(name).alias("list"), value.cast("double").alias("value")) for name, value in lists.items()]
    )
    rows = df.select(*keep, F.explode(entries).alias("_e")).select(*keep, "_e.list", "_e.value")
    return top_per_group(
        rows.filter(F.col("value").isNotNull()), ["list"], [F.desc("value"), *[F.asc(t) for t in tie]], k
    )


def side_by_side(ranked: DataFrame, names: Sequence[str], item: str) -> DataFrame:
    """Ranked lists next to each other, one row per rank (a pivot over the few kept rows, no join)."""
    columns = [
        F.max(F.when(F.col("list") == name, F.col(source))).alias(f"{name}_{label}")
        for name in names
        for source, label in ((item, item), ("value", "value"))
    ]
    return ranked.groupBy("rank").agg(*columns)


def latest(df: DataFrame, by: Sequence[str], version: str) -> DataFrame:
    """Latest version of every key."""
    rest = [c for c in df.columns if c not in by]
    picked = df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row"))
    return picked.select(*by, *[F.col("_row")[c].alias(c) for c in rest])
