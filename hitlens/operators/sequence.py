"""Previous-row operators that split a hot key by time.

A ``lag`` partitioned by key alone sorts the whole of a hot key in one task. Here the window is
partitioned by (key, time slice); only the first row of a slice looks up the last row of the key's
previous non-empty slice, a table with one row per key and slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    *,
    slice_of: Column,
    prefix: str = "prev_",
) -> DataFrame:
    """Add ``prev_<carry>`` of the preceding row per key; order columns must be total per key."""
    inner = Window.partitionBy(*by, "_slice").orderBy(*order)
    rows = df.withColumn("_slice", slice_of).withColumns(
        {
            "_at": F.row_number().over(inner),
            "_more": F.lead(F.lit(1)).over(inner),
            **{f"_lag_{c}": F.lag(c).over(inner) for c in carry},
        }
    )
    # the last row of a slice comes from the same window, so both branches share one shuffle
    last = rows.filter(F.col("_more").isNull()).select(*by, "_slice", F.struct(*carry).alias("_last"))
    across = Window.partitionBy(*by).orderBy("_slice")
    before = last.select(*by, "_slice", F.lag("_last").over(across).alias("_before"))
    # keys may be NULL, and a NULL key has rows in a row like any other
    before = before.select(*[F.col(k).alias(f"_of_{k}") for k in (*by, "_slice")], "_before")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in (*by, "_slice")])
    joined = rows.join(before, same, "left")
    first = F.col("_at") == 1
    picked = {
        f"{prefix}{c}": F.when(first, F.col("_before")[c]).otherwise(F.col(f"_lag_{c}")) for c in carry
    }
    return joined.withColumns(picked).select(*df.columns, *picked)


def slice_seconds(df: DataFrame, by: Sequence[str], ts: str, *, rows: int = 100_000, seconds: int = 3600) -> Column:
    """Width of time slices in which no key has many more than ``rows`` rows: ``seconds``, or less where a key is hot.

    One value from a count per key and span of ``seconds``, which map tasks combine; rows are not moved for it.
    """
    span = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / seconds)
    most = df.groupBy(*by, span.alias("_span")).agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.max("_n"), F.lit(1)).alias("_most"))
    finer = F.greatest(F.lit(1), F.floor(F.lit(seconds) * rows / F.col("_most")))
    return most.select(F.least(F.lit(seconds), finer)).scalar()


def prefix_sums(df: DataFrame, order: str, columns: Sequence[str], chunk: Column) -> DataFrame:
    """Running sums ``upto_<column>`` over rows in order, without one task for all rows.

    ``chunk`` must rise with ``order``: sums run inside each chunk and are lifted by the running
    sum over the chunk totals, one row per chunk.
    """
    cut = df.withColumn("_chunk", chunk)
    inner = Window.partitionBy("_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = cut.groupBy("_chunk").agg(*[F.sum(c).alias(f"_sum_{c}") for c in columns])
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "_chunk", *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_base_{c}") for c in columns]
    )
    out = cut.withColumns({f"_in_{c}": F.sum(c).over(inner) for c in columns}).join(bases, "_chunk")
    return out.select(*df.columns, *[(F.col(f"_in_{c}") + F.col(f"_base_{c}")).alias(f"upto_{c}") for c in columns])


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Running sum over bucket rows (one row per time bucket, so few)."""
    spec = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(spec))
