"""Writing tables: partitioned Parquet, CSV, retention and deletion."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: age limits in days per layer
RETENTION_DAYS = {"raw": 90, "enriched": 365, "rollup": 1095, "ranking_short": 7, "ranking": 30, "ranking_long": 90}
PARTITION_KEYS = ["date", "tenant", "environment"]


def with_fallbacks(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill missing key fields and say so in ``enrichment_status``."""
    missing = F.lit(False)
    for name in defaults:
        missing = missing | F.col(name).isNull()
    out = df.withColumn("enrichment_status", F.when(missing, F.lit("fallback")).otherwise(F.lit("complete")))
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()})


def write_table(
    df: DataFrame,
    path: str,
    *,
    keys: Sequence[str] = PARTITION_KEYS,
    sort_by: Sequence[str] = ("log_time",),
    mode: str = "append",
    bloom: Sequence[str] = (),
) -> None:
    """Partitioned Parquet, sorted inside files so that row groups can be skipped.

    REBALANCE lets AQE cut a hot partition value into several files and merge small ones.
    """
    out = df.withColumn("date", F.to_date("log_time")) if "date" in keys and "date" not in df.columns else df
    writer = out.hint("rebalance", *keys).sortWithinPartitions(*keys, *sort_by).write.mode(mode)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def retain(df: DataFrame, column: str, limit: int | str, today: date) -> DataFrame:
    """Rows not older than a number of days or a layer's limit; on a partition column this prunes folders."""
    days = RETENTION_DAYS[limit] if isinstance(limit, str) else limit
    return df.filter(F.col(column) >= F.lit(today - timedelta(days=days)).cast("date"))


def kept_after_delete(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """All rows outside [start, end]."""
    inside = F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return df.filter(~F.coalesce(inside, F.lit(False)))


def delete_dates(spark: SparkSession, path: str, start: date, end: date, *, key: str = "date") -> list[str]:
    """Drop the folders of whole dates. Metadata only: no row is read or moved."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    day = start
    while day <= end:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{key}={day.isoformat()}")
        if fs.exists(folder) and fs.delete(folder, True):
            dropped.append(day.isoformat())
        day += timedelta(days=1)
    return dropped
