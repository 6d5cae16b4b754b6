"""Reading log folders, file-derived columns, and the manifest of processed files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitlens.operators.ordered import lagged, spans
from hitlens.operators.ranking import latest
from hitlens.schema import METRIC_SCHEMA, canonical, coerce


def read_lines(spark: SparkSession, path: str | Sequence[str], *, glob: str | None = None) -> DataFrame:
    """Text lines (gzip included) of a folder tree with source file and a rising line id per file block.

    A gzip file cannot be split: many small archives read in parallel, one huge archive does not.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
    )


def first_lines(lines: DataFrame, n: int = 5) -> DataFrame:
    """The first n lines of each file, numbered from 1; only first blocks take part."""
    spec = Window.partitionBy("source_file").orderBy("line_id")
    head = lines.filter(F.col("block_start") == 0).withColumn("line_no", F.row_number().over(spec))
    return head.filter(F.col("line_no") <= n)


def read_staged_csv(spark: SparkSession, path: str, aliases: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """CSV with a header -> canonical columns with safe casts (no schema inference pass)."""
    raw = spark.read.option("header", "true").csv(path)
    return coerce(canonical(raw) if aliases is None else canonical(raw, aliases))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metric samples ``(metric, cluster, instance, ts, value)``."""
    return spark.read.schema(METRIC_SCHEMA).parquet(path)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def application_from_file(name: Column) -> Column:
    """Application from a log file name: parts before the last ``_x.log``, else before the last two."""
    parts = F.split(name, "_")
    n = F.size(parts)
    keep = F.when(F.element_at(parts, -1).endswith(".log"), n - 1).otherwise(n - 2)
    joined = F.array_join(F.slice(parts, 1, F.greatest(keep, F.lit(0))), "_")
    return F.when(n >= 2, joined).otherwise(F.substring_index(name, ".", 1))


def archive_log_date(name: Column) -> Column:
    """Log date of an archive: the day before the first eight digits of its name; NULL if unreadable."""
    day = F.try_to_timestamp(F.regexp_extract(name, r"^(\d{8})", 1), F.lit("yyyyMMdd"))
    return F.date_sub(F.to_date(day), 1)


def name_range(name: Column) -> tuple[Column, Column]:
    """Start and end from ``…_YYYY_MM_DD_HHMMSS_HHMMSS…``; NULL if the name has no range."""
    pattern = r"(\d{4}_\d{2}_\d{2})_(\d{6})_(\d{6})"
    day = F.regexp_extract(name, pattern, 1)

    def moment(i: int) -> Column:
        return F.try_to_timestamp(F.concat(day, F.regexp_extract(name, pattern, i)), F.lit("yyyy_MM_ddHHmmss"))

    return moment(2), moment(3)


def continuity(files: DataFrame, name: str = "file") -> DataFrame:
    """Gaps in a set of file ranges: a file ends before the next one starts. One row per file."""
    start, end = name_range(F.col(name))
    ranged = files.select(name, start.alias("range_start"), end.alias("range_end")).filter("range_start is not null")
    out = lagged(ranged, ["range_start", name], spans(F.col("range_start")), {"next_start": "range_start"}, -1)
    gap = F.unix_timestamp("next_start") - F.unix_timestamp("range_end")
    return out.withColumn("gap_seconds", F.when(gap > 0, gap).otherwise(F.lit(0)))


def list_files(spark: SparkSession, path: str, *, glob: str = "*") -> DataFrame:
    """Recursive listing with size and time; file contents are not read (column pruning)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(F.col("path").alias("file"), "length", "modificationTime")
    )


def content_fingerprints(lines: DataFrame) -> DataFrame:
    """Content fingerprint per file from per-line hashes, so no task holds a whole file.

    Only the lines decide it (two independent sums and their number), so it does not depend on how the
    folder was split into tasks, nor on the other files. Lines that change places go unnoticed.
    """

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(38,0)")).cast("string")

    n = F.count(F.lit(1))
    return lines.groupBy(F.col("source_file").alias("file")).agg(
        n.alias("lines"), F.concat_ws("/", n.cast("string"), total(1), total(2)).alias("hash")
    )


def pending(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose (name, hash) is not recorded as completed; failed and unfinished ones return."""
    current = latest(manifest, ["file"], "updated_at").filter(F.col("state") == "completed")
    return files.join(current.select("file", "hash"), ["file", "hash"], "left_anti")


def manifest_rows(files: DataFrame, state: str, updated_at: Column) -> DataFrame:
    """Append-only state rows (processing / completed / failed); the latest per file counts."""
    return files.select("file", "hash", F.lit(state).alias("state"), updated_at.alias("updated_at"))


def reset_failed(manifest: DataFrame, updated_at: Column) -> DataFrame:
    """New ``pending`` rows for every file whose latest state is failed."""
    failed = latest(manifest, ["file"], "updated_at").filter(F.col("state") == "failed")
    return manifest_rows(failed, "pending", updated_at)
