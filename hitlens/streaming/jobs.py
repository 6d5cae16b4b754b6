"""Streaming jobs: file watch, insert-time rollups, event time with a bound on lateness, alert episodes.

In the rollups late rows only add another partial state row to their hour, so nothing is dropped.
``windowed`` and ``unique`` on a stream use a watermark, whose bound is a parameter; ``start_event_time``
puts rows behind its bound into a table of their own. All state that a job keeps itself is one folder for each
micro-batch, which a replayed batch overwrites.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitlens.operators.measures import rate
from hitlens.streaming import state

c = F.col


def watch_lines(spark: SparkSession, path: str, *, glob: str | None = None, max_files: int = 100) -> DataFrame:
    """Lines of files as they appear in a folder."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select("value", c("_metadata.file_path").alias("source_file"))


def start_rollup(
    requests: DataFrame,
    keys: Sequence[str],
    state_path: str,
    checkpoint: str,
    *,
    also: Callable[[DataFrame, int], None] | None = None,
    every: str | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append partial state per micro-batch; a replayed batch overwrites its own folder (exactly once).

    ``also`` gets the same micro-batch, for instance to append the enriched rows to a table.
    ``every`` is a processing-time interval; without it the job drains what is there and stops.
    ``derive`` makes the enriched rows out of a micro-batch. Given here, only those of its columns are computed that
    the state needs; rows enriched before come with all of them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = derive(batch) if derive else batch
        state.partial(batch, keys).write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")
        if also is not None:
            also(batch, batch_id)

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _earlier(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What the batches before this one have written to a folder."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.filter(c("batch_id") < batch_id)


def _latest_time(spark: SparkSession, path: str, batch_id: int):
    """Latest event time that the batches before this one have seen, or None."""
    times = _earlier(spark, path, batch_id)
    return None if times is None else times.agg(F.max("latest")).first()[0]


def start_event_time(
    requests: DataFrame,
    keys: Sequence[str],
    folder: str,
    checkpoint: str,
    *,
    late_seconds: int = 3600,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Rollup state of the rows in time (``state``), and apart from it the rows behind the watermark (``late``).

    The watermark is the latest event time of the batches before, less ``late_seconds``. It comes from the job's own
    folder (``time``), so a batch that is run again draws the same line. ``derive``: see :func:`start_rollup`; each of
    the three tables has only the columns derived that it keeps.
    """
    spark = requests.sparkSession
    derived = derive or (lambda rows: rows)

    def write(batch: DataFrame, batch_id: int) -> None:
        latest = _latest_time(spark, f"{folder}/time", batch_id)
        behind = F.lit(False) if latest is None else c("log_time") < F.lit(latest) - F.make_interval(secs=F.lit(late_seconds))
        rows = batch.withColumn("_behind", F.coalesce(behind, F.lit(False)))
        on_time = rows.filter(~c("_behind")).drop("_behind")
        state.partial(derived(on_time), keys).write.mode("overwrite").parquet(f"{folder}/state/batch_id={batch_id}")
        derived(rows.filter("_behind").drop("_behind")).write.mode("overwrite").parquet(f"{folder}/late/batch_id={batch_id}")
        rows.agg(F.max("log_time").alias("latest")).write.mode("overwrite").parquet(f"{folder}/time/batch_id={batch_id}")

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def unique(requests: DataFrame, keys: Sequence[str], late: str = "1 hour", *, time: str = "log_time") -> DataFrame:
    """The first row of each key; on a stream keys are remembered as long as a repeat may still come."""
    if not requests.isStreaming:
        return requests.dropDuplicates(list(keys))
    return requests.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def _current(spark: SparkSession, state_path: str, folded: str | None) -> DataFrame:
    """Partial rows that count: the latest fold, and the batches after the last one in it."""
    batches = spark.read.parquet(state_path)
    if folded is None:
        return batches
    try:
        folds = spark.read.parquet(folded)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return batches
    through = folds.agg(F.max("through")).first()[0]
    later = batches.filter(c("batch_id") > through).drop("batch_id")
    return folds.filter(c("through") == through).drop("through").unionByName(later)


def read_rollup(spark: SparkSession, state_path: str, keys: Sequence[str], folded: str | None = None) -> DataFrame:
    """Current report over all partial state rows; with ``folded``, over the latest fold and what came later."""
    return state.report(state.merge(_current(spark, state_path, folded), keys), keys)


def compact(spark: SparkSession, state_path: str, keys: Sequence[str], target: str) -> None:
    """Fold the partial rows into one row per key, in a folder named after the last batch in it.

    A reader of the fold takes no earlier batch, so those may be deleted at any time.
    """
    last = spark.read.parquet(state_path).agg(F.max("batch_id")).first()[0]
    rows = _current(spark, state_path, target)
    state.merge(rows, keys).write.mode("overwrite").parquet(f"{target}/through={last}")


def windowed(requests: DataFrame, width: str, *, late: str = "1 hour", slide: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Requests, error and slow rate per tumbling or sliding window; works on batch and stream."""
    slot = F.window("log_time", width, slide) if slide else F.window("log_time", width)
    source = requests.withWatermark("log_time", late) if requests.isStreaming else requests
    out = source.groupBy(slot.alias("w"), *by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("is_error").alias("errors"),
        F.count_if("is_slow").alias("slow"),
        F.sum("duration_ms").alias("ms"),
    )
    n = c("requests")
    return out.select(
        c("w.start").alias("window_start"), c("w.end").alias("window_end"), *by, "requests",
        rate(c("errors"), n).alias("error_rate"),
        rate(c("slow"), n).alias("slow_rate"),
        (c("ms") / n).alias("avg_ms"),
    )


def alerts(windows: DataFrame, *, error_rate: float = 5.0, mean_ms: float = 3000.0) -> DataFrame:
    """Windows that break a threshold, one code per broken rule."""
    rules = F.array_compact(
        F.array(
            F.when(c("error_rate") > error_rate, F.lit("error_rate")),
            F.when(c("avg_ms") > mean_ms, F.lit("response_time")),
        )
    )
    return windows.withColumn("alert", F.explode(rules))


def pieces(windows: DataFrame, by: Sequence[str], **limits: float) -> DataFrame:
    """Windows that break a rule as episodes of one window each."""
    worst = F.when(c("alert") == "error_rate", c("error_rate")).otherwise(c("avg_ms"))
    return alerts(windows, **limits).select(
        *by, "alert", c("window_start").alias("raised"), c("window_end").alias("until"), F.lit(1).cast("long").alias("windows"), worst.alias("worst")
    )


def joined_up(parts: DataFrame, by: Sequence[str], *, hold_seconds: int = 0) -> DataFrame:
    """Episodes from pieces in any order: an alert is held while the next piece starts within ``hold_seconds`` of its end.

    The rows are windows with an alert, few per key, whatever the traffic.
    """
    key = [*by, "alert"]
    order = Window.partitionBy(*key).orderBy("raised", "until")
    before = F.max("until").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = c("raised") > before + F.make_interval(secs=F.lit(hold_seconds))
    rows = parts.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
    rows = rows.withColumn("_episode", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy(*key, "_episode").agg(
        F.min("raised").alias("raised"), F.max("until").alias("until"), F.sum("windows").alias("windows"), F.max("worst").alias("worst")
    ).drop("_episode")


def start_episodes(
    windows: DataFrame, by: Sequence[str], folder: str, checkpoint: str, *, width_seconds: int, hold_seconds: int = 0, **limits: float
) -> StreamingQuery:
    """Alerts as state over a stream of closed windows: raised, held, and cleared into one row per episode.

    Open episodes are the state (``open``, one folder for each batch). An episode is cleared, and written to
    ``cleared``, once the clock is so far that no window which could prolong it is still to come.
    """
    spark = windows.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        clocks = _earlier(spark, f"{folder}/clock", batch_id)  # one row for each batch, also where nothing is open
        clock, last = (None, None) if clocks is None else clocks.agg(F.max("latest"), F.max("batch_id")).first()
        batch = batch.persist()
        now = batch.agg(F.greatest(F.max("window_end"), F.lit(clock).cast("timestamp")).alias("latest"))
        now.write.mode("overwrite").parquet(f"{folder}/clock/batch_id={batch_id}")
        latest = spark.read.parquet(f"{folder}/clock/batch_id={batch_id}").first()[0]
        parts = pieces(batch, by, **limits)
        if last is not None:
            parts = parts.unionByName(spark.read.parquet(f"{folder}/open").filter(c("batch_id") == F.lit(last)).drop("batch_id"))
        made = joined_up(parts, by, hold_seconds=hold_seconds).persist()
        over = F.lit(latest) >= c("until") + F.make_interval(secs=F.lit(hold_seconds + width_seconds))
        over = F.coalesce(over, F.lit(False))
        made.filter(over).write.mode("overwrite").parquet(f"{folder}/cleared/batch_id={batch_id}")
        made.filter(~over).write.mode("overwrite").parquet(f"{folder}/open/batch_id={batch_id}")
        made.unpersist()
        batch.unpersist()

    writer = windows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_episodes(spark: SparkSession, folder: str) -> DataFrame:
    """All episodes so far with ``state``: cleared ones, and those still open after the last batch."""
    cleared = spark.read.parquet(f"{folder}/cleared").drop("batch_id").withColumn("state", F.lit("cleared"))
    held = spark.read.parquet(f"{folder}/open")
    last = spark.read.parquet(f"{folder}/clock").agg(F.max("batch_id")).first()[0]
    return cleared.unionByName(held.filter(c("batch_id") == F.lit(last)).drop("batch_id").withColumn("state", F.lit("open")))
