"""Small helpers the operators share: shared folders, registry, column rules, bounded Arrow slices."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = r"[ \t-\r]"  # the six ASCII white-space characters
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # digits, a-z and everything outside ASCII, in lower-cased text


def register(name: str, sql: str | None = None):
    """Decorator: add a query and, where SQL can say it, its oracle."""

    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder every executor and the driver can reach: under the shared folder that the session
    names, else (tests) under the warehouse, which is always set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/work"
    return f"{shared.rstrip('/')}/hitlens/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{workspace(df.sparkSession, name)}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(df: DataFrame) -> None:
    """Delete a table that :func:`stored` wrote, once everything that reads it is stored itself."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder named by URI or by plain path."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def others(df: DataFrame, produced: Iterable[str]) -> list[Column]:
    """The columns of ``df`` that an operator passes on; on a clash of names its own column wins."""
    own = {c.lower() for c in produced}
    return [df[f"`{c}`"] for c in df.columns if c.lower() not in own]


def quoted(names: Iterable[str]) -> list[str]:
    """Column names as select() takes them, whatever characters they have."""
    return [f"`{c.replace('`', '``')}`" for c in names]


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow(run, schema)``, also for column names with dots, which that call cannot take."""
    inner, names = run, df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from inner(batches)
        pa.default_memory_pool().release_unused()  # the worker lives on

    if not any("." in c or "`" in c for c in names):
        return df.mapInArrow(run, schema)

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(pa.RecordBatch.from_arrays(batch.columns, names) for batch in batches)

    return df.toDF(*[f"c{k}" for k in range(len(names))]).mapInArrow(renamed, schema)


_HELD: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]) -> object:
    """What a Python worker keeps between tasks: the tables of one operator, the last that asked."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def wrapped(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc`` (the other columns as one), ``doc_id`` and ``text``: nothing can clash, the text travels once."""
    rest = [F.col(c) for c in quoted(c for c in docs.columns if c != text)]
    return docs.select(F.struct(*rest).alias("doc"), F.col("doc_id"), F.col(text).alias("text"))


def unwrapped(df: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` again, from rows that :func:`wrapped` made."""
    return df.select(*[F.col("text" if c == text else f"doc.{q}").alias(c) for c, q in zip(docs.columns, quoted(docs.columns), strict=True)])


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` (text, or lists of 32-bit numbers) holds about ``size`` bytes at a time; one
    longer value stays whole."""
    for batch in batches:
        values = batch.column(column)
        counted = pc.multiply(pc.list_value_length(values), 4) if pa.types.is_list(values.type) else pc.binary_length(values)
        lengths = pc.fill_null(counted, 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts_of(array: pa.Array) -> list[bytes]:
    """UTF-8 bytes per row, null as empty."""
    return pc.fill_null(array.cast(pa.binary()), b"").to_pylist()
