"""Windows over all rows of a table in order, without one task that sorts them all.

``Window.orderBy`` without a partition moves every row to one task. Here rows are numbered first: inside
chunks of the order, lifted by the running count of the chunks before (one row per chunk). The numbers
then cut the rows into even blocks; a row near an edge also goes to the neighbouring block, as far as the
frames reach, and every block answers for its own rows. ``chunk`` must rise with ``order`` and keep
chunks small, say a span of time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK = 4096


def spans(moment: Column, seconds: int = BLOCK) -> Column:
    """Chunks of a time order: as many rows as there are in so many seconds."""
    return F.floor(F.unix_seconds(moment.cast("timestamp")) / seconds)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` with a test that always holds and reads every column.

    Two branches that need different columns of a shuffled result are planned as two shuffles over two
    scans. With the test, both need all of them, and Spark runs the common part once.
    """
    return df.filter(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) >= F.lit(-(1 << 63)))


def numbered(df: DataFrame, order: Sequence[str | Column], chunk: Column, name: str = "row", *, total: str | None = None) -> DataFrame:
    """``name``: place of each row in the order, from 1; ``total``: the number of rows. The order must be total."""
    inner = Window.partitionBy("_chunk").orderBy(*order)
    rows = df.withColumn("_chunk", chunk).withColumns({"_at": F.row_number().over(inner), "_more": F.lead(F.lit(1)).over(inner)})
    rows = pinned(rows)
    lasts = rows.filter("_more is null").select(F.col("_chunk").alias("_of"), F.col("_at").cast("long").alias("_size"))
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    bases = lasts.select("_of", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"), F.sum("_size").over(Window.partitionBy()).alias("_all"))
    joined = rows.join(bases, F.col("_chunk").eqNullSafe(F.col("_of")))
    added = [(F.col("_at") + F.col("_base")).alias(name)] + ([F.col("_all").alias(total)] if total else [])
    return joined.select(*df.columns, *added)


def framed(
    df: DataFrame,
    order: Sequence[str | Column],
    chunk: Column,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    *,
    before: int = 0,
    after: int = 0,
    block: int = BLOCK,
) -> DataFrame:
    """Add window columns over the ordered rows; frames and offsets reach ``before`` rows back and ``after`` ahead."""
    size = max(block, before, after)
    rows = numbered(df, order, chunk, "_row")
    own, place = F.floor((F.col("_row") - 1) / size), (F.col("_row") - 1) % size
    blocks = F.array_compact(F.array(own, F.when(place >= size - before, own + 1), F.when(place < after, own - 1)))
    spread = rows.withColumn("_own", own).withColumn("_block", F.explode(blocks))
    spec = Window.partitionBy("_block").orderBy("_row")
    out = spread.withColumns({name: make(spec) for name, make in columns.items()})
    return out.filter("_block = _own").select(*df.columns, *columns)


def lagged(df: DataFrame, order: Sequence[str | Column], chunk: Column, columns: Mapping[str, str], rows: int = 1) -> DataFrame:
    """Add the values that the columns have ``rows`` rows earlier (later if negative): ``{new name: column}``."""
    made = {name: (lambda w, c=c: F.lag(c, rows).over(w)) for name, c in columns.items()}
    return framed(df, order, chunk, made, before=max(rows, 0), after=max(-rows, 0))
