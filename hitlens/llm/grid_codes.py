"""Vector codes by product quantisation on integers, with memoised grid cells.

A vector becomes ``floor(SCALE * x)`` per component and is cut into ``PARTS`` equal parts; each part is coded by its
nearest codebook entry. To find it, the part's place is rounded down to a coarse grid cell. For a cell seen first, the
least and greatest squared distance from its box to every entry are taken; an entry whose least distance is beyond the
smallest greatest one is dominated everywhere in the box, and the mask of the others is kept under the cell. Parts in
a known cell evaluate only the entries of its mask, exactly, so the codes are those of a full search.

Plan: the integer vectors are stored once in the shared folder. A round sends the codebooks (``ENTRIES`` vectors) to the
tasks, each task adds up its own vectors per part and entry, and the sums of all tasks meet in one small aggregation;
the driver sees PARTS x ENTRIES rows a round. Cells are kept per Python worker, ``CELLS`` at most, then forgotten.

Defined results: rows whose vector is null, empty, or holds a null or non-finite component are dropped; rows with another
number of components than the kept row of the smallest vec_id with whole parts keep a null code and error; components
beyond 2^27 after scaling are taken as 2^27, so that sums stay exact; a null vec_id comes last among the
seeds, equal ones are ordered by their packed vectors; repeated rows are coded one by one; fewer than ENTRIES rows make a smaller
codebook; an empty table gives an empty result; extra columns pass, a clashing one is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlens.llm.common import held, mapped, others, quoted, register, stored, table

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LIMIT = 1 << 27  # of an integer component: squared distances and their sums stay far inside 64 bits
CELLS = 200_000


def integers(vectors: DataFrame, vector: str) -> DataFrame:
    """The other columns and ``point``: the scaled components as packed 32-bit numbers; unusable rows are gone."""
    carried = others(vectors, ["point", "code", "error", vector])
    source = vectors.select(*carried, F.col(quoted([vector])[0]).cast("array<double>").alias("point"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("point", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.greater(pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0), 0))
            lists = batch.column(batch.num_columns - 1)
            if not batch.num_rows:
                continue
            flat = pc.fill_null(lists.flatten(), np.nan).to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            usable = np.logical_and.reduceat(np.isfinite(flat), np.concatenate([[0], ends[:-1]]))
            scaled = np.clip(np.floor(SCALE * np.nan_to_num(flat)), -LIMIT, LIMIT).astype("<i4").tobytes()
            offsets = pa.py_buffer((4 * np.concatenate([[0], ends])).astype(np.int32))
            points = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(scaled)])
            out = pa.RecordBatch.from_arrays([*batch.columns[:-1], points], schema.names)
            yield out.filter(pa.array(usable))

    return mapped(source, run, schema)


def matrix(points: pa.Array, parts: int, width: int) -> np.ndarray:
    """Packed vectors of one length as rows x parts x components."""
    return np.frombuffer(b"".join(points.to_pylist()), dtype="<i4").astype(np.int64).reshape(-1, parts, width)


class Cells:
    """Nearest entries of one part's codebook, with the entries that matter remembered per grid cell."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        apart = ((entries[:, None] - entries[None]) ** 2).sum(axis=2).astype(float)
        np.fill_diagonal(apart, np.inf)
        near = np.sqrt(np.median(apart.min(axis=1))) if len(entries) > 1 else 1.0
        # a box whose diagonal is about half of the way between entries, as a power of two
        self.shift = max(0, int(np.floor(np.log2(max(1.0, near / 2 / np.sqrt(entries.shape[1]))))))
        self.masks: dict[bytes, int] = {}

    def learn(self, cells: np.ndarray) -> list[int]:
        """Masks of cells: bit k is set where entry k may be nearest to some place in the box."""
        low = (cells.astype(np.int64) << self.shift)[:, None]
        high = low + (1 << self.shift) - 1
        gap = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
        reach = np.maximum(np.abs(self.entries - low), np.abs(self.entries - high))
        least, most = (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)
        open_ = least <= most.min(axis=1, keepdims=True)
        return (open_.astype(np.int64) << np.arange(len(self.entries))).sum(axis=1).tolist()

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each row; ties go to the lower entry."""
        cells = np.ascontiguousarray(x >> self.shift, dtype="<i4")
        keys = cells.view(f"V{4 * x.shape[1]}").ravel().tolist()
        new = {key: k for k, key in enumerate(keys) if key not in self.masks}
        if len(self.masks) + len(new) > CELLS:
            self.masks.clear()
            new = {key: k for k, key in enumerate(keys)}
        if new:
            self.masks.update(zip(new, self.learn(cells[list(new.values())]), strict=True))
        masks = np.fromiter(map(self.masks.__getitem__, keys), dtype=np.int64, count=len(keys))
        best = np.full(len(x), np.iinfo(np.int64).max)
        chosen = np.zeros(len(x), dtype=np.int64)
        for k, entry in enumerate(self.entries):
            rows = np.flatnonzero(masks >> k & 1)
            gap = x[rows] - entry
            distance = np.einsum("ij,ij->i", gap, gap)
            closer = distance < best[rows]
            best[rows[closer]] = distance[closer]
            chosen[rows[closer]] = k
        return chosen, best


def assigned(books: np.ndarray, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per part its number, entries and distances, by the cells this worker keeps for these codebooks."""
    cells = held(("cells", hashlib.sha256(books.tobytes()).digest(), books.shape), lambda: [Cells(book) for book in books])
    for part, known in enumerate(cells):
        yield part, *known.nearest(x[:, part])


def refined(points: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose used entries are the floored means of the parts nearest to them."""
    parts, entries, width = books.shape
    names = ["part", "entry", "n", *[f"s{j}" for j in range(width)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for batch in batches:
            x = matrix(batch.column(0), parts, width)
            for part, chosen, _ in assigned(books, x):
                for k in np.unique(chosen).tolist():
                    rows = x[chosen == k, part]
                    sums[part, k, 0] += len(rows)
                    sums[part, k, 1:] += rows.sum(axis=0)
        part, entry = np.nonzero(sums[:, :, 0])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (part, entry, *sums[part, entry].T)], names)

    fitting = points.filter(F.octet_length("point") == 4 * parts * width).select("point")
    each = mapped(fitting, run, ", ".join(f"{n} long" for n in names))
    total = each.groupBy("part", "entry").agg(*[F.sum(n).alias(n) for n in names[2:]])
    out = books.copy()
    for part, entry, n, *sums in total.collect():  # a row for each part and entry
        out[part, entry] = np.array(sums, dtype=np.int64) // n
    return out


def seeds(points: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The first codebooks: the parts of the smallest vec_ids; None without a usable row."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("point")]
    whole = points.filter(F.octet_length("point") % (4 * parts) == 0)
    first = whole.orderBy(*order).select(F.octet_length("point").alias("n")).head()
    if first is None:
        return None
    rows = points.filter(F.octet_length("point") == first.n).orderBy(*order).select("point").limit(entries).collect()
    return matrix(pa.array([bytes(r.point) for r in rows], pa.binary()), parts, first.n // (4 * parts)).transpose(1, 0, 2).copy()


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(points: DataFrame, books: np.ndarray) -> DataFrame:
    """``point`` replaced by ``code`` (two hex digits for each part) and ``error``."""
    parts, _, width = books.shape
    fields = [f for f in points.schema.fields if f.name != "point"]
    schema = T.StructType([*fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = pc.equal(pc.binary_length(batch.column(batch.num_columns - 1)), 4 * parts * width).to_numpy(zero_copy_only=False)
            x = matrix(batch.column(batch.num_columns - 1).filter(pa.array(fits)), parts, width)
            codes, error = np.zeros((len(x), parts), dtype=np.uint8), np.zeros(len(x), dtype=np.int64)
            for part, chosen, distance in assigned(books, x):
                codes[:, part] = chosen
                error += distance
            at = pa.array(np.where(fits, np.cumsum(fits) - 1, 0), mask=~fits)
            made = [pa.array([c.tobytes().hex() for c in codes], pa.string()).take(at), pa.array(error).take(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], schema.names)

    return mapped(points, run, schema)


def compressed(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """The usable rows with ``code`` and ``error`` (stored), and the codebooks: parts x entries x components."""
    points = stored(integers(vectors, vector), "points")
    books = seeds(points, parts, entries)
    if books is None:
        null = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")]
        return points.select(*quoted(c for c in points.columns if c != "point"), *null), None
    for _ in range(rounds):
        books = refined(points, books)
    names = [c for c in points.columns if c != "point"]
    return stored(coded(points.select(*quoted(names), "point"), books), "codes"), books


def _sql() -> str:
    """The same rounds over one row for each vector and part."""
    xs = [f"x{j}" for j in range(1, 9)]
    far = " + ".join(f"(a.{x} - c.{x}) * (a.{x} - c.{x})" for x in xs)

    def nearest(books: str) -> str:
        pairs = f"SELECT a.*, c.e, {far} AS d FROM pts a JOIN {books} c ON a.p = c.p"
        return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) AS rn FROM ({pairs})) WHERE rn = 1"

    steps = [
        "ok AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings"
        " WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "pts AS MATERIALIZED (SELECT vec_id, label, p, " + ", ".join(f"v[CAST(p * 8 + {j} AS INT)] AS x{j}" for j in range(1, 9))
        + " FROM (SELECT *, unnest(range(8)) AS p FROM ok))",
        f"c0 AS MATERIALIZED (SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, {', '.join(xs)} FROM pts"
        " WHERE vec_id IN (SELECT vec_id FROM ok ORDER BY vec_id LIMIT 16))",
    ]
    for k in range(ROUNDS):
        mean = ", ".join(f"(sum({x}) - ((sum({x}) % count(*)) + count(*)) % count(*)) // count(*) AS {x}" for x in xs)
        steps.append(f"m{k + 1} AS MATERIALIZED (SELECT p, e, {mean} FROM ({nearest(f'c{k}')}) GROUP BY p, e)")
        new = ", ".join(f"CAST(coalesce(m.{x}, c.{x}) AS BIGINT) AS {x}" for x in xs)
        steps.append(f"c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, {new} FROM c{k} c LEFT JOIN m{k + 1} m ON c.p = m.p AND c.e = m.e)")
    last = f"c{ROUNDS}"
    steps += [
        f"out AS MATERIALIZED (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM ({nearest(last)}) GROUP BY vec_id)",
        f"sha AS (SELECT sha256(string_agg(concat_ws(',', {', '.join(xs)}), ',' ORDER BY p, e)) AS s FROM {last})",
    ]
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256 FROM out, sha"


@register("op11_vector_codes", _sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compressed(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    if books is None:
        sums = sums.withColumn("codebooks_sha256", F.lit(None).cast("string"))
    else:
        sums = sums.withColumn("codebooks_sha256", F.lit(digest(books)))
        sums = stored(sums, "label-errors")  # its size is known then, so that Spark sends it only if it is small
    joined = codes.join(sums, codes["label"].eqNullSafe(sums["of"]), "left")
    return joined.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
