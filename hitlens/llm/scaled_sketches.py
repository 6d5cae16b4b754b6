"""Document fingerprints as threshold-scaled sketches: every shingle hash below a fixed share of the hash range.

A text's words (A-Z lower-cased, cut at white space) give shingles of ``WIDTH`` words, each one hash of 64 bits. The sketch
is the set of the hashes below ``2**64 / SHARE``. As the threshold is the same for all texts, however long, the sketch of
texts put together is the union of their sketches, and the part of one sketch found in another estimates the part of
one text's shingles found in the other, also between a line and a book. A text without any hash below the threshold
keeps its smallest one, which a union drops again as soon as another one is below. Two sketches compare by containment
(``covered``: the share of the first found in the second) and by the share of both (``alike``).

Plan of :func:`edited`: one range partitioning by doc_id, of compressed texts, puts neighbours into the same task; tasks
carry a text over to the next row and compare sketches at hand. What they find is stored, with the last text of a
partition and the first of the next, one row each for a partition, which are joined by partition afterwards.

Defined results: a null text counts as empty; an empty text (no words) has an empty sketch, which covers and is like
another empty one only (1, else 0); fewer words than WIDTH are one shingle; repeated shingles count once; equal doc_ids
are ordered by a hash of their texts, a null one comes first; the document after the last is the first, a lone one follows
itself; repeated rows are documents of their own; an empty table gives an empty result; extra columns pass, a
clashing one is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from hitlens.llm.common import held, mapped, mixed, others, quoted, register, slices, stored, table, texts_of

WIDTH = 5
SHARE = 8  # one hash of so many is kept
THRESHOLD = np.uint64(2**64 // SHARE)
SEED = 42
WORDS = 150_000  # distinct short words whose hashes a worker keeps
LONG = 64  # bytes; longer words are hashed each time
MADE = [
    ("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.BinaryType()), ("edited_fingerprint", T.BinaryType()),
    *[(name, T.DoubleType()) for name in ("near_edited", "near_next", "alike_edited", "alike_next")],
]


def word_hashes(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = held(("words", SEED), dict)
    if len(known) > WORDS:
        known.clear()
    out = []
    for w in words:
        found = known.get(w)
        if found is None:
            found = xxh64_intdigest(w, SEED)
            if len(w) <= LONG:
                known[w] = found
        out.append(found)
    return np.array(out, dtype=np.uint64)


def shingle_hashes(text: str, width: int = WIDTH) -> np.ndarray:
    """A hash for each run of ``width`` words, of their hashes in order; fewer words are one run."""
    words = text.encode().lower().split()  # bytes: A-Z and the six ASCII white-space characters only
    if not words:
        return np.array([], dtype=np.uint64)
    each = word_hashes(words)
    n = max(1, len(words) - width + 1)
    state = np.full(n, min(width, len(words)), dtype=np.uint64)
    for k in range(min(width, len(words))):
        state = mixed(state * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n])
    return state


def kept(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set of hashes, ascending: those below the threshold, or else the smallest."""
    distinct = np.unique(hashes)
    below = int(np.searchsorted(distinct, THRESHOLD))
    return distinct[: max(1, below)]


def sketch(text: str, width: int = WIDTH) -> bytes:
    """The sketch of a text, as big-endian 64-bit numbers."""
    return kept(shingle_hashes(text, width)).astype(">u8").tobytes()


def hashes_of(fingerprint: Column) -> Column:
    """A sketch in hex as an array of 16-digit numbers, ascending."""
    return F.regexp_extract_all(fingerprint, F.lit("[0-9a-f]{16}"), F.lit(0))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together, from their sketches (arrays of hex numbers)."""
    both = F.array_sort(F.array_union(a, b))
    below = F.filter(both, lambda x: x < F.lit(f"{int(THRESHOLD):016x}"))
    return F.when(F.size(below) > 0, below).otherwise(F.slice(both, 1, 1))


def covered(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second one has."""
    empty = F.when(F.size(b) == 0, 1.0).otherwise(0.0)
    return F.when(F.size(a) == 0, empty).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def alike(a: Column, b: Column) -> Column:
    """Estimated share of both texts' shingles that they have in common."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def sketched(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """The other columns of ``docs`` with ``sketch``, an array of hex numbers; texts are read whole, nothing is shuffled."""
    source = docs.select(*others(docs, ["sketch", text]), F.coalesce(F.col(quoted([text])[0]).cast("string"), F.lit("")).alias("sketch"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "sketch"):
            made = pa.array([sketch(t, width) for t in part.column("sketch").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], schema.names)

    packed = mapped(source, run, schema)
    return packed.select(*quoted(packed.columns[:-1]), hashes_of(F.lower(F.hex("sketch"))).alias("sketch"))


def compared(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """:func:`covered` and :func:`alike` of two sketches at hand."""
    if not len(a) or not len(b):
        return (1.0, 1.0) if len(a) == len(b) else (0.0, 0.0)
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / len(a), common / (len(a) + len(b) - common)


class Text:
    """A document on its way through a task: its compressed text, unpacked, and its sketch."""

    def __init__(self, packed: bytes, width: int) -> None:
        self.packed, self.width = packed, width
        self.text = zstandard.ZstdDecompressor().decompress(packed).decode()
        self.sketch = kept(shingle_hashes(self.text, width))

    def row(self, after: Text) -> tuple:
        """The columns of MADE: the edited text's last half is the start of the document after this one."""
        half = len(self.text) // 2
        changed = self.text[: len(self.text) - half] + after.text[:half]
        edited = kept(shingle_hashes(changed, self.width))
        (near, alike), (near_next, alike_next) = compared(self.sketch, edited), compared(self.sketch, after.sketch)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        return len(self.text), digest, *[x.astype(">u8").tobytes() for x in (self.sketch, edited)], near, near_next, alike, alike_next


def packed_texts(docs: DataFrame, carried: list[Column], text: str) -> DataFrame:
    """``doc`` (the other columns), ``id``, a hash of the text, and the compressed text; half of the bytes to shuffle or less."""
    source = docs.select(F.struct(*carried).alias("doc"), docs["doc_id"].alias("id"), F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")).alias("packed"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("tie", T.LongType()), T.StructField("packed", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for part in slices(batches, "packed"):
            texts = texts_of(part.column("packed"))
            ties = np.array([xxh64_intdigest(t, SEED) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(ties), pa.array([packer.compress(t) for t in texts], pa.binary())], schema.names)

    return mapped(source, run, schema)


def edited(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """The other columns of ``docs`` with fingerprints (hex) of a text and its edited text, and how near that and the next are."""
    produced = [name for name, _ in MADE]
    ordered = packed_texts(docs, others(docs, [*produced, text]), text).repartitionByRange("id").sortWithinPartitions("id", "tie", "packed")
    ordered = ordered.select("doc", F.spark_partition_id().alias("part"), "packed")
    made = [T.StructField(n, t) for n, t in MADE]
    schema = T.StructType([*ordered.schema.fields[:-1], *made, T.StructField("own", T.BinaryType()), T.StructField("head", T.BinaryType())])

    def columns(rows: list[tuple]) -> list[pa.Array]:
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), *[pa.float64()] * 4]
        return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are finished by the row after them; the last one keeps its text, and the first one's text goes with it."""
        last_row, last, head = None, None, b""
        for part in slices(batches, "packed", 1 << 20):
            texts = [Text(p, width) for p in part.column("packed").to_pylist()]
            carried = pa.Table.from_batches([part.select([0, 1])])
            if last is None:
                head = texts[0].packed
            else:
                carried, texts = pa.concat_tables([last_row, carried]), [last, *texts]
            rows = [a.row(b) for a, b in zip(texts, texts[1:], strict=False)]
            last_row, last = carried.slice(len(texts) - 1), texts[-1]
            if rows:
                (whole,) = carried.slice(0, len(rows)).combine_chunks().to_batches()
                yield pa.RecordBatch.from_arrays([*whole.columns, *columns(rows), *[pa.nulls(len(rows), pa.binary())] * 2], schema.names)
        if last is not None:
            (row,) = last_row.combine_chunks().to_batches()
            none = columns([(None,) * len(MADE)])
            yield pa.RecordBatch.from_arrays([*row.columns, *none, pa.array([last.packed], pa.binary()), pa.array([head], pa.binary())], schema.names)

    found = stored(mapped(ordered, run, schema), "fingerprints")
    ends = found.filter("own is not null")  # a row for each partition
    order = Window.orderBy("part")
    after = ends.select("part", F.lead("part").over(order).alias("next"), F.min("part").over(Window.partitionBy()).alias("first"))
    after = after.select(F.col("part").alias("at"), F.coalesce("next", "first").alias("next"))
    heads = ends.select(F.col("part").alias("of"), F.col("head").alias("after"))
    pairs = ends.join(after, F.col("part") == F.col("at")).join(heads, F.col("next") == F.col("of")).select("doc", "own", "after")
    ended = T.StructType([schema["doc"], *made])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "own", 1):
            own, after = (Text(part.column(c)[0].as_py(), width) for c in ("own", "after"))
            yield pa.RecordBatch.from_arrays([part.column("doc"), *columns([own.row(after)])], ended.names)

    whole = found.filter("own is null").select(*ended.names).unionByName(mapped(pairs, finish, ended))
    names = [c for c in docs.columns if c.lower() not in {*produced, text.lower()}]
    hexed = {"fingerprint", "edited_fingerprint"}
    return whole.select(*[F.col("doc").getField(c).alias(c) for c in names], *[F.lower(F.hex(c)).alias(c) if c in hexed else F.col(c) for c in produced])


@register("op13_document_fingerprints")
def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", *[name for name, _ in MADE])
