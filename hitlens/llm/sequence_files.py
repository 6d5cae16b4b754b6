"""Token ids as Arrow stream files of fixed-size-list batches.

Texts are encoded where they lie; their packed ids, not the texts, are dealt out by ranges of doc_id, whose bounds come
from the ids alone. Each partition writes one shard: a file of record batches with ``ids: fixed_size_list<uint16 or
uint32>[length]`` and ``mask: fixed_size_list<bool>[length]`` (the last sequence is padded and masked), and beside it an
index file with ``doc_id, start, n_tokens``. All batches but the last hold equally many sequences, so sequence k is found
by arithmetic in a memory-mapped file without copying.

Shards are written under a name of their own and moved into place, with content that depends only on the rows, so a
task that is run again replaces its file by the same bytes. Nothing but one row for each shard is gathered, and a
shard is written and read back a few sequences at a time.

Defined results: a null or empty text has only the end id; rows without a doc_id come first; equal doc_ids stay
together, ordered by their packed ids; an empty table has no shard and no row; extra columns are not stored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitlens.llm.common import filesystem, held, mapped, register, slices, table, workspace
from hitlens.llm.word_tokens import token_type, word_table

LENGTH = 2048
ROWS = 64  # sequences in a record batch
DOCUMENTS = 2048  # in a shard at least, where there are fewer than the shuffle has room for
END = 1
SHARDS = "shard long, first_sequence long, n_documents long, n_tokens long, n_sequences long, path string"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


class ShardWriter:
    """Packs documents one after the other into sequences of one length; holds at most one batch of them."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, length: int, rows: int) -> None:
        self.fs, base = filesystem(folder)
        self.length, self.rows, self.dtype = length, rows, dtype
        self.schema = sequence_schema(dtype, length)
        attempt = uuid.uuid4().hex
        self.final = [f"{base}/{name}.arrow", f"{base}/{name}.index.arrow"]
        self.draft = [f"{base}/_{name}-{attempt}-{k}" for k in (0, 1)]
        self.fs.create_dir(base, recursive=True)
        self.files = [self.fs.open_output_stream(p) for p in self.draft]
        self.writers = [pa.ipc.new_file(f, s) for f, s in zip(self.files, (self.schema, INDEX), strict=True)]
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_documents = self.n_sequences = 0

    def add(self, doc_ids: list[int | None], texts: list[np.ndarray]) -> None:
        counts = np.array([len(t) for t in texts], dtype=np.int64)
        starts = self.n_tokens + np.cumsum(counts) - counts
        self.writers[1].write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(counts)], schema=INDEX))
        self.n_documents += len(texts)
        self.n_tokens += int(counts.sum())
        self.held += texts
        self.n_held += int(counts.sum())
        if self.n_held >= self.length * self.rows:
            flat = np.concatenate(self.held)
            whole = self.length * self.rows
            done = len(flat) // whole * whole
            for start in range(0, done, whole):
                self._write(flat[start : start + whole], whole)
            self.held, self.n_held = [flat[done:].copy()], len(flat) - done

    def _write(self, ids: np.ndarray, used: int) -> None:
        values = [pa.array(ids), pa.array(np.arange(len(ids)) < used)]
        lists = [pa.FixedSizeListArray.from_arrays(v, self.length) for v in values]
        self.writers[0].write_batch(pa.record_batch(lists, schema=self.schema))
        self.n_sequences += len(ids) // self.length

    def close(self) -> str:
        if self.n_held:
            flat = np.concatenate(self.held)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, dtype=self.dtype)
            padded[: len(flat)] = flat
            self._write(padded, len(flat))
        for writer, file in zip(self.writers, self.files, strict=True):
            writer.close()
            file.close()
        for draft, final in zip(self.draft, self.final, strict=True):
            if self.fs.get_file_info(final).type == pafs.FileType.NotFound:
                self.fs.move(draft, final)
            else:  # another attempt of this task has put the same bytes there
                self.fs.delete_file(draft)
        return self.final[0]


class ShardReader:
    """Random access to the sequences of a shard: batches are memory-mapped where the file system is local."""

    def __init__(self, fs: pafs.FileSystem, path: str) -> None:
        opened = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(opened)
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0
        self.length = self.file.schema.field("ids").type.list_size
        self.last: tuple[int, np.ndarray] | None = None
        self.wide: tuple[int, memoryview] | None = None

    def ids(self, batch: int) -> np.ndarray:
        """Ids of a batch (no copy), one row for each sequence; the last batch asked for stays at hand."""
        if self.last is None or self.last[0] != batch:
            flat = self.file.get_batch(batch).column("ids").flatten()
            self.last = batch, flat.to_numpy(zero_copy_only=True).reshape(-1, self.length)
        return self.last[1]

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a sequence."""
        mask = self.file.get_batch(k // self.rows).column("mask")[k % self.rows].values
        return self.ids(k // self.rows)[k % self.rows], mask.to_numpy(zero_copy_only=False)

    def checksum(self, start: int, count: int) -> int:
        """CRC-32 of a run of token ids as little-endian 32-bit numbers; a batch is widened once."""
        crc, whole = 0, self.rows * self.length
        while count > 0:
            batch, at = divmod(start, whole)
            if self.wide is None or self.wide[0] != batch:
                self.wide = batch, memoryview(self.ids(batch).reshape(-1).astype("<u4")).cast("B")
            step = min(count, len(self.wide[1]) // 4 - at)
            crc = zlib.crc32(self.wide[1][4 * at : 4 * (at + step)], crc)
            start, count = start + step, count - step
        return crc

    def tokens(self, start: int, count: int) -> Iterator[np.ndarray]:
        """A run of token ids, as views of the batches that it touches."""
        whole = self.rows * self.length
        while count > 0:
            part = self.ids(start // whole).reshape(-1)[start % whole : start % whole + count]
            yield part
            start, count = start + len(part), count - len(part)


def split_points(docs: DataFrame) -> np.ndarray:
    """Ascending doc_ids that cut the documents into parts of like size, as many as a shuffle has; from the ids alone."""
    spark = docs.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // DOCUMENTS + 1)
    if parts == 1:
        return np.array([], dtype=np.int64)
    points = F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], F.lit(100 * parts))
    return np.unique(np.array(docs.agg(points).first()[0] or [], dtype=np.int64))


def write_sequences(docs: DataFrame, tokenizer: str, folder: str, text: str = "text", end: int = END, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """Write ``docs`` in doc_id order; returns one stored row for each shard."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("ids"))
    bounds = split_points(texts)
    dtype = token_type(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_, tail = word_table(tokenizer), np.array([end], dtype=dtype).tobytes()
        for part in slices(batches, "ids"):
            ids = pa.array([table_.encode(t) + tail for t in part.column("ids").to_pylist()], pa.binary())
            doc = part.column("doc_id")
            at = np.searchsorted(bounds, doc.fill_null(0).to_numpy()).astype(np.int32)
            place = pa.array(np.where(doc.is_null().to_numpy(zero_copy_only=False), 0, at))
            yield pa.RecordBatch.from_arrays([place, doc, ids], ["part", "doc_id", "ids"])

    encoded = mapped(texts, encode, "part int, doc_id long, ids binary")
    ordered = encoded.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(("sequences",), dict)  # lets go the tables that have encoded the texts
        shard, writer = 0, None
        for part in slices(batches, "ids"):
            if writer is None:
                shard = part.column("part")[0].as_py()
                writer = ShardWriter(folder, f"shard-{shard:06d}", dtype, length, rows)
            writer.add(part.column("doc_id").to_pylist(), [np.frombuffer(b, dtype=dtype) for b in part.column("ids").to_pylist()])
        if writer is not None:
            path = writer.close()
            row = [[shard], [0], [writer.n_documents], [writer.n_tokens], [writer.n_sequences], [path]]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in row[:-1]], pa.array(row[-1])], SHARDS.replace(" long", "").replace(" string", "").split(", "))

    manifest = f"{folder}/shards"
    mapped(ordered, run, SHARDS).drop("first_sequence").write.parquet(manifest)
    return docs.sparkSession.read.parquet(manifest)


def read_documents(shards: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files; one task reads a shard's documents."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    placed = shards.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("path", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for path, first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                reader = ShardReader(fs, path)
                with fs.open_input_file(path.removesuffix(".arrow") + ".index.arrow") as file:
                    index = pa.ipc.open_file(file)
                    for k in range(index.num_record_batches):
                        part = index.get_batch(k)
                        runs = zip(part.column("start").to_pylist(), part.column("n_tokens").to_pylist(), strict=True)
                        sums = [reader.checksum(start, count) for start, count in runs]
                        starts = pa.array(part.column("start").to_numpy() + first)
                        yield pa.RecordBatch.from_arrays([part.column("doc_id"), starts, part.column("n_tokens"), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = placed.repartition(max(1, shards.count()))  # a task for each shard, though their rows are few
    return mapped(spread, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op3_token_sequences")
def op3_token_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "sequences")
    shards = write_sequences(table(spark, sf_dir, "documents"), tokenizer_path(), folder)
    return read_documents(shards, folder)
