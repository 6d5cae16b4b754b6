"""SentencePiece encoding and decoding with a table of distinct chunks.

In a model whose pieces carry white-space markers only at their start, no piece crosses from a character into the
next marker, so a text can be cut before each run of markers and the parts encode independently (checked when the
model is loaded). Each task keeps a table of the distinct marked words it has met, has the library segment each of
them once, and joins the ids back by position. The table is bounded; when it is full it starts anew.

One table over the whole corpus would need every word of every text in a shuffle (several times the input) to join
ids back; the per-task table needs none, at the price of segmenting a word once per task.

Defined results: a null or empty text has only the end id and decodes to the empty string; the marker character in
a text is a space, as in the library; repeated rows are encoded one by one; an empty table gives an empty result;
extra columns pass, a clashing one is replaced.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlens.llm.common import held, mapped, others, register, slices, table

MARK = "▁"
TABLE_SIZE = 150_000
LONG = 100  # characters; longer chunks (text without blanks) are not kept, which bounds the table's bytes too
_RUNS = re.compile(" +[^ ]*")


class ChunkTable:
    """Ids by distinct chunk for one model; lives as long as its Python worker."""

    def __init__(self, model: str, size: int = TABLE_SIZE) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces) or self.model.encode("a  b") != self.model.encode("a") + self._marked(" b"):
            raise ValueError("pieces of this model cross white-space markers; chunks are not independent")
        self.size = size
        self.known: dict[str, bytes] = {}

    def _marked(self, chunk: str) -> list[int]:
        """Ids of a chunk after its first marker, which the library puts there itself, except before nothing."""
        if chunk:
            return self.model.encode(chunk)
        return [self.model.piece_to_id(MARK)]

    def chunks(self, text: str) -> list[str]:
        """The text's parts, each without the first of the markers it starts with."""
        parts = text.replace(MARK, " ").split(" ")
        if "" in parts:  # runs of spaces, or a space at an end
            return [run[1:] for run in _RUNS.findall(f" {text.replace(MARK, ' ')}")] if text else []
        return parts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as 32-bit numbers: segment what is new in these texts, then join by position."""
        if len(self.known) > self.size:
            self.known.clear()
        cut = [self.chunks(t) for t in texts]
        known = self.known
        new = [c for c in {c for parts in cut for c in parts} if c not in known]
        for start in range(0, len(new), 20_000):
            some = new[start : start + 20_000]
            for chunk, ids in zip(some, self.model.encode(some, num_threads=1), strict=True):
                known[chunk] = array("i", ids if chunk else self._marked(chunk)).tobytes()
        joined = [b"".join([known[c] for c in parts]) for parts in cut]
        for chunk in new:
            if len(chunk) > LONG:
                del known[chunk]
        return joined


def chunk_table(model: str) -> ChunkTable:
    return held(("chunks", model), lambda: ChunkTable(model))


def strings(column: pa.Array) -> list[str]:
    """Texts per row, null as empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def _extended(docs: DataFrame, field: T.StructField) -> tuple[DataFrame, T.StructType]:
    source = docs.select(*others(docs, [field.name]))
    return source, T.StructType([*source.schema.fields, field])


def _lists(rows: list[bytes]) -> pa.ListArray:
    """Packed 32-bit ids per row as an Arrow list column."""
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), dtype=np.int32)))


def encoded(docs: DataFrame, model: str, text: str = "text", into: str = "ids", end: bool = True, carry_text: bool = True) -> DataFrame:
    """``docs`` with the ids of each whole text, and the model's end id after them if ``end``."""
    source, schema = _extended(docs, T.StructField(into, T.ArrayType(T.IntegerType(), False), False))
    if not carry_text:
        schema = T.StructType([f for f in schema.fields if f.name != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = chunk_table(model)
        tail = array("i", [known.model.eos_id()] if end else []).tobytes()
        for part in slices(batches, text):
            rows = [ids + tail for ids in known.encode(strings(part.column(text)))]
            names = [n for n in part.schema.names if carry_text or n != text]
            yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], _lists(rows)], [*names, into])

    return mapped(source, run, schema)


def decoded(encodings: DataFrame, model: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encodings`` with the text that the library decodes from each row's ids; null ids decode to the empty text."""
    source, schema = _extended(encodings, T.StructField(into, T.StringType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = chunk_table(model).model
        for part in slices(batches, ids, 1 << 20):
            texts = codec.decode([r or [] for r in part.column(ids).to_pylist()], num_threads=1)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], schema.names)

    return mapped(source, run, schema)


def round_trip(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: ids with the end id, and the text decoded from them, in one Python worker a task."""
    source = docs.select("doc_id", F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        source.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), T.StructField("decoded", T.StringType(), False)
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = chunk_table(model)
        tail = array("i", [known.model.eos_id()]).tobytes()
        for part in slices(batches, "text", 1 << 20):
            rows = [ids + tail for ids in known.encode(strings(part.column("text")))]
            texts = known.model.decode([np.frombuffer(r, dtype=np.int32).tolist() for r in rows], num_threads=1)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(rows), pa.array(texts, pa.string())], schema.names)

    return mapped(source, run, schema)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Encode, decode, and reduce both to counts and digests; nothing is shuffled."""
    return round_trip(docs, model).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def coded(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every document."""
    return round_trip(docs, model).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register("op2_sentencepiece_codec")
def op2_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), model_path())
