"""Token counts that follow edits: a segment tree over the pre-tokens of each document.

A byte-level BPE never merges across pre-tokens, so a document's token count is a sum over its pre-tokens. Each
document keeps a tree whose leaves are runs of up to ``LEAF`` pre-tokens with their characters and tokens, and whose
inner nodes are sums. An edit descends by characters to the last leaf that starts ``CONTEXT`` characters before it
(the pattern looks ahead, never back), splits and encodes again from there until a boundary falls on an old leaf
boundary behind the edit, puts the new pre-tokens into the same leaves, and updates the sums above them. A leaf that
grew too long makes the tree be laid out anew from its leaves, without encoding anything outside the edit.

The state is a table of one row for each document, so builds and updates are row-wise and shuffle nothing; edits that
come as a table are gathered by document (``with_edits``), where an edit history is as sequential as the document.

Defined results: a null text is empty and has no tokens; edits are applied in order, each to the text as the one
before left it; places outside the text mean its start or end, a stop before the start means the start; a null
replacement is empty; null or no edits leave the row as it is; repeated rows are independent; an empty table gives an
empty result; extra columns pass, a clashing one is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlens.llm.chunk_codec import strings
from hitlens.llm.common import held, mapped, others, register, slices, table
from hitlens.llm.word_tokens import Generations

LEAF = 32
CONTEXT = 4  # characters that the pattern may look ahead
TABLE_SIZE = 250_000
EDITS = "array<struct<start:bigint,stop:bigint,text:string>>"
STATE = ["tree_chars", "tree_tokens"]


class Counter:
    """Tokens of a pre-token, by a table of distinct pre-tokens; lives as long as its Python worker."""

    def __init__(self, ranks: str, pattern: str) -> None:
        with open(ranks, "rb") as file:
            table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=table_, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known = Generations(lambda piece: len(self.encoding.encode_ordinary(piece)), TABLE_SIZE)

    def counted(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        return list(map(len, pieces)), list(map(self.known.__getitem__, pieces))


def counter(ranks: str, pattern: str) -> Counter:
    return held(("pieces", ranks, pattern), lambda: Counter(ranks, pattern))


class SegmentTree:
    """Characters and tokens of a document's leaves, with sums: node k has the children 2k and 2k + 1."""

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self.chars, self.tokens = chars, tokens

    @classmethod
    def of(cls, leaves: list[tuple[int, int]]) -> SegmentTree:
        half = 1 << max(0, len(leaves) - 1).bit_length()
        sums = []
        for part in (0, 1):
            row = np.zeros(2 * half, dtype=np.int64)
            row[half : half + len(leaves)] = [leaf[part] for leaf in leaves]
            level = half
            while level > 1:
                row[level // 2 : level] = row[level : 2 * level].reshape(-1, 2).sum(axis=1)
                level //= 2
            sums.append(row.tolist())
        return cls(*sums)

    @property
    def half(self) -> int:
        return len(self.chars) // 2

    def leaf_at(self, place: int) -> tuple[int, int]:
        """Leaf that holds a character, and where the leaf starts."""
        node, start = 1, 0
        while node < self.half:
            node *= 2
            if place >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.half, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.half
        dc, dt = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += dc
            self.tokens[node] += dt
            node //= 2

    def leaves(self) -> list[tuple[int, int]]:
        return list(zip(self.chars[self.half :], self.tokens[self.half :], strict=True))


def grouped(chars: list[int], tokens: list[int], size: int = LEAF) -> list[tuple[int, int]]:
    """Runs of ``size`` pre-tokens as (characters, tokens)."""
    if not chars:
        return []
    at = np.arange(0, len(chars), size)
    return list(zip(np.add.reduceat(chars, at).tolist(), np.add.reduceat(tokens, at).tolist(), strict=True))


def built(text: str, count: Counter) -> SegmentTree:
    return SegmentTree.of(grouped(*count.counted(count.pattern.findall(text))))


def edited(text: str, tree: SegmentTree, start: int, stop: int, new: str, count: Counter) -> tuple[str, SegmentTree, int]:
    """Text and tree after an edit, and how many characters were encoded again."""
    start = min(max(start, 0), len(text))
    stop = min(max(stop, start), len(text))
    after = text[:start] + new + text[stop:]
    moved = len(new) - (stop - start)
    first, begin = tree.leaf_at(max(0, start - CONTEXT))
    if begin > max(0, start - CONTEXT):  # an empty tree or an empty leaf at the end
        first, begin = 0, 0
    # old leaf ends behind the edit, where the old and the new pre-tokens may meet again
    last, end = first, begin + tree.chars[tree.half + first]
    pieces: list[str] = []
    at = begin
    for found in count.pattern.finditer(after, begin):
        while last + 1 < tree.half and (end < stop or end + moved < at):
            last += 1
            end += tree.chars[tree.half + last]
        if end >= stop and end + moved == at and at > begin and at >= start + len(new):
            break
        pieces.append(found[0])
        at = found.end()
    else:
        last = tree.half - 1
    chars, tokens = count.counted(pieces)
    slots = last - first + 1
    size = max(1, -(-len(pieces) // slots))
    leaves = grouped(chars, tokens, size)
    if size > 4 * LEAF:
        kept = tree.leaves()
        rest = [leaf for leaf in kept[:first] + grouped(chars, tokens) + kept[last + 1 :] if leaf[0]]
        return after, SegmentTree.of(rest), sum(chars)
    for k in range(slots):
        tree.put(first + k, *(leaves[k] if k < len(leaves) else (0, 0)))
    return after, tree, sum(chars)


_SUMS = T.ArrayType(T.IntegerType(), False)


def trees(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with its segment trees (``tree_chars``, ``tree_tokens``; node 1 is the whole text)."""
    source = docs.select(*others(docs, [*STATE, text]), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))
    schema = T.StructType([*source.schema.fields, *[T.StructField(c, _SUMS) for c in STATE]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks, pattern)
        for part in slices(batches, text):
            made = [built(t, count) for t in strings(part.column(text))]
            sums = [pa.array([t.chars for t in made], pa.list_(pa.int32())), pa.array([t.tokens for t in made], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*part.columns, *sums], schema.names)

    return mapped(source, run, schema)


def n_tokens(tokens: str = "tree_tokens") -> Column:
    """A document's token count: the root of its tree."""
    return F.get(tokens, F.lit(1)).cast("bigint")


def with_edits(state: DataFrame, edits: DataFrame) -> DataFrame:
    """``state`` with an ``edits`` column from a table ``doc_id, seq, start, stop, text``, in order of ``seq``."""
    each = F.struct("seq", F.col("start").cast("bigint").alias("start"), F.col("stop").cast("bigint").alias("stop"), F.col("text").alias("text"))
    listed = edits.groupBy(F.col("doc_id").alias("__doc")).agg(F.sort_array(F.collect_list(each)).alias("edits"))
    listed = listed.withColumn("edits", F.transform("edits", lambda e: F.struct(e["start"].alias("start"), e["stop"].alias("stop"), e["text"].alias("text"))))
    kept = state.select(*others(state, ["edits"]))
    return kept.join(listed, kept["doc_id"] == listed["__doc"], "left").drop("__doc")


def updated(state: DataFrame, ranks: str, pattern: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """``state`` after each row's edits: new text and trees, and ``reencoded`` characters; the edits are consumed."""
    source = state.select(*others(state, ["reencoded", edits]), F.col(edits).cast(EDITS).alias(edits))
    rest = [c for c in source.columns if c not in (text, *STATE, edits)]
    schema = T.StructType([*[source.schema[c] for c in rest], T.StructField(text, T.StringType()), *[T.StructField(c, _SUMS) for c in STATE], T.StructField("reencoded", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks, pattern)
        for part in slices(batches, text):
            rows = []
            columns = [part.column(c).to_pylist() for c in (text, *STATE, edits)]
            for body, chars, tokens, changes in zip(*columns, strict=True):
                tree, spent = SegmentTree(chars, tokens), 0
                for change in changes or []:
                    if change is not None:
                        body, tree, more = edited(body, tree, change["start"] or 0, change["stop"] or 0, change["text"] or "", count)
                        spent += more
                rows.append((body, tree.chars, tree.tokens, spent))
            kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64()]
            made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], *made], schema.names)

    return mapped(source, run, schema)


def revision(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Three edits of a document that follow from its id and length: a replaced span, an insertion, a deletion."""
    n = F.char_length(text)

    def place(k: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(k), F.col(doc_id)), (n + 1).cast("bigint"))

    def edit(start: Column, size: int, new: Column) -> Column:
        return F.struct(start.alias("start"), (start + size).alias("stop"), new.alias("text"))

    stamp = F.concat(F.lit(" revised, "), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("'s copy\n\n"))
    return F.array(edit(place(1), 25, stamp), edit(place(2), 0, F.lit("  it's new ")), edit(place(3), 40, F.lit("")))


def tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@register("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after a revision of three edits."""
    state = trees(table(spark, sf_dir, "documents").select("doc_id", "text"), *tokenizer())
    before = state.select("*", n_tokens().alias("n_before"), revision().alias("edits"))
    after = updated(before, *tokenizer())
    return after.select(
        "doc_id", "n_before", n_tokens().alias("n_after"), "reencoded", F.char_length("text").cast("bigint").alias("n_chars_after")
    )
