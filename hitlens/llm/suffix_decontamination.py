"""Benchmark decontamination with suffix arrays of the training texts.

Each task turns its documents into shards of word numbers, sorts the shard's suffixes, and looks up every suffix of
the test items by binary search. A suffix that matches over a whole window (10 words, or a shorter item as a whole)
is extended to its longest verbatim match; its places in the document are the hit words.

Only suffixes that start like some test window (same first words) are put into the array: no other suffix can be
found by a search, so this loses nothing and keeps the array small. Shards are bounded by bytes of text, the texts
are never shuffled, and a passage that sits in millions of documents is found by each shard for itself.

The test set reaches the tasks in blocks of at most ``block_bytes`` of text, one pass over the documents for each
block, so its size is bounded in every task, and on the driver, however large the test set is.

Defined results: a null or wordless text has no words and no hits; an item without words (or null) has no window; an
item without id marks hit words but is not listed; repeated items and ids count once; repeated documents are judged
one by one; an empty test set marks nothing; extra columns pass, a clashing one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitlens.llm.common import WORD, mapped, others, register, slices, stored, table, texts_of, unwrapped, wrapped

WINDOW = 10
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 4 << 20
PRODUCED = ["n_words", "hits", "items", "longest"]

# A-Z become a-z, every other ASCII character outside 0-9 and a-z becomes a space
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of digits, a-z and characters outside ASCII."""
    return text.translate(_FOLD).split()


class TestSet:
    """Word numbers of a block of test items and the distinct windows that its suffixes start with."""

    __test__ = False  # not a test class

    def __init__(self, items: Iterable[tuple[str | None, bytes]], window: int = WINDOW) -> None:
        self.vocabulary: dict[bytes, int] = {}
        tokens: list[int] = []
        windows: dict[tuple[int, ...], tuple[int, set[str]]] = {}
        starts: list[int] = []
        for item, text in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if not numbers:
                continue
            length = min(window, len(numbers))
            for at in range(len(numbers) - length + 1):
                key = tuple(numbers[at : at + length])
                owners = windows.setdefault(key, (len(windows), set()))[1]
                if item is not None:
                    owners.add(item)
                starts.append(len(tokens) + at)
            tokens += [*numbers, 0]
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.per_key = max(1, 63 // self.bits)
        # room to read past the end
        self.tokens = np.array([*tokens, *[0] * (window + self.per_key)], dtype=np.int64)
        self.starts = np.array(starts, dtype=np.int64)  # every suffix that holds a whole window
        ends = np.flatnonzero(self.tokens == 0)
        self.left = ends[np.searchsorted(ends, self.starts)] - self.starts if len(starts) else self.starts
        self.lengths = np.minimum(self.left, window)
        by_window = [tuple(tokens[s : s + n]) for s, n in zip(starts, self.lengths.tolist(), strict=True)]
        self.window_of = np.array([windows[w][0] for w in by_window], dtype=np.int64)
        self.owners = [sorted(owners) for _, owners in windows.values()]
        lone = {w[0] for w in windows if len(w) == 1}
        self.first = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        self.first[[w[0] for w in windows] or [0]] = bool(windows)
        self.lone = np.zeros_like(self.first)
        self.lone[list(lone) or [0]] = bool(lone)
        self.pairs = np.unique(np.array([w[0] << self.bits | w[1] for w in windows if len(w) > 1], dtype=np.int64))
        self.depth = int(self.left.max()) if len(starts) else 0


def _keys(tokens: np.ndarray, at: np.ndarray, test: TestSet) -> np.ndarray:
    """The next ``per_key`` word numbers from each position, packed so that numeric order is word order."""
    out = np.zeros(len(at), dtype=np.int64)
    last = len(tokens) - 1
    for k in range(test.per_key):
        out = out << test.bits | tokens[np.minimum(at + k, last)]
    return out


def suffix_array(tokens: np.ndarray, test: TestSet) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the useful suffixes in word order (as deep as the longest test suffix) and their first keys."""
    at = np.flatnonzero(test.first[tokens[:-1]])  # the last number is a boundary
    code = tokens[at] << test.bits | tokens[at + 1]
    paired = np.zeros(len(at), dtype=bool)
    if len(test.pairs):
        paired = test.pairs[np.minimum(np.searchsorted(test.pairs, code), len(test.pairs) - 1)] == code
    at = at[paired | test.lone[tokens[at]]]
    key = _keys(tokens, at, test)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    first, depth = key, test.per_key
    group = np.cumsum(np.append(True, key[1:] != key[:-1])) if len(key) else key
    while depth < test.depth:
        sizes = np.bincount(group) if len(group) else group
        tied = np.flatnonzero(sizes[group] > 1) if len(group) else group
        if not len(tied):
            break
        deeper = _keys(tokens, at[tied] + depth, test)
        order = np.lexsort((deeper, group[tied]))
        at[tied], deeper = at[tied][order], deeper[order]
        change = np.zeros(len(at), dtype=np.int64)
        change[1:] = group[1:] != group[:-1]
        inner = np.zeros(len(tied), dtype=bool)
        inner[1:] = (np.diff(tied) == 1) & (group[tied][1:] == group[tied][:-1]) & (deeper[1:] != deeper[:-1])
        change[tied] |= inner
        group, depth = np.cumsum(change), depth + test.per_key
    return at, first


def _narrow(tokens: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, want: np.ndarray, drop: np.ndarray, depth: int, test: TestSet) -> tuple[np.ndarray, np.ndarray]:
    """Binary search inside each range for the suffixes whose key at ``depth``, without the last bits, is ``want``."""
    ends = []
    for right in (False, True):
        low, high = lo.copy(), hi.copy()
        while True:
            active = np.flatnonzero(low < high)
            if not len(active):
                break
            middle = (low[active] + high[active]) >> 1
            key = _keys(tokens, at[middle] + depth, test) >> drop[active]
            below = key <= want[active] if right else key < want[active]
            low[active[below]] = middle[below] + 1
            high[active[~below]] = middle[~below]
        ends.append(low)
    return ends[0], ends[1]


def search(tokens: np.ndarray, test: TestSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every occurrence of a test window: position in the shard, index of the test suffix, longest match."""
    none = np.empty(0, dtype=np.int64)
    if not len(test.starts) or len(tokens) < 2:
        return none, none, none
    at, first = suffix_array(tokens, test)
    alive = np.arange(len(test.starts))
    lo, hi = np.zeros(len(alive), dtype=np.int64), np.full(len(alive), len(at))
    depth = 0
    while len(alive):
        open_ = test.lengths[alive] - depth
        todo = open_ > 0
        if not todo.any():
            break
        part = alive[todo]
        want = _keys(test.tokens, test.starts[part] + depth, test)
        drop = np.maximum(0, test.per_key - (test.lengths[part] - depth)) * test.bits
        if depth:
            low, high = _narrow(tokens, at, lo[todo], hi[todo], want >> drop, drop, depth, test)
        else:
            base = want >> drop << drop
            low = np.searchsorted(first, base, side="left")
            high = np.searchsorted(first, base | (np.int64(1) << drop) - 1, side="right")
        lo[todo], hi[todo] = low, high
        found = lo < hi
        alive, lo, hi = alive[found], lo[found], hi[found]
        depth += test.per_key
    sizes = hi - lo
    query = np.repeat(alive, sizes)
    offset = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = at[np.repeat(lo, sizes) + offset]
    longest = test.lengths[query].copy()
    grow = np.arange(len(query))
    while len(grow):
        more = longest[grow]
        can = (more < test.left[query[grow]]) & (place[grow] + more < len(tokens))
        grow, more = grow[can], more[can]
        grow = grow[tokens[place[grow] + more] == test.tokens[test.starts[query[grow]] + more]]
        longest[grow] += 1
    return place, query, longest


def _matched(texts: list[bytes], test: TestSet) -> Iterator[tuple[int, list[tuple[int, int]], list[str], int]]:
    """Per text: words, merged hit spans (from word, to word), item ids, longest verbatim match in words."""
    get = test.vocabulary.get
    arrays, counts = [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        arrays.append(np.fromiter(map(get, words, repeat(0)), dtype=np.int64, count=len(words)))
        arrays.append(np.zeros(1, dtype=np.int64))
    tokens = np.concatenate(arrays) if arrays else np.zeros(1, dtype=np.int64)
    place, query, longest = search(tokens, test)
    starts = np.cumsum([0, *[c + 1 for c in counts]])
    document = np.searchsorted(starts, place, side="right") - 1
    order = np.lexsort((place, document))
    place, query, longest, document = place[order], query[order], longest[order], document[order]
    cuts = np.searchsorted(document, np.arange(len(texts) + 1))
    for k, n in enumerate(counts):
        a, b = cuts[k], cuts[k + 1]
        if a == b:
            yield n, [], [], 0
            continue
        begin = place[a:b] - starts[k]
        end = np.maximum.accumulate(begin + longest[a:b])
        new = np.append(True, begin[1:] > end[:-1])
        spans = list(zip(begin[new].tolist(), end[np.append(new[1:], True)].tolist(), strict=True))
        windows = np.unique(test.window_of[query[a:b]])
        yield n, spans, sorted({i for w in windows for i in test.owners[w]}), int(longest[a:b].max())


def _scan(docs: DataFrame, shared: Broadcast, text: str, carried: list[str]) -> DataFrame:
    """The carried columns with what one block of the test set finds in each text."""
    fields = [docs.schema[c] for c in carried]
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([
        *fields, T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(span)),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("longest", T.LongType()),
    ])
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in slices(batches, text, SHARD_BYTES):
            rows = list(_matched(texts_of(part.column(text)), known))
            made = [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in r[1]] for r in rows], spans),
                pa.array([r[2] for r in rows], pa.list_(pa.string())),
                pa.array([r[3] for r in rows], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in carried], *made], [*carried, *PRODUCED])

    return mapped(docs, run, schema)


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[TestSet]:
    """The test set cut by a hash into blocks of bounded size, fetched one after the other."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = size // block_bytes + 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for k in range(count):
        yield TestSet(((r.item, r.text.encode()) for r in items.filter(block == k).toLocalIterator()), window)


def _merged(hits: str) -> Column:
    """Sorted spans with those that meet put together."""
    return F.aggregate(
        hits,
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", carry_text: bool = False, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (merged word spans), ``items`` (ids found) and ``longest`` (match in words).

    A test set of several blocks is scanned block by block: the hits of a block are stored and it is let go before the
    next is fetched; what they found is added to the rows by a hash of the whole row (equal rows have equal hits).
    """
    spark = docs.sparkSession
    kept = others(docs, [*PRODUCED, text])
    names = [c for c in docs.columns if c.lower() not in {*PRODUCED, text.lower()}]
    whole = docs.select(F.struct(*kept).alias("doc"), F.xxhash64(*kept, docs[f"`{text}`"]).alias("row"), docs[f"`{text}`"].cast("string").alias("text"))
    blocks = _blocks(benchmark, window, block_bytes)
    shared = spark.sparkContext.broadcast(next(blocks))
    base = _scan(whole, shared, "text", ["doc", "row", *(["text"] if carry_text else [])])
    later = []
    for test in blocks:
        sent = spark.sparkContext.broadcast(test)  # at most one block of the test set
        scan = _scan(whole.select("row", "text"), sent, "text", ["row"])
        later.append(stored(scan.filter(F.size("hits") > 0).select("row", *PRODUCED[1:]), "hits"))
        sent.destroy()
    if later:
        found = reduce(DataFrame.union, [base.filter(F.size("hits") > 0).select("row", *PRODUCED[1:]), *later])
        found = found.groupBy(F.col("row").alias("of")).agg(
            F.sort_array(F.flatten(F.collect_set("hits"))).alias("all_hits"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("all_items"),
            F.max("longest").alias("most"),
        )  # at most one set per block
        base = base.join(found, F.col("row") == F.col("of"), "left").withColumns(
            {
                "hits": F.coalesce(_merged("all_hits"), F.col("hits")),
                "items": F.coalesce("all_items", "items"),
                "longest": F.coalesce("most", "longest"),
            }
        )
    passed = [F.col("text") if c == text and carry_text else F.col("doc").getField(c) for c in names]
    out = [v.alias(c) for v, c in zip(passed, names, strict=True)] + ([F.col("text").alias(text)] if carry_text else [])
    return base.select(*out, *PRODUCED)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents without any test window, with their own columns, whatever they are called."""
    clean = matches(wrapped(docs, text), benchmark, carry_text=True, window=window).filter(F.size("hits") == 0)
    return unwrapped(clean, docs, text)


_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, len(g) AS n, array_to_string(g, ' ') AS g FROM (
    SELECT item, w[i:i + least({WINDOW}, len(w)) - 1] AS g FROM (
      SELECT item, w, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0))),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, item, i, dw.n FROM dw JOIN bw USING (n, g)),
spread AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spread USING (doc_id) LEFT JOIN found USING (doc_id)"""


@register("op1_benchmark_decontamination", _SQL)
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
