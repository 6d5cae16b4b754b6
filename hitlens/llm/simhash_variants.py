"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint of 64 bits is cut into few segments, so few that of two fingerprints with at most ``distance``
differing bits one segment differs by at most one bit. Each segment is indexed once per wildcard bit; two linked
fingerprints then have an indexed variant in common, found by equality of keys and verified on all 64 bits.

Scale: texts are read once and never shuffled; equal fingerprints are one node, so exact copies cost nothing after
the first grouping. Keys are spread over all tasks. A bucket emits links that connect it (all pairs only in buckets
of up to ``SMALL`` members), found by a search in which linked members leave the open set, so a large group of near
copies costs no square of its size. ``plan_for`` takes a finer index for more fingerprints; the links are the same.
Components come from alternating star contraction in rounds over stored tables; nothing goes to the driver.

Defined results: a null or empty text has fingerprint zero and is linked like any other; fewer words than the width
are one shingle; repeated rows fall into one component; rows without an id are grouped but never name a component
that has an id; an empty table gives an empty result; extra columns pass, a clashing one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from hitlens.llm.common import mapped, others, register, slices, stored, table, texts_of

WIDTH = 4
DISTANCE = 4
SEED = 42
SMALL = 16  # buckets up to this size compare all pairs, larger ones search


def shingle_hashes(text: bytes, width: int = WIDTH) -> np.ndarray:
    """XXH64 of the word shingles (repeats included) of a text, A-Z lower-cased, words at ASCII white space."""
    words = text.lower().split()  # bytes: exactly the ASCII letters and the six white-space characters
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64_intdigest(joined, SEED)] if words else [], dtype=np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - width + 1].tolist()
    pairs = zip(starts, ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in pairs), dtype=np.uint64, count=len(starts))


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """Bit k is 1 if it is set in over half of the shingle hashes."""
    hashes = shingle_hashes(text, width)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", width: int = WIDTH, into: str = "fingerprint") -> DataFrame:
    """The other columns of ``docs`` with the fingerprint as a (signed) long; texts are read whole."""
    source = docs.select(*others(docs, [text, into]), F.col(text).cast("string").alias(text))
    schema = T.StructType([*[f for f in source.schema.fields if f.name != text], T.StructField(into, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            values = np.array([fingerprint(t, width) for t in texts_of(part.column(text))], dtype=np.uint64)
            columns = [part.column(n) for n in part.schema.names if n != text] + [pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*[n for n in part.schema.names if n != text], into])

    return mapped(source, run, schema)


def variant_masks(segments: int, exact: int, distance: int = DISTANCE) -> list[int]:
    """The bits each index key looks at: ``exact`` whole segments and one more without one wildcard bit.

    Complete for ``distance``: at least ``segments - distance`` segments are equal, and more than ``exact`` of them
    differ by one bit at most.
    """
    if segments - distance // 2 < exact + 1 or (exact and segments - distance < exact):
        raise ValueError("too few segments to find every link")
    cuts = [round(64 * k / segments) for k in range(segments + 1)]
    whole = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = []
    for kept in combinations(range(segments), exact):
        base = sum(whole[s] for s in kept)
        for s in range(segments):
            if s not in kept:
                masks += [base | whole[s] & ~(1 << bit) for bit in range(cuts[s], cuts[s + 1])]
    return masks


def plan_for(fingerprint_count: int) -> tuple[int, int]:
    """Segments and exact segments that keep the mean bucket small; every plan finds the same links."""
    if fingerprint_count < 1 << 25:
        return 3, 0
    return (5, 1) if fingerprint_count < 1 << 30 else (6, 2)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _connect(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect each component of a bucket: members leave the open set once they are reached."""
    links, rest = [], values
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            pivot = queue.pop()
            near = np.bitwise_count(rest ^ pivot) <= distance
            if near.any():
                found = rest[near]
                links += [(int(pivot), int(x)) for x in found.tolist()]
                queue.extend(found)
                rest = rest[~near]
    return links


def _bucket_links(tags: np.ndarray, keys: np.ndarray, values: np.ndarray, masks: np.ndarray, distance: int) -> np.ndarray:
    """Verified links among rows sorted by (tag, key), as an array of pairs."""
    n = len(values)
    new = np.ones(n, dtype=bool)
    new[1:] = (tags[1:] != tags[:-1]) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, n))
    found = []
    bucket = np.repeat(np.arange(len(first)), sizes)
    small = np.flatnonzero((sizes[bucket] > 1) & (sizes[bucket] <= SMALL))
    b, v, t = bucket[small], values[small], tags[small]
    for step in range(1, SMALL):
        same = np.flatnonzero(b[step:] == b[:-step]) if len(b) > step else np.empty(0, dtype=np.int64)
        if not len(same):
            break
        x, y = v[same], v[same + step]
        near = np.bitwise_count(x ^ y) <= distance
        x, y, tag = x[near], y[near], t[same][near]
        # a pair meets under many keys; only the first key that it shares reports it
        shared = np.full(len(x), len(masks))
        for k in range(len(masks) - 1, -1, -1):
            shared[(x ^ y) & masks[k] == 0] = k
        keep = shared == tag
        found.append(np.stack([x[keep], y[keep]], axis=1))
    for k in np.flatnonzero(sizes > SMALL):
        links = _connect(values[first[k] : first[k] + sizes[k]], distance)
        if links:
            found.append(np.array(links, dtype=np.uint64))
    return np.concatenate(found) if found else np.empty((0, 2), dtype=np.uint64)


def links(nodes: DataFrame, segments: int, exact: int, distance: int = DISTANCE) -> DataFrame:
    """``(src, dst)`` links, enough of them to connect all fingerprints within ``distance``; src > dst."""
    masks = variant_masks(segments, exact, distance)
    variants = F.array(
        *[F.struct(F.lit(k).cast("smallint").alias("tag"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks)]
    )
    index = nodes.select("fingerprint", F.inline(variants)).repartition("tag", "key").sortWithinPartitions("tag", "key")
    array = np.array(masks, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("tag", "key", "fingerprint")]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            tags, keys, _ = columns
            # the last bucket may go on in the next batch
            tail = int(np.flatnonzero((tags != tags[-1]) | (keys != keys[-1]))[-1]) + 1 if tags[0] != tags[-1] or keys[0] != keys[-1] else 0
            held = [c[tail:] for c in columns]
            if tail:
                yield from pairs(*[c[:tail] for c in columns])
        if held is not None and len(held[0]):
            yield from pairs(*held)

    def pairs(tags: np.ndarray, keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = _bucket_links(tags, keys, values.view(np.uint64), array, distance)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found[:, k].copy().view(np.int64)) for k in (0, 1)], ["a", "b"])

    pairs_df = mapped(index, run, "a long, b long")
    return pairs_df.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (src > dst)``: alternate large-star and small-star until stable.

    Each round groups neighbours with a map-side minimum and stores its edges in the shared folder.
    """
    edges = stored(edges, "links")
    state = None
    while True:
        both = edges.union(edges.select("dst", "src"))
        least = both.groupBy(F.col("src").alias("u")).agg(F.least(F.min("dst"), F.min("src")).alias("m"))
        large = both.join(least, both["src"] == least["u"]).filter("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        large = large.filter("src <> dst").distinct()
        least = large.groupBy(F.col("src").alias("u")).agg(F.min("dst").alias("m"))
        small = large.join(least, large["src"] == least["u"]).select(
            F.inline(F.array(F.struct(F.col("src").alias("src"), F.col("m").alias("dst")), F.struct(F.col("dst").alias("src"), F.col("m").alias("dst"))))
        )
        edges = stored(small.filter("src <> dst").distinct(), "star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
        state = now


def classes(fingerprinted: DataFrame, order: list[str], distance: int = DISTANCE, plan: tuple[int, int] | None = None) -> DataFrame:
    """``(fingerprint, first)``: per fingerprint the smallest ``order`` struct of its whole component.

    Rows with a null in the first order column come after those without.
    """
    rank = F.struct(F.col(order[0]).isNull().alias("missing"), *[F.col(c) for c in order])
    nodes = stored(fingerprinted.groupBy("fingerprint").agg(F.min(rank).alias("first")), "fingerprints")
    segments, exact = plan or plan_for(nodes.count())
    roots = components(links(nodes.select("fingerprint"), segments, exact, distance))
    named = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "first"
    )
    least = named.groupBy("root").agg(F.min("first").alias("first"))
    return named.select("fingerprint", "root").join(least, "root").select("fingerprint", "first")


def near_duplicates(docs: DataFrame, text: str = "text", width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """``docs`` (without the text) with ``fingerprint`` and ``component_id``, the smallest reachable doc_id."""
    names = [c for c in docs.columns if c.lower() not in {"fingerprint", "component_id", text.lower()}]
    # the other columns travel as one, so that none can clash with what is made on the way
    clean = docs.select(F.struct(*others(docs, ["fingerprint", "component_id", text])).alias("doc"), docs["doc_id"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    rows = stored(fingerprints(clean, "text", width), "documents")
    groups = classes(rows.select("fingerprint", "doc_id"), ["doc_id"], distance)
    groups = groups.select(F.col("fingerprint").alias("of"), F.col("first.doc_id").alias("component_id"))
    joined = rows.join(groups, rows["fingerprint"] == groups["of"], "left")
    return joined.select(*[F.col("doc").getField(c).alias(c) for c in names], "fingerprint", "component_id")


def deduplicated(docs: DataFrame, text: str = "text", width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with its own columns."""
    key = F.xxhash64(F.col("doc_id"), F.col(text))
    rows = stored(fingerprints(docs.select("doc_id", key.alias("row_key"), F.col(text).alias("text")), "text", width), "documents")
    first = classes(rows, ["doc_id", "row_key"], distance).select(F.col("first.row_key").alias("row_key")).distinct()
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), key.alias("row_key"))
    return whole.join(first, "row_key").dropDuplicates(["row_key"]).select("doc.*")


@register("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
