"""Threshold-scaled sketches against sets of shingle hashes in plain Python."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from hitlens.llm import scaled_sketches
from hitlens.llm.common import QUERIES

SF = "/root/testdata/sf0.001"
FULL = 2**64
SCHEMA = "doc_id long, text string, sketch string, part int, id string, `a.b` int"


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % FULL
    x = (x ^ x >> 27) * 0x94D049BB133111EB % FULL
    return x ^ x >> 31


def shingles(text):
    """Hashes of all runs of five words."""
    words = "".join(c.lower() if c.isascii() else c for c in text)
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    out = set()
    for k in range(max(1, len(words) - 4) if words else 0):
        run = words[k : k + 5]
        state = len(run)
        for w in run:
            state = mix((state * 0x9E3779B97F4A7C15 + xxh64_intdigest(w.encode(), 42)) % FULL)
        out.add(state)
    return out


def sketch(hashes):
    return {h for h in hashes if h < FULL // 8} or set(sorted(hashes)[:1])


def hexed(hashes):
    return "".join(f"{h:016x}" for h in sorted(hashes))


def covered(a, b):
    return len(a & b) / len(a) if a else float(not b)


def tie(text):
    value = xxh64_intdigest(text.encode(), 42)
    return value - FULL if value >> 63 else value


def plain(rows):
    """What the query returns for (doc_id, text) rows."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = (sketch(shingles(t)) for t in (text, changed, after))
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((i, len(text), digest, hexed(a), hexed(b), round(covered(a, b), 9), round(covered(a, c), 9)))
    return sorted(out, key=str)


def got(df):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((tuple(round(r[n], 9) if isinstance(r[n], float) else r[n] for n in names) for r in df.collect()), key=str)


def test_query(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    df = QUERIES["op13_document_fingerprints"](spark, SF)
    assert got(df) == plain(rows)
    texts = [t or "" for _, t in sorted(rows)]
    order = sorted(i for i, _ in rows)
    seen = 0
    for r in df.collect():
        text, after = texts[order.index(r.doc_id)], texts[(order.index(r.doc_id) + 1) % len(texts)]
        own = shingles(text)
        if len(own) > 400:  # the estimate against the shingles themselves
            changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
            assert abs(r.near_edited - covered(own, shingles(changed))) < 0.2 and r.near_next < 0.1
            seen += 1
    assert seen > 10


@pytest.mark.parametrize("n", [0, 1, 2, 40])
def test_odd_rows_over_partitions(spark, tmp_path, n):
    rng = random.Random(n)
    texts = [None, "", " \n\t ", "One", "one two THREE four five six", "Ünï  cöde x \U0001f600 é e\x0bf g", "a b c d e " * 300, "x" * 5000]
    rows = [(rng.choice([None, 3, k]), rng.choice(texts)) for k in range(n)]
    rows += rows[:2]
    df = spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for parts in (1, 4, 30):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            assert got(QUERIES["op13_document_fingerprints"](spark, str(tmp_path))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    out = scaled_sketches.edited(df)
    assert {"doc_id", "part", "id", "a.b", "sketch", "n_chars"} <= set(out.columns) and "text" not in out.columns
    assert out.count() == len(rows)


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(5000)]
    book = [rng.choice(words) for _ in range(30_000)]
    part = book[1000:4000]
    texts = [" ".join(book), " ".join(part), " ".join(part[:1500] + [rng.choice(words) for _ in range(1500)]), "just one line", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = scaled_sketches.sketched(df)
    for r in rows.collect():
        assert "".join(r.sketch) == hexed(sketch(shingles(texts[r.doc_id] or "")))
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(b, F.lit(True)).select(
        F.col("a.doc_id").alias("i"), F.col("b.doc_id").alias("j"),
        scaled_sketches.covered(F.col("a.sketch"), F.col("b.sketch")).alias("covered"),
        scaled_sketches.alike(F.col("a.sketch"), F.col("b.sketch")).alias("alike"),
        scaled_sketches.merged(F.col("a.sketch"), F.col("b.sketch")).alias("merged"),
    )
    got = {(r.i, r.j): r for r in pairs.collect()}
    assert got[1, 0].covered > 0.99 and 0.08 < got[0, 1].covered < 0.12
    assert abs(got[2, 0].covered - 0.5) < 0.08 and abs(got[2, 1].covered - 0.5) < 0.08
    assert got[4, 5].covered == got[4, 5].alike == 1 and got[4, 0].covered == 0 and got[0, 4].covered == 0
    for (i, j), r in got.items():
        both = sketch(shingles(texts[i] or "") | shingles(texts[j] or ""))
        assert "".join(r.merged) == hexed(both)
        assert r.alike == got[j, i].alike
