"""Vector codes against a full search in plain Python integers, and their defined results on odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from hitlens.llm import grid_codes
from hitlens.llm.common import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, code string, point int, `a.b` int"


def plain(rows, dims, parts=8, entries=16, rounds=6):
    """{(vec_id, vector): (code, error)} and the codebooks, by full search over (vec_id, vector) rows."""
    whole = [(i, [math.floor(4096 * x) for x in v]) for i, v in rows if len(v) == dims]
    kept = sorted(((i is None, i or 0, v) for i, v in whole), key=lambda r: (*r[:2], np.array(r[2], "<i4").tobytes()))
    width = dims // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for *_, v in kept]
    books = [[list(x[p]) for x in cut[:entries]] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            of = [[] for _ in book]
            for x in cut:
                of[nearest(book, x[p])[1]].append(x[p])
            books[p] = [[sum(c) // len(g) for c in zip(*g, strict=True)] if g else e for g, e in zip(of, book, strict=True)]
    out = []
    for (null, i, _), x in zip(kept, cut, strict=True):
        found = [nearest(b, part) for b, part in zip(books, x, strict=True)]
        out.append((None if null else i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return sorted(out, key=str), books


def vectors(n, dims, seed, spread=0.2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.5) for _ in range(dims)] for _ in range(5)]
    return [[float(np.float32(rng.gauss(c, spread))) for c in rng.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize(("n", "dims", "spread"), [(120, 16, 0.2), (90, 64, 0.001), (7, 8, 0.2), (1, 8, 0.0)])
def test_codes_as_by_full_search(spark, n, dims, spread):
    rows = [(3 * k % 101, v) for k, v in enumerate(vectors(n, dims, n, spread))]
    df = spark.createDataFrame([(i, v, 1, "x", 5, 6) for i, v in rows], SCHEMA).repartition(3)
    codes, books = grid_codes.compressed(df)
    want, want_books = plain(rows, dims)
    assert books.tolist() == want_books
    assert sorted(((r.vec_id, r.code, r.error) for r in codes.collect()), key=str) == want
    assert set(codes.columns) == {"vec_id", "label", "a.b", "code", "error"}
    flat = ",".join(str(c) for book in want_books for e in book for c in e)
    assert grid_codes.digest(books) == hashlib.sha256(flat.encode()).hexdigest()


def test_odd_rows(spark):
    good = [(k, v) for k, v in enumerate(vectors(40, 8, 3))]
    good += [(None, good[1][1]), good[0], good[0], (2, good[3][1])]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [None] * 8, [1.0] * 7 + [nan], [inf] + [0.0] * 7, [-inf] * 8]
    other = [[0.5] * 16, [0.5] * 3]
    rows = [(i, v, None if (i or 0) % 3 else 7, "x", 1, 2) for i, v in good]
    rows += [(50 + k, v, 7, "x", 1, 2) for k, v in enumerate(bad + other)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    codes, _ = grid_codes.compressed(df)
    got = [(r.vec_id, r.code, r.error) for r in codes.collect()]
    want, _ = plain(good, 8)
    assert sorted(got, key=str) == sorted([*want, (56, None, None), (57, None, None)], key=str)
    assert grid_codes.compressed(df.limit(0))[0].count() == 0
    huge = spark.createDataFrame([(1, [3e38] * 8, 1, "", 1, 1), (2, [-3e38] * 8, 1, "", 1, 1)], SCHEMA)
    assert [r.error for r in grid_codes.compressed(huge)[0].collect()] == [0, 0]


def test_cells_keep_every_entry_that_may_be_nearest():
    rng = np.random.default_rng(1)
    for spread in (3, 200, 5000):
        book = rng.integers(-spread, spread, (16, 8))
        book[7] = book[2]  # a tie goes to the lower entry
        cells = grid_codes.Cells(book)
        x = rng.integers(-2 * spread, 2 * spread, (3000, 8))
        for _ in range(2):
            chosen, best = cells.nearest(x)
            far = ((x[:, None] - book[None]) ** 2).sum(axis=2)
            assert (chosen == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
    known = grid_codes.Cells(np.array([[0] * 8, [1000] * 8]))
    known.nearest(np.zeros((1, 8), dtype=np.int64))
    assert list(known.masks.values()) == [1]  # the far entry is dominated in that cell


def test_label_errors(spark, tmp_path):
    rows = [(k, v, [None, 1, 2][k % 3], "x", 1, 2) for k, v in enumerate(vectors(60, 8, 9))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op11_vector_codes"](spark, str(tmp_path)).collect()
    label = {r[0]: r[2] for r in rows}
    for r in got:
        assert r.label_error == sum(x.error for x in got if label[x.vec_id] == label[r.vec_id])
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert QUERIES["op11_vector_codes"](spark, f"{tmp_path}/none").count() == 0
