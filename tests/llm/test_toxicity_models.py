"""Gram counts, models and word sums against Kneser-Ney counts in plain Python."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hitlens.llm import toxicity_models as tm


def corpus(n=260, seed=8):
    """(doc_id, text, toxic or None) rows with repeated words, odd characters, nulls and texts without words."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeghiländ") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    bad = ["scumbag", "idiotic", "moronic", "x" * 40]
    rows = []
    for k in range(n):
        line = rng.choices(words, k=rng.randint(0, 25)) + (rng.sample(bad, 2) if k % 5 == 0 else [])
        rng.shuffle(line)
        rows.append((k, " ".join(line).capitalize(), None if k % 3 == 2 else int(k % 5 == 0)))
    return [*rows, (900, None, 0), (901, " .. ", 1), (902, "Ünï 世界 abc", None)]


def plain(words):
    """Counts by gram, evidence by gram and weight by context, from {word: counts} as the module's docstring has it."""
    total = {c: Counter() for c in tm.COUNTS}
    for w, row in words.items():
        padded = "\x02" + w + "\x03"
        for i in range(2, len(padded) + 1):
            for c in tm.COUNTS:
                total[c][padded[max(0, i - tm.ORDER) : i]] += row[c]
    n = total["n"]
    low = {g: g[-tm.LOWER :] for g in n}
    c = Counter(low.values())
    cc, ct, single = Counter(), Counter(), Counter(g[-1] for g in n)
    for x, k in c.items():
        cc[x[:-1]] += k
        ct[x[:-1]] += 1
    all_n, all_t = Counter(), Counter()
    for g, k in n.items():
        all_n[g[:-1]] += k
        all_t[g[:-1]] += 1

    def pool(g):
        x = low[g]
        p = (c[x] - 0.75) / cc[x[:-1]] + 0.75 * ct[x[:-1]] / cc[x[:-1]] * single[g[-1]] / sum(single.values())
        return (n[g] - 0.75) / all_n[g[:-1]] + 0.75 * all_t[g[:-1]] / all_n[g[:-1]] * p

    def taken(k):
        return 0 if k <= 0 else tm.DISCOUNTS[min(k, 3) - 1]

    models = {}
    for name, parts in {"all": ("t0 t1", "o0 o1"), "first": ("t0", "o0"), "second": ("t1", "o1")}.items():
        for side, cols in zip("to", parts, strict=True):
            own = {g: sum(total[k][g] for k in cols.split()) for g in n}
            mass, left = Counter(), Counter()
            for g, k in own.items():
                mass[g[:-1]] += k
                left[g[:-1]] += taken(k)
            models[side, name] = own, mass, left
    seen = [g for g in n if any(total[k][g] for k in tm.COUNTS[1:])]
    grams, contexts = {}, {}
    for name in tm.HALVES:
        def p(side, g, name=name):
            own, mass, left = models[side, name]
            return (own[g] - taken(own[g]) + (left[g[:-1]] + tm.STRENGTH) * pool(g)) / (mass[g[:-1]] + tm.STRENGTH)

        def weight(side, x, name=name):
            _, mass, left = models[side, name]
            return math.log((left[x] + tm.STRENGTH) / (mass[x] + tm.STRENGTH))

        for g in seen:
            grams.setdefault(g, []).append(math.log(p("t", g)) - math.log(p("o", g)))
        for x in {g[:-1] for g in seen}:
            contexts.setdefault(x, []).append(weight("t", x) - weight("o", x))
    return total, grams, contexts


@pytest.fixture(scope="module")
def parts(spark):
    rows = corpus()
    df = spark.createDataFrame([*rows, rows[5]], "doc_id long, text string, toxic int").repartition(4)
    sample = tm.training_sample(df.select("doc_id", "toxic")).cache()
    marks = {r.labelled: (r.toxic, r.half) for r in sample.collect()}
    words = {}
    for k, text, _ in [*rows, rows[5]]:
        for w in {w.decode() for w in tm.words_of((text or "").encode())}:
            row = words.setdefault(w, Counter())
            row["n"] += 1
            if k in marks:
                row["to"[marks[k][0] == 0] + str(marks[k][1])] += 1
    return df, sample, plain(words)


def test_gram_counts(parts, monkeypatch):
    df, sample, (total, _, _) = parts
    for flush in (10, tm.FLUSH):
        monkeypatch.setattr(tm, "FLUSH", flush)
        counts = tm.text_grams(df.select("doc_id", "text"), sample, "text")
        got = {r.gram: r for r in counts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in tm.COUNTS], F.countDistinct("bucket").alias("b")).collect()}
        assert set(got) == set(total["n"])
        assert all(r[c] == total[c][g] for g, r in got.items() for c in tm.COUNTS) and all(r.b == 1 for r in got.values())


def test_models_gram_by_gram(parts):
    df, sample, (_, grams, contexts) = parts
    rows = tm.modelled(tm.text_grams(df.select("doc_id", "text"), sample, "text"))
    got = {r.gram: [r[n] for n in tm.HALVES] for r in tm.log_ratios(rows).collect()}
    assert set(got) == set(grams) and len(got) > 800
    for g, values in got.items():
        assert values == pytest.approx(grams[g], abs=1e-9)
    got = {r.context: [r[n] for n in tm.HALVES] for r in tm.backoffs(rows).collect()}
    assert set(got) == set(contexts)
    for x, values in got.items():
        assert values == pytest.approx(contexts[x], abs=1e-9)


@pytest.mark.parametrize(("block", "kept"), [(100, 0), (100, 500), (1 << 20, 1 << 20)])
def test_word_sums_with_unseen_grams(parts, block, kept):
    df, sample, (_, grams, contexts) = parts
    rows = tm.modelled(tm.text_grams(df.select("doc_id", "text"), sample, "text"))
    known = tm.Evidence(tm.in_blocks(tm.keyed(tm.log_ratios(rows), tm.backoffs(rows)), block), kept=kept)
    asked = [b"scumbag", b"scumbags", b"idio", b"zzz", "ländä".encode(), b"q", b"x" * 200]
    for word, values in zip(asked, known.sums(asked), strict=True):
        want = [sum(grams[g][k] if g in grams else contexts.get(g[:-1], (0,) * 3)[k] for g in tm.pieces(word.decode())) for k in range(3)]
        assert values.tolist() == pytest.approx(want, abs=1e-9)
    assert sum(len(k) for k, _ in known.blocks.values()) <= max(kept, 0)
