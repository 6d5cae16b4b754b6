"""Nulls, empty and long texts, ties and repeated rows, empty tables, clashing columns: each has a defined result."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hitlens.llm import (
    chunk_codec,
    edit_counts,
    license_rules,
    page_wrappers,
    quality_ledger,
    sequence_files,
    simhash_variants,
    suffix_decontamination,
    toxicity_models,
    url_automaton,
    word_tokens,
)
from hitlens.llm.common import table, workspace

from . import brute

LONG = " ".join(f"Wört{k % 977} and" for k in range(60_000))
TEXTS = [None, "", "  \n\t ", "one", "One two three", "one two three", "a b c a b c a b c", "MIT-License\nmit license", LONG, LONG, "x\x00y  z▁ \U0001f600 é"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, repeated rows, a null id, and columns named like what operators make."""
    schema = "doc_id long, text string, n_words string, score string, ids string, hits string, fingerprint string, host string, row string, t int, `a.b` int"
    rows = [(None if k == 3 else k, t, "x", "x", "x", "x", "x", "x", "x", 1, 2) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], rows[0]], schema)


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, "/root/testdata/sf0.001", "labels")


def count(odd):
    return len(TEXTS) + 2


def test_quality(odd):
    out = quality_ledger.ledger(odd)
    got = out.collect()
    assert len(got) == count(odd) and {"a.b", "score", "t"} <= set(out.columns)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(r.text)
    assert quality_ledger.kept_documents(odd).columns == odd.columns
    assert quality_ledger.ledger(odd.limit(0)).count() == 0


def test_ablations(odd):
    rows = quality_ledger.ledger(odd).select("failed_bits")
    bits = [r.failed_bits & quality_ledger.POLICIES["3"] for r in rows.collect()]
    for r in quality_ledger.ablations(rows).collect():
        bit = quality_ledger.BITS[r.rule]
        assert (r.n_failed, r.n_failed_only) == (sum(bool(b & bit) for b in bits), sum(b == bit for b in bits))
        assert r.n_kept_without == sum(b in (0, bit) for b in bits)
    assert quality_ledger.ablations(rows.limit(0)).count() == 0


@pytest.mark.parametrize("block", [suffix_decontamination.BLOCK_BYTES, 40])
def test_decontamination(spark, odd, block):
    items = [(1, "one two three"), (2, "One, two; THREE"), (3, None), (4, "..."), (None, "a b c a"), (5, "and " * 12), (6, LONG[1000:1400]), (6, LONG[1000:1400]), (7, "mit")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = suffix_decontamination.matches(odd, bench, carry_text=True, block_bytes=block)
    got = out.collect()
    assert len(got) == count(odd) and "score" in out.columns
    for r in got:
        n, hit, ids = brute.contaminated(r.text, items)
        assert (r.n_words, sum(h.end - h.start for h in r.hits), r["items"]) == (n, hit, ids)
        assert (r.longest > 0) == (hit > 0)
    clean = suffix_decontamination.decontaminated(odd, bench)
    assert clean.columns == odd.columns and clean.count() == sum(not r.hits for r in got)
    assert suffix_decontamination.matches(odd.limit(0), bench).count() == 0
    assert all(not r.hits for r in suffix_decontamination.matches(odd, bench.limit(0)).collect())


def test_suffix_search_on_random_words():
    rng = random.Random(5)
    for _ in range(30):
        alphabet = [f"w{k}" for k in range(rng.choice([2, 3, 30]))]
        def text(n):
            return " ".join(rng.choice(alphabet) for _ in range(n))

        items = [(str(k), text(rng.randint(0, 25))) for k in range(6)]
        test = suffix_decontamination.TestSet([(k, t.encode()) for k, t in items], window=4)
        texts = [text(rng.randint(0, 60)) for _ in range(5)]
        rows = list(suffix_decontamination._matched([t.encode() for t in texts], test))
        for t, (n, spans, ids, longest) in zip(texts, rows, strict=True):
            assert (n, sum(e - s for s, e in spans), ids) == brute.contaminated(t, items, 4)
            assert longest == 0 or longest >= min(4, *(len(x.split()) for _, x in items if x))


def test_codec(odd):
    path = chunk_codec.model_path()
    model = chunk_codec.chunk_table(path).model
    out = chunk_codec.decoded(chunk_codec.encoded(odd, path), path)
    for r in out.collect():
        assert r.ids == model.encode(r.text or "") + [2]
        assert r.decoded == model.decode(model.encode(r.text or ""))
    assert out.count() == count(odd) and "hits" in out.columns
    assert chunk_codec.encoded(odd.limit(0), path).count() == 0


def test_codec_on_random_texts():
    known = chunk_codec.chunk_table(chunk_codec.model_path())
    rng = random.Random(1)
    texts = ["".join(rng.choice(" ▁abcé\n\U0001f600.xThe\t　") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert [np.frombuffer(b, dtype=np.int32).tolist() for b in known.encode(texts)] == known.model.encode(texts)


def test_word_tokens_on_random_texts():
    words = word_tokens.word_table(sequence_files.tokenizer_path())
    rng = random.Random(2)
    texts = ["".join(rng.choice(" abcé\n\U0001f600.xThe'sdİ1ÀŸſ́$<|\x1c ") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["<|startoftext|>x<|endoftext|> y", "It's they'LL DON'T", "ΑΣ Σ"]
    want = [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(words.encode(t), dtype=words.dtype).tolist() for t in texts] == want


def test_generations_are_bounded():
    made = []
    known = word_tokens.Generations(lambda key: made.append(key) or key, 10)
    for k in range(200):
        assert known["often"] == "often" and known[f"w{k}"] == f"w{k}"
        assert len(known) + len(known.old) <= 22
    assert made.count("often") == 1


def test_sequence_files(spark, odd):
    folder = workspace(spark, "sequences")
    shards = sequence_files.write_sequences(odd, sequence_files.tokenizer_path(), folder, length=16, rows=3)
    got = sorted(sequence_files.read_documents(shards, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in odd.collect()), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    total = 0
    for shard in shards.collect():
        reader = sequence_files.ShardReader(*sequence_files.filesystem(shard.path))
        assert reader.file.schema.field("ids").type == pa.list_(pa.uint16(), 16)
        for k in range(shard.n_sequences):
            ids, mask = reader.sequence(k)
            assert len(ids) == 16 and not ids[~mask].any()
            total += int(mask.sum())
    assert total == sum(r.n_tokens for r in got)
    folder = workspace(spark, "sequences")
    empty = sequence_files.write_sequences(odd.limit(0), sequence_files.tokenizer_path(), folder)
    assert sequence_files.read_documents(empty, folder).count() == 0


def test_token_trees(spark, odd):
    count_ = edit_counts.counter(*edit_counts.tokenizer())
    edits = spark.createDataFrame(
        [(4, 1, 0, 3, "ONE"), (4, 2, 100, 5, None), (8, 1, 5000, 5100, "x" * 500), (8, 2, -5, 2, "\n\n"), (9, 1, 0, 10**6, ""), (99, 1, 0, 1, "z")],
        "doc_id long, seq int, start long, stop long, text string",
    )
    state = edit_counts.with_edits(edit_counts.trees(odd, *edit_counts.tokenizer()), edits)
    out = edit_counts.updated(state, *edit_counts.tokenizer()).withColumn("n", edit_counts.n_tokens()).collect()
    assert len(out) == count(odd)
    for r in out:
        assert r.n == len(count_.encoding.encode_ordinary(r.text)) and r.tree_chars[1] == len(r.text)
    by = {r.doc_id: r for r in out}
    assert by[9].text == "" and by[4].text == "ONE two three" and 0 < by[8].reencoded < 5000 and by[10].reencoded == 0
    assert edit_counts.trees(odd.limit(0), *edit_counts.tokenizer()).count() == 0


def test_random_edits():
    count_ = edit_counts.counter(*edit_counts.tokenizer())
    rng = random.Random(3)
    parts = ["'s", "'l", "l", "'", " ", "  ", "\n", "a", "the", " x", "é", "1", "!!", "\t", "'re", "$"]

    def text(n):
        return "".join(rng.choice(parts) for _ in range(n))

    for _ in range(150):
        body = text(rng.randint(0, 300))
        tree = edit_counts.built(body, count_)
        for _ in range(8):
            start = rng.randint(0, len(body) + 2)
            body, tree, _ = edit_counts.edited(body, tree, start, start + rng.choice([0, 1, 2, 30, 200]), text(rng.choice([0, 1, 2, 300])), count_)
            assert (tree.chars[1], tree.tokens[1]) == (len(body), len(count_.encoding.encode_ordinary(body)))


def test_toxicity(odd, labels):
    out = toxicity_models.scored(odd, labels, carry_text=True)
    got = out.collect()
    assert len(got) == count(odd) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not brute.words(r.text)}) == 1
    assert toxicity_models.ordinary(odd, labels).columns == odd.columns
    assert all(r.score == 0 for r in toxicity_models.scored(odd, labels.limit(0)).collect())
    assert toxicity_models.scored(odd.limit(0), labels).count() == 0


def test_training_sample_is_bounded(labels):
    assert toxicity_models.training_sample(labels, 5).count() < 30
    assert toxicity_models.training_sample(labels).filter(toxicity_models.held_out(F.col("labelled"))).count() == 0


def test_page_wrappers(spark):
    def page(k):
        return (
            f"<html><head><title>T{k}</title><script>var a='<p>no</p>';</script></head><body><header>Site {k}</header>"
            f"<div class='menu'><a href=1>A{k}</a></div><div id=main><h1>Head {k}</h1><p>Fixed line of the site</p><p>Text &amp; more\n {k}<br>end"
            f"<ul><li><a href=1>l{k}</a><li><a href=1>m{k}</a><li><a href=1>n{k}</a></ul><p class=\"cookie-notice\">Cookies {k}</p></div>"
            f"<form>Mail {k}</form><div class='comments'><p>Reader {k}</p></div><footer>End {k}</footer>"
        )

    rows = [(k, f"http://h.example/{k}", page(k), "x") for k in range(12)]
    rows += [(20, None, None, "x"), (21, "http://o.example/", "", "x"), (22, "http://o.example/", "plain &lt; text", "x"), (0, "http://h.example/0", page(0), "x")]
    rows += [(23, "http://o.example/", "<article>" + "<div>" * 3000 + "deep" + "<p>x" * 2000, "x"), (24, "http://q/", "<p><a href='unclosed>y", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text) for r in page_wrappers.extracted(df).collect()]
    assert len(got) == len(rows)
    for k in range(12):
        assert (k, f"Head {k}\n\nFixed line of the site\n\nText & more {k} end") in got or (k, f"Head {k}\n\nText & more {k} end") in got
    texts = dict(got)
    assert texts[20] == "" and texts[21] == "" and texts[22] == "plain < text" and texts[23].startswith("deep\n\nx")
    assert page_wrappers.extracted(df.limit(0)).count() == 0


def test_constant_nodes_are_template():
    wrapper = page_wrappers.Wrapper()
    trees = [page_wrappers.parse(f"<body><h2>Our <b>site</b></h2><p>Story {k}</p><h3>Follow us</h3></body>") for k in range(8)]
    pairs = [wrapper.align(page_wrappers.Skeleton((t.tag, t.names), [t])) for t in trees]
    assert [page_wrappers.main_text(t, wrapper.template(p)) for t, p in zip(trees, pairs, strict=True)] == [f"Story {k}" for k in range(8)]


def test_simple_tree_matching():
    def tree(html):
        t = page_wrappers.parse(html)
        return page_wrappers.Skeleton((t.tag, t.names), [t])

    size, pairs = page_wrappers.match(tree("<div><h1>a</h1><ul></ul><p>b</p></div>"), tree("<div><h1>c</h1><table></table><p>d</p><p>e</p></div>"))
    assert size == 4 and len(pairs) == 4


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTP://A.Example.NET/en/x?q#f"), (5, "http://net"), (6, "http://x.org/fr/"), (7, "http://a.com/b.net/"),
            (8, "ftp://xnet/"), (9, "https://m.casino-1.com?x=/"), (10, "http://example.com/de/" + "y" * 50_000), (10, "http://example.com/de/"), (11, "http://é.net/")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in url_automaton.judged(df).collect()}
    assert got[1] == got[2] == got[3] == ("", None, "allow")
    assert got[4] == ("a.example.net", "example.net/en/", "allow") and got[5] == ("net", None, "allow") and got[6][1:] == ("org/fr/", "allow")
    assert got[7][1] is None and got[8][1] is None and got[9][1:] == (None, "block") and got[10][1:] == ("example.com/de/", "block")
    assert got[11][1] == "net/" and url_automaton.judged(df.limit(0)).count() == 0


def test_globs_by_regex():
    import re

    rng = random.Random(4)
    rules = [url_automaton.Rule("block", "".join(rng.choice("ab*?") for _ in range(rng.randint(0, 6))), "".join(rng.choice("/a*") for _ in range(rng.randint(0, 4)))) for _ in range(60)]
    hosts = ["".join(rng.choice("ab.") for _ in range(rng.randint(0, 8))).encode() for _ in range(200)]
    paths = ["".join(rng.choice("ab/") for _ in range(rng.randint(0, 8))).encode() for _ in range(200)]
    got = url_automaton.Automaton(rules).matches(hosts, paths)

    def pattern(glob):
        return "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob)

    for j, rule in enumerate(rules):
        host, path = re.compile(r"(?:.*)\." + pattern(rule.host)), re.compile(pattern(rule.path) + ".*")
        want = [bool(host.fullmatch("." + h.decode()) and path.fullmatch(p.decode())) for h, p in zip(hosts, paths, strict=True)]
        assert got[:, j].tolist() == want


def test_simhash(spark, odd):
    out = simhash_variants.near_duplicates(odd)
    got = out.collect()
    assert len(got) == count(odd) and "hits" in out.columns
    by = {r.doc_id: r for r in got}
    assert by[0].fingerprint == by[1].fingerprint == by[2].fingerprint == 0 and by[2].component_id == 0
    assert by[4].component_id == by[5].component_id == 4 and by[9].component_id == 8
    kept = simhash_variants.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == len({r.component_id for r in got if r.doc_id is not None}) + 1
    assert simhash_variants.near_duplicates(odd.limit(0)).count() == 0
    assert simhash_variants.deduplicated(odd.limit(0)).count() == 0


def test_simhash_plans_agree(spark):
    rng = random.Random(6)
    values = []
    for _ in range(40):
        center = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 60])):
            x = center
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            values.append(x)
    values = sorted(set(values))
    want = [values[r] for r in brute.components(values)]
    df = spark.createDataFrame([(k, simhash_variants._signed(v)) for k, v in enumerate(values)], "doc_id long, fingerprint long")
    for plan in ((3, 0), (5, 1), (6, 2)):
        got = {r.fingerprint: r["first"].doc_id for r in simhash_variants.classes(df, ["doc_id"], plan=plan).collect()}
        assert [values[got[simhash_variants._signed(v)]] for v in values] == want
    with pytest.raises(ValueError):
        simhash_variants.variant_masks(2, 0)


def test_licenses(spark, odd):
    texts = [
        "Released under the terms of the GNU General Public License version 2, or later. See MIT License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under CC BY-NC 4.0.",
        "licensed to you under the Apache License, Version 2.0; general public license",
        "mit license " * 3000,
    ]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, detections string")
    got = {r.doc_id: r for r in license_rules.scanned(df).collect()}
    assert [d.label for d in got[0].detections] == ["gpl-2.0", "mit"] and got[0].detections[0].start == 0
    assert [d.label for d in got[1].detections] == ["apache-2.0"] and got[1].detections[0].weight == 1.0
    assert [d.label for d in got[2].detections] == ["cc-by-nc-4.0"]
    assert [d.label for d in got[3].detections] == ["apache-2.0"] and [b.label for b in got[3].base] == ["apache", "gpl"]
    assert len(got[4].base) == 3000 and {d.label for d in got[4].detections} == {"mit"}
    assert len(license_rules.rule_table()) >= 300
    out = license_rules.scanned(odd)
    assert out.count() == count(odd) and license_rules.scanned(odd.limit(0)).count() == 0
    assert {r.doc_id: len(r.base) for r in out.collect()}[7] == 2
