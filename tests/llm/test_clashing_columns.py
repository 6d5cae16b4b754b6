"""Extra columns with the names that operators use inside pass unharmed."""

import pytest

from hitlens.llm import grid_codes, merkle_manifest, quality_ledger, scaled_sketches, simhash_variants, suffix_decontamination, toxicity_models, url_automaton

INNER = ["doc", "row", "of", "first", "root", "node", "part", "key", "id", "tree", "digest", "own", "head", "text_", "__row", "labelled", "toxic", "half", "name.dot"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, f"a b c {k} one two three four five six", *[f"{n}{k}" for n in INNER]) for k in range(6)]
    return spark.createDataFrame(rows, ["doc_id", "text", *INNER])


def passes(df, docs):
    assert set(INNER) <= set(df.columns)
    want = {r.doc_id: [r[n] for n in INNER] for r in docs.collect()}
    got = {r.doc_id: [r[n] for n in INNER] for r in df.collect()}
    assert got and all(got[k] == want[k] for k in got)
    return got


@pytest.mark.parametrize("block", [20, 1 << 20])
def test_decontamination(spark, docs, block):
    bench = spark.createDataFrame([(k, f"c {k} one") for k in range(4)], "item_id long, text string")
    found = suffix_decontamination.matches(docs, bench, block_bytes=block)
    assert len(passes(found, docs)) == 6 and {r.doc_id: r["items"] for r in found.collect()}[3] == ["3"]
    clean = suffix_decontamination.decontaminated(docs, bench)
    assert clean.columns == docs.columns and set(passes(clean, docs)) == {4, 5}


def test_near_duplicates(docs):
    found = simhash_variants.near_duplicates(docs)
    assert len(passes(found, docs)) == 6
    assert simhash_variants.deduplicated(docs).columns == docs.columns


def test_other_operators(spark, docs):
    labels = spark.createDataFrame([(k, k % 2) for k in range(6)], "doc_id long, toxic int")
    passes(toxicity_models.scored(docs, labels), docs)
    passes(quality_ledger.ledger(docs), docs)
    passes(scaled_sketches.edited(docs), docs)
    passes(scaled_sketches.sketched(docs), docs)
    passes(url_automaton.judged(docs.withColumnRenamed("text", "url")), docs)
    from pyspark.sql import functions as F

    full = docs.withColumns({c: F.lit("x") for c in ("source", "lang", "n_chars")})
    out = merkle_manifest.audited(full)  # a clashing output column is replaced: root is one
    rest = [n for n in INNER if n != "root"]
    want = {r.doc_id: [r[n] for n in rest] for r in docs.collect()}
    assert {r.doc_id: [r[n] for n in rest] for r in out.collect()} == want
    vectors = docs.select(F.col("doc_id").alias("vec_id"), "doc_id", F.array(*[F.col("doc_id").cast("float")] * 8).alias("embedding"), F.lit(1).alias("label"), *[f"`{n}`" for n in INNER])
    passes(grid_codes.compressed(vectors)[0], docs)


def test_url_rules(spark):
    urls = {
        "https://ads1.example.com/x": "block", "https://www.example.com/news/ads/1": "block", "https://shop.example.com/cart/": "block", "https://example.com/a.jpeg": "block",
        "https://example.com/a.jpg?x=1": "block", "https://badge.example.com/fr/8": "allow", "https://example.com/en/leads/": "allow", "https://example.com/loginfo": "allow",
        "https://stats.example.com/": "block", "https://mystats.example.com/": "allow", "https://my-analytics.example.com/": "block", "https://example.com/login": "block",
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.verdict for r in url_automaton.judged(df).collect()} == urls
