"""Every query of the subpackage against SQL or a plain version on the smallest tables."""

import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from check import rows
from hitlens.llm import chunk_codec, edit_counts, license_rules, sequence_files, toxicity_models
from hitlens.llm.common import ORACLES, QUERIES
from hitlens.llm.queries import QUERIES as REGISTERED

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for name in os.listdir(SF):
        db.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return db


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


def test_all_queries():
    assert REGISTERED is QUERIES
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.execute(ORACLES[name])
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, rel.fetchall())


def test_sentencepiece(spark, documents):
    codec = chunk_codec.chunk_table(chunk_codec.model_path()).model
    want = set()
    for doc, text in documents:
        ids = codec.encode(text) + [codec.eos_id()]
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.add((doc, len(ids), digest, hashlib.sha256(codec.decode(ids).encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op2_sentencepiece_codec"](spark, SF).collect()} == want


def test_token_sequences(spark, documents):
    tokenizer = Tokenizer.from_file(sequence_files.tokenizer_path())
    want, at = set(), 0
    for doc, text in documents:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        want.add((doc, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert {tuple(r) for r in QUERIES["op3_token_sequences"](spark, SF).collect()} == want


def test_token_counts_after_edits(spark):
    count = edit_counts.counter(*edit_counts.tokenizer())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", edit_counts.revision().alias("edits"))
    want = {}
    for doc, text, edits in docs.collect():
        before = len(count.encoding.encode_ordinary(text))
        for e in edits:
            start = min(max(e.start, 0), len(text))
            text = text[:start] + e.text + text[min(max(e.stop, start), len(text)) :]
        want[doc] = (before, len(count.encoding.encode_ordinary(text)), len(text))
    got = QUERIES["op4_token_counts"](spark, SF).collect()
    assert {r.doc_id: (r.n_before, r.n_after, r.n_chars_after) for r in got} == want
    long = [r for r in got if r.n_chars_after > 8000]
    assert long and all(r.reencoded < r.n_chars_after / 4 for r in long)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, sf).collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic, text FROM '{sf}/labels.parquet' JOIN '{sf}/documents.parquet' USING (doc_id)").fetchall()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= toxicity_models.THRESHOLD) for r in got.values())
    words = ("idiot", "moron", "loser", "scum", "stupid", "trash", "worthless", "clown", "disgusting", "pathetic")
    held = [(got[d].predicted, toxic, any(w in text.lower() for w in words)) for d, toxic, text in labels if got[d].held_out]
    clean = [p for p, toxic, _ in held if not toxic]
    marked = [p for p, toxic, named in held if toxic and named]
    assert sum(clean) <= 0.03 * len(clean)
    assert sum(marked) >= 0.7 * len(marked)


def test_simhash(spark, documents):
    prints = [brute.fingerprint(text) for _, text in documents]
    roots = brute.components(prints)
    want = {(doc, f"{p:016x}", documents[r][0]) for (doc, _), p, r in zip(documents, prints, roots, strict=True)}
    assert {tuple(r) for r in QUERIES["op9_simhash_near_dedup"](spark, SF).collect()} == want


def test_license_base(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op10_license_scans"](spark, SF).collect()}
    for doc, text in documents:
        w = brute.words(text)
        at = [(k, label) for phrase, label in license_rules.BASE.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        r = got[doc]
        places = [k for k, _ in at]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in at}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_page_text(spark, con):
    """In these pages the article is one element of headings and paragraphs."""
    import re
    from html import unescape

    got = {r.page_id: r for r in QUERIES["op7_html_extraction"](spark, SF).collect()}
    for page, html in con.execute("SELECT page_id, html FROM pages").fetchall():
        article = re.search("<article>(.*?)</article>", html, re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
        want = "\n\n".join(p for p in parts if p)
        assert got[page].text == want and got[page].n_chars == len(want)
