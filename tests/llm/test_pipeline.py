"""The pipeline stage by stage against plain versions."""

import duckdb

import corpus_pipeline
from hitlens.llm import chunk_codec, quality_ledger, toxicity_models
from hitlens.llm.common import stored, table

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    kept = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), "test")
        got = {r.doc_id: r for r in out.collect()}
        if name == "quality rules":
            sql = duckdb.connect()
            for t in ("documents",):
                sql.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
            want = {d for d, k in sql.execute(f"SELECT doc_id, kept FROM ({quality_ledger._SQL})").fetchall() if k}
        elif name == "toxicity":
            scores = toxicity_models.scored(docs, table(spark, SF, "labels"))
            want = {r.doc_id for r in scores.collect() if r.predicted == 0}
            assert len(want) > 0.8 * len(kept)
        elif name == "simhash near-dedup":
            ids = sorted(kept)
            roots = brute.components([brute.fingerprint(kept[d]) for d in ids])
            want = {d for k, d in enumerate(ids) if roots[k] == k}
        elif name == "benchmark decontamination":
            want = {d for d, text in kept.items() if not brute.contaminated(text, items)[1]}
        else:
            codec = chunk_codec.chunk_table(chunk_codec.model_path()).model
            assert {d: r.ids for d, r in got.items()} == {d: codec.encode(t) + [2] for d, t in kept.items()}
            assert all(r.decoded == kept[d] for d, r in got.items())
            want = set(kept)
        assert set(got) == want, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs, kept = out, {d: r.text for d, r in got.items()}
    assert corpus_pipeline.run(spark, SF).count() == len(kept)


def test_registered():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
