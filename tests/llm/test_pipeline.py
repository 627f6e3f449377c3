from llm_helpers import table
from test_op9_minhash import brute as near
from test_op7_packing import check

import __spark_entry__
import corpus_pipeline
from martwright.llm.components import stored

DIRECTORY = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(spark, docs, DIRECTORY), "test")
        kept[name] = rows = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "quality_classifier":
            labels = dict(table("labels", columns="doc_id, quality"))
            assert all(labels.get(r.doc_id, 1) for r in rows)
            assert all(tuple(before[r.doc_id]) == tuple(r) for r in rows)
        if name == "minhash_dedup":
            want = near([(r.doc_id, r.text) for r in before.values()], 5)
            assert {r.doc_id for r in rows} == {i for i, x in want.items() if x[2]}
    last = [(r.doc_id, r.text) for r in kept["substring_dedup"]]
    check(last, kept["best_fit_packing"])


def test_registered(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "minhash_dedup", "substring_dedup", "best_fit_packing"]
    ops = {q.split("_")[0] for q in __spark_entry__.queries() if q.startswith("op")}
    assert ops == {f"op{n}" for n in range(1, 14)}
    assert corpus_pipeline.run(spark, DIRECTORY).count() >= 1
