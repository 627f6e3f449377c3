import zlib

import numpy as np
from llm_helpers import CLASHING, documents, table

from martwright.llm import quality_knn as Q


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in Q.op3_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    labels = dict(table("labels", "/root/testdata/sf0.01", "doc_id, quality"))
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [i for i in labels if got[i].held_out]
    assert len(held) > 50
    right = np.mean([got[i].predicted == labels[i] for i in held])
    assert right > 0.97


def test_scores_are_exact_votes():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.2, (300, Q.DIMENSIONS)).astype(np.float32)
    labels = rng.integers(0, 2, 300)
    model = Q.fit(counts, labels)
    some = rng.poisson(0.2, (20, Q.DIMENSIONS)).astype(np.float32)
    x = model.latent(some)
    for i, s in enumerate(model.score(some)):
        near = sorted(((float(v @ x[i]), k) for k, v in enumerate(model.vectors)), reverse=True)[: Q.NEIGHBOURS]
        weight = [max(v, 0) ** Q.SHARPNESS for v, _ in near]
        assert abs(s - sum(w * labels[k] for w, (_, k) in zip(weight, near)) / sum(weight)) < 1e-4


def test_held_out_labels_are_never_read(spark):
    rows = [(i, f"good text number {i} of the set" if i % 2 else "BAD!! TEXT!! OF!! IT!!") for i in range(200)]
    docs = documents(spark, rows)
    right = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    wrong = right.withColumn("quality", Q.F.when(Q.held_out(Q.F.col("doc_id")), 1 - Q.F.col("quality")).otherwise(Q.F.col("quality")))
    a, b = (sorted(map(tuple, Q.scored(docs, x, ["doc_id"]).collect())) for x in (right, wrong))
    assert a == b and all(p == i % 2 for i, _, p in a)


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 0, "c"), (3, None, "d"), (None, 0, "e")],
                                   "doc_id long, quality int, text string")
    df = documents(spark, [(1, "fine words here"), (2, "NO!! NO!!"), (3, None), (4, ""), (None, "fine words"),
                           (1, "fine words here"), (9, "w " * 500_000)], CLASHING)
    out = Q.scored(df, labels)
    assert set(out.columns) == {*df.columns, "predicted"}
    assert out.count() == 7 and all(0 <= r.score <= 1 for r in out.collect())
    assert Q.scored(df.limit(0), labels).collect() == []
    assert {r.score for r in Q.scored(df, labels.limit(0)).collect()} == {0.5}
    assert Q.stage.__doc__


def test_a_kept_text_goes_to_the_workers_once(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    df = documents(spark, [(1, "fine words here"), (2, "NO!! NO!!")])
    whole, alone = Q.scored(df, labels), Q.scored(df, labels, ["doc_id"])
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "_text" not in plan(whole) and "_text" in plan(alone)
    assert [r.text for r in whole.orderBy("doc_id").collect()] == ["fine words here", "NO!! NO!!"]
    score = lambda d: {r.doc_id: r.score for r in d.collect()}
    assert score(whole) == score(alone)
