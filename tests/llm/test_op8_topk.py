import numpy as np
import pytest

from martwright.llm import topk_search as T


def brute(rows, every=50, k=5):
    """As the SQL: all rows of another vec_id are candidates, those of a
    repeated query rank together."""
    x = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows
         if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for q in {i for i, _ in x if i % every == 0}:
        s = sorted((-sum(a * b for a, b in zip(v, w)), c) for i, v in x if i == q for c, w in x if c != q)[:k]
        out += [(q, r + 1, c, -v) for r, (v, c) in enumerate(s)]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    v = T.stored(T.quantised(df), "v")
    return sorted(map(tuple, T.top_products(v, v.where("vec_id % 50 = 0"), **more).collect()))


@pytest.mark.parametrize("kind", ["signed", "ties", "skewed"])
def test_against_brute_force(spark, kind):
    rng = np.random.default_rng(len(kind))
    n, d = 700, 24
    x = {"signed": rng.normal(size=(n, d)), "ties": rng.integers(-1, 2, (n, d)) / 256,
         "skewed": rng.normal(size=(n, d)) * 3.0 ** -np.arange(d)}[kind].astype(np.float32)
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x)]
    assert run(spark, rows, shard_rows=150, query_rows=4) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [0.5, None]), (100, None), (150, [nan, 1.0]), (200, [inf, 1.0]), (None, [1.0, 1.0]),
            (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, []), (3, [0.25])]
    best = 256 * 256 + 512 * 256
    assert run(spark, rows) == [(0, 1, 1, best), (0, 2, 1, best), (0, 3, 3, 256 * 64), (0, 4, 2, 0)] == brute(rows)
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []
    assert run(spark, [(7, [1.0])]) == []


def test_pruning_keeps_ties():
    rng = np.random.default_rng(9)
    for _ in range(100):
        n, d, k = int(rng.integers(1, 120)), int(rng.integers(1, 30)), int(rng.integers(1, 7))
        x = rng.integers(-3, 4, (n, d)).astype(float)
        q = rng.integers(-3, 4, d).astype(float)
        own = slice(a := int(rng.integers(0, n)), a + int(rng.integers(0, 3)))
        rows, score = T.max_score(q, np.ascontiguousarray(x.T), x.min(0), x.max(0), own, k)
        full = x @ q
        others = [i for i in range(n) if not own.start <= i < own.stop]
        want = sorted((-full[i], i) for i in others)[:k]
        assert sorted((-s, r) for r, s in zip(rows.tolist(), score.tolist()))[:k] == want


def test_repeated_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(c) for c in rng.integers(-2, 3, 4) / 8]) for i in rng.integers(0, 60, 300)]
    rows += [(50, [0.5] * 4), (50, [0.25, -0.5, 0.0, 1.0]), *[(7, [0.5] * 4)] * 120, *[(0, [0.5] * 4)] * 3]
    assert run(spark, rows, shard_rows=40, query_rows=2) == brute(rows)
