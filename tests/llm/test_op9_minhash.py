import itertools

import numpy as np
import pyarrow as pa
from llm_helpers import CLASHING, connected, crafted_words, documents, table, words

from martwright.llm import minhash_dedup as M
from martwright.llm.components import components


def shingles(text, n):
    w = words(text, lower=True)
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n, percent=80):
    sets = {i: shingles(t, n) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    low = connected(sets, links)
    return {i: (len(s), low[i], low[i] == i) for i, s in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def chained(seed=1, n=150):
    """Families in which each text is an edit of an earlier one, so that
    families hold links which their smallest member does not have."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.75:
            w = rows[int(rng.integers(len(rows)))][1].split()
            for _ in range(max(1, len(w) // 25)):
                w[int(rng.integers(len(w)))] = f"e{rng.integers(10**6)}"
        else:
            w = [f"v{x}" for x in rng.integers(0, 400, int(rng.integers(3, 120)))]
        rows.append((int(rng.permutation(1)[0]) + i, " ".join(w)))
    order = rng.permutation(n)
    return [(int(order[i]), t) for i, (_, t) in enumerate(rows)]


def test_documents_against_brute_force(spark):
    rows = table("documents", columns="doc_id, text")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(M.near_duplicates(docs, 2)) == brute(rows, 2)


def test_chains_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 16)  # buckets are compared in several blocks
    rows = chained()
    want = brute(rows, 2)
    assert len({c for _, c, _ in want.values()}) < len(rows) - 40
    assert got(M.near_duplicates(documents(spark, rows), 2)) == want


def test_registers_estimate_similarity():
    rng = np.random.default_rng(4)
    sets = [rng.choice(2000, 800, replace=False)]
    sets.append(np.concatenate([sets[0][:700], 5000 + np.arange(100)]))
    keys = [np.sort(M.mix(s.astype(np.uint64))) for s in sets]
    sig = M.registers(np.repeat([0, 1, 2], [800, 800, 0]), np.concatenate(keys), 3)
    assert (sig[2] == M.EMPTY).all() and (sig[0] != M.EMPTY).all()
    estimate, ok = M.may_match(sig[:1], sig[1:2], np.array([800]), np.array([800]), 80)
    assert abs(estimate[0] - 700 / 900) < 0.15 and ok[0]
    assert not M.may_match(sig[:1], sig[2:], np.array([800]), np.array([1]), 80)[1][0]


def test_registers_hold_zeros_and_mantissa():
    key = np.arange(1, 5000, dtype=np.uint64)
    sig = M.registers(np.zeros(len(key), np.int64), key, 1)[0]
    for t in range(M.TABLES):
        x = M.mix(key ^ M._SEEDS[t])
        for b in range(M.BUCKETS):
            low = min(int(v) >> 11 for v in x if int(v) % M.BUCKETS == b)
            lead = 53 - low.bit_length()
            bits = format(low, "053b")[lead + 1:][: M.MANTISSA].ljust(M.MANTISSA, "0")
            assert sig[t * M.BUCKETS + b] == (lead << M.MANTISSA) + int(bits, 2)


def test_first_shared_band():
    sig = np.arange(3 * M.REGISTERS, dtype=np.uint16).reshape(3, -1)
    sig[1, 8:] = sig[0, 8:]
    assert M.first_band(sig[:1], sig[1:2]).tolist() == [2]
    assert M.first_band(sig[:0], sig[:0]).tolist() == [] and M.band_keys(sig[:0]).shape == (0, 32)
    sig[:, :8] = M.EMPTY
    assert M.first_band(sig[:1], sig[1:2]).tolist() == [2] and (M.band_keys(sig)[:, :2] == -1).all()


def test_shingle_sets():
    w = M.split_words(pa.array(["a b a b", "A", None, "x y", ""]), lower=True)
    who, key = M.shingle_sets(w, 2)
    assert np.bincount(who, minlength=5).tolist() == [2, 1, 0, 1, 0] and len(set(key.tolist())) == 4


def test_components(spark):
    rng = np.random.default_rng(6)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(400, 460)]
    low = connected({x for l in links for x in l}, links)
    out = {r.a: r.b for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {n: c for n, c in low.items() if n != c}


def test_edges(spark):
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(5, t), (3, t.upper()), (3, t.upper()), (9, t + " end"), (7, None), (8, ""), (10, " \n"), (11, "one"), (12, "ONE"),
            (None, t), (13, "z " * 200_000), (14, "z z z")]
    df = documents(spark, rows, CLASHING)
    out = M.near_duplicates(df, 2)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = [(5, 59, 3, False), (3, 59, 3, True), (3, 59, 3, True), (9, 60, 3, False), (7, 0, 7, True), (8, 0, 8, True),
            (10, 0, 10, True), (11, 1, 11, True), (12, 1, 11, False), (None, 59, None, True), (13, 1, 13, True),
            (14, 1, 13, False)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert M.near_duplicates(df.limit(0)).collect() == []


def test_blocks_are_decided_by_exact_counts(spark):
    rng = np.random.default_rng(7)
    base = M.mix(np.arange(1000, dtype=np.uint64))
    sets = [np.sort(base), np.sort(np.concatenate([base[:890], M.mix(5000 + np.arange(110, dtype=np.uint64))]))]
    # registers that disagree as one pair in a million does by chance
    sig = [rng.integers(0, 1000, 128).astype(np.uint16).tobytes() for _ in sets]
    schema = "node long, n long, sig binary, keys binary"
    full = spark.createDataFrame([(i, 1000, bytearray(g), bytearray(k.tobytes())) for i, (g, k) in enumerate(zip(sig, sets))], schema)
    groups = spark.createDataFrame([(0, 0), (0, 1)], "hub long, node long")
    assert sorted(map(tuple, M.group_links(groups, full, 80).collect())) == [(1, 0)]


def test_crafted_words_are_told_apart(spark):
    rows = [(i, f"{w} {w}") for i, w in enumerate(crafted_words())]
    rows.append((10, rows[3][1]))
    assert got(M.near_duplicates(documents(spark, rows), 2)) == brute(rows, 2)


def test_estimate_rules_out_only_what_is_all_but_impossible():
    least = M.fewest_equal(80)
    assert least[:13].max() == 0 and least[128] == 71 and (np.diff(least) >= 0).all()


def test_the_stage_keeps_one_row_of_each_group(spark):
    t, u = (" ".join(f"{c}{i}" for i in range(60)) for c in "tu")
    rows = [(1, t), (1, t), (None, t), (None, t), (2, t), (None, u), (None, u + " end"), (3, "short"), (3, "short"), (3, "other"),
            (None, None), (4, "")]
    df = documents(spark, rows, CLASHING)
    out = M.stage(spark, df.repartition(3), "")
    assert out.columns == df.columns and out.schema["doc_id"].dataType == df.schema["doc_id"].dataType
    texts = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert [x for x in texts if x[1] == t] == [(1, t)]
    assert len([x for x in texts if x[1] in (u, u + " end")]) == 1
    assert len(texts) == 6 and (3, "short") in texts and (3, "other") in texts
    assert M.stage(spark, df.limit(0), "").collect() == []
