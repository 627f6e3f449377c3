import numpy as np
import pytest
from llm_helpers import CLASHING, crafted_words, documents, table, words

from martwright.llm import substring_dedup as S


def brute(rows, width=20):
    """doc_id -> (n_words, kept text)."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = words(t)
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - width + 1):
            k = tuple(w[s:s + width])
            if k in seen:
                gone[s:s + width] = True
            seen.add(k)
        out[i] = (len(w), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def made(seed, n=120):
    """Texts over small vocabularies with copied passages, runs and cycles."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        w = [f"w{x}" for x in rng.integers(0, int(rng.integers(2, 60)), int(rng.integers(0, 150)))]
        for _ in range(int(rng.integers(0, 3))):
            if rows:
                o = (rows[int(rng.integers(len(rows)))][1] or "").split()
                if len(o) > 5:
                    a = int(rng.integers(len(o)))
                    p = int(rng.integers(len(w) + 1))
                    w[p:p] = o[a:a + int(rng.integers(1, 120))]
        for chance, unit in ((0.3, ["w1"]), (0.2, ["w1", "w2"])):
            if rng.random() < chance:
                p = int(rng.integers(len(w) + 1))
                w[p:p] = unit * int(rng.integers(10, 60))
        rows.append((i, " ".join(w) if rng.random() > 0.03 else None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_made_texts_against_brute_force(spark, seed):
    rows = made(seed)
    got = S.dedup_substrings(documents(spark, rows).repartition(4)).collect()
    assert {r.doc_id: (r.n_words, r.kept_text) for r in got} == brute(rows)
    assert any(r.n_removed for r in got)


def test_documents_against_brute_force(spark):
    rows = table("documents", columns="doc_id, text")
    got = S.dedup_substrings(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert {r.doc_id: (r.n_words, r.kept_text) for r in got} == brute(rows)


def test_equal_windows_have_equal_anchors():
    """What recompression promises: symbols inside a window depend on it only."""
    import pyarrow as pa
    rng = np.random.default_rng(7)
    for _ in range(50):
        inner = [f"w{x}" for x in rng.integers(0, 5, 20)]
        names = []
        for _ in range(3):
            left, right = ([f"w{x}" for x in rng.integers(0, 5, int(rng.integers(0, 9)))] for _ in range(2))
            a = S.anchors(split := S.split_words(pa.array([" ".join(left + inner + right)])))
            k = np.flatnonzero((a["lo"] <= len(left)) & (len(left) < a["lo"] + a["n"]))
            assert len(k) == 1 and len(split.key) == len(left) + 20 + len(right)
            names.append(a["name"][k[0]])
        assert len(set(names)) == 1


def test_edges(spark):
    p = " ".join(f"p{i}" for i in range(25))
    long = " ".join(f"q{i}" for i in range(200_000))
    rows = [(1, p), (2, f"a\n{p}\tb"), (2, f"a\n{p}\tb"), (3, None), (4, ""), (5, "one two"), (None, p), (6, long), (7, long),
            (8, "r " * 21), (9, "s " * 20)]
    df = documents(spark, rows, CLASHING)
    out = S.dedup_substrings(df)
    assert set(out.columns) == {*df.columns, "n_words", "n_removed", "kept_text"}
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in out.collect()), key=repr)
    assert got == sorted([(1, 25, 0), (2, 27, 25), (2, 27, 25), (3, 0, 0), (4, 0, 0), (5, 2, 0), (None, 25, 0),
                          (6, 200_000, 0), (7, 200_000, 200_000), (8, 21, 20), (9, 20, 0)], key=repr)
    assert S.dedup_substrings(df.limit(0)).collect() == []
    kept = {r.doc_id: (r.text, r.n_chars) for r in S.stage(spark, df.where("doc_id < 6"), "").collect()}
    assert kept == {1: (p, len(p)), 2: ("a b", 3), 3: (None, 0), 4: ("", 0), 5: ("one two", 7)}


def test_crafted_words_are_told_apart(spark):
    rest = [f"p{i}" for i in range(19)]
    rows = [(i, " ".join([*rest[:9], w, *rest[9:]])) for i, w in enumerate(crafted_words())]
    rows.append((10, rows[3][1]))
    got = S.dedup_substrings(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.kept_text) for r in got} == brute(rows)


def test_rows_that_share_a_doc_id_but_not_the_text(spark):
    a, b = ([f"{c}{i}" for i in range(n)] for c, n in (("a", 200), ("b", 30)))
    rows = [(1, " ".join(a)), (2, " ".join(a)), (2, " ".join(b)), (3, " ".join([*b, "x", "y", "z", "u"])),
            (4, " ".join(b + b)), (4, " ".join(["q", *b, "r", *b])), (4, " ".join(b + b))]
    got = S.dedup_substrings(documents(spark, rows).repartition(3)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [
        (1, 200, 0), (2, 30, 0), (2, 200, 200), (3, 34, 30), (4, 60, 60), (4, 60, 60), (4, 62, 60)]
    only = S.dedup_substrings(documents(spark, rows[4:]).repartition(2)).collect()  # no smaller doc_id
    assert sorted((r.n_words, r.n_removed) for r in only) == [(60, 30), (60, 30), (62, 30)]
