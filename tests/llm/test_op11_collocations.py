import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import LOWER, table

from martwright.llm import collocations as C

SF = "/root/testdata/sf0.01"


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute(rows, least, top=2000, longest=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        within = Counter()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    within[p[i:i + k]] = max(within[p[i:i + k]], a)
        got = []
        for p, a in cand.items():
            if within[p] < a:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                got.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(got)[:top])]
    return sorted(out)


def docs_df(spark, rows):
    return spark.createDataFrame([(None, t, g, "x", "y") for g, t in rows],
                                 "doc_id long, text string, lang string, phrase string, block string")


def got(df):
    return sorted(map(tuple, df.collect()))


TEXT = st.text(alphabet="aaabbA .,;:!?\n\t\x0b\x0c\ré\x1c\xa0", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=6), st.sampled_from([1, 2, 5]))
def test_every_phrase_begins_in_one_chunk(texts, mean):
    chunk, own, text = C.parse(pa.array(texts, pa.string()), 5, mean)
    want, have = Counter(), Counter()
    for t in texts:
        for w in pieces(t):
            want.update(tuple(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    for c, m in zip(chunk.to_pylist(), own.tolist()):
        at = 0
        for w in (p.split(" ") for p in c.split("\n")):
            have.update(tuple(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1) if at + i < m)
            at += len(w)
    assert have == want and (np.diff(text) >= 0).all()


def test_equal_text_is_cut_at_equal_places():
    rng = np.random.default_rng(5)
    body = " ".join(f"w{x}" for x in rng.integers(0, 99, 400))
    a, b = (set(C.parse(pa.array([t]))[0].to_pylist()) for t in (body, "one two three. " + body))
    assert len(a & b) >= len(a) - 1 >= 5


def test_documents_against_brute_force_and_sql(spark):
    rows = table("documents", SF, "lang, text")
    want = brute(rows, 100)
    assert len(want) > 50
    assert got(C.op11_collocations(spark, SF)) == want
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert sorted(con.execute(C.oracle()).fetchall()) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_made_texts_in_small_blocks(spark, seed):
    rng = np.random.default_rng(seed)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 30, 40))
    rows = []
    for i in range(150):
        w = [f"w{x}" for x in rng.zipf(1.5, int(rng.integers(1, 60))) % 12]
        w = [x + ("," if rng.random() < 0.1 else "") for x in w]
        rows.append(([None, "und", "en", "de"][i % 4], " ".join(w) + (f" {passage} W1" if i % 3 == 0 else "")))
    df = docs_df(spark, rows).repartition(5)
    want = brute(rows, 6, top=40)
    assert len(want) == 120 and any(r[2].count(" ") == 4 for r in want)
    assert got(C.collocations(df, min_count=6, top=40, mean=4, block_bytes=2000)) == want


def test_edges(spark):
    rows = [("en", None), ("en", ""), (None, "a b"), ("en", " . "), ("en", "z " * 300_000), ("en", "Z z"), ("fr", "é è. é è"), ("fr", "é è")]
    df = docs_df(spark, rows)
    assert got(C.collocations(df, min_count=2)) == brute(rows, 2)
    assert got(C.collocations(df.limit(0), min_count=2)) == []


def test_scores_beyond_64_bits(spark, monkeypatch):
    n, a = 9 * 10**14, 8 * 10**14
    found = spark.createDataFrame([("en", "", n), ("en", "x", a), ("en", "y", a), ("en", "x y", a - 1)], "lang string, phrase string, f long")
    monkeypatch.setattr(C, "frequent_phrases", lambda *_: found)
    assert got(C.collocations(None)) == [("en", 1, "x y", a - 1, a, a, n, 1000 * (a - 1) * n // (a * a))]
