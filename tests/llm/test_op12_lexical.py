import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import CLASHING, LOWER, SMALL, documents, table

from martwright.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """(item_id, rank, doc_id, score) rows, in order of the items."""
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    N, total = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        own = terms(text)
        scores = []
        for i, c, n in bags:
            s = 0
            for t in own:
                if c[t]:
                    m = 100 - 75 + 75 * n * N // total
                    s += math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return out


def items_df(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet=" \t\n.aBzZ09é你-_\x7f", max_size=30), max_size=5))
def test_terms_equal_the_pattern(texts):
    spelt, begin = L.split_terms(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert spelt.to_pylist()[begin[i]:begin[i + 1]] == terms(t)


def test_documents_against_brute_force_and_sql(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD_BYTES", 60_000)
    docs, items = table("documents", columns="doc_id, text"), table("benchmark", columns="item_id, text")
    want = sorted(brute(docs, items))
    assert len(want) >= 10
    assert sorted(map(tuple, L.op12_lexical_search(spark, SMALL).collect())) == want
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    assert sorted(con.execute(L.oracle()).fetchall()) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_pruned_search_against_brute_force(spark, seed, monkeypatch):
    """Skewed terms, many blocks, several shards and query blocks."""
    monkeypatch.setattr(L, "BLOCK", 4)
    rng = np.random.default_rng(seed)
    word = lambda n: " ".join(f"w{min(int(x), 300)}" for x in rng.zipf(1.3, n))
    docs = [(i, word(int(rng.integers(1, 60)))) for i in range(700)]
    items = [(i, word(int(rng.integers(1, 25)))) for i in range(40)]
    got = L.lexical_search(documents(spark, docs).repartition(5), items_df(spark, items), k=7, query_bytes=1500)
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs, items, 7))


def test_blocks_are_rejected_before_they_are_unpacked(monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 16)
    n = 4000
    length = np.full(n, 50)
    rare, common = np.arange(0, n, 400), np.arange(n)
    lists = []
    for docs, w in ((rare, 9000), (common, 10)):
        p = L.PostingList(*L.pack_list(docs, np.ones(len(docs), np.int64), length))
        p.bound = L.gain(p.most, 100 + 0 * p.shortest)
        lists.append((w, p))
    docs, score = L.block_max_max_score(lists, np.full(n, 100), 5)
    assert set(rare[:5].tolist()) <= set(docs.tolist()) and len(set(score.tolist())) == 1
    assert len(lists[1][1].unpacked) <= len(rare) < len(lists[1][1].n)


def test_posting_lists_round_trip():
    rng = np.random.default_rng(3)
    for top in (100, 60_000, 5_000_000):
        docs = np.unique(rng.integers(0, top, 900))
        tf = rng.integers(1, [2, 70_000][int(top > 100)], len(docs))
        p = L.PostingList(*L.pack_list(docs, tf, np.arange(top)))
        a, b = p.whole()
        assert a.tolist() == docs.tolist() and b.tolist() == tf.tolist()
        assert p.shortest.tolist() == docs[::L.BLOCK].tolist()


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "..."), (5, "alpha beta"), (4, "Alpha BETA"), (None, "alpha beta"), (4, "Alpha BETA"),
            (6, "gamma " * 100_000), (7, "x")]
    items = [(1, "alpha alpha beta"), (2, None), (3, ""), (4, "unknown"), (1, "alpha alpha beta"), (5, "GAMMA, x?"), (None, "x")]
    df = documents(spark, docs, CLASHING)
    got = L.lexical_search(df.repartition(2), items_df(spark, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(docs, items), key=repr)
    assert L.lexical_search(df.limit(0), items_df(spark, items)).collect() == []
    assert L.lexical_search(df, items_df(spark, items).limit(0)).collect() == []
