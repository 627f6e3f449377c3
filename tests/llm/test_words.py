import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import words

from martwright.llm.words import chunks, fresh, ngram_keys, split_words

TEXT = st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0aBé你🙂\0", max_size=40)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=6))
def test_words_equal_the_pattern(texts):
    w = split_words(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        own = [w.word(j).decode() for j in range(w.first[i], w.first[i + 1])]
        assert own == words(t)


def test_equal_words_have_equal_keys_wherever_they_stand():
    w = split_words(pa.array(["a bb a", None, "", "bb  bb", "x" * 3_000_000 + " a"]))
    by = {}
    for i, k in enumerate(w.key.tolist()):
        by.setdefault(w.word(i), set()).add(k)
    assert all(len(v) == 1 for v in by.values())
    assert len({next(iter(v)) for v in by.values()}) == 3


def test_lower_case_is_ascii_only():
    w = split_words(pa.array(["ÀB Àb"]), lower=True)
    assert [w.word(0).decode(), w.word(1).decode()] == ["Àb", "Àb"] and w.key[0] == w.key[1]


def test_ngrams_depend_on_order():
    w = split_words(pa.array(["a b c a b c b a"]))
    k = ngram_keys(w.key, 2)
    assert k[0] == k[3] and k[0] != k[6] and len(k) == 7
    assert len(ngram_keys(w.key, 9)) == 0


def test_chunks_keep_all_rows_and_never_cut_a_text():
    texts = ["x" * n for n in (5, 0, 50, 1, 7)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts, pa.string())], ["doc_id", "text"])
    parts = list(chunks(batch, 1, 10))
    assert [x for p in parts for x in p.column(1).to_pylist()] == texts
    assert max(p.num_rows for p in parts) > 1 and len(parts) > 2
    assert not list(chunks(batch.slice(0, 0)))
    sliced = batch.slice(2, 3)
    assert [x for p in chunks(sliced, 1, 10) for x in p.column(1).to_pylist()] == texts[2:5]
    w = split_words(sliced.column(1))
    assert np.array_equal(w.counts, [1, 1, 1])


def test_fresh_names():
    assert fresh("_id", ["a", "_ID"]) == "_id_" and fresh("_id", []) == "_id"


def test_chunks_give_unused_memory_back():
    pool = pa.default_memory_pool()
    released = []
    batch = pa.record_batch({"id": [1, 2, 3], "text": ["a" * 8, "b" * 8, None]})

    class Pool:
        def release_unused(self):
            released.append(True)
            pool.release_unused()

    with pytest.MonkeyPatch.context() as m:
        m.setattr(pa, "default_memory_pool", Pool)
        parts = chunks(batch, 1, 8)
        assert [next(parts).num_rows for _ in range(2)] == [1, 2] and not released
        assert list(parts) == [] and released == [True]
