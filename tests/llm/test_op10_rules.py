import duckdb
from llm_helpers import CLASHING, documents, words

from martwright.llm import quality_rules as R


def brute(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    cover = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover),
            len(w) < 50 or 100 * len(cover) > 50 * len(w))


TEXTS = ["", None, "a b c", "x y z x y z", "x x x x x", "a\n\na\n a\nb\na", "# a|b <>\x0b&\x85c\xa0d", "é 你好 🙂\t\r\n",
         "the of and to in " * 9 + "end with other words", "p q r s p q t u p q r", " ".join(f"the w{i}" for i in range(60)),
         "$$$ " * 60]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_against_brute_force(spark):
    out = R.apply_rules(documents(spark, list(enumerate(TEXTS)), CLASHING))
    assert set(CLASHING) <= set(out.columns)
    got = {r.doc_id: r for r in out.collect()}
    for i, t in enumerate(TEXTS):
        assert tuple(got[i][c] for c in COUNTS) == brute(t), t
        assert not (got[i].base_failed and got[i].kept)
    assert got[10].kept and not got[11].kept and not got[0].kept


def test_rows(spark):
    df = documents(spark, [(1, "a b"), (1, "a b"), (None, "c " * 300_000)])
    assert sorted(((r.doc_id, r.n_words) for r in R.apply_rules(df).collect()), key=repr) == [(1, 2), (1, 2), (None, 300_000)]
    assert R.apply_rules(df.limit(0)).collect() == []


def test_table_of_rules(spark):
    df = documents(spark, [(1, " ".join(f"w{i}" for i in range(60)))])
    assert not R.apply_rules(df).first().kept  # no stop word
    assert R.apply_rules(df, {}).first().kept
    assert not R.apply_rules(df, {"mean_word_length": (9.0, None)}).first().kept


def test_oracle_and_no_python_in_the_plan(spark):
    d = "/root/testdata/sf0.001"
    df = R.op10_quality_rules(spark, d)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{d}/documents.parquet'")
    want = con.execute(R.oracle()).fetchall()
    names = [x[0] for x in con.execute(R.oracle()).description]
    assert names == df.columns and sorted(map(tuple, df.collect())) == sorted(want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
