from llm_helpers import CLASHING, documents, table

from martwright.llm import line_dedup as L


def brute(rows, min_sites):
    """rows: (doc_id, text, source)."""
    sites, first = {}, {}
    for i, t, s in rows:
        for p, line in enumerate((t or "").split("\n")):
            k = line.strip(" \t\n\x0b\x0c\r")
            if k:
                sites.setdefault(k, set()).add(s)
                first[k] = min(first.get(k, (i, p)), (i, p))
    out = []
    for i, t, s in rows:
        keep = [x for p, x in enumerate((t or "").split("\n"))
                if len(sites.get(k := x.strip(" \t\n\x0b\x0c\r"), ())) < min_sites or first[k] == (i, p)]
        out.append((i, None if t is None else "\n".join(keep)))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rows = table("documents", columns="doc_id, text, source")
    for sites in (3, 10):
        got = L.dedup_lines(documents(spark, rows), sites).select("doc_id", "text").collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows, sites)


def test_near_threshold_counts_are_exact(spark):
    rows = [(100 * k + i, f"line on {k} sites\nown {k} {i}", f"s{i}") for k in range(5, 16) for i in range(k)]
    got = L.dedup_lines(documents(spark, rows)).where("n_removed_lines > 0").collect()
    assert {r.doc_id for r in got} == {100 * k + i for k in range(10, 16) for i in range(1, k)}


def test_edges(spark):
    rows = [(1, "a\n\nb ", "s1"), (2, " a", "s2"), (2, " a", "s2"), (3, None, "s3"), (4, "", None), (5, "a\nc", None),
            (None, "a", "s1"), (7, "z" * 3_000_000 + "\na", "s4")]
    df = documents(spark, rows, CLASHING)
    out = L.dedup_lines(df, 3)
    assert set(out.columns) == {*df.columns, "n_lines", "n_removed_lines"}
    got = sorted(((r.doc_id, r.text, r.n_removed_lines) for r in out.collect()), key=repr)
    assert [(i, t if t is None or len(t) < 9 else len(t), n) for i, t, n in got] == sorted(
        [(1, "\nb ", 1), (2, "", 1), (2, "", 1), (3, None, 0), (4, "", 0), (5, "c", 1), (None, "a", 0), (7, 3_000_000, 1)],
        key=repr)
    assert L.dedup_lines(df.limit(0)).collect() == []


def test_stage_keeps_columns(spark):
    df = documents(spark, [(i, f"shared line\nown {i:02}", f"s{i}") for i in range(12)])
    out = L.stage(spark, df, "")
    assert out.columns == df.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {
        i: (f"own {i:02}", 6) if i else ("shared line\nown 00", 18) for i in range(12)}
