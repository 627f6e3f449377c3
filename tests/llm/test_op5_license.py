import random

import pyarrow as pa
from llm_helpers import CLASHING, documents, table, words

from martwright.llm import license_scan as L
from martwright.llm import license_texts as T


def bare(text):
    """Words in lower case without marks at their ends."""
    out = []
    for w in words(text, lower=True):
        while len(w) > 1 and ord(w[-1]) < 128 and not w[-1].isalnum() and ord(w[-1]) > 32:
            w = w[:-1]
        while len(w) > 1 and ord(w[0]) < 128 and not w[0].isalnum() and ord(w[0]) > 32:
            w = w[1:]
        out.append(w)
    return out


def brute(text, templates):
    """Templates of which some window holds 80 % of the shingles."""
    w = bare(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    found = set()
    for name, t in templates.items():
        t = bare(t)
        own = {tuple(t[i:i + 5]) for i in range(len(t) - 4)}
        n = len(t) - 4
        for i in range(max(1, len(grams) - n + 1)):
            if 100 * len(own & set(grams[i:i + n])) >= 80 * len(own):
                found.add(name)
    return found


def test_documents_against_brute_force(spark):
    got = {}
    for r in L.op5_license_scan(spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    want = {i: f for i, t in table("documents", "/root/testdata/sf0.01", "doc_id, text") if (f := brute(t, L.TEMPLATES))}
    assert got == want and len(want) > 10


def test_edited_notices():
    rng = random.Random(5)
    table_ = L.Templates(L.TEMPLATES)
    for _ in range(150):
        name = rng.choice(list(L.TEMPLATES))
        w = L.TEMPLATES[name].split()
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = "other"
        filler = [f"f{rng.randrange(99)}" for _ in range(rng.randrange(0, 60))]
        at = rng.randrange(len(filler) + 1)
        text = " ".join(filler[:at] + w + filler[at:])
        keys = L.ngram_keys(L.license_words(pa.array([text])).key, 5)
        assert {m[0] for m in table_.matches(keys, 80)} == brute(text, L.TEMPLATES), text


def test_edges(spark):
    mit = L.TEMPLATES["mit"]
    df = documents(spark, [(1, f"x {mit} y {mit}"), (1, f"x {mit} y {mit}"), (2, None), (3, ""), (4, "Released under the MIT"),
                           (None, mit.upper()), (6, "w " * 300_000 + mit)], CLASHING)
    got = sorted(map(tuple, L.scan(df).collect()), key=repr)
    want = [(1, "mit", s, 5, 1.0, "Released under the MIT License") for s in (1, 7)] * 2
    want += [(None, "mit", 0, 5, 1.0, "RELEASED UNDER THE MIT LICENSE"), (6, "mit", 300_000, 5, 1.0, "Released under the MIT License")]
    assert got == sorted(want, key=repr)
    assert L.scan(df.limit(0)).collect() == []


def licenses(spark, *texts, **kw):
    """The licences found in each text."""
    got = L.scan(documents(spark, list(enumerate(texts))), **kw).collect()
    return [sorted(r.license for r in got if r.doc_id == i) for i in range(len(texts))]


def test_texts_headers_and_wordings(spark):
    texts = [(n, T.full_text(n)) for n in (*T.FULL, *T.ADAPTED)] + [(n, h[0]) for n, h in T.HEADERS.items()]
    texts += [("mit", "It is Licensed under the MIT License, see there"), ("mit", "Released under an MIT License"),
              ("gpl-2.0", "is under the terms of the GNU General Public License, version 2. All of it"),
              ("cc-by-4.0", "This is licensed under a Creative Commons Attribution 4.0 International License."),
              ("isc", "Released under the ISC license")]
    got = licenses(spark, *(f"Begin here. {t} And so on." for _, t in texts))
    assert got == [[n] for n, _ in texts]


def test_commented_and_edited_notices(spark):
    bsd, mpl = L.TEMPLATES["bsd"].split(), L.TEMPLATES["mpl-2.0"].split()
    lines = [" ".join(bsd[:10]), " ".join(bsd[10:17]), " ".join(bsd[17:])]
    texts = [f"x\n{sign} " + f"\n{sign} ".join(lines) + f"\n{sign} y" for sign in ("*", "#", "//", ";;", "--")]
    texts.append("/*\n * " + " ".join(mpl[:12]) + "\n * " + " ".join(mpl[12:]) + "\n */")
    mit = T.full_text("mit").split()
    for step in (9, 12):
        texts.append(" ".join(w + " [sic]" * (i % 40 == step) for i, w in enumerate(mit)))
    # a name inserted again and again: 80 % of the shingles, in no window of the template's length
    wide = T.full_text("apache-2.0").split()
    texts.append(" ".join(w + " inserted words" * 9 * (i % 50 == 7) for i, w in enumerate(wide)))
    got = licenses(spark, *texts)
    assert got == [["bsd"]] * 5 + [["mpl-2.0"], ["mit"], ["mit"], ["apache-2.0"]]


def test_places_count_words_of_marks(spark):
    df = documents(spark, [(1, "a * b\n * Released under\n * the MIT License. Released under the MIT License")])
    got = sorted(map(tuple, L.scan(df).collect()))
    assert got == [(1, "mit", 4, 6, 1.0, "Released under\n * the MIT License"), (1, "mit", 10, 5, 1.0, "Released under the MIT License")]


def test_names_and_tags_under_five_words(spark):
    texts = ["# SPDX-License-Identifier: MIT", "// SPDX-License-Identifier: GPL-2.0-or-later\nint x;", "MIT License",
             "The MIT\n * License (see there)", "Some MIT Licensed work", "Apache License, Version 2.0", "a BSD 3-Clause License b",
             "spdx-license-identifier:", "MIT", "licensed under the Apache License, Version 2.0", "MIT. License to all",
             "MIT Licence, or else CC-BY-SA-4.0 license"]
    want = [["mit"], ["gpl-2.0"], ["mit"], ["mit"], [], ["apache-2.0"], ["bsd-3-clause"], [], [], ["apache-2.0"], ["mit"],
            ["cc-by-sa-4.0", "mit"]]
    assert licenses(spark, *texts) == want
    # the end of one text and the start of the next are no name
    assert licenses(spark, "the MIT", "License of all") == [[], []]


def test_short_templates_against_brute_force(spark):
    rng = random.Random(8)
    templates = {f"t{k}": " ".join(rng.choice("abcd") for _ in range(n)) for k, n in enumerate((1, 2, 2, 3, 4, 4))}
    templates = {name: text for name, text in templates.items() if list(templates.values()).count(text) == 1}
    rows = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randrange(0, 12)))) for i in range(300)]
    want = []
    for i, text in rows:
        w = text.split()
        found = [(len(t), at, name) for name, text_ in templates.items() for t in [text_.split()]
                 for at in range(len(w)) if w[at:at + len(t)] == t]
        taken = set()
        for n, at, name in sorted(found, key=lambda x: (-x[0], x[1])):
            if not taken & set(range(at, at + n)):
                taken |= set(range(at, at + n))
                want.append((i, name, at, n))
    got = [tuple(r)[:4] for r in L.scan(documents(spark, rows), templates).collect()]
    assert sorted(got) == sorted(want) and len(want) > 100
