r"""License scans: MinHash bands over overlapping windows.

Words are lower-cased (A-Z) and rid of marks at their ends; words of marks alone
(comment signs, rules, bullets) are dropped.  For a template of
s five-word shingles every window of s consecutive shingles of a text is
sketched by 16 MinHash values, each a band of its own.  A window that holds 80 %
of the template's shingles has similarity 2/3 or more to it and misses all
bands with probability 2e-8 at most.  Windows that share a band are verified
by exact containment of the template's shingles.  A licence has many templates
(full text, headers, sentences) and sister licences share most of their words:
of overlapping matches the one that holds most shingles counts.

Inserted words spread a notice: where a band hit gives no match in a window of
the template's length, windows of up to 1.5 times its words are verified.  One
that holds 80 % has similarity 0.47 or more and misses all bands with
probability 4e-5 at most.

A band value equals a template's only if the window holds that very shingle,
so texts without any of these shingles are passed over after one look-up.

A template of under five words ("MIT License", an SPDX tag) is one shingle of
its own length: it is looked up at every place, and containment of 80 % of one
shingle means all its words in a row, which are compared as text.  Names and
tags count where no match that holds more overlaps them, and only in texts
without a full text, header or sentence of the same licence: a notice that also
names itself is one notice.

Defined results: start_word and n_words count all words, those of marks too;
null and empty texts match nothing, texts under five words only templates of
under five; a text shorter than a template is one window; repeated rows give
repeated matches; a null doc_id stays; templates need a word; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import license_texts
from .words import LOWER_ASCII, Words, chunks, mix, ngram_keys, split_words, word_keys

SHINGLE = 5
BANDS = 16
MIN_CONTAINMENT_PERCENT = 80
_SEEDS = mix(np.arange(101, 101 + BANDS, dtype=np.uint64))
_MARK = np.zeros(256, bool)
_MARK[33:128] = True
for _r in (slice(48, 58), slice(65, 91), slice(97, 123)):
    _MARK[_r] = False

#: Short notices; license_texts has the full texts, headers and
#: further wordings.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                 "and associated documentation files",
}

MATCHES = "doc_id long, license string, start_word long, n_words long, containment double, matched string"


def placed_words(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Words in lower case without marks at their ends, none of marks alone;
    start and end hold the remaining bytes.  And each word's place in its text
    among all words."""
    w = split_words(texts)
    start, end = w.start.copy(), w.end.copy()
    for edge, step in ((end, -1), (start, 1)):
        while True:
            at = edge - 1 if step < 0 else edge
            cut = (end - start > 1) & _MARK[w.data[at]]
            if not cut.any():
                break
            edge[cut] += step
    kept = ~((end - start == 1) & _MARK[w.data[start]])
    place = (np.arange(len(start)) - np.repeat(w.first[:-1], w.counts))[kept]
    first = np.concatenate([[0], np.cumsum(kept)])[w.first]
    start, end = start[kept], end[kept]
    with np.errstate(over="ignore"):
        key = word_keys(LOWER_ASCII[w.data], start, end)
    return Words(w.data, w.text_at, start, end, first, key), place


def license_words(texts: pa.Array) -> Words:
    return placed_words(texts)[0]


def _lower_words(w: Words, first: int, stop: int) -> tuple[bytes, ...]:
    return tuple(w.data[a:b].tobytes().lower() for a, b in zip(w.start[first:stop], w.end[first:stop]))


class Templates:
    """Sorted shingles and sketch of every template; a licence may have many.
    A sketch is kept as the shingles that give its values.  ``mentions``, and
    templates under five words, count where no other template of the licence
    matches."""

    def __init__(self, templates: dict[str, str] | Iterable[tuple[str, str]], mentions: Iterable[tuple[str, str]] = ()):
        self.names: list[str] = []
        self.mention: list[bool] = []
        self.shingles: list[np.ndarray] = []
        #: sketch shingle -> (template, band)
        self.bands: dict[int, list[tuple[int, int]]] = {}
        known = set()
        #: words of a template under SHINGLE words -> licence, by their number
        self.short: dict[int, dict[tuple[bytes, ...], str]] = {}
        given = [(*x, False) for x in (templates.items() if isinstance(templates, dict) else templates)]
        for name, text, mention in [*given, *((*x, True) for x in mentions)]:
            w = license_words(pa.array([text]))
            if not len(w.key):
                raise ValueError(f"template {name} has no words")
            if len(w.key) < SHINGLE:
                self.short.setdefault(len(w.key), {}).setdefault(_lower_words(w, 0, len(w.key)), name)
                continue
            own = np.unique(ngram_keys(w.key, SHINGLE))
            if (name, own.tobytes()) in known:
                continue
            known.add((name, own.tobytes()))
            with np.errstate(over="ignore"):
                for b, seed in enumerate(_SEEDS):
                    least = int(own[mix(own ^ seed).argmin()])
                    self.bands.setdefault(least, []).append((len(self.names), b))
            self.names.append(name)
            self.mention.append(mention)
            self.shingles.append(own)
        self.sketch = np.array(sorted(self.bands), np.uint64)
        texts = {n: pa.array([b" ".join(x).decode() for x in own]) for n, own in self.short.items()}
        self.short_keys = {n: np.unique(ngram_keys(license_words(t).key, n)[::n]) for n, t in texts.items()}

    def short_matches(self, w: Words) -> dict[int, list[tuple[str, int, int, float, int, bool]]]:
        """As ``matches``, by text, for the templates of under SHINGLE words;
        fewer shingles held than by any longer match, and the fewer the shorter."""
        out: dict[int, list[tuple[str, int, int, float, int, bool]]] = {}
        for n, some in self.short_keys.items():
            keys = ngram_keys(w.key, n)
            at = np.searchsorted(some, keys)
            at[at == len(some)] = 0
            for i in np.flatnonzero(some[at] == keys).tolist():
                t = int(w.text_of[i])
                name = self.short[n].get(_lower_words(w, i, i + n))
                if name is not None and i + n <= w.first[t + 1]:
                    out.setdefault(t, []).append((name, i - int(w.first[t]), n, 1.0, n - SHINGLE, True))
        return out

    def matches(self, keys: np.ndarray, percent: int) -> Iterator[tuple[str, int, int, float, int, bool]]:
        """(name, first word, words, containment, shingles held, whether it is
        a mention) in one text's shingles."""
        shared: dict[int, list[tuple[int, int]]] = {}
        for key in np.unique(keys[np.isin(keys, self.sketch)]).tolist():
            for t, b in self.bands[key]:
                shared.setdefault(t, []).append((b, key))
        hashed: dict[int, np.ndarray] = {}
        places: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for t, bands in sorted(shared.items()):
            width = min(len(self.shingles[t]), len(keys))
            anchors = []
            for b, key in bands:
                if (b, key) not in places:
                    places[b, key] = self._places(keys, b, key, hashed)
                at, room = places[b, key]
                anchors.append(at[room >= width])
            anchors = np.unique(np.concatenate(anchors))
            if len(anchors):
                own, found = self.shingles[t], []
                # the template's length, then with room for inserted words
                for size in (width, -(-3 * (len(own) + SHINGLE - 1) // 2) - SHINGLE + 1):
                    found = found + verified(keys, own, anchors, size, percent, found)
                for i, n, held in found:
                    yield self.names[t], i, n + SHINGLE - 1, held / len(own), held, self.mention[t]

    @staticmethod
    def _places(keys: np.ndarray, band: int, key: int, hashed: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Where the shingle ``key`` is, and how wide the widest window there
        is in which no shingle has a smaller value in this band."""
        with np.errstate(over="ignore"):
            if band not in hashed:
                hashed[band] = mix(keys ^ _SEEDS[band])
            least = mix(np.array([key], np.uint64) ^ _SEEDS[band])[0]
        at = np.flatnonzero(keys == np.uint64(key))
        less = np.concatenate([[-1], np.flatnonzero(hashed[band] < least), [len(keys)]])
        k = np.searchsorted(less, at)
        return at, less[k] - less[k - 1] - 1


def verified(keys: np.ndarray, own: np.ndarray, anchors: np.ndarray, width: int, percent: int,
             taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(first shingle, shingles, held) of disjoint windows of at most ``width``
    shingles, each with an anchor, that hold enough of the template's shingles
    (``own``); the best of those that begin close together, cut to what it holds.
    Words of matches in ``taken`` (in order) are not used again."""
    need = -(-percent * len(own) // 100)
    begin = np.array([-1, *(i for i, _, _ in taken)])
    end = np.array([-1, *(i + n + SHINGLE - 1 for i, n, _ in taken)])

    def free_of_taken(x: np.ndarray) -> np.ndarray:
        k = np.searchsorted(begin, x + SHINGLE - 1, "right") - 1
        return x >= end[k]

    anchors = anchors[free_of_taken(anchors)]
    if not len(anchors):
        return []
    # nothing further off lies in a window with an anchor
    low = max(0, int(anchors[0]) - width + 1)
    some = keys[low:int(anchors[-1]) + width]
    at = low + np.flatnonzero(np.isin(some, own))
    at = at[free_of_taken(at)]
    if len(at) < need:
        return []
    name = np.searchsorted(own, keys[at]).tolist()
    ends = np.searchsorted(at, at + width).tolist()
    held, count, distinct, j = [], [0] * len(own), 0, 0
    for i, end in enumerate(ends):
        while j < end:
            distinct += not count[name[j]]
            count[name[j]] += 1
            j += 1
        held.append(distinct)
        count[name[i]] -= 1
        distinct -= not count[name[i]]
    ok = (np.array(held) >= need) & (np.searchsorted(anchors, at) < np.searchsorted(anchors, at + width))
    out, free = [], 0
    good = np.flatnonzero(ok)
    k = 0
    while k < len(good):
        i = good[k]
        if at[i] < free:
            k += 1
            continue
        close = good[k:np.searchsorted(at[good], at[i] + width - need, "right")]
        best = max(close.tolist(), key=lambda x: (held[x], -x))
        part = at[best:ends[best]]
        part = part[:_reach(keys[part])]
        part = part[len(part) - _reach(keys[part[::-1]]):]
        first, last = int(part[0]), int(part[-1])
        free = last + SHINGLE
        # not across a match of the narrower windows
        if not ((begin > first) & (begin < free)).any():
            out.append((first, last - first + 1, held[best]))
    return out


def _reach(keys: np.ndarray) -> int:
    """How many of the first keys hold all that occur."""
    return int(np.unique(keys, return_index=True)[1].max()) + 1


def disjoint(found: Iterable[tuple]) -> list[tuple]:
    """Of overlapping matches the one that holds most shingles (ties: the
    larger containment, the first), in text order."""
    kept: list[tuple[int, int, tuple]] = []
    for m in sorted(found, key=lambda m: (-m[4], -m[3], m[1])):
        begin, end = m[1], m[1] + m[2]
        k = bisect.bisect(kept, begin, key=lambda x: x[0])
        if (k == 0 or kept[k - 1][1] <= begin) and (k == len(kept) or kept[k][0] >= end):
            kept.insert(k, (begin, end, m))
    return [m for _, _, m in kept]


def scan(docs: DataFrame, templates: dict[str, str] | Iterable[tuple[str, str]] | None = None,
         percent: int = MIN_CONTAINMENT_PERCENT) -> DataFrame:
    """(doc_id, license, start_word, n_words, containment, matched) of every
    match of a template."""
    if templates is None:
        table = Templates([*TEMPLATES.items(), *license_texts.templates()], license_texts.mentions())
    else:
        table = Templates(templates)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                w, place = placed_words(part.column(1))
                keys = ngram_keys(w.key, SHINGLE)
                hit = np.flatnonzero(np.isin(keys, table.sketch))
                rows, short = [], table.short_matches(w)
                for t in sorted({*np.unique(w.text_of[hit]).tolist(), *short}):
                    a, b = w.first[t], w.first[t + 1]
                    found = [*table.matches(keys[a:max(a, b - SHINGLE + 1)], percent), *short.get(t, ())]
                    noticed = {m[0] for m in disjoint(m for m in found if not m[5])}
                    for name, i, n, c, *_ in disjoint(m for m in found if not m[5] or m[0] not in noticed):
                        i, last = a + i, a + i + n - 1
                        body = w.data[w.start[i]:w.end[last]].tobytes().decode("utf-8")
                        rows.append((part.column(0)[t].as_py(), name, place[i], place[last] - place[i] + 1, c, body))
                columns = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64(),
                                                              pa.float64(), pa.string()))],
                    ["doc_id", "license", "start_word", "n_words", "containment", "matched"])

    return docs.select("doc_id", "text").mapInArrow(compute, MATCHES)


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    """Every license notice in every document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
