r"""Substring dedup by recompression.

Words are ``[^\x20\x09-\x0D]+``, unchanged.  A window is ``width`` (20)
consecutive words of a document; a word goes if a window over it also starts
earlier (smaller doc_id, or same document, earlier start).

1. Two recompression rounds rename each text: words (then symbols) are split
   into a left and a right class by a global hash, and every left-right pair
   becomes one symbol whose name depends on its content only.  Names thus
   agree on all executors, and inside equal word sequences all symbols but
   those of the outer three words agree.  Runs of ``width`` or more equal
   words, which no pair divides, are named as (word, run).
2. Every window has symbols that start in its interior; the one with the
   smallest name of its seven-word surroundings becomes the window's anchor.
   Neighbouring windows share anchors, about one per eight words.  A row
   (name, span, doc_id, at) is sent per anchor; ``span`` names all words under
   its windows, ``at`` holds the first window, how many, and whether the
   document has the same name and span before.
3. Names that occur once are unrepeated and drop out after a map-side merge.
   Anchors of one name and span stand for equal windows: all go but those of
   the smallest doc_id.  Only where a name has several spans (the ends of a
   repeat) the windows of each span's first anchor are named from the text
   and compared one by one.

Rows compared agree in two independent 64-bit names.  A word sequence in many
documents costs each document one row per anchor and merges before the
shuffle; no group is collected but a document's own rows.

Defined results: a null or empty text has no words; texts under ``width``
words lose nothing; of rows that repeat a doc_id none starts earlier than
another, whether their texts are equal or not, and each is judged by its own
text (what is found belongs to doc_id and text hash, and a place beyond a text is
an error); rows without doc_id lose nothing and hide nothing; an empty table
gives no rows; all columns of the input are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import stored, with_text
from .tokens import let_go
from .words import Words, _odd_constants, chunks, combine, fresh, mix, split_words

WIDTH = 20
ROUNDS = 2
_CLASS_SEED = _odd_constants(ROUNDS, 31_337)
_RUN, _LAST = np.uint64(0x5851F42D4C957F2D), np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0xDA942042E4DD58B5)

#: ``at`` is first window * 256 + windows * 2 + (1 if not the document's first).
ANCHORS = "name long, span long, doc_id long, tid long, at long"


class Sequences:
    """Names of word ranges of a chunk, by prefix sums."""

    def __init__(self, key: np.ndarray):
        n = len(key)
        with np.errstate(over="ignore"):
            self.powers = np.full(n + 1, _STEP).cumprod(dtype=np.uint64)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(key * self.powers[:n], dtype=np.uint64)])
            back = np.uint64(pow(int(_STEP), -1, 1 << 64))
            self.back = np.full(n + 1, back).cumprod(dtype=np.uint64)

    def names(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def symbol_starts(key: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Whether each word begins a symbol after the recompression rounds."""
    name, text, at = key, text_of, np.arange(len(key))
    with np.errstate(over="ignore"):
        for seed in _CLASS_SEED:
            left = (mix(name ^ seed) & np.uint64(1)).astype(bool)
            pair = np.zeros(len(name), bool)
            pair[:-1] = left[:-1] & ~left[1:] & (text[:-1] == text[1:])
            head = np.ones(len(name), bool)
            head[1:] = ~pair[:-1]
            joined = name.copy()
            joined[pair] = combine(name[:-1][pair[:-1]], name[1:][pair[:-1]])
            name, text, at = joined[head], text[head], at[head]
    out = np.zeros(len(key), bool)
    out[at] = True
    return out


def run_windows(key: np.ndarray, text_of: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows of one repeated word, those of them that begin a run)."""
    n = len(key)
    head = np.ones(n, bool)
    head[1:] = (key[1:] != key[:-1]) | (text_of[1:] != text_of[:-1])
    begin = np.flatnonzero(head)
    end = np.append(begin[1:], n)
    at = np.arange(n)
    inside = at + width <= np.repeat(end, end - begin)
    return inside, inside & head


def anchors(words: Words, width: int = WIDTH) -> dict[str, np.ndarray]:
    """The anchors of a chunk: text, name, span, lo (first window, counted
    from the text's first word), n (windows) and again (whether the text has
    the same name and span before)."""
    key, text_of = words.key, words.text_of
    core = width // 3 + 1
    reach = width - core  # anchors of window i lie in i .. i + reach
    m = len(key) - width + 1
    empty = {k: np.zeros(0, np.uint64 if k in ("name", "span") else np.int64) for k in ("text", "name", "span", "lo", "n", "again")}
    if m <= 0:
        return empty
    seq = Sequences(key)
    run, run_head = run_windows(key, text_of, width)
    valid = (text_of[:m] == text_of[width - 1:]) & ~run[:m]
    at = np.arange(m + reach)
    core_name = seq.names(at, at + core)
    spans = Sequences(words.other)
    # a symbol must start 2 ** ROUNDS - 1 words inside its surroundings
    value = np.where(symbol_starts(key, text_of)[at + 2**ROUNDS - 1], core_name, _LAST)
    index, step = at, 1
    while step <= reach:  # leftmost smallest value of windows of 1, 2, 4, ... places, then of all
        far = min(step, reach + 1 - step)
        a, b = value[:-far], value[far:]
        pick = a <= b
        value, index, step = np.where(pick, a, b), np.where(pick, index[:-far], index[far:]), step + far
    index, windows = index[:m][valid], np.flatnonzero(valid)
    new = np.ones(len(windows), bool)
    new[1:] = (index[1:] != index[:-1]) | (windows[1:] != windows[:-1] + 1)
    head = np.flatnonzero(new)
    lo, place = windows[head], index[head]
    n = np.diff(np.append(head, len(windows)))
    with np.errstate(over="ignore"):
        span = mix(spans.names(lo, lo + n - 1 + width) + (place - lo).astype(np.uint64))
        runs = np.flatnonzero(run_head)
        lo = np.concatenate([lo, runs])
        text = text_of[lo]
        name = np.concatenate([core_name[place], mix(key[runs] ^ _RUN)])
        span = np.concatenate([span, mix(words.other[runs])])
        first = np.unique(combine(combine(name, span), text.astype(np.uint64)), return_index=True)[1]
    again = np.ones(len(lo), bool)
    again[first] = False
    return {"text": text, "name": name, "span": span, "lo": lo - words.first[text],
            "n": np.concatenate([n, np.ones(len(runs), np.int64)]), "again": again}


def anchor_rows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(name, span, doc_id, tid, at) of every anchor; tid: the text's hash."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in chunks(batch):
                a = anchors(split_words(part.column(1)), width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a["name"].view(np.int64)), pa.array(a["span"].view(np.int64)),
                     part.column(0).cast(pa.int64()).take(pa.array(a["text"])), part.column(2).take(pa.array(a["text"])),
                     pa.array(a["lo"] * 256 + a["n"] * 2 + a["again"])], ["name", "span", "doc_id", "tid", "at"])

    return docs.where("doc_id is not null").select("doc_id", "text", _tid()).mapInArrow(compute, ANCHORS)


def _tid() -> Column:
    return F.xxhash64("text").alias("tid")


def _inside(words: Words, row: np.ndarray, end: np.ndarray):
    if (end > words.counts[row]).any():
        raise ValueError("a repeat ends beyond its text: the input gave other rows when it was read again")


def _lists(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(row of every element, the elements' fields) of a list<struct> column."""
    n = np.asarray(column.value_lengths().fill_null(0))
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), n), {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type}


def _places(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], ..., first[0] + n[0] - 1, first[1], ..."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - n), n)


def _listed(docs: DataFrame, rows: DataFrame, field: list[str]) -> DataFrame:
    """docs, the text's hash and the list of their rows (both null: none).
    Always the same columns in the same join, so that Spark deals the texts out
    once."""
    key, tid, listed = (fresh(c, docs.columns) for c in ("_id", "_tid", "_list"))
    # a set: repeated rows send the same
    lists = rows.groupBy(F.col("doc_id").alias(key), F.col("tid").alias(tid)).agg(F.collect_set(F.struct(*field)).alias(listed))
    return docs.join(lists, (F.col("doc_id") == F.col(key)) & (F.xxhash64("text") == F.col(tid)), "left").drop(key)


def window_rows(docs: DataFrame, firsts: DataFrame, width: int = WIDTH) -> DataFrame:
    """(name, window, doc_id, tid, lo, again) of every window under the given
    anchors (doc_id, tid, name, at); again: whether the text has it before."""
    id_at, text_at, tid_at = docs.columns.index("doc_id"), docs.columns.index("text"), len(docs.columns)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in chunks(batch, text_at):
                row, a = _lists(part.column(len(part.columns) - 1))
                w = split_words(part.column(text_at))
                n = a["at"] // 2 % 128
                lo = _places(a["at"] // 256, n)
                row, name = np.repeat(row, n), np.repeat(a["name"], n)
                _inside(w, row, lo + width)
                start = w.first[row] + lo
                window = Sequences(w.other).names(start, start + width).view(np.int64)
                order = np.lexsort((lo, window, name, row))
                new = np.ones(len(order), bool)
                for x in (row, name, window):
                    new[1:] &= x[order][1:] == x[order][:-1]
                again = np.zeros(len(order), bool)
                again[order[1:]] = new[1:]
                spread = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name, pa.int64()), pa.array(window), part.column(id_at).cast(pa.int64()).take(spread),
                     part.column(tid_at).take(spread), pa.array(lo.astype(np.int32)), pa.array(again)],
                    ["name", "window", "doc_id", "tid", "lo", "again"])

    return _listed(docs, firsts, ["name", "at"]).mapInArrow(
        compute, "name long, window long, doc_id long, tid long, lo int, again boolean")


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, tid, lo, n): windows lo .. lo + n - 1 of the text also start
    earlier.  Windows inside a run of one word, but its first, are not listed."""
    rows = anchor_rows(docs, width)
    names = (rows.groupBy("name").agg(F.min("span").alias("s"), F.max("span").alias("t"),
                                      F.min("doc_id").alias("d"), F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("name", (F.col("s") == F.col("t")).alias("single"), "d"))
    # of names with one span, what is earliest already drops out here
    hits = stored(rows.join(names, "name").where("not single or doc_id > d or at % 2 = 1")
                  .select("name", "span", "doc_id", "tid", "at", "single"), "anchors")
    several = hits.where("not single")
    spans = several.groupBy("name", "span").agg(F.min("doc_id").alias("d"))
    several = stored(several.join(spans, ["name", "span"])
                     .select("name", "doc_id", "tid", "at", (F.expr("doc_id > d or at % 2 = 1")).alias("later")), "spans")
    windows = window_rows(docs, several.where("not later"), width)
    firsts = (windows.groupBy("name", "window").agg(F.min("doc_id").alias("d"), F.count(F.lit(1)).alias("c"))
              .where("c > 1").drop("c"))
    again = (windows.join(firsts, ["name", "window"]).where("doc_id > d or again")
             .select("doc_id", "tid", "lo", F.lit(1).alias("n")))
    whole = (hits.where("single").select("doc_id", "tid", "at")
             .unionByName(several.where("later").select("doc_id", "tid", "at")))
    return again.unionByName(whole.selectExpr("doc_id", "tid", "cast(at div 256 as int) lo", "cast(at div 2 % 128 as int) n"))


def dedup_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """docs plus n_words, n_removed and kept_text (kept words joined by one
    space)."""
    names = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed", "kept_text")]
    docs = docs.select(*names)
    both = _listed(docs, repeated_windows(docs, width), ["lo", "n"])
    text_at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in chunks(batch, text_at):
                w = split_words(part.column(text_at))
                row, g = _lists(part.column(len(names) + 1))
                _inside(w, row, g["lo"] + g["n"] - 1 + width)
                lo = w.first[row] + g["lo"]
                edge = np.zeros(len(w.key) + 1, np.int64)
                np.add.at(edge, lo, 1)
                np.add.at(edge, lo + g["n"] - 1 + width, -1)
                run, head = run_windows(w.key, w.text_of, width)
                more = np.flatnonzero(run & ~head)
                np.add.at(edge, more, 1)
                np.add.at(edge, more + width, -1)
                keep = np.cumsum(edge[:-1]) == 0
                kept = np.flatnonzero(keep)
                # the kept words' bytes, each followed by a space but a text's last
                text = w.text_of[kept]
                size = w.end[kept] - w.start[kept]
                last = np.ones(len(kept), bool)
                last[:-1] = text[1:] != text[:-1]
                wide = size + ~last
                body = np.full(int(wide.sum()), 0x20, np.uint8)
                body[_places(np.cumsum(wide) - wide, size)] = w.data[_places(w.start[kept], size)]
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, wide, minlength=part.num_rows).astype(np.int64))])
                out = pa.LargeStringArray.from_buffers(part.num_rows, pa.py_buffer(ends), pa.py_buffer(body))
                left = np.bincount(text, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(names)], pa.array(w.counts.astype(np.int64)),
                     pa.array((w.counts - left).astype(np.int64)), out.cast(pa.string())],
                    [*names, "n_words", "n_removed", "kept_text"])

    return both.mapInArrow(cut, f"{_schema(docs, names)}, n_words long, n_removed long, kept_text string")


def _schema(docs: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's word count, removed words and remaining text's hash."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without repeated 20-word passages; texts
    that lose nothing stay byte for byte."""
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return dedup_substrings(docs).select(*with_text(docs.columns, text, F.col("n_removed") > 0))
