r"""Phrase collocation mining by prefix-free parsing.

Words are counted per language inside pieces (texts split at ``.,;:!?`` and
line ends); n is a language's number of word occurrences, f a phrase's number
of contiguous occurrences, overlaps included.

1. Parsing: a word begins a chunk where a hash of it and the next word is 0
   modulo ``MEAN_WORDS`` (and where a text begins), so that equal text is cut
   at equal places.  A chunk also carries the next ``LONGEST - 1`` words of
   its last piece; every phrase belongs to the one chunk in whose own words it
   begins, so that overlaps are assigned once.  Chunks and their frequencies
   form the dictionary; equal chunks meet in one block and count once, weighted.
2. A block sends the keys of its distinct word pairs with their weighted counts
   to buckets, packed; a bucket adds them up and names the frequent ones to each
   block that holds them.  A bucket holds its share of all keys (8 bytes each):
   ``spark.sql.shuffle.partitions`` times ``BUCKETS`` shares.
3. A phrase of three words or more can only be frequent if all its pairs are:
   the blocks count words, frequent pairs and the phrases made of them, by
   their text, and a grouped sum over all blocks gives exact counts.  (Keys of
   pairs decide what is counted, never a count.)
4. The frequent phrases, each cut at every place, are joined with their parts
   for the scores; those inside an equally frequent longer phrase are dropped.

A passage, chunk or word in a third of all rows merges before every shuffle:
chunks per part of a task, keys and phrases per block.

Defined results: a null or empty text has no words; a null lang is ``und``;
repeated rows count each; rows without doc_id count (doc_id is not read); an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import _pack, _places, _unpack
from .components import stored
from .words import LOWER_ASCII, chunks, combine, distinct_words, mix, split_words

MEAN_WORDS = 32
LONGEST = 5
MIN_COUNT = 100
MIN_SHARE = 100  # per cent of a phrase's occurrences inside a longer one that drop it
TOP = 2000
BLOCK_BYTES = 4 << 20
PART_BYTES = 4 << 20
BUCKETS = 4
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SEPARATOR = _BREAK.copy()
_SEPARATOR[[0x20, 0x09]] = True

CHUNKS = "lang string, chunk string, own int, freq long"


# --- parsing -----------------------------------------------------------------------

def parse(texts: pa.Array, longest: int = LONGEST, mean: int = MEAN_WORDS) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(chunks, number of own words, text of each) of some texts: words in
    lower case, joined by a space inside a piece and a line feed between."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    data = LOWER_ASCII[data[offsets[0]:offsets[-1]]]
    at = offsets - offsets[0]
    inside = ~_SEPARATOR[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    m = len(start)
    if not m:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    text_of = np.searchsorted(at, start, side="right") - 1
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
    new_text = np.ones(m, bool)
    new_text[1:] = text_of[1:] != text_of[:-1]
    new_piece = new_text.copy()
    new_piece[1:] |= breaks[start[1:]] != breaks[end[:-1]]
    begin = np.flatnonzero(new_piece)
    piece_end = np.repeat(np.append(begin[1:], m), np.diff(np.append(begin, m)))
    code, _, keys = distinct_words(data, start, end)
    key = keys[code, 0]
    head = new_text.copy()
    head[:-1] |= combine(key[:-1], key[1:]) % np.uint64(mean) == 0
    lo = np.flatnonzero(head)
    hi = np.append(lo[1:], m)
    same = np.append(~new_text[1:], False)[hi - 1]  # the text goes on
    over = np.where(same, np.minimum(piece_end[hi - 1] - hi, longest - 1), 0)
    n = hi - lo + over
    words = _places(lo, n)
    last = np.zeros(len(words), bool)
    last[np.cumsum(n) - 1] = True
    size = (end - start)[words]
    wide = size + ~last
    out = np.full(int(wide.sum()), 0x20, np.uint8)
    where = np.cumsum(wide) - wide
    out[_places(where, size)] = data[_places(start[words], size)]
    ends_piece = ~last & (piece_end[words] == words + 1)
    out[(where + size)[ends_piece]] = 0x0A
    bounds = np.concatenate([[0], np.cumsum(wide)[np.cumsum(n) - 1]]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(lo), pa.py_buffer(bounds), pa.py_buffer(out)), hi - lo, text_of[lo]


def parsed_chunks(docs: DataFrame, longest: int = LONGEST, mean: int = MEAN_WORDS) -> DataFrame:
    """(lang, chunk, own, freq), merged per part of a task."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1, PART_BYTES):
                chunk, own, text = parse(part.column(1), longest, mean)
                rows = pa.table([part.column(0).cast(pa.string()).take(pa.array(text)), chunk, pa.array(own, pa.int32())],
                                names=["lang", "chunk", "own"])
                rows = rows.group_by(["lang", "chunk", "own"]).aggregate([([], "count_all")])
                yield from rows.rename_columns(["lang", "chunk", "own", "freq"]).cast(
                    pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("own", pa.int32()), ("freq", pa.int64())])
                ).to_batches(max_chunksize=50_000)

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(compute, CHUNKS)


# --- one block of the dictionary ---------------------------------------------------

class Block:
    """The words of a block's distinct chunks.

    own: whether a phrase that begins at a word counts here; reach: how many
    words its piece goes on for; pair: key of each word with the next one."""

    def __init__(self, rows: pa.Table):
        rows = rows.select(["lang", "chunk", "own", "freq"]).group_by(["lang", "chunk", "own"]).aggregate([("freq", "sum")])
        self.words = w = split_words(rows.column("chunk").combine_chunks())
        lang = rows.column("lang").combine_chunks().dictionary_encode()
        self.langs = lang.dictionary
        chunk = w.text_of
        self.lang = lang.indices.to_numpy()[chunk]
        self.freq = rows.column("freq_sum").to_numpy()[chunk]
        m = len(w.key)
        self.own = np.arange(m) - w.first[chunk] < rows.column("own").to_numpy()[chunk]
        self.goes_on = np.zeros(m, bool)
        if m > 1:
            self.goes_on[:-1] = (chunk[1:] == chunk[:-1]) & (w.data[w.end[:-1]] == 0x20)
        seeds = np.array([xxhash.xxh3_64_intdigest(x) for x in self.langs.to_pylist()], np.uint64)
        self.pair = np.zeros(m, np.uint64)
        if m > 1:
            self.pair[:-1] = combine(combine(seeds[self.lang[:-1]], w.key[:-1]), w.key[1:])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct keys, weighted counts) of all pairs, 0 of those that other
        chunks own."""
        at = np.flatnonzero(self.goes_on)
        order = at[np.argsort(self.pair[at], kind="stable")]
        key, n = self.pair[order], np.where(self.own[order], self.freq[order], 0)
        if not len(key):
            return key, n
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return key[begin], np.add.reduceat(n, begin)

    def phrases(self, frequent: np.ndarray, longest: int) -> Iterator[pa.Table]:
        """(lang, phrase, n): words, frequent pairs and what they make up, and
        per language an empty phrase with the number of words."""
        at = np.searchsorted(frequent, self.pair)
        linked = self.goes_on & (at < len(frequent))
        linked[linked] = frequent[at[linked]] == self.pair[linked]
        here = np.flatnonzero(self.own)
        total = np.bincount(self.lang[here], self.freq[here], minlength=len(self.langs)).astype(np.int64)
        yield pa.table([self.langs, pa.array([""] * len(self.langs), pa.string()), pa.array(total)], names=["lang", "phrase", "n"])
        w = self.words
        for n in range(1, longest + 1):
            lo, hi = w.start[here], w.end[here + n - 1]
            ends = np.concatenate([[0], np.cumsum(hi - lo)]).astype(np.int64)
            spelt = pa.LargeStringArray.from_buffers(len(here), pa.py_buffer(ends), pa.py_buffer(w.data[_places(lo, hi - lo)]))
            rows = pa.table([pa.array(self.lang[here]), spelt, pa.array(self.freq[here])], names=["lang", "phrase", "n"])
            rows = rows.group_by(["lang", "phrase"]).aggregate([("n", "sum")])
            yield pa.table([self.langs.take(rows.column("lang").combine_chunks()), rows.column("phrase").cast(pa.string()),
                            rows.column("n_sum")], names=["lang", "phrase", "n"])
            here = here[here + n < len(linked)]
            here = here[linked[here + n - 1]]


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, mean: int = MEAN_WORDS,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, phrase, f): all phrases of up to ``longest`` words with at least
    ``min_count`` occurrences, and per language an empty phrase with n."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dictionary = parsed_chunks(docs, longest, mean).withColumn(
        "block", F.pmod(F.xxhash64("lang", "chunk"), F.lit(blocks)))

    def send(key: tuple, rows: pa.Table) -> pa.Table:
        keys, n = Block(rows).pairs()
        bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        at = np.searchsorted(bucket[order], np.arange(buckets + 1))
        keys, n = keys[order], np.minimum(n[order], min_count)  # (more than min_count is frequent at once)
        out = [(b, key[0].as_py(), keys[x:y].tobytes(), _pack(n[x:y]))
               for b, (x, y) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())) if x < y]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                        names=["bucket", "block", "keys", "counts"])

    def reply(rows: pa.Table) -> pa.Table:
        held = [np.frombuffer(k, np.uint64) for k in rows.column("keys").to_pylist()]
        n = np.concatenate([_unpack(c, len(k)) for c, k in zip(rows.column("counts").to_pylist(), held)]).astype(np.int64)
        key, inverse = np.unique(np.concatenate(held), return_inverse=True)
        hit = (np.bincount(inverse, n, minlength=len(key)) >= min_count)[inverse]
        cut = np.cumsum([0, *map(len, held)])
        out = [(b, k[h].tobytes()) for b, k, h in
               zip(rows.column("block").to_pylist(), held, (hit[x:y] for x, y in zip(cut[:-1], cut[1:]))) if h.any()]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.binary()))], names=["block", "keys"])

    def count(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table([[], [], []], schema=pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())]))
        frequent = np.sort(np.frombuffer(b"".join(replies.column("keys").to_pylist()), np.uint64))
        return pa.concat_tables(list(Block(rows).phrases(frequent, longest)))

    sent = dictionary.groupBy("block").applyInArrow(send, "bucket int, block long, keys binary, counts binary")
    replies = sent.groupBy("bucket").applyInArrow(reply, "block long, keys binary")
    counted = (dictionary.groupBy("block").cogroup(replies.groupBy("block"))
               .applyInArrow(count, "lang string, phrase string, n long"))
    return (counted.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
            .where((F.col("f") >= min_count) | (F.col("phrase") == "")))


# --- scores ---------------------------------------------------------------------------

def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, longest: int = LONGEST,
                 mean: int = MEAN_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top``."""
    found = stored(frequent_phrases(docs, min_count, longest, mean, block_bytes), "phrases")
    totals = found.where("phrase = ''").select("lang", F.col("f").alias("n"))
    phrases = found.where("phrase <> ''")
    candidates = phrases.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)

    # inside a longer candidate that is as frequent: one of those a word longer, then, is
    longer = (candidates.where(F.size("w") > 2)
              .select("lang", "f", F.explode(F.array(F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"))).alias("p"))
              .groupBy("lang", F.array_join("p", " ").alias("phrase")).agg(F.max("f").alias("within")))
    kept = (candidates.join(longer, ["lang", "phrase"], "left")
            .where(F.coalesce(100 * F.col("within") < MIN_SHARE * F.col("f"), F.lit(True))))

    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("first"),
                       F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("rest"))
    part = lambda column, f: phrases.select("lang", F.col("phrase").alias(column), F.col("f").alias(f))
    scored = (cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
              .withColumn("score", F.expr("""(cast(1000 as decimal(4, 0)) * cast(a as decimal(16, 0)) * cast(n as decimal(16, 0)))
                  div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))""")))
    lowest = (scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (lowest.withColumn("rank", F.row_number().over(ranked).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    """The same rows in DuckDB SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
with p as (
  select lang, row_number() over () as pid, piece
  from (select coalesce(lang, 'und') as lang,
          unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents)),
w as (select lang, pid, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from p),
t as (select lang, sum(len(w))::bigint as n from w group by lang),
g as (
  select lang, k as words, array_to_string(w[i:i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (select unnest(range(1, {LONGEST + 1})) as k) where len(w) >= k)),
f as materialized (select lang, words, phrase, count(*) as f from g group by all having count(*) >= {MIN_COUNT}),
c as (select lang, phrase, f as a, words, string_split(phrase, ' ') as w from f where words > 1),
inside as (
  select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, max(a) as within
  from (select lang, w, a, k, unnest(range(1, words - k + 2)) as i from c, (select unnest(range(2, {LONGEST})) as k) where words > k)
  group by all),
cuts as (
  select c.lang, c.phrase, a, k, array_to_string(w[:k], ' ') as x, array_to_string(w[k + 1:], ' ') as y
  from c left join inside using (lang, phrase), (select unnest(range(1, {LONGEST})) as k)
  where k < words and (within is null or 100 * within < {MIN_SHARE} * a)),
s as (
  select cuts.lang, cuts.phrase, a, k, x.f as l, y.f as r, n,
    ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score
  from cuts join f x on x.lang = cuts.lang and x.phrase = cuts.x join f y on y.lang = cuts.lang and y.phrase = cuts.y
  join t on t.lang = cuts.lang),
b as (select *, row_number() over (partition by lang, phrase order by score, k) as best from s),
r as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b where best = 1)
select lang, rank, phrase, a, l, r, n, score from r where rank <= {TOP}
"""
