r"""Ranked lexical search by Block-Max MaxScore over document shards.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters,
A-Z lower-cased.  A term's weight in the corpus is w = floor(1000 ln((2N+2) /
(2df+1))), a document's length factor m = 25 + 75 n N div L, and a term that
occurs tf times adds w ((1e9 tf) div (1000 tf + 8 m)) to its score; all but w
is integer arithmetic.

1. Tasks cut their documents into shards and write, per shard and query term,
   a posting list of compressed blocks of ``BLOCK`` postings, with each
   block's last document, largest tf and smallest n; and per shard its
   documents' lengths.  Sums over the lists give N, L and every df.
2. A shard's lists come together in one task and each query runs on it.
   The largest tf and smallest n bound what a block, and so a list, can add.
   Lists from the widest bound down are essential until the others
   cannot reach the threshold (the k-th best score so far) by themselves.
   Essential lists are traversed; on the others, documents that their
   score and the maxima of their blocks leave below the threshold are rejected
   before any block is decompressed.
3. A shard returns its k best per query; a window merges these heaps.

Queries are taken in blocks of ``QUERY_BYTES`` of text, which bounds what is
broadcast and collected; every block meets every document.  Nothing else
leaves the executors but N and L.

Defined results: a null or empty text has no terms (documents without a term
do not count in N); an item without terms has no rows; rows that repeat a
doc_id or an item_id are documents and items of their own; rows without doc_id
count and come last among ties; fewer than k scores above 0 are all
returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import stored
from .minhash_dedup import blocks_of, bounds_of
from .words import LOWER_ASCII, chunks

TOP = 10
BLOCK = 128
#: Text of a shard, and of the queries that run at a time.
SHARD_BYTES = 16 << 20
QUERY_BYTES = 16 << 20
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_WIDTHS = (np.uint8, np.uint16, np.uint32)

#: term -1: the shard itself; payload: its documents' ids, meta: their lengths.
INDEX = "shard long, term int, n long, total long, meta binary, payload binary, ids array<long>"


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all terms of the texts in order, where each text's begin, one more)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    data = data[offsets[0]:offsets[-1]]
    at = offsets - offsets[0]
    inside = _IN_TERM[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(LOWER_ASCII[data[inside]]))
    return terms, np.searchsorted(start, at)


# --- posting lists ----------------------------------------------------------------

def _narrow(x: np.ndarray) -> tuple[int, bytes]:
    """(width, bytes) of numbers under 2 ** 32 in the narrowest of one, two or
    four bytes."""
    top = int(x.max())
    k = 0 if top < 1 << 8 else 1 if top < 1 << 16 else 2
    return k, x.astype(_WIDTHS[k]).tobytes()


def pack_list(docs: np.ndarray, tf: np.ndarray, length: np.ndarray) -> tuple[bytes, bytes]:
    """(meta, payload) of one posting list.  meta holds per block: first and
    last document, largest tf, smallest length, where its bytes begin, and the
    widths of its gaps and frequencies."""
    meta, body, at = [], [], 0
    for a in range(0, len(docs), BLOCK):
        d, f = docs[a:a + BLOCK], tf[a:a + BLOCK]
        (wg, gaps), (wf, freqs) = _narrow(np.diff(d, prepend=d[0])), _narrow(f)
        meta.append((d[0], d[-1], f.max(), length[d].min(), at, wg * 4 + wf, len(d)))
        body += [gaps, freqs]
        at += len(gaps) + len(freqs)
    return np.array(meta, "<u4").tobytes(), b"".join(body)


class PostingList:
    """A packed list; blocks are unpacked when they are asked for."""

    def __init__(self, meta: bytes, payload: bytes):
        self.first, self.last, self.most, self.shortest, self.at, self.widths, self.n = (
            np.frombuffer(meta, "<u4").reshape(-1, 7).astype(np.int64).T)
        self.payload = payload
        self.unpacked: dict[int, tuple] = {}
        self.bound = np.zeros(0, np.int64)

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, frequencies) of one block."""
        if b not in self.unpacked:
            n, at = int(self.n[b]), int(self.at[b])
            wg, wf = (_WIDTHS[int(x)] for x in divmod(int(self.widths[b]), 4))
            gaps = np.frombuffer(self.payload, wg, n, at)
            tf = np.frombuffer(self.payload, wf, n, at + gaps.nbytes)
            self.unpacked[b] = self.first[b] + np.cumsum(gaps, dtype=np.int64), tf.astype(np.int64)
        return self.unpacked[b]

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(b) for b in range(len(self.n))]
        return tuple(np.concatenate(x) for x in zip(*parts)) if len(parts) > 1 else parts[0]


def index_rows(docs: DataFrame, terms) -> DataFrame:
    """The shards' posting lists (INDEX) of the terms (a broadcast list)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        wanted = pa.array(terms.value, pa.large_string())
        for batch in batches:
            for part in chunks(batch, 1, SHARD_BYTES):
                spelt, begin = split_terms(part.column(1))
                length = np.diff(begin)
                found = spelt.dictionary_encode()
                number = pc.index_in(found.dictionary, wanted).fill_null(-1).to_numpy()[found.indices.to_numpy()]
                hit = np.flatnonzero(number >= 0)
                doc = np.repeat(np.arange(part.num_rows), length)[hit]
                pair, tf = np.unique(number[hit].astype(np.int64) << 32 | doc, return_counts=True)
                term, doc = pair >> 32, pair & 0xFFFFFFFF
                rows = [(shard, -1, int((length > 0).sum()), int(length.sum()), length.astype("<u4").tobytes(), None,
                         part.column(0).cast(pa.int64()).to_pylist())]
                at = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
                for a, b in zip(at.tolist(), [*at[1:].tolist(), len(term)]):
                    rows.append((shard, int(term[a]), b - a, 0, *pack_list(doc[a:b], tf[a:b], length), None))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
                for x in range(0, len(rows), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[x:x + 20_000]), types)],
                                                     ["shard", "term", "n", "total", "meta", "payload", "ids"])
                shard += 1

    return docs.select("doc_id", "text").mapInArrow(build, INDEX)


# --- one shard ----------------------------------------------------------------------

def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence adds per unit of weight; rises with tf, falls with m."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def block_max_max_score(lists: list[tuple[int, PostingList]], m: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores): at least the k best documents of one shard with
    score above 0, all ties included.  lists: (weight, list) of the query's
    terms; m: length factor of every document."""
    lists = sorted(lists, key=lambda x: -x[0] * int(x[1].bound.max()))
    most = np.array([w * int(p.bound.max()) for w, p in lists], np.int64)
    rest = np.concatenate([np.cumsum(most[::-1])[::-1], [0]])  # bound of the lists from each place on
    score = np.zeros(len(m), np.int64)
    threshold, at = 0, 0

    def kth(x: np.ndarray) -> int:
        return max(threshold, int(np.partition(x, len(x) - k)[len(x) - k])) if len(x) > k else threshold

    while at < len(lists) and (at == 0 or rest[at] >= threshold):  # essential
        w, p = lists[at]
        docs, tf = p.whole()
        score[docs] += w * gain(tf, m[docs])
        at += 1
        threshold = kth(score)
    docs = np.flatnonzero(score + rest[at] >= max(threshold, 1))
    docs = docs[score[docs] > 0] if rest[at] < max(threshold, 1) else docs
    own = score[docs]
    while at < len(lists) and len(docs):
        w, p = lists[at]
        at += 1
        b = np.searchsorted(p.last, docs)
        inside = b < len(p.last)
        inside[inside] = docs[inside] >= p.first[b[inside]]
        # what the list can add at most to each: its block's maximum, or nothing
        most_here = np.where(inside, w * p.bound[np.minimum(b, len(p.last) - 1)], 0)
        alive = own + most_here + rest[at] >= threshold
        docs, own, b, inside = docs[alive], own[alive], b[alive], inside[alive]
        for block in np.unique(b[inside]).tolist():
            held, tf = p.block(block)
            x = np.flatnonzero(inside & (b == block))
            y = np.minimum(np.searchsorted(held, docs[x]), len(held) - 1)
            x, y = x[held[y] == docs[x]], y[held[y] == docs[x]]
            own[x] += w * gain(tf[y], m[docs[x]])
        threshold = kth(own)
        alive = own + rest[at] >= threshold
        docs, own = docs[alive], own[alive]
    found = own > 0
    return docs[found], own[found]


def search_shard(rows: pa.Table, queries: list[list[tuple[int, int, int]]], n_docs: int, n_terms: int, k: int) -> list[tuple]:
    """(query, doc_id, score) of the k best documents of one shard per query.
    queries: (term, weight) lists; rows: the shard's index rows."""
    lists: dict[int, PostingList] = {}
    ids, lengths = None, None
    for term, meta, payload, own in zip(*(rows.column(c).to_pylist() for c in ("term", "meta", "payload", "ids"))):
        if term < 0:
            ids, lengths = own, np.frombuffer(meta, "<u4").astype(np.int64)
        else:
            lists[term] = PostingList(meta, payload)
    factor = lambda n: 25 + 75 * n * n_docs // n_terms
    m = factor(lengths)
    for p in lists.values():
        p.bound = gain(p.most, factor(p.shortest))
    order = np.array([2**63 - 1 if i is None else i for i in ids])
    out = []
    for q, terms in enumerate(queries):
        own = [(w, lists[t]) for t, w in terms if w > 0 and t in lists]
        if not own:
            continue
        docs, score = block_max_max_score(own, m, k)
        best = np.lexsort((order[docs], -score))[:k]
        out += [(q, ids[int(docs[x])], int(score[x])) for x in best]
    return out


# --- all shards -----------------------------------------------------------------------

def search_block(docs: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """(item_id, rank, doc_id, score) for some queries, (item_id, text) each."""
    spark = docs.sparkSession
    spelt, begin = split_terms(pa.array([t for _, t in items], pa.string()))
    spelt = spelt.to_pylist()
    per_item = [Counter(spelt[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
    terms = sorted({t for c in per_item for t in c})
    number = {t: i for i, t in enumerate(terms)}
    index = stored(index_rows(docs, spark.sparkContext.broadcast(terms)), "lexical-index")
    corpus = index.where("term = -1").agg(F.sum("n"), F.sum("total")).first()
    n_docs, n_terms = corpus[0] or 0, corpus[1] or 0
    df = dict(index.where("term >= 0").groupBy("term").agg(F.sum("n")).collect())  # one row per query term
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in df}
    queries = spark.sparkContext.broadcast(
        [[(number[t], c * weight[number[t]]) for t, c in own.items() if number[t] in weight] for own in per_item])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks_of(batches, ["shard"]):
            for a, b in bounds_of(rows, ["shard"]):
                found = search_shard(rows.slice(a, b - a), queries.value, n_docs, n_terms, k)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*found), (pa.int32(), pa.int64(), pa.int64()))], ["query", "doc_id", "score"])

    heaps = (index.repartition("shard").sortWithinPartitions("shard")
             .mapInArrow(search, "query int, doc_id long, score long"))
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(items)], "query int, item_id long")
    return (heaps.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).join(names, "query")
            .select("item_id", "rank", "doc_id", "score"))


def lexical_search(docs: DataFrame, items: DataFrame, k: int = TOP, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item;
    items: (item_id, text)."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // query_bytes + 1
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = [tuple(r) for r in own.collect()]  # about query_bytes of text
        if rows:
            out = out.unionByName(search_block(docs, rows, k))
    return out


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return lexical_search(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def oracle() -> str:
    """The same rows in DuckDB SQL."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
with d as (
  select row_number() over () as rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{pattern}') as terms from documents),
b as (
  select row_number() over () as qid, item_id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{pattern}')) as term from benchmark),
c as (select count(*) as n_docs, sum(len(terms))::bigint as n_terms from d where len(terms) > 0),
p as (
  select rid, doc_id, n, term, count(*) as tf from (select rid, doc_id, len(terms) as n, unnest(terms) as term from d)
  where term in (select term from b) group by all),
w as (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint as w from p, c group by term),
s as (
  select qid, item_id, rid, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::bigint as score
  from b join p using (term) join w using (term), c group by all),
r as (
  select *, row_number() over (partition by qid order by score desc, doc_id nulls last)::int as rank from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= {TOP}
"""
