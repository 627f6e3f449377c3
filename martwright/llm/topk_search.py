"""Exact top-k inner products by MaxScore over shards.

Vectors become integers, floor(256 * x) per component; a component is a term
with a posting (row of the transposed shard matrix).  Candidates are dealt into
shards and queries into blocks of bounded size; each (shard, block) pair is one
task.  Within it, per query:

1. each term's contribution is bounded by its query weight and the shard's
   smallest and largest component; contributions are shifted by their lower
   bound, so that all are positive as MaxScore needs;
2. the k-th best of a few probed rows is the first threshold;
3. terms are taken from the widest bound down until the others (the
   non-essential ones) cannot reach the threshold by themselves; the essential
   postings are traversed for all rows;
4. the others are probed only for rows still competitive, a few terms at a
   time, raising the threshold as rows become complete.

Each pair returns k rows per query; a last window ranks them.  Both sides are
split by size, nothing is broadcast, and every query meets every shard.

Defined results: vectors that are null or hold null or non-finite components,
and rows without vec_id, take no part; a shorter vector counts 0 for the
components it lacks; all rows of the query's vec_id are its own; rows that
repeat another vec_id are candidates each, and rows that repeat a query rank
their candidates together, as in the SQL; ties go to the smaller vec_id; with
fewer than k candidates all are returned; no query rows give no rows.  Scores
are exact while sums of products stay under 2 ** 53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import stored

SCALE = 256
TOP = 5
QUERY_EVERY = 50
SHARD_ROWS = 16_384
QUERY_ROWS = 1_024
PROBED = 64
STEP = 8


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, q): components as little-endian 64-bit integers."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            n = np.asarray(column.value_lengths().fill_null(0))
            flat = column.flatten()
            x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: not a number
            at = np.concatenate([[0], np.cumsum(n)])
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            ok = np.asarray(column.is_valid()) & np.asarray(ids.is_valid()) & (bad[at[1:]] == bad[at[:-1]])
            q = np.floor(SCALE * np.where(np.isfinite(x), x, 0)).astype("<i8")
            rows = np.flatnonzero(ok)
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()).take(pa.array(rows)),
                 pa.array([q[at[r]:at[r + 1]].tobytes() for r in rows.tolist()], pa.binary())], ["vec_id", "q"])

    return vectors.select("vec_id", "embedding").mapInArrow(compute, "vec_id long, q binary")


def matrix(ids: np.ndarray, rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) in order of id."""
    order = sorted(range(len(rows)), key=lambda i: (ids[i], rows[i]))
    out = np.zeros((len(order), width))
    for r, i in enumerate(order):
        x = np.frombuffer(rows[i], "<i8")
        out[r, :len(x)] = x
    return ids[order], out


def max_score(query: np.ndarray, postings: np.ndarray, low: np.ndarray, high: np.ndarray, own: slice, k: int) -> tuple:
    """(rows, scores) of at least the k best rows, all ties included.

    postings: (terms, rows); low, high: a term's smallest and largest
    component; own: the query's own rows."""
    n = postings.shape[1]
    a, b = query * low, query * high
    least, most = np.minimum(a, b), np.maximum(a, b)
    order = np.argsort(least - most, kind="stable")
    order = order[query[order] != 0]
    left = np.concatenate([np.cumsum(most[order][::-1])[::-1], [0.0]])  # bound of the terms from each place on
    probe = np.unique(np.linspace(0, n - 1, min(n, PROBED)).astype(np.int64))
    probe = probe[(probe < own.start) | (probe >= own.stop)]
    score = query @ postings[:, probe]
    threshold = np.partition(score, len(score) - k)[len(score) - k] if len(score) >= k else -np.inf
    # essential: until a row at its lower bounds could no longer compete
    floor = np.concatenate([[0.0], np.cumsum(least[order])]) + left
    essential = int(np.argmax(floor < threshold)) if (floor < threshold).any() else len(order)
    essential = max(essential, min(STEP, len(order)))
    partial = query[order[:essential]] @ postings[order[:essential]]
    partial[own] = -np.inf
    rows = np.flatnonzero(partial + left[essential] >= threshold)
    partial, at = partial[rows], essential
    while at < len(order) and len(rows) > k:
        terms = order[at:at + STEP]
        partial = partial + query[terms] @ postings[terms[:, None], rows]
        at = min(at + STEP, len(order))
        best = np.partition(partial, len(rows) - k)[len(rows) - k] + least[order[at:]].sum()
        threshold = max(threshold, best)
        alive = partial + left[at] >= threshold
        rows, partial = rows[alive], partial[alive]
    if at < len(order):
        terms = order[at:]
        partial = partial + query[terms] @ postings[terms[:, None], rows]
    kept = np.isfinite(partial)
    return rows[kept], partial[kept]


def top_products(vectors: DataFrame, queries: DataFrame, k: int = TOP, shard_rows: int = SHARD_ROWS,
                 query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every
    query; both inputs are (vec_id, q)."""
    n, m = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // query_rows))
    # by row, whatever vec_id repeats
    deal = lambda count: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    c = vectors.withColumn("shard", deal(shards)).select("vec_id", "q", "shard", every(blocks).alias("block"))
    q = queries.withColumn("block", deal(blocks)).select("vec_id", "q", "block", every(shards).alias("shard"))

    def search(candidates: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if candidates.num_rows and wanted.num_rows:
            sides = [(t.column("vec_id").to_numpy(), t.column("q").to_pylist()) for t in (candidates, wanted)]
            width = max(len(r) for _, rows in sides for r in rows) // 8
            (ids, x), (query_ids, y) = (matrix(i, r, width) for i, r in sides)
            low, high, postings = x.min(0), x.max(0), np.ascontiguousarray(x.T)
            own = [np.searchsorted(ids, query_ids, side).tolist() for side in ("left", "right")]
            for query_id, query, a, b in zip(query_ids.tolist(), y, *own):
                rows, score = max_score(query, postings, low, high, slice(a, b), k)
                best = np.lexsort((ids[rows], -score))[:k]
                out += [(query_id, int(ids[rows[b]]), int(score[b])) for b in best]
        return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(3)],
                        names=["query_id", "vec_id", "score"])

    found = (c.groupBy("shard", "block").cogroup(q.groupBy("shard", "block"))
             .applyInArrow(search, "query_id long, vec_id long, score long"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The 5 best candidates of every row whose vec_id is divisible by 50."""
    vectors = stored(quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "vectors")
    return top_products(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


def oracle() -> str:
    """The same rows in DuckDB SQL."""
    return f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id,
    list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % {QUERY_EVERY} = 0),
r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= {TOP}
"""
