"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms of a text are its words and their shapes (case, length, closing marks),
pairs of neighbouring shapes and repetitions, hashed to ``DIMENSIONS``.  At
most ``MAX_LABELLED`` labelled rows of each class (a documented bound; smallest
hash of doc_id first) give term weights and, by a truncated singular value
decomposition of their weighted counts, the latent space.  Their vectors, a
few hundred kB, are broadcast.  Tasks then project every whole text, take exact
cosine products with all labelled vectors block by block, and let the
``NEIGHBOURS`` nearest vote with their similarity as weight.

Only text enters a score.  Rows whose crc32(doc_id as text) is divisible by 5
are held out: their labels are never read.

Defined results: a null or empty text, or one without a similar neighbour,
scores the share of label 1 among the fitted rows (0.5 without any); labels
that are null or neither 0 nor 1 are ignored, repeated labels count once; a
row without doc_id is not held out and scores by its text; repeated rows get
equal scores; every input row gives one output row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import let_go
from .words import Words, chunks, combine, fresh, mix, split_words

MAX_LABELLED = 2000
NEIGHBOURS = 5
#: Votes weigh by this power of the cosine, so that near neighbours decide.
SHARPNESS = 4
LATENT = 48
THRESHOLD = 0.3
FOLDS = 5
#: Hashed terms: shapes, pairs of shapes, words, repetitions.
FAMILIES = (256, 256, 448, 64)
DIMENSIONS = sum(FAMILIES)

_UPPER, _LOWER, _MARK = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _LOWER[97:123] = True
_MARK[33:128] = True
for _r in (slice(48, 58), slice(65, 91), slice(97, 123)):
    _MARK[_r] = False


def shapes(w: Words) -> np.ndarray:
    """A key of each word's case, length class and closing marks."""
    upper, lower, mark = (np.concatenate([[0], np.cumsum(c[w.data], dtype=np.int32)]) for c in (_UPPER, _LOWER, _MARK))
    count = lambda x: x[w.end] - x[w.start]
    size, ups, lows = w.end - w.start, count(upper), count(lower)
    case = np.where(ups == 0, np.where(lows > 0, 1, 0), np.where(lows == 0, 3, np.where((ups == 1) & _UPPER[w.data[w.start]], 2, 4)))
    last = w.data[w.end - 1]
    closing = np.where(_MARK[last], last, 0).astype(np.int64)
    marks = np.minimum(count(mark), 3)
    length = np.minimum(size // 4, 5)
    return (((case * 6 + length) * 4 + marks) * 128 + closing).astype(np.uint64)


def term_counts(w: Words) -> np.ndarray:
    """Counts of the hashed terms, (texts, DIMENSIONS)."""
    n = len(w.first) - 1
    text = w.text_of
    out = np.zeros((n, DIMENSIONS), np.float32)
    if not len(text):
        return out
    shape = shapes(w)
    same = text[1:] == text[:-1]
    again1 = np.concatenate([[False], same & (w.key[1:] == w.key[:-1])])
    again2 = np.zeros(len(text), bool)
    again2[2:] = (text[2:] == text[:-2]) & (w.key[2:] == w.key[:-2])
    begin = 0
    with np.errstate(over="ignore"):
        pairs = combine(shape[:-1], shape[1:])[same]
        for size, term, who in ((FAMILIES[0], mix(shape), text), (FAMILIES[1], pairs, text[1:][same]),
                                (FAMILIES[2], w.key, text)):
            cell = who * size + (term % np.uint64(size)).astype(np.int64)
            out[:, begin:begin + size] = np.bincount(cell, minlength=n * size).reshape(n, size)
            begin += size
    out[:, begin] = np.bincount(text, again1, minlength=n)
    out[:, begin + 1] = np.bincount(text, again2, minlength=n)
    return out


@dataclass
class Model:
    """Term weights, latent axes, labelled vectors (unit length) and labels."""

    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        x = (weighted(counts) * self.weight) @ self.axes
        size = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, size, out=np.zeros_like(x), where=size > 0)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        near = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        top = np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(near, top, 1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(1)
        vote = (weight * self.labels[top]).sum(1)
        return np.clip(np.where(total > 0, vote / np.maximum(total, 1e-30), self.prior), 0, 1)


def weighted(counts: np.ndarray) -> np.ndarray:
    """Square roots of term shares: long and short texts become comparable."""
    return np.sqrt(counts / np.maximum(counts[:, : FAMILIES[0]].sum(1, keepdims=True), 1))


def fit(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Model of labelled rows' term counts."""
    if not len(labels):
        z = np.zeros((0, LATENT), np.float32)
        return Model(np.ones(DIMENSIONS, np.float32), np.zeros((DIMENSIONS, LATENT), np.float32), z, np.zeros(0), 0.5)
    weight = (1 + np.log((1 + len(counts)) / (1 + (counts > 0).sum(0)))).astype(np.float32)
    x = weighted(counts) * weight
    _, vectors = np.linalg.eigh(x.T.astype(np.float64) @ x)
    model = Model(weight, np.ascontiguousarray(vectors[:, ::-1][:, :LATENT], np.float32), None,
                  labels.astype(np.float64), float(labels.mean()))
    model.vectors = model.latent(counts)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str = "quality", limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, label, text): at most ``limit`` learnable rows per label."""
    rows = (labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .select("doc_id", F.col(target).cast("int").alias("label")).distinct()
            .join(docs.select("doc_id"), "doc_id", "left_semi"))
    some = [rows.where(F.col("label") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit) for x in (0, 1)]
    # at most 2 * limit rows of two numbers
    return docs.select("doc_id", "text").join(F.broadcast(some[0].unionByName(some[1])), "doc_id")


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", limit: int = MAX_LABELLED) -> Model:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in chunks(batch):
                counts = term_counts(split_words(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(2),
                     pa.array([r.astype(np.float32).tobytes() for r in counts], pa.binary())], ["doc_id", "label", "counts"])

    rows = (labelled_sample(docs, labels, target, limit).select("doc_id", "text", "label")
            .mapInArrow(compute, "doc_id long, label int, counts binary").toArrow())
    ids, label = rows.column("doc_id").to_numpy(), rows.column("label").to_numpy()
    counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.float32).reshape(-1, DIMENSIONS)
    order = np.lexsort((label, ids))
    return fit(counts[order], label[order])


def scored(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, target: str = "quality",
           limit: int = MAX_LABELLED) -> DataFrame:
    """The columns ``keep`` (default: all) of docs plus ``score`` and
    ``predicted``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, target, limit))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    # a text that is kept goes to the workers once
    text_at = keep.index("text") if "text" in keep else len(keep)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in chunks(batch, text_at):
                score = model.value.score(term_counts(split_words(part.column(text_at))))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                    [*keep, "score", "predicted"])

    rows = docs.select(*keep, *([] if text_at < len(keep) else [F.col("text").alias(fresh("_text", keep))]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInArrow(compute, schema + ", score double, predicted int")


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Every document's score; learns from the rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(docs, labels, ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(docs, labels).where("predicted = 1").select(*docs.columns)
