"""Exact dedup by a tree-merge of sorted digest runs.

1. Every partition sorts its rows by (digest, length, identifier) and makes a
   run: one entry per text with the identifier to keep, the number of rows and
   the rows' identifiers in lists of at most ``LIST_ROWS``.  The digest is
   SHA-256 of the text; entries are the same text only if digest and length in
   bytes agree, which every merge verifies again.
2. Runs are exchanged in binomial rounds.  A run's slot is its partition's
   number, read as digits of base ``FAN``; in round r digit r is replaced by
   digit r of the entry's digest, so that ``FAN`` slots that differ in it deal
   their entries out among themselves and each slot merges the ``FAN`` sorted
   parts that it gets, keeping the best verified identifier and the sum of the
   counts.  After the last round a slot holds the entries of its digests alone.
3. The merged entries go back to the runs of step 1 and to their rows.

A text in a third of all rows is one entry per run from step 1 on, and a
``FAN``-th of that after every round, so no round and no join has a hot key.

Defined results: a null text counts as empty; of equal texts the row with the
largest (or smallest) doc_id stays, of rows that repeat this doc_id one; rows
without doc_id stay only if no equal text has one, then one of them; an empty
table gives no rows; other columns are not read by ``duplicates`` and all kept
by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import stored
from .words import fresh

FAN = 16
LIST_ROWS = 4096

ENTRY = "digest binary, size long, keep long, part int, piece int, n long"


def _text(docs: DataFrame) -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _new_text(digest: pa.Array, size: np.ndarray) -> np.ndarray:
    """Whether each of the sorted rows is another text than the row before."""
    raw = np.frombuffer(b"".join(digest.to_pylist()), np.uint64).reshape(-1, 4)
    new = np.ones(len(raw), bool)
    new[1:] = (raw[1:] != raw[:-1]).any(1) | (size[1:] != size[:-1])
    return new


def digest_runs(docs: DataFrame, largest: bool = True) -> DataFrame:
    """The partitions' runs: (digest, size, keep, part, piece, n, ids), several
    pieces where a text has more than ``LIST_ROWS`` rows in the partition."""
    best = F.desc_nulls_last("doc_id") if largest else F.asc_nulls_last("doc_id")
    rows = docs.select(_digest(_text(docs)).alias("digest"), F.octet_length(_text(docs)).cast("long").alias("size"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.spark_partition_id().alias("part"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            begin = np.flatnonzero(_new_text(batch.column(0), batch.column(1).to_numpy()))
            # cut at LIST_ROWS (and where a batch ends: merging counts them together)
            n = np.diff(np.append(begin, batch.num_rows))
            cuts = -(-n // LIST_ROWS)
            begin = np.repeat(begin, cuts) + LIST_ROWS * (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts))
            at = pa.array(begin)
            ends = pa.array(np.append(begin, batch.num_rows), pa.int32())
            ids = batch.column(2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), ids.take(at), batch.column(3).take(at),
                 pa.array(piece + np.arange(len(begin)), pa.int32()), pa.array(np.diff(ends.to_numpy()), pa.int64()),
                 pa.ListArray.from_arrays(ends, ids)],
                ["digest", "size", "keep", "part", "piece", "n", "ids"])
            piece += len(begin)

    return rows.sortWithinPartitions("digest", "size", best).mapInArrow(make, ENTRY + ", ids array<long>")


def merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry per (slot, text) of entries sorted by (slot, digest, size,
    best identifier first): the first one, with the sum of the counts."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        slot, size, n = (rows.column(c).to_numpy() for c in ("slot", "size", "n"))
        new = _new_text(rows.column("digest").chunk(0), size)
        new[1:] |= slot[1:] != slot[:-1]
        begin = np.flatnonzero(new)
        merged = rows.take(pa.array(begin))
        merged = merged.set_column(merged.schema.get_field_index("n"), "n", pa.array(np.add.reduceat(n, begin)))
        merged = merged.combine_chunks()
        held = merged.slice(len(begin) - 1).to_batches()[0]  # may go on in the next batch
        if len(begin) > 1:
            yield merged.slice(0, len(begin) - 1).to_batches()[0]
    if held is not None:
        yield held


def tree_merge(runs: DataFrame, parts: int, largest: bool = True, fan: int = FAN) -> DataFrame:
    """(digest, size, keep, part, piece, n) of every text.  parts: the number
    of runs, which sets the number of rounds."""
    best = F.desc_nulls_last("keep") if largest else F.asc_nulls_last("keep")
    entries = runs.select("digest", "size", "keep", "part", "piece", "n", F.col("part").cast("long").alias("slot"))
    step = 1
    while step < parts:
        own, digit = (F.expr(f"{c} div {step} % {fan}") for c in ("slot", "digits"))
        # 60 bits of the digest, read as digits of base fan
        entries = (entries.withColumn("digits", F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long"))
                   .withColumn("slot", F.col("slot") + (digit - own) * step).drop("digits")
                   .repartition("slot").sortWithinPartitions("slot", "digest", "size", best, "part", "piece")
                   .mapInArrow(merge_sorted, ENTRY + ", slot long"))
        step *= fan
    return (entries.sortWithinPartitions("slot", "digest", "size", best, "part", "piece")
            .mapInArrow(merge_sorted, ENTRY + ", slot long").drop("slot"))


def duplicates(docs: DataFrame, largest: bool = True, fan: int = FAN) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row."""
    runs = stored(digest_runs(docs, largest), "digest-runs")
    parts = (runs.agg(F.max("part")).first()[0] or 0) + 1
    merged = tree_merge(runs, parts, largest, fan).select(
        "digest", "size", F.col("keep").alias("keep_id"), F.col("n").alias("group_size"),
        F.col("part").alias("keep_part"), F.col("piece").alias("keep_piece"))
    rows = runs.join(merged, ["digest", "size"]).select(
        "digest", "keep_id", "group_size", (F.expr("part = keep_part and piece = keep_piece")).alias("best"),
        F.posexplode("ids").alias("pos", "doc_id"))
    return rows.select("doc_id", "keep_id", "group_size", (F.col("best") & (F.col("pos") == 0)).alias("kept"), "digest")


def dedup(docs: DataFrame, largest: bool = True) -> DataFrame:
    """The rows that stay, with all their columns."""
    mark, keep = fresh("_digest", docs.columns), fresh("_keep", docs.columns)
    best = duplicates(docs, largest).where("kept").select(F.col("digest").alias(mark), F.col("keep_id").alias(keep))
    rows = docs.withColumn(mark, _digest(_text(docs))).join(best, mark)
    return rows.where(F.col("doc_id").eqNullSafe(F.col(keep))).dropDuplicates([mark]).select(*docs.columns)


def op13_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the one of its equals that stays."""
    return duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def oracle() -> str:
    """The same rows in DuckDB SQL."""
    return """
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from (select doc_id, coalesce(text, '') as t from documents)
"""
