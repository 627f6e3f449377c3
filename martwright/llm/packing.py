"""Best-fit packing: all documents into few sequences of a fixed length.

Tasks tokenize the documents and cut only those over the capacity; the pieces
(a few dozen bytes each) go to a table in the shared folder.  Their total
and number set the number of groups, each of about ``GROUP_BINS`` sequences or
``GROUP_PIECES`` pieces, whichever is less; pieces are dealt out by their place
in the table, whatever their source, key or length, so that rows of one key (or
none) spread as well.  A group is packed in one task by best-two-fit: fill
a sequence greedily with the largest pieces that fit, then replace its
smallest piece by the two unpacked pieces that fill the enlarged gap most
tightly.  At most one sequence per group stays half empty.

Defined results: a null or empty text is one piece that holds the end token
only; every input row is packed, repeated rows each on their own; ties are
broken by (doc_id, piece); an empty table gives no rows; other columns of the
input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .tokens import Encoder, vocabulary_json
from .words import chunks, split_words

CAPACITY = 4096
END_ID = 1
GROUP_BINS = 4000
GROUP_PIECES = 500_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def cut_pieces(docs: DataFrame, vocabulary_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(vocabulary_json(vocabulary_path))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(vocabulary.value)
        for batch in batches:
            for part in chunks(batch):
                ids, at = encoder.encode(split_words(part.column(1)))
                rows = []
                for doc_id, a, b in zip(part.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    own = np.append(ids[a:b], np.uint32(END_ID)).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        x = own[s:s + capacity]
                        rows.append((doc_id, k, s, len(x), zlib.crc32(x.tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of lengths (each at most ``capacity``), as lists of lengths."""
    left = np.bincount(lengths, minlength=capacity + 1)
    bins = []
    # fits[g]: the largest length <= g that is still there (0: none)
    fits = np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0))

    def take(x: int):
        left[x] -= 1
        if not left[x]:
            below = fits[x - 1]
            stop = x + 1 + int(np.argmax(left[x + 1:] > 0)) if left[x + 1:].any() else capacity + 1
            fits[x:stop] = below

    while fits[capacity]:
        own, gap = [], capacity
        while gap and fits[gap]:
            x = int(fits[gap])
            take(x)
            own.append(x)
            gap -= x
        if gap and len(own) > 1:
            small = own[-1]
            room = gap + small
            one = np.flatnonzero(left[1:room] > 0) + 1
            two = fits[room - one]
            two = np.where((two == one) & (left[one] < 2), fits[np.maximum(one - 1, 0)], two)
            both = np.where(two > 0, one + two, 0)
            best = int(both.argmax()) if len(both) else -1
            if best >= 0 and both[best] > small:
                a, b = int(one[best]), int(two[best])
                own[-1:] = [a, b]
                take(a)
                take(b)
                left[small] += 1
                if left[small] == 1:
                    fits[small:] = np.maximum(fits[small:], small)
        bins.append(own)
    return bins


def pack_group(pieces: pa.Table, capacity: int = CAPACITY) -> pa.Table:
    """pieces of one group with sequence number (from 0) and offset."""
    p = pieces.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "start", "ids_crc32")])
    lengths = p.column("length").to_numpy()
    following = np.searchsorted(lengths, np.arange(capacity + 1)).tolist()
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, own in enumerate(best_two_fit(lengths, capacity)):
        at = 0
        for x in own:
            row = following[x]
            following[x] += 1
            sequence[row], offset[row] = k, at
            at += x
    return p.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))


def pack(docs: DataFrame, vocabulary_path: str | None = None, capacity: int = CAPACITY,
         group_bins: int = GROUP_BINS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """All pieces with their sequence and place in it."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    cut_pieces(docs, vocabulary_path, capacity).write.parquet(path)
    pieces = spark.read.parquet(path)
    total, rows = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    groups = max(1, total // (capacity * group_bins), -(-rows // group_pieces))

    def pack_one(key: tuple, rows: pa.Table) -> pa.Table:
        out = pack_group(rows.drop_columns(["grp"]), capacity)
        first = pa.scalar(key[0].as_py() << 32, pa.int64())
        return out.set_column(out.schema.get_field_index("sequence_id"), "sequence_id",
                              pc.add(out.column("sequence_id"), first))

    group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    return pieces.withColumn("grp", group).groupBy("grp").applyInArrow(pack_one, PACKED)


def op7_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents as packed pieces."""
    return pack(docs)
