"""BPE encoding and decoding over a table of distinct words.

1. Tasks split the texts into words and find each block's distinct words by
   their bytes (a block is a run of texts of about ``BLOCK_BYTES``).
2. Each block's words go to buckets by their hash, packed.  A bucket gathers a
   word's rows from all blocks, encodes each distinct word once (a dictionary
   keyed by the word itself), and sends the ids back, packed by block.  There
   are as many buckets as shuffle partitions, so what one task holds is set by
   that setting.
3. Each block's ids meet its documents, kept as compressed slot numbers in
   word order; every position takes its word's ids.  Decoding joins a block's
   distinct words' ids with the vocabulary's id-to-piece table (49,408 pieces,
   a bound of the vocabulary, sent to every task) and the pieces as the
   vocabulary's missing decoder does, by one space.  Rows of one block
   follow one another in the task, so one block is held at a time.

A word travels once per block, never once per occurrence, so a frequent word
is not hot.  A block's number is a hash of its words in order: if a repeated
scan cut the input differently, step 3 fails rather than mixes blocks.

Defined results: a null or empty text has no ids and decodes to ''; repeated
rows give repeated results; a null doc_id stays null; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import WordTokenizer, vocabulary_json
from .words import Words, chunks, split_words

BLOCK_BYTES = 4 << 20
#: Ids per Arrow batch that a bucket sends back.
BATCH_IDS = 1 << 20
_CODEC = "zstd"
_DOCUMENTS = 2**31 - 1

ENCODED = "doc_id long, n_tokens long, ids binary, decoded string"
IDS = "block long, bucket int, n int, slots binary, total long, counts binary, ids binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Words]]:
    """(doc_ids, words) of runs of consecutive texts."""
    for batch in batches:
        for part in chunks(batch, 1, BLOCK_BYTES):
            yield part.column(0).cast(pa.int64()), split_words(part.column(1))


def _slots(w: Words) -> tuple[int, np.ndarray, np.ndarray]:
    """(block number, slot of every distinct word, distinct word of every
    slot); slots are numbered from the most frequent word on."""
    order = np.argsort(-np.bincount(w.code, minlength=len(w.distinct)), kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    x = xxhash.xxh3_64(w.keys.tobytes())
    x.update(w.code.astype(np.uint32).tobytes())
    return int(np.uint64(x.intdigest()).astype(np.int64)), rank, order


def _pack(values: np.ndarray) -> bytes:
    """Numbers under 2 ** 32, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return pa.compress(planes, _CODEC, asbytes=True)


def _unpack(packed: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(packed, 4 * n, _CODEC, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def block_words(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, n, slots, size, words): a block's distinct words of a
    bucket, slots ascending (kept as differences); words are joined by spaces
    and compressed, ``size`` is their length."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, w in _blocks(batches):
            if not len(w.distinct):
                continue
            number, _, order = _slots(w)
            bucket = (w.keys[order, 1] % np.uint64(buckets)).astype(np.int64)
            slots = np.argsort(bucket, kind="stable")
            words = w.distinct.take(pa.array(order[slots])).to_pylist()
            at = np.searchsorted(bucket[slots], np.arange(buckets + 1))
            rows = []
            for b, (x, y) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                if x < y:
                    body = b" ".join(words[x:y])
                    rows.append((b, number, y - x, _pack(np.diff(slots[x:y], prepend=0)), len(body),
                                 pa.compress(body, _CODEC, asbytes=True)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary()))],
                ["bucket", "block", "n", "slots", "size", "words"])

    return docs.select("doc_id", "text").mapInArrow(
        compute, "bucket int, block long, n int, slots binary, size long, words binary")


def block_documents(docs: DataFrame) -> DataFrame:
    """(block, doc_ids, counts, slots): the documents as packed slot numbers
    in word order."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, w in _blocks(batches):
            number, rank, _ = _slots(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([w.counts.tolist()], pa.list_(pa.int32())), pa.array([_pack(rank[w.code])], pa.binary())],
                ["block", "doc_ids", "counts", "slots"])

    return docs.select("doc_id", "text").mapInArrow(
        compute, "block long, doc_ids array<long>, counts array<int>, slots binary")


def word_ids(words: DataFrame, buckets: int, vocabulary) -> DataFrame:
    """(block, bucket, n, slots, total, counts, ids): the words' ids, each
    distinct word of a bucket encoded once."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          ["block", "bucket", "n", "slots", "total", "counts", "ids"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known, bucket = WordTokenizer.shared(vocabulary.value), {}, None
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("bucket", "block", "n", "slots", "size", "words"))):
                b, block, n, slots, length, words = (x.as_py() for x in row)
                if b != bucket:
                    known, bucket = {}, b
                own = pa.decompress(words, length, _CODEC, asbytes=True).decode().split(" ")
                new = [w for w in own if w not in known]
                known.update(zip(new, (np.array(x, "<u4") for x in tokenizer.encode(new))))
                ids = [known[w] for w in own]
                counts = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.concatenate(ids)
                rows.append((block, b, n, slots, len(flat), _pack(counts), _pack(flat)))
                size += len(flat)
                if size >= BATCH_IDS:
                    yield batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return words.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(encode, IDS)


def _joined(pieces: pa.Array, counts: np.ndarray) -> pa.Array:
    """Each run of ``counts`` pieces, joined by one space."""
    at = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))
    return pc.binary_join(pa.LargeListArray.from_arrays(at, pieces), pa.scalar(" ", pa.large_string()))


class BlockIds:
    """The ids and decoded text of a block's distinct words, by slot."""

    def __init__(self, rows: list[tuple], pieces: pa.Array):
        slot, n, flat = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (
            [np.cumsum(_unpack(r[1], r[0]), dtype=np.int64) for r in rows],
            [_unpack(r[3], r[0]).astype(np.int64) for r in rows], [_unpack(r[4], r[2]) for r in rows]))
        slot, first = np.unique(slot, return_index=True)  # a repeated block sends its words again
        if len(slot) and slot[-1] != len(slot) - 1:
            raise ValueError("a block lacks words: the input gave other rows when it was read again")
        self.begin, self.n, self.flat = (np.cumsum(n) - n)[first], n[first], flat.astype("<u4")
        self.text = _joined(pieces.take(pa.array(self.flat[_places(self.begin, self.n)])), self.n)

    def documents(self, doc_ids: pa.Array, counts: np.ndarray, packed: bytes) -> pa.RecordBatch:
        slots = _unpack(packed, int(counts.sum()))
        if len(slots) and int(slots.max()) >= len(self.n):
            raise ValueError("a block lacks words: the input gave other rows when it was read again")
        n = self.n[slots]
        cut = np.concatenate([[0], np.cumsum(counts)])
        ends = np.concatenate([[0], np.cumsum(n)])[cut]
        own = self.flat[_places(self.begin[slots], n)]
        filled = n > 0
        per_text = np.concatenate([[0], np.cumsum(filled)])[cut]
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [
            None, pa.py_buffer((4 * ends).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(own))])
        decoded = _joined(self.text.take(pa.array(slots[filled])), np.diff(per_text))
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(np.diff(ends), pa.int64()), ids.cast(pa.binary()), decoded.cast(pa.string())],
            ["doc_id", "n_tokens", "ids", "decoded"])


def _places(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], ..., first[0] + n[0] - 1, first[1], ..."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - n), n)


def encode_decode(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the ids as little-endian unsigned
    32-bit integers and the text that they decode to."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(vocabulary_json(vocabulary_path))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = word_ids(block_words(docs, buckets), buckets, vocabulary)
    texts = block_documents(docs).withColumn("bucket", F.lit(_DOCUMENTS))  # after the block's words
    rows = ids.withColumnsRenamed({"counts": "n_ids"}).unionByName(texts, allowMissingColumns=True)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(WordTokenizer.shared(vocabulary.value).pieces, pa.large_string())
        block, held, table = None, [], None
        for batch in batches:
            column = {f: batch.column(f) for f in batch.schema.names}
            for i, number in enumerate(column["block"].to_pylist()):
                if number != block:
                    block, held, table = number, [], None
                if column["bucket"][i].as_py() != _DOCUMENTS:
                    held.append(tuple(column[f][i].as_py() for f in ("n", "slots", "total", "n_ids", "ids")))
                    continue
                table = table or BlockIds(held, pieces)
                yield table.documents(column["doc_ids"][i].values, column["counts"][i].values.to_numpy(),
                                      column["slots"][i].as_py())

    return (rows.repartition("block").sortWithinPartitions("block", "bucket").mapInArrow(join, ENCODED))


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document's token count and the hashes of ids and decoded text."""
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
