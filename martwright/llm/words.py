r"""Vectorised words of Arrow text batches.

Words are ``[^\x20\x09-\x0D]+``: the separators are single ASCII bytes, so
splitting the UTF-8 bytes gives the same words as splitting the code points.
A batch is cut into chunks of a few MB (:func:`chunks`), which bounds the
memory of the arrays below whatever the batch holds; a text is never cut.

A batch's distinct words are found by their bytes and hashed by 128-bit
XXH3 with a fixed seed, so that keys are equal on every executor and in every
retry and no sum over positions decides which words are equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
CHUNK_BYTES = 1 << 20
_SEED = 0x6D617274


def _odd_constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * U64(2) + U64(1)


_BASE, _GAMMA, _M1, _M2 = (U64(x) for x in (
    0xD1342543DE82EF95, 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x + _GAMMA
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Key of the ordered pair (a, b)."""
    return mix(a * _BASE + (b ^ _GAMMA))


@dataclass
class Words:
    """The words of some texts, in order.

    data: the texts' bytes, one after the other; text_at: where text i begins
    (one more entry at the end); start, end: byte range of each word; first:
    index of text i's first word (one more entry at the end); key, other: two
    independent 64-bit hashes of each word; code: each word's index in
    ``distinct``, whose hashes are ``keys``.
    """

    data: np.ndarray
    text_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    key: np.ndarray
    other: np.ndarray | None = None
    code: np.ndarray | None = None
    distinct: pa.LargeBinaryArray | None = None
    keys: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def take(self, index: np.ndarray) -> pa.Array:
        """The words at these indices as strings."""
        start, n = self.start[index], (self.end - self.start)[index]
        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        body = self.data[np.arange(ends[-1]) + np.repeat(start - ends[:-1], n)]
        return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(body)).cast(pa.string())


def distinct_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple:
    """(code of each word, distinct words, their hashes (n, 2)); the byte
    ranges are in order, not empty and do not overlap."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start] += 1  # (starts are distinct, and so are ends)
    edge[end] -= 1
    body = data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    spelt = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(body)])
    found = spelt.dictionary_encode()
    digests = b"".join([xxhash.xxh3_128_digest(w, _SEED) for w in found.dictionary.to_pylist()])
    return found.indices.to_numpy(), found.dictionary, np.frombuffer(digests, np.uint64).reshape(-1, 2)


def word_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range."""
    code, _, keys = distinct_words(data, start, end)
    return keys[code, 0]


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of a text array (null: no words)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), np.zeros(1, np.int64), z, z, np.zeros(1, np.int64), z.view(np.uint64),
                     z.view(np.uint64), z, pa.array([], pa.large_binary()), np.zeros((0, 2), np.uint64))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = (np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8))
    data = data[offsets[0]:offsets[-1]]
    at = offsets - offsets[0]
    if lower:
        data = LOWER_ASCII[data]
    inside = ~_IS_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    code, distinct, keys = distinct_words(data, start, end)
    return Words(data, at, start, end, np.searchsorted(start, at), keys[code, 0], keys[code, 1], code, distinct, keys)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that no column has."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def chunks(batch: pa.RecordBatch, column: int = 1, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts (the column at this place) take about
    ``limit`` bytes together (at least one row each).

    After the last slice Arrow gives the memory that its pool keeps (over 100 MB in
    a worker that goes from task to task) back to the system."""
    if batch.num_rows == 0:
        return
    texts = batch.column(column).cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    row = 0
    while row < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), batch.num_rows)
        yield batch.slice(row, stop - row)
        row = stop
    pa.default_memory_pool().release_unused()


def same_text(text_of: np.ndarray, n: int) -> np.ndarray:
    """For every n-gram start: whether its n words lie in one text."""
    if len(text_of) < n:
        return np.zeros(0, bool)
    return text_of[: len(text_of) - n + 1] == text_of[n - 1:]


def ngram_keys(key: np.ndarray, n: int) -> np.ndarray:
    """Key of the n words from each position (meaningful where they lie in
    one text): a fold of ordered pair keys."""
    if len(key) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = key[: len(key) - n + 1]
        for k in range(1, n):
            out = combine(out, key[k: len(key) - n + 1 + k])
    return out
