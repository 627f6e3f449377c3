"""Token ids of Arrow text batches, each distinct word encoded once per worker.

The vocabulary's rules never look across ASCII white space, so a text's ids
are the ids of its words one after the other (tested against the library on
whole texts).  A worker keeps the ids of the words it has met in a table of
bounded size and looks up a batch's distinct words there.
"""

from __future__ import annotations

import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from .words import Words, mix

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCABULARY = "word_bpe_49k.json"
MAX_KNOWN = 2_000_000
#: Parts of words that one worker keeps besides.
MAX_PARTS = 100_000

#: Words of these characters only: the vocabulary's normalizer just lowers
#: their case, and its pattern splits them as _PARTS does.  "<|" may begin a
#: special token.
_PLAIN = re.compile(r"(?!.*<\|)[!-~À-ÿ]+", re.S)
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: What the rule applies to: the pattern and steps of the vocabulary file.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def vocabulary_json(path: str | None = None) -> str:
    """Content of the vocabulary file (1.7 MB), to be sent to the executors."""
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        return f.read()


def load(vocabulary: str):
    """The library's tokenizer, without truncation and padding."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(vocabulary)
    t.no_truncation()
    t.no_padding()
    return t


def let_go() -> None:
    """Drop the tokenizers and tables that this worker process keeps for its next
    task: for tasks of operators without tokens, which Spark gives to the same
    processes."""
    if Encoder._shared or WordTokenizer._shared:
        Encoder._shared.clear()
        WordTokenizer._shared.clear()
        pa.default_memory_pool().release_unused()


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the UTF-8 bytes of À to ÿ."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordTokenizer:
    """Ids of single words: words of plain letters by the vocabulary's merge
    model directly, part by part and each part once; others by the library's
    whole chain."""

    def __init__(self, vocabulary: str, max_known: int = MAX_PARTS):
        self.tokenizer = load(vocabulary)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.direct = _PATTERN in (str(self.tokenizer.pre_tokenizer).replace("\\\\", "\\"))
        self.max_known = max_known
        self.parts: dict[str, list[int]] = {}
        self.pieces = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]

    _shared: dict[int, WordTokenizer] = {}

    @classmethod
    def shared(cls, vocabulary: str) -> WordTokenizer:
        """One per worker process and vocabulary."""
        key = hash(vocabulary)
        if key not in cls._shared:
            cls._shared[key] = cls(vocabulary)
        return cls._shared[key]

    def part(self, part: str) -> list[int]:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= self.max_known:
                self.parts.clear()
            shown = part if part.isascii() else part.translate(self.letters)
            ids = self.parts[part] = [t.id for t in self.model.tokenize(shown)]
        return ids

    def encode(self, words: list[str]) -> list[list[int]]:
        out: list = [None] * len(words)
        rest = []
        for i, w in enumerate(words):
            if self.direct and _PLAIN.fullmatch(w):
                parts = _PARTS.findall(w.lower())
                out[i] = self.part(parts[0]) if len(parts) == 1 else [x for p in parts for x in self.part(p)]
            else:
                rest.append(i)
        if rest:
            for i, e in zip(rest, self.tokenizer.encode_batch([words[i] for i in rest], add_special_tokens=False)):
                out[i] = e.ids
        return out


class KeyTable:
    """Numbers of 64-bit keys, in order of entry; sorted arrays, 16 bytes a
    key.  New keys gather in a small array before they are merged."""

    RECENT = 1 << 16

    def __init__(self):
        self.parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2
        self.size = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; -1 where unknown."""
        out = np.full(len(keys), -1, np.int64)
        for known, number in self.parts:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                out = np.where(known[at] == keys, number[at], out)
        return out

    def add(self, keys: np.ndarray):
        """Numbers unknown, distinct keys on from the table's size."""
        old, recent = self.parts
        number = np.arange(self.size, self.size + len(keys))
        self.size += len(keys)
        recent = self._merge(recent, (keys, number))
        if len(recent[0]) > self.RECENT:
            old, recent = self._merge(old, recent), (keys[:0], number[:0])
        self.parts = [old, recent]

    @staticmethod
    def _merge(a: tuple, b: tuple) -> tuple:
        keys, number = (np.concatenate([x, y]) for x, y in zip(a, b))
        order = np.argsort(keys, kind="stable")
        return keys[order], number[order]


class Encoder:
    """Ids of words, remembered for up to ``max_known`` distinct words (about
    60 bytes a word).  A word found by its hash counts as known only if its
    bytes are the same."""

    _shared: dict[int, Encoder] = {}

    def __init__(self, vocabulary: str, max_known: int = MAX_KNOWN):
        self.words = WordTokenizer.shared(vocabulary)
        self.max_known = max_known
        self._forget()

    @classmethod
    def shared(cls, vocabulary: str) -> Encoder:
        """One encoder per worker process and vocabulary."""
        key = hash(vocabulary)
        if key not in cls._shared:
            cls._shared[key] = cls(vocabulary)
        return cls._shared[key]

    def _forget(self):
        self.table = KeyTable()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 14, np.int64)
        self.spelt = pa.chunked_array([pa.array([], pa.large_binary())])

    def _learn(self, ids: list[list[int]], keys: np.ndarray, words: pa.Array):
        # a few growing arrays rather than one per call
        chunks = [*self.spelt.chunks, words]
        while len(chunks) > 1 and len(chunks[-2]) < 2 * len(chunks[-1]):
            chunks[-2:] = [pa.concat_arrays(chunks[-2:])]
        self.spelt = pa.chunked_array(chunks)
        size, n = self.table.size, np.fromiter(map(len, ids), np.int64, len(ids))
        used, total = int(self.at[size]), int(n.sum())
        while used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while size + len(ids) >= len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.flat[used:used + total] = np.fromiter((x for one in ids for x in one), np.uint32, total)
        self.at[size + 1:size + 1 + len(ids)] = used + np.cumsum(n)
        self.table.add(keys)

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids begin; one more at the end)."""
        keys = words.keys[:, 0]
        slot = self.table.find(keys)
        found = np.flatnonzero(slot >= 0)
        if len(found):
            same = pc.equal(self.spelt.take(pa.array(slot[found])), words.distinct.take(pa.array(found)))
            other = found[~np.asarray(same)]
            if len(other):  # another word of this hash is known: one more entry that only this call uses
                slot[other] = -1
                keys = keys.copy()
                keys[other] = mix(keys[other] ^ words.keys[other, 1])
        if self.table.size + (slot < 0).sum() > self.max_known:
            self._forget()
            slot[:] = -1
        new = np.flatnonzero(slot < 0)
        if len(new):
            slot[new] = self.table.size + np.arange(len(new))
            spelt = words.distinct.take(pa.array(new))
            self._learn(self.words.encode(spelt.cast(pa.large_string()).to_pylist()), keys[new], spelt)
        inverse = words.code
        begin = self.at[slot]
        n = (self.at[slot + 1] - begin)[inverse]
        begin = begin[inverse]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], n)]
        return ids, ends[words.first]
