"""Byte-level BPE encoding and decoding with a contiguous rank array for each short word."""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tidemark.llm.batches import add_columns
from tidemark.llm.token_counts import PairTable

CACHED_CHUNKS = 150_000  # of a Python worker; only speed depends on it
CACHED_CHARS = 64  # longer chunks are not kept
TOGETHER = 32  # bytes; words up to this length are merged many at a time
FEW = 16  # words, which are merged one by one
SHORT = 200  # bytes; scanning a longer word for its minimum again and again would take quadratic time
NONE = (1 << 31) - 1

#: How byte-level BPE vocabularies of this kind cut a text into words. White space is spelled as a
#: Unicode property, since ``\s`` has a few control characters more here than in the library.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Cuts before each space that something visible follows. What ``\S`` leaves out beside white space only means a cut less.
CHUNKS = re.compile(r" (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in the file: printable Latin-1 for itself, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class ByteVocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letter = byte_alphabet()
        as_bytes = lambda token: bytes(letter[c] for c in token)
        ids = {as_bytes(token): i for token, i in content["model"]["vocab"].items()}
        self.id = ids
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.token = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.token[i] = token
        for token, i in self.special.items():
            self.token[i] = token.encode()
        self.tokens = pa.array(self.token, pa.binary())
        self.byte = [ids[bytes([b])] for b in range(256)]
        self.bytes = np.array(self.byte, dtype=np.int32)
        #: Rank of a pair of ids, as left id times ``size`` plus right id, and by rank the id that a merge makes.
        self.size = len(self.token)
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (left, right) in enumerate(content["model"]["merges"]):
            left, right = as_bytes(left), as_bytes(right)
            self.rank[ids[left] * self.size + ids[right]] = rank
            self.made.append(ids[left + right])
        self.pairs = PairTable(np.fromiter(self.rank, dtype=np.int64))
        self.pair_rank = np.array([*self.rank.values(), NONE], dtype=np.int32)
        self.merged = np.array(self.made, dtype=np.int32)
        self.split = regex.compile(WORDS)
        self.cut = regex.compile("|".join(f"({regex.escape(s)})" for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        #: Ids of chunks. Two generations: when the young one is full it becomes the old one, so frequent chunks stay.
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def word_ids(self, word: bytes) -> tuple[int, ...]:
        return self._short(word) if len(word) <= SHORT else self._long(word)

    def _short(self, word: bytes) -> tuple[int, ...]:
        """``ids[i]`` is part i, ``ranks[i]`` is the rank of parts i and i + 1."""
        size, find, made = self.size, self.rank.get, self.made
        ids = [self.byte[b] for b in word]
        ranks = [find(a * size + b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NONE:
                break
            i = ranks.index(best)
            ids[i] = part = made[best]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = find(part * size + ids[i + 1], NONE)
            if i:
                ranks[i - 1] = find(ids[i - 1] * size + part, NONE)
        return tuple(ids)

    def _long(self, word: bytes) -> tuple[int, ...]:
        """The same with a heap: a word of n bytes takes n log n steps."""
        n, size, find = len(word), self.size, self.rank.get
        ids = [self.byte[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = [find(a * size + b, NONE) for a, b in zip(ids, ids[1:])] + [NONE]
        heap = [(r, i) for i, r in enumerate(rank) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if rank[i] != r:
                continue
            gone = after[i]
            ids[i], after[i], rank[gone] = self.made[r], after[gone], -1
            if after[i] < n:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0:
                    rank[k] = find(ids[k] * size + ids[after[k]], NONE) if after[k] < n else NONE
                    if rank[k] != NONE:
                        heapq.heappush(heap, (rank[k], k))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return tuple(out)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pair_rank[self.pairs.find(left.astype(np.int64).ravel() * self.size + right.ravel())].reshape(left.shape)

    def _rows(self, words: list[bytes]) -> list[bytes]:
        """Words of one length: a row of ids and a row of ranks for each. A step merges the first best pair of every
        row that has one, so the rows that go on stay equally long."""
        out = [b""] * len(words)
        ids = self.bytes[np.frombuffer(b"".join(words), dtype=np.uint8)].reshape(len(words), -1)
        ranks = np.full(ids.shape, NONE, dtype=np.int32)
        ranks[:, :-1] = self._ranks(ids[:, :-1], ids[:, 1:])
        at = np.arange(len(words))
        while True:
            i = ranks.argmin(axis=1)
            best = ranks[np.arange(len(at)), i]
            done = best == NONE
            if done.any():
                packed, width = ids[done].tobytes(), 4 * ids.shape[1]
                for k, word in enumerate(at[done].tolist()):
                    out[word] = packed[k * width : (k + 1) * width]
                if done.all():
                    return out
                at, ids, ranks, i, best = (x[~done] for x in (at, ids, ranks, i, best))
            row = np.arange(len(at))
            left = np.ones(ids.shape, dtype=bool)
            left[row, i + 1] = False
            ids, ranks = ids[left].reshape(len(at), -1), ranks[left].reshape(len(at), -1)
            ids[row, i] = self.merged[best]
            ranks[row, i] = NONE
            inner, before = i + 1 < ids.shape[1], i > 0
            for r, k in ((row[inner], i[inner]), (row[before], i[before] - 1)):
                ranks[r, k] = self._ranks(ids[r, k], ids[r, k + 1])

    def _all_words(self, words: set[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        by_length: dict[int, tuple[list[str], list[bytes]]] = {}
        for word in words:
            content = word.encode()
            names, contents = by_length.setdefault(len(content), ([], []))
            names.append(word)
            contents.append(content)
        for length, (names, contents) in by_length.items():
            many = length <= TOGETHER and len(names) > FEW
            out.update(zip(names, self._rows(contents) if many else [_packed(self.word_ids(w)) for w in contents]))
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], dtype=np.int32).tolist()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit numbers, one after the other."""
        if not any(s in text for text in texts for s in self.special):
            return self._plain(texts)
        # special strings stand between plain parts
        parts = [[p for p in self.cut.split(text) if p is not None] for text in texts]
        plain = iter(self._plain([p for ps in parts for p in ps[::2]]))
        return [b"".join(_packed([self.special[p]]) if k % 2 else next(plain) for k, p in enumerate(ps)) for ps in parts]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """No word goes over a space that something visible follows: what lies between such spaces is looked up whole."""
        if len(self.known) > CACHED_CHUNKS:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        chunks = [CHUNKS.split(text) for text in texts]
        starts = [self.split.findall(c.pop(0)) for c in chunks]
        fresh = []
        for chunk in set().union(*chunks):
            if chunk not in known:
                if chunk in old:
                    known[chunk] = old[chunk]
                else:
                    fresh.append(chunk)
        words = self.split.findall("".join([" " + c for c in fresh]))
        packed = self._all_words({*words}.union(*starts)).__getitem__
        # the words of a chunk end where it ends
        ends = np.cumsum([len(w) for w in words])
        ends = (np.searchsorted(ends, np.cumsum([1 + len(c) for c in fresh])) + 1).tolist()
        found = list(map(packed, words))
        for chunk, start, end in zip(fresh, [0, *ends], ends):
            known[chunk] = b"".join(found[start:end])
        rows = [b"".join([*map(packed, s), *map(known.__getitem__, c)]) for s, c in zip(starts, chunks)]
        for chunk in fresh:
            if len(chunk) > CACHED_CHARS:
                del known[chunk]
        return rows

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The texts of all rows."""
        ends = np.zeros(1 + len(ids.values), dtype=np.int32)
        tokens = self.tokens.take(ids.values)
        np.cumsum(pc.binary_length(tokens).to_numpy(), out=ends[1:])
        offsets = ends[ids.offsets.to_numpy()]
        texts = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), tokens.buffers()[2]])
        try:
            return texts.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in texts.to_pylist()], pa.string())


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteVocabulary:
    return ByteVocabulary(path)


def _packed(ids: Iterable[int]) -> bytes:
    return array("i", ids).tobytes()


def _ragged(rows: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(x) // 4 for x in rows], out=offsets[1:])
    values = np.frombuffer(b"".join(rows), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def bpe_encode(docs: DataFrame, vocabulary_path: str, *, id_column: str = "doc_id", text_column: str = "text", decode: bool = False) -> DataFrame:
    """Token ids of each whole text; with ``decode``, also the text that the ids give back, as ``decoded``.

    Returns ``id_column`` and ``ids`` (array<int>), one row for each input row. Special strings in a
    text become their ids. A null or empty text has no ids and decodes to an empty text. Repeated rows
    stay, a null id stays null, an empty table gives an empty result, other columns are not read.
    """

    def work():
        known = vocabulary(vocabulary_path)

        def step(part):
            ids = _ragged(known.encode_all([t or "" for t in part[text_column]]))
            return {"ids": ids} | ({"decoded": known.decode_all(ids)} if decode else {})

        return step

    return add_columns(docs, [id_column], [text_column], work, {"ids": "array<int>"} | ({"decoded": "string"} if decode else {}))


def bpe_decode(encoded: DataFrame, vocabulary_path: str, *, id_column: str = "doc_id") -> DataFrame:
    """The text of each row of ``ids``, as ``decoded``; null ids give an empty text."""

    def work():
        known = vocabulary(vocabulary_path)
        return lambda part: {"decoded": [known.decode(x or []) for x in part["ids"]]}

    return add_columns(encoded, [id_column], ["ids"], work, {"decoded": "string"})
