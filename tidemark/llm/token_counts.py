"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import add_columns

SPACE = "▁"
NONE = np.int64(1) << 40  # rank of a pair that the vocabulary doesn't merge
CACHED_WORDS = 300_000  # of a Python worker; only speed depends on it
CACHED_CHARS = 64  # longer words are not kept
CUT_CHARS = 48  # longer words are cut where no piece can lie
MERGED_SYMBOLS = 1 << 20  # symbols merged in one array


_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


class PairTable:
    """Open addressing from (left symbol, right symbol) to a row of the merge list, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.rows = np.full(1 << self.bits, -1, dtype=np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            take, at = np.unique(slot[free], return_index=True)
            placed = left[free][at]
            self.keys[take], self.rows[take] = keys[placed], placed
            rest = np.ones(len(left), dtype=bool)
            rest[np.flatnonzero(free)[at]] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        held = self.keys[slot]
        found = np.where(held == keys, self.rows[slot], -1)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot[open_]]
            same = held == keys[open_]
            found[open_[same]] = self.rows[slot[open_[same]]]
            open_ = open_[~same & (held != -1)]
        return found


class PieceVocabulary:
    """Pieces, scores and merges of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = [model.id_to_piece(i) for i in ids]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece goes over the start of a word")
        symbol = {p: k for k, p in enumerate(pieces)}
        for char in sorted({c for p in pieces for c in p} - symbol.keys()):
            symbol[char] = len(symbol)
        self.n_pieces, self.unknown = len(pieces), len(symbol)
        self.base = len(symbol) + 1
        scores = np.array([model.get_score(i) for i in ids])
        order = np.unique(-scores, return_inverse=True)[1]
        left, right, made = [], [], []
        for k, piece in enumerate(pieces):
            for cut in range(1, len(piece)):
                if piece[:cut] in symbol and piece[cut:] in symbol:
                    left.append(symbol[piece[:cut]])
                    right.append(symbol[piece[cut:]])
                    made.append(k)
        left, right, self.made = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), np.array(made, dtype=np.int64)
        self.rank = order[self.made].astype(np.int64)
        self.pairs = PairTable(left * self.base + right)
        # A merge is done everywhere in a sequence at once only if nothing it makes possible comes before it.
        first = np.full(self.base, NONE)
        np.minimum.at(first, left, self.rank)
        np.minimum.at(first, right, self.rank)
        tied = np.bincount(order, minlength=order.max() + 1) > 1
        self.at_once = (first[: len(pieces)] > order) & ~tied[order]
        self.at_once = self.at_once[self.made]
        self.chars = np.full(0x110000, self.unknown, dtype=np.int64)
        for text, k in symbol.items():
            if len(text) == 1:
                self.chars[ord(text)] = k
        # Long runs of spaces: all run pieces rank last and alike, so a run is filled from the left
        # with the longest one, and whole lengths of it can be counted without merging.
        # Hashes of all beginnings of pieces, by length, and which of them are whole pieces.
        whole: dict[int, dict[int, bool]] = {}
        for piece in pieces:
            key = ord(piece[0])
            for size in range(2, len(piece) + 1):
                key = (key * _BASE + ord(piece[size - 1])) & _MASK
                found = whole.setdefault(size, {})
                found[key] = found.get(key, False) or size == len(piece)
        self.beginnings = []
        for size in sorted(whole):
            keys = np.array(sorted(whole[size]), dtype=np.uint64)
            self.beginnings.append((keys, np.array([whole[size][int(k)] for k in keys], dtype=bool)))
        runs = [k for k, p in enumerate(pieces) if len(p) > 1 and not p.strip(SPACE)]
        self.period = max((len(pieces[k]) for k in runs), default=0) if {order[k] for k in runs} == {order.max()} else 0

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each word; a word is a run of spaces and what follows up to the next space."""
        total = np.zeros(len(words), dtype=np.int64)
        if not words:
            return total
        if self.period:
            words = list(words)
            for k, word in enumerate(words):
                if word.startswith(SPACE * (4 * self.period)):
                    run = len(word) - len(word.lstrip(SPACE))
                    cut = run // self.period - 3
                    total[k], words[k] = cut, word[cut * self.period :]
        lengths = np.array([len(w) for w in words])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        word = np.repeat(np.arange(len(words)), lengths)
        symbols = self.chars[codes]
        unknown = np.flatnonzero(symbols == self.unknown)
        code = codes[unknown]
        np.add.at(total, word[unknown], (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF))
        sequence = np.cumsum(self._cuts(codes, word, lengths)) - 1
        counts = np.zeros(sequence[-1] + 1 if len(sequence) else 0, dtype=np.int64)
        owner = word[np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])] if len(sequence) else word
        self._merge(symbols, sequence, counts)
        np.add.at(total, owner, counts)
        return total

    def _cuts(self, codes: np.ndarray, word: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Where a sequence starts: at each word, and within long words wherever no piece lies over the place.

        A merge makes a piece out of neighbours, so none goes over such a place and both sides can be merged by
        themselves. That a hash of other characters equals a piece's only means a cut less.
        """
        starts = np.r_[True, word[1:] != word[:-1]]
        at = np.flatnonzero(np.repeat(lengths > CUT_CHARS, lengths))
        if not len(at):
            return starts
        covered = np.zeros(len(codes) + 1, dtype=np.int64)
        end, key = at, codes[at].astype(np.uint64)
        for size, (keys, whole) in enumerate(self.beginnings, 2):
            inside = end + 1 < len(codes)
            inside[inside] = word[end[inside] + 1] == word[end[inside]]
            at, end, key = at[inside], end[inside] + 1, key[inside]
            key = key * np.uint64(_BASE) + codes[end]
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            known = keys[place] == key
            at, end, key, place = at[known], end[known], key[known], place[known]
            piece = whole[place]
            # places after ``at`` up to ``end`` lie within the piece
            np.add.at(covered, at[piece] + 1, 1)
            np.add.at(covered, end[piece] + 1, -1)
            if not len(at):
                break
        free = np.cumsum(covered[:-1]) == 0
        return starts | (free & np.repeat(lengths > CUT_CHARS, lengths))

    def _rank(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray, rank: np.ndarray, row: np.ndarray) -> None:
        at = at[(at >= 0) & (at < len(symbols))]
        rank[at] = NONE
        inner = at[at < len(symbols) - 1]
        inner = inner[word[inner] == word[inner + 1]]
        found = self.pairs.find(symbols[inner] * self.base + symbols[inner + 1])
        hit = found >= 0
        rank[inner[hit]], row[inner[hit]] = self.rank[found[hit]], found[hit]

    def _merge(self, symbols: np.ndarray, word: np.ndarray, total: np.ndarray) -> None:
        rank, row = np.full(len(symbols), NONE), np.zeros(len(symbols), dtype=np.int64)
        self._rank(symbols, word, np.arange(len(symbols)), rank, row)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(np.r_[starts, len(symbols)])
            best = np.minimum.reduceat(rank, starts)
            done = best == NONE
            if done.any():
                total[word[starts[done]]] += lengths[done]
                left = np.repeat(~done, lengths)
                symbols, word, rank, row = symbols[left], word[left], rank[left], row[left]
                best, lengths = best[~done], lengths[~done]
                if not len(symbols):
                    return
            hit = np.flatnonzero(rank == np.repeat(best, lengths))
            new_word = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
            # Overlapping occurrences: every other one of a run, from its start.
            new_run = new_word | np.r_[True, np.diff(hit) != 1]
            in_run = np.arange(len(hit)) - np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
            hit = hit[new_word | (self.at_once[row[hit]] & (in_run % 2 == 0) & self.at_once[row[hit[np.flatnonzero(new_word)[np.cumsum(new_word) - 1]]]])]
            symbols[hit] = self.made[row[hit]]
            left = np.ones(len(symbols), dtype=bool)
            left[hit + 1] = False
            hit = hit - np.arange(len(hit))
            symbols, word, rank, row = symbols[left], word[left], rank[left], row[left]
            self._rank(symbols, word, np.concatenate([hit - 1, hit]), rank, row)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)


_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def text_words(text: str) -> list[str]:
    """The words of a text after the model's normalisation, each without its first space."""
    if "  " in text or SPACE in text or text.startswith(" ") or text.endswith(" "):
        return [w[1:] for w in _WORDS.findall(SPACE + text.replace(" ", SPACE))] if text else []
    return text.split(" ") if text else []


class TokenCounter:
    def __init__(self, path: str):
        self.model, self.known = vocabulary(path), {}

    def __call__(self, texts: list[str]) -> list[int]:
        words = [text_words(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        fresh = list({w for ws in words for w in ws if w not in self.known})
        start = size = 0
        for k, w in enumerate(fresh):
            size += len(w) + 1
            if size >= MERGED_SYMBOLS or k == len(fresh) - 1:
                part = fresh[start : k + 1]
                self.known.update(zip(part, self.model.count([SPACE + w for w in part]).tolist()))
                start, size = k + 1, 0
        get = self.known.__getitem__
        counts = [sum(map(get, ws)) for ws in words]
        for w in fresh:
            if len(w) > CACHED_CHARS:
                del self.known[w]
        return counts


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, model_path: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokens of each text under a sentencepiece BPE model.

    The text is cut before each run of spaces, which no piece of the model goes over
    (this is checked). Words that a worker hasn't seen are merged together: every word's
    best pair at once, until none has a pair left; long words are cut first where no piece can lie. Unknown characters
    count as their bytes.

    Returns ``id_column``, ``n_bytes`` and ``n_tokens``, one row for each input row. A null
    text counts as empty: 0 bytes and 0 tokens. Repeated rows stay, a null id stays null,
    an empty table gives an empty result, other columns are not read.
    """

    def work():
        count = counter(model_path)
        return lambda part: {"n_tokens": count([t or "" for t in part[text_column]])}

    source = docs.select(id_column, text_column, F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("n_bytes"))
    return add_columns(source, [id_column, "n_bytes"], [text_column], work, {"n_tokens": "long"})
