"""Quality rules in a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import add_columns, emit_rows

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Rows, about, on which the cost and the selectivity of each rule are estimated. They set the order of the rules, not their verdicts.
SAMPLE_ROWS = 2000
_LETTER = re.compile(r"[^\W\d_]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LOWER = re.compile(r"[a-zà-öø-ÿ]")


class Document:
    """A text with what rules measure of it, each worked out when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # bytes.split() cuts at space and U+0009 to U+000D

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of five that occur more than once. Different hashes of all windows rule that out."""
        words, n = self.words, self.n_words - WINDOW + 1
        if n < 2:
            return 0
        hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
        mixed = hashes[:n].copy()
        for k in range(1, WINDOW):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
        if len(np.unique(mixed)) == n:
            return 0
        windows = list(zip(*[words[k : k + n] for k in range(WINDOW)]))
        often = Counter(windows)
        inside = np.zeros(len(words) + 1, dtype=np.int64)
        starts = np.fromiter((often[w] > 1 for w in windows), dtype=bool, count=n).nonzero()[0]
        np.add.at(inside, starts, 1)
        np.add.at(inside, starts + WINDOW, -1)
        return int((np.cumsum(inside) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


def _few_words(d: Document) -> bool:
    return d.n_words < 10


def _repeated_windows(d: Document) -> bool:
    return 100 * d.n_repeat_words > 20 * d.n_words


def _symbols(d: Document) -> bool:
    return 10 * d.n_symbols > d.n_words


def _duplicate_lines(d: Document) -> bool:
    return 10 * d.n_dup_lines > 3 * len(d.lines)


def _word_length(d: Document) -> bool:
    return not 2 * d.n_words <= d.word_chars <= 20 * d.n_words


def _shouting(d: Document) -> bool:
    return len(_UPPER.findall(d.text)) > len(_LOWER.findall(d.text))


def _no_letters(d: Document) -> bool:
    return 2 * sum(1 for w in d.text.split() if _LETTER.search(w)) < d.n_words


BASE_RULES = [Rule("few_words", _few_words), Rule("repeated_windows", _repeated_windows)]
RULES = [
    *BASE_RULES,
    Rule("symbols", _symbols),
    Rule("duplicate_lines", _duplicate_lines),
    Rule("word_length", _word_length),
    Rule("shouting", _shouting),
    Rule("no_letters", _no_letters),
]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Estimate:
    rule: str
    seconds: float
    rejected: float


def estimate(docs: DataFrame, rules: list[Rule] = RULES, *, text_column: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> list[Estimate]:
    """Seconds and share of rejections of each rule by itself, on about ``sample_rows`` rows drawn from the whole table."""
    size = docs.count()
    if not size:
        return [Estimate(r.name, 0.0, 0.0) for r in rules]
    sample = docs.select(text_column).sample(min(1.0, sample_rows / size), seed=seed)

    def work():
        def step(parts):
            for part in parts:
                out = {"rule": [], "tested": [], "rejected": [], "seconds": []}
                for rule in rules:
                    documents = [Document(t) for t in part[text_column]]
                    start = time.perf_counter()
                    rejected = sum(map(rule.rejects, documents))
                    out["seconds"].append(time.perf_counter() - start)
                    out["rule"].append(rule.name)
                    out["tested"].append(len(documents))
                    out["rejected"].append(rejected)
                yield out

        return step

    parts = emit_rows(sample, [text_column], work, {"rule": "string", "tested": "long", "rejected": "long", "seconds": "double"})
    found = {r[0]: r for r in parts.groupBy("rule").agg(F.sum("tested"), F.sum("rejected"), F.sum("seconds")).collect()}
    return [Estimate(r.name, found[r.name][3] / found[r.name][1], found[r.name][2] / found[r.name][1]) if r.name in found else Estimate(r.name, 0.0, 0.0) for r in rules]


def cascade_order(estimates: list[Estimate]) -> list[str]:
    """Most rejections per second first; rules that reject nothing on the sample come last, the cheap ones before the dear."""
    return [e.rule for e in sorted(estimates, key=lambda e: (-e.rejected / max(e.seconds, 1e-9), e.seconds, e.rule))]


def quality_cascade(
    docs: DataFrame, rules: list[Rule] = RULES, *, id_column: str = "doc_id", text_column: str = "text", measures: list[str] | None = None, order: list[str] | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Whether each whole text passes all rules: ``kept``, and ``rejected_by``, the first rule in cascade order that rejects it.

    Later rules are not evaluated for a rejected text. ``order`` is estimated on a sample if not given; it changes
    the cost and ``rejected_by``, never ``kept``. ``measures`` are columns (long) wanted for every text. Returns ``keep`` (the id
    if not given), the measures, ``kept`` and ``rejected_by``, one row for each input row. A null text has no words. Repeated
    rows and null ids stay, an empty table gives an empty result, other columns are not read.
    """
    by_name = {r.name: r for r in rules}
    cascade = [by_name[name] for name in (order or cascade_order(estimate(docs, rules, text_column=text_column)))]
    measures = measures or []

    def work():
        def step(part):
            out = {c: [] for c in [*measures, "kept", "rejected_by"]}
            for text in part[text_column]:
                document = Document(text)
                verdict = next((r.name for r in cascade if r.rejects(document)), None)
                out["kept"].append(verdict is None)
                out["rejected_by"].append(verdict)
                for c in measures:
                    out[c].append(getattr(document, c))
            return out

        return step

    return add_columns(docs, keep or [id_column], [text_column], work, {c: "long" for c in measures} | {"kept": "boolean", "rejected_by": "string"})
