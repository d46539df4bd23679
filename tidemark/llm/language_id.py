"""Language identification: averaged hashed subword embeddings and a linear softmax, trained in numpy."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import add_columns, emit_rows

UNDETERMINED = "und"
BUCKETS = 1 << 15
DIMENSIONS = 16
ORDERS = (2, 3, 4)
#: Bound of the training sample: labelled documents, and passages of up to ``PASSAGE_WORDS`` words from each.
SAMPLE_DOCUMENTS = 4000
PASSAGES = 3
PASSAGE_WORDS = 48
#: Text that is turned into arrays at once: they take some 60 times as much memory.
SLICE_BYTES = 1 << 20
#: Languages that are learned, the commonest ones: a bound for a column that holds anything else.
MOST_LANGUAGES = 1000
_LETTER = re.compile(r"[^\W\d_]")
_MULTIPLY = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


def subwords(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Bucket numbers of the subwords that start at each position, by order (-1: none), and where each text starts.

    Subwords are runs of 2 to 4 letters within a word, whose ends count as letters.
    """
    lower = [t.lower() for t in texts]
    starts = np.cumsum([0] + [len(t) + 2 for t in lower])
    codes = np.frombuffer("".join(f" {t} " for t in lower).encode("utf-32-le"), dtype=np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(32))
    space = codes == 32
    stays = np.ones(len(codes), dtype=bool)
    stays[1:] = ~(space[1:] & space[:-1])
    stays[starts[:-1]] = True
    starts = np.concatenate([[0], np.cumsum(stays)])[starts[:-1]]
    codes, space = codes[stays].astype(np.uint64), space[stays]
    found = []
    for n in ORDERS:
        size = max(0, len(codes) - n + 1)
        mixed = np.full(size, n, dtype=np.uint64)
        for k in range(n):
            mixed = (mixed ^ codes[k : k + size]) * _MULTIPLY[k]
            mixed ^= mixed >> np.uint64(15)
        bucket = (mixed % np.uint64(BUCKETS)).astype(np.int32)
        outside = space[:size] & space[1 : 1 + size] if n == 2 else np.zeros(size, dtype=bool)
        for k in range(1, n - 1):
            outside |= space[k : k + size]
        bucket[outside] = -1
        found.append(np.concatenate([bucket, np.full(len(codes) - size, -1, dtype=np.int32)]))
    return found, starts


def has_letter(text: str | None) -> bool:
    """Whether a character is a letter; numerals that count as word characters (as in one half) are none."""
    return bool(text) and any(m[0].isalpha() for m in _LETTER.finditer(text))


@dataclass
class LanguageModel:
    """``scores`` is the embedding table times the softmax weights: averaging them is averaging embeddings first."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its calibrated probability."""
        found, starts = subwords(texts)
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts))
        for bucket in found:
            total += np.add.reduceat(self.scores[bucket], starts, axis=0, dtype=np.float64)  # row -1 holds zeros
            count += np.add.reduceat((bucket >= 0).astype(np.int64), starts)
        logits = (total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature
        return logits.argmax(axis=1), _softmax(logits).max(axis=1)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def passages(text: str, seed: int) -> list[str]:
    """Up to ``PASSAGES`` runs of 1 to ``PASSAGE_WORDS`` words; which ones follows from ``seed``."""
    words = text.split()
    draw = np.random.default_rng(seed)
    out = []
    for _ in range(PASSAGES if len(words) > 1 else 1):
        size = int(draw.integers(1, PASSAGE_WORDS + 1))
        start = int(draw.integers(0, max(1, len(words) - size + 1)))
        out.append(" ".join(words[start : start + size]))
    return out


def fit(features: list[np.ndarray], labels: list[str], *, epochs: int = 6, batch: int = 64, rate: float = 3.0, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent over four fifths of the passages; the others set temperature and rejection."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0), 1.0, 1.0)
    draw = np.random.default_rng(seed)
    target = np.searchsorted(languages, labels)
    order = draw.permutation(len(features))
    held, train = order[: len(order) // 5], order[len(order) // 5 :]
    embedding = draw.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    weights[:] = draw.normal(0, 0.1, weights.shape)
    steps = max(1, epochs * -(-len(train) // batch))
    step = 0
    for _ in range(epochs):
        train = draw.permutation(train)
        for at in range(0, len(train), batch):
            now, step = rate * (1 - step / steps), step + 1
            rows = train[at : at + batch]
            size = np.array([len(features[r]) for r in rows])
            bucket = np.concatenate([features[r] for r in rows])
            mean = np.add.reduceat(embedding[bucket], np.cumsum(size) - size, axis=0) / size[:, None]
            slope = _softmax(mean @ weights + bias)
            slope[np.arange(len(rows)), target[rows]] -= 1
            slope /= len(rows)
            back = np.repeat((slope @ weights.T) / size[:, None], size, axis=0)
            weights -= now * (mean.T @ slope)
            bias -= now * slope.sum(axis=0)
            sort = np.argsort(bucket, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(bucket[sort]) != 0])
            embedding[bucket[sort][first]] -= now * len(rows) * np.add.reduceat(back[sort], first, axis=0)
    model = LanguageModel(languages, np.vstack([embedding @ weights, np.zeros((1, len(languages)))]).astype(np.float32), bias.astype(np.float64), 1.0, 0.0)
    return _calibrated(model, [features[r] for r in held], target[held])


def _calibrated(model: LanguageModel, features: list[np.ndarray], target: np.ndarray) -> LanguageModel:
    """Temperature by likelihood; the rejection limit keeps at least 999 of 1000 right answers, and is at most 0.5."""
    if not len(target):
        return model
    logits = np.array([model.scores[f].mean(axis=0, dtype=np.float64) for f in features]) + model.bias
    loss = {t: -np.log(_softmax(logits / t)[np.arange(len(target)), target] + 1e-12).mean() for t in np.geomspace(0.1, 10, 41)}
    model.temperature = float(min(loss, key=loss.get))
    chance = _softmax(logits / model.temperature)
    right = chance.max(axis=1)[chance.argmax(axis=1) == target]
    model.reject_below = float(min(0.5, np.quantile(right, 0.001))) if len(right) else 0.0
    return model


def train_language_model(labelled: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", sample_documents: int = SAMPLE_DOCUMENTS) -> LanguageModel:
    """Fit on about ``sample_documents`` rows with a text and a language, drawn by id hash in equal parts from the
    ``MOST_LANGUAGES`` commonest languages (of two as common, the one that sorts first).

    Subwords of the sampled passages come from Spark tasks; the driver holds at most
    ``sample_documents * PASSAGES`` lists of bucket numbers, however long the texts are.
    """
    rows = labelled.where(F.col(text_column).isNotNull() & F.col(lang_column).isNotNull())
    sizes = rows.groupBy(F.col(lang_column).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not sizes:
        return fit([], [])
    shares = [(r["lang"], min(1.0, sample_documents / len(sizes) / r["count"])) for r in sizes]
    learned = F.broadcast(labelled.sparkSession.createDataFrame(shares, "lang string, share double"))  # MOST_LANGUAGES rows
    place = F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    known = rows.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"), F.xxhash64(F.col(id_column).cast("string")).alias("seed"), place.alias("place"))
    sample = known.join(learned, "lang").where(F.col("place") < F.col("share"))

    def work():
        def step(parts):
            for part in parts:
                cut = [(lang, p) for lang, text, seed in zip(part["lang"], part["text"], part["seed"]) for p in passages(text, seed & 0x7FFFFFFF)]
                found, starts = subwords([p for _, p in cut])
                ends = np.r_[starts[1:], len(found[0])]
                lists = [np.concatenate([f[a:b][f[a:b] >= 0] for f in found]) for a, b in zip(starts, ends)]
                some = [k for k, x in enumerate(lists) if len(x)]
                yield {"lang": [cut[k][0] for k in some], "buckets": [lists[k] for k in some]}

        return step

    collected = emit_rows(sample, ["lang", "text", "seed"], work, {"lang": "string", "buckets": "array<int>"}).toArrow()
    labels = collected.column("lang").to_pylist()
    features = [np.array(x, dtype=np.int32) for x in collected.column("buckets").to_pylist()]
    # Tasks may come back in any order; the model must not depend on it.
    order = sorted(range(len(labels)), key=lambda k: (labels[k], len(features[k]), zlib.crc32(features[k].tobytes())))
    return fit([features[k] for k in order], [labels[k] for k in order])


def identify_language(docs: DataFrame, model: LanguageModel, *, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Language of each whole text: ``lang_pred``, its calibrated probability ``score``, and ``rejected``.

    ``keep`` (the id if not given) are the columns to pass on. A null text or one without a letter gives
    ``und`` with score 0 and is rejected; a text below the calibrated limit keeps its prediction and is
    rejected. A model without languages answers ``und``. Repeated rows and null ids stay, an empty table
    gives an empty result, other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most BUCKETS rows of one score per language

    def work():
        known = shared.value

        def step(part):
            texts = part[text_column]
            has = [k for k, t in enumerate(texts) if has_letter(t)] if known.languages else []
            lang, score, rejected = [UNDETERMINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
            if has:
                best, chance = known.predict([texts[k] for k in has])
                for k, b, c in zip(has, best.tolist(), chance.tolist()):
                    lang[k], score[k], rejected[k] = known.languages[b], min(1.0, c), c < known.reject_below
            return {"lang_pred": lang, "score": score, "rejected": rejected}

        return step

    return add_columns(docs, keep or [id_column], [text_column], work, {"lang_pred": "string", "score": "double", "rejected": "boolean"}, SLICE_BYTES)
