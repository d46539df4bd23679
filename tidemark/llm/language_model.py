"""Scores of a hashed maximum-entropy language model with class-factored softmax."""

from __future__ import annotations

from collections import Counter
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import add_columns, emit_rows
from tidemark.shared import new_folder

#: The empty word ends a text.
END = b""
#: The words that are predicted one by one; all others share a class and are told apart by their frequency alone.
CLASSES, CLASS_WORDS = 64, 64
#: Rows of the hashed weights, powers of two that 16 bits can number: of contexts for classes, and of contexts and classes for words.
CLASS_ROWS, WORD_ROWS = 1 << 12, 1 << 14
#: Words with at least this share of the training tokens are counted in every task's memory, so at most its inverse of them.
COMMON_SHARE = 2.0**-20
#: Length of the gradient step, and how many tokens of the prior it is damped by.
RATE, DAMPING = 0.6, 100.0
STEP_TOKENS, COUNT_TOKENS = 8192, 1 << 17
FLUSH_WORDS = 400_000
#: The counts are summed in this many blocks, and of so many tasks at once.
_BLOCKS, FAN_IN = 64, 128
_START = np.uint64(0x5BD1E995)
_FAR = np.float32(-1e9)


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, cut at space and U+0009 to U+000D, and the end."""
    found = text.encode().lower().split() if text else []
    found.append(END)
    return found


def word_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(word, c) over all whole texts; tasks count first."""

    def work():
        def step(parts):
            held: Counter = Counter()
            for part in parts:
                for text in part[text_column]:
                    held.update(tokens(text))
                    if len(held) > FLUSH_WORDS:
                        yield {"word": list(held), "n": list(held.values())}
                        held.clear()
            yield {"word": list(held), "n": list(held.values())}

        return step

    return emit_rows(docs, [text_column], work, {"word": "binary", "n": "long"}).groupBy("word").agg(F.sum("n").alias("c"))


class Vocabulary:
    """The common words, most frequent first, with their counts and hashes, and one more place for all others.

    The first ``CLASSES * CLASS_WORDS`` are predicted one by one; all other words share the last class and have their
    share of its tokens, with one more for words never seen.
    """

    def __init__(self, count: dict[bytes, int], n: int, v: int):
        words = sorted(count, key=lambda w: (-count[w], w))
        self.place = {w: k for k, w in enumerate(words)}
        self.counts = np.array([*map(count.get, words), 0], dtype=np.int64)
        self.hashes = np.array([*map(crc32, words), 0], dtype=np.uint64)
        self.n, self.v, self.size = n, v, len(words)
        self.n_head = min(self.size, CLASSES * CLASS_WORDS)
        self.head_counts = np.zeros(CLASSES * CLASS_WORDS)
        self.head_counts[: self.n_head] = self.counts[: self.n_head]

    @property
    def tail_total(self) -> float:
        return self.n - self.head_counts.sum() + self.v - self.n_head + 1


class Weights:
    """Biases hold word frequencies; the hashed rows hold what contexts add to them."""

    def __init__(self, vocabulary: Vocabulary):
        by_class = vocabulary.head_counts.reshape(CLASSES, CLASS_WORDS)
        mass = np.append(by_class.sum(axis=1), vocabulary.tail_total)
        self.class_bias = np.log(np.maximum(mass, 1e-3) / max(mass.sum(), 1)).astype(np.float32)
        self.class_bias[mass == 0] = _FAR
        self.word_bias = np.where(by_class > 0, np.log(np.maximum(by_class, 1) / np.maximum(by_class.sum(axis=1, keepdims=True), 1)), _FAR).astype(np.float32)
        self.class_rows = np.zeros((CLASS_ROWS, CLASSES + 1), np.float32)
        self.word_rows = np.zeros((WORD_ROWS, CLASS_WORDS), np.float32)


def _mix(a: np.ndarray, salt: int) -> np.ndarray:
    a = (a ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return a ^ (a >> np.uint64(29))


class Batch:
    """Tokens of several texts as arrays: features are the word before, the two before, and the one before that alone."""

    def __init__(self, texts: list[str | None], vocabulary: Vocabulary):
        words = [tokens(t) for t in texts]
        self.sizes = np.array([len(w) for w in words])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = list(chain.from_iterable(words))
        self.place = np.fromiter(map(vocabulary.place.get, self.words, repeat(vocabulary.size)), dtype=np.int64, count=len(self.words))
        hashed = vocabulary.hashes[self.place]
        self.rare = np.flatnonzero(self.place == vocabulary.size)
        hashed[self.rare] = np.fromiter((crc32(self.words[i]) for i in self.rare.tolist()), dtype=np.uint64, count=len(self.rare))
        one, two = np.empty_like(hashed), np.empty_like(hashed)
        one[1:], two[2:] = hashed[:-1], hashed[:-2]
        one[self.starts] = _START
        two[self.starts] = _START
        two[(self.starts + 1)[self.sizes > 1]] = _START
        self.features = np.stack([_mix(one, 1), _mix(one * np.uint64(31) ^ _mix(two, 2), 3), _mix(two, 4)], axis=1)
        self.in_head = self.place < vocabulary.n_head
        self.target = np.where(self.in_head, self.place // CLASS_WORDS, CLASSES)

    def class_features(self, a: int, b: int) -> np.ndarray:
        return (self.features[a:b] & np.uint64(CLASS_ROWS - 1)).astype(np.uint16)

    def word_features(self, at: np.ndarray) -> np.ndarray:
        mixed = _mix(self.features[at] ^ (self.target[at].astype(np.uint64) << np.uint64(40))[:, None], 5)
        return (mixed & np.uint64(WORD_ROWS - 1)).astype(np.uint16)


class Scratch:
    """Arrays that the steps over a batch use again: ``out`` and ``spare`` of ``STEP_TOKENS`` rows."""

    def __init__(self, width: int):
        self.out, self.spare = np.empty((2, STEP_TOKENS, width), np.float32)

    def logits(self, table: np.ndarray, rows: np.ndarray, bias: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        """Sums of the rows of all features and of ``bias``, or of its rows ``of``; valid until the next call."""
        out, spare = self.out[: len(rows)], self.spare[: len(rows)]
        np.take(table, rows[:, 0], axis=0, out=out, mode="clip")
        for k in range(1, rows.shape[1]):
            np.take(table, rows[:, k], axis=0, out=spare, mode="clip")
            out += spare
        out += bias if of is None else np.take(bias, of, axis=0, out=spare, mode="clip")
        return out


def _log_chances(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1)[:, None]
    chosen = logits[np.arange(len(logits)), target]
    return chosen - np.log(np.exp(logits, out=logits).sum(axis=1))


def log_chances(weights: Weights, batch: Batch) -> np.ndarray:
    """Natural log of each token's probability; of other than head words, that of their class."""
    out = np.empty(len(batch.words))
    classes, words = Scratch(CLASSES + 1), Scratch(CLASS_WORDS)
    for a in range(0, len(out), STEP_TOKENS):
        b = min(a + STEP_TOKENS, len(out))
        out[a:b] = _log_chances(classes.logits(weights.class_rows, batch.class_features(a, b), weights.class_bias), batch.target[a:b])
        at = a + np.flatnonzero(batch.in_head[a:b])
        if len(at):
            out[at] += _log_chances(words.logits(weights.word_rows, batch.word_features(at), weights.word_bias, batch.target[at]), batch.place[at] % CLASS_WORDS)
    return out


class Gradient:
    """What the gradient at the biases needs: how often each class and word came with each hashed row.

    Observed counts less expected ones are the gradient of the log-likelihood, and at the biases the expected ones follow from
    the tokens of each row. So a task counts, and Spark sums whole numbers: the result is the same
    whatever the tasks were.
    """

    SHAPES = ((CLASS_ROWS, CLASSES + 1), (WORD_ROWS, CLASS_WORDS), (WORD_ROWS, CLASSES))

    def __init__(self, flat: np.ndarray | None = None):
        sizes = [a * b for a, b in self.SHAPES]
        self.flat = np.zeros(sum(sizes), dtype=np.int64) if flat is None else flat
        cuts = np.cumsum(sizes)[:-1]
        self.classes, self.words, self.word_classes = (x.reshape(shape) for x, shape in zip(np.split(self.flat, cuts), self.SHAPES))

    def learn(self, batch: Batch) -> None:
        def count(table, rows, of):
            table += np.bincount((rows.astype(np.int64) * table.shape[1] + of[:, None]).ravel(), minlength=table.size).reshape(table.shape)

        for a in range(0, len(batch.words), COUNT_TOKENS):
            b = min(a + COUNT_TOKENS, len(batch.words))
            count(self.classes, batch.class_features(a, b), batch.target[a:b])
            at = a + np.flatnonzero(batch.in_head[a:b])
            rows = batch.word_features(at)
            count(self.words, rows, batch.place[at] % CLASS_WORDS)
            count(self.word_classes, rows, batch.target[at])

    def stepped(self, weights: Weights, rate: float = RATE, damping: float = DAMPING) -> Weights:
        """One step from the biases, in the logarithms that the weights are: the damped ratio of observed to expected counts."""
        chance = np.exp(weights.class_bias.astype(np.float64))
        tokens_ = self.classes.sum(axis=1, keepdims=True)
        some = chance > 0
        weights.class_rows[:, some] = rate * np.log((self.classes + damping * chance)[:, some] / ((tokens_ + damping) * chance)[:, some])
        by_class = np.where(weights.word_bias > _FAR, np.exp(weights.word_bias.astype(np.float64)), 0)
        tokens_ = self.word_classes.sum(axis=1, keepdims=True)
        chance = self.word_classes @ by_class / np.maximum(tokens_, 1)
        expected = np.where(chance > 0, (tokens_ + damping) * chance, 1)
        weights.word_rows[:] = np.where(chance > 0, rate * np.log((self.words + damping * chance) / expected + (chance <= 0)), 0)
        return weights


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    """The sum of the same block of counts of at most ``FAN_IN`` tasks."""
    total = 0
    for counts in group["counts"]:
        total = total + np.frombuffer(counts, np.int64)
    first = group.iloc[0]
    return pd.DataFrame({"block": [int(first["block"])], "part": [int(first["next_part"])], "counts": [total.tobytes()]})


def train(docs: DataFrame, vocabulary: Vocabulary, *, text_column: str = "text") -> Weights:
    """A gradient step over all tokens of all training texts, summed by Spark in a tree of tasks."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)  # at most 1 / COMMON_SHARE words

    def work():
        def step(parts):
            gradient = Gradient()
            for part in parts:
                gradient.learn(Batch(part[text_column], shared.value))
            for k, block in enumerate(np.array_split(gradient.flat, _BLOCKS)):
                yield {"block": [k], "part": [TaskContext.get().partitionId()], "counts": [block.tobytes()]}

        return step

    schema = {"block": "int", "part": "int", "counts": "binary"}
    sums = emit_rows(docs, [text_column], work, schema)
    while True:
        folder = new_folder(spark, "gradient")
        sums.write.parquet(folder)
        sums = spark.read.parquet(folder)
        parts = (sums.agg(F.max("part")).first()[0] or 0) + 1
        if parts == 1:
            break
        grouped = sums.withColumn("next_part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("block", "next_part")
        sums = grouped.applyInPandas(_summed, "block int, part int, counts binary")
    rows = sorted((r["block"], r["counts"]) for r in sums.collect())  # the tables of fixed size, once
    flat = np.concatenate([np.frombuffer(c, np.int64) for _, c in rows]) if rows else None
    return Gradient(flat).stepped(Weights(vocabulary))


def score_texts(docs: DataFrame, training: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Log10 probabilities of whole texts under models of the ``training`` rows.

    Returns ``id_column``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (words independent, one added to all counts)
    and ``score`` (the maximum-entropy model), one row for each input row. The scores don't depend on how the rows are partitioned.

    Words outside the common ones have no bound, so their counts aren't sent out: texts are scored without them, and
    their counts come by a join on the word and a sum by text. Common words aren't in that join, so it has no hot word but
    one that training has hardly seen, which adaptive execution splits.

    A null text is empty and has one token, its end. Repeated rows stay and count twice in training, null ids stay, an
    empty table gives an empty result, without training rows all counts are 0; other columns are not read.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "word-counts")
    word_counts(training.select(text_column), text_column).write.parquet(folder)
    counts = spark.read.parquet(folder)
    n, v = (x or 0 for x in counts.agg(F.sum("c"), F.count("*")).first())
    common = counts.where(F.col("c") >= COMMON_SHARE * n).toArrow()
    vocabulary = Vocabulary(dict(zip(common.column(0).to_pylist(), common.column(1).to_pylist())), n, v)
    weights = train(training, vocabulary, text_column=text_column)
    shared = spark.sparkContext.broadcast((weights, vocabulary))  # at most 1 / COMMON_SHARE words

    def work():
        weights, vocabulary = shared.value
        tail, log_counts = np.log10(vocabulary.tail_total), np.log10(vocabulary.counts + 1.0)

        def step(part):
            batch = Batch(part[text_column], vocabulary)
            logs = log_counts[batch.place]
            chance = log_chances(weights, batch) / np.log(10)
            chance += np.where(batch.in_head, 0, logs - tail)
            begins, ends = np.searchsorted(batch.rare, [batch.starts, batch.starts + batch.sizes])
            rare = [batch.words[i].decode() for i in batch.rare.tolist()]
            by = lambda x: np.add.reduceat(x, batch.starts)
            return {
                "n_tokens": batch.sizes,
                "common": batch.sizes - (ends - begins),
                "logs": by(logs),
                "chance": by(chance),
                "rare": [rare[a:b] for a, b in zip(begins.tolist(), ends.tolist())],
            }

        return step

    scored = new_folder(spark, "scored-texts")
    numbered = docs.select(F.col(id_column).alias("id"), text_column, F.monotonically_increasing_id().alias("row"))
    added = {"n_tokens": "long", "common": "long", "logs": "double", "chance": "double", "rare": "array<string>"}
    # The row numbers are written, so they stay what they are when a task runs again.
    add_columns(numbered, ["id", "row"], [text_column], work, added).write.parquet(scored)
    texts = spark.read.parquet(scored)
    seen = counts.where(F.col("c") < COMMON_SHARE * n).select(F.col("word").cast("string").alias("word"), "c")
    rare = texts.select("row", F.explode("rare").alias("word")).join(seen, "word").groupBy("row").agg(F.count("*").alias("rare_known"), F.sum(F.log10(F.col("c") + 1)).alias("rare_logs"))
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    return texts.drop("rare").join(rare, "row", "left").select(
        F.col("id").alias(id_column),
        "n_tokens",
        (F.col("common") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + rare_logs - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("chance") + rare_logs).alias("score"),
    )
