"""Importance resampling towards a target, over hashed words and word pairs with a head-tail vocabulary."""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain, repeat
from zlib import crc32

import numpy as np
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import add_columns, emit_rows
from tidemark.llm.decontaminate import words
from tidemark.operators.ranking import with_position
from tidemark.shared import new_folder

BUCKETS = 10_000
#: Words and pairs with at least this share of all words make up the head, so there are at most its inverse of each.
HEAD_SHARE = 2.0**-16
#: Counts that a profiling task holds before it passes them on.
HELD_COUNTS = 200_000
#: Text that is turned into arrays at once.
SLICE_BYTES = 2 << 20


class HeadVocabulary:
    """Frequent words with their CRC states, and frequent pairs of them with their buckets.

    It only saves work: every bucket is that of the feature's CRC, whether the head holds the feature or not.
    """

    def __init__(self, frequent: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int):
        self.place = {w: k for k, w in enumerate(frequent)}
        self.buckets = buckets
        self.word = np.array([crc32(w) for w in frequent], dtype=np.int64)
        self.state = np.array([crc32(b" ", crc32(w)) for w in frequent], dtype=np.int64)
        known = sorted((self.place[a] * len(frequent) + self.place[b], crc32(a + b" " + b) % buckets) for a, b in pairs if a in self.place and b in self.place)
        self.pair = np.array([k for k, _ in known] or [-1], dtype=np.int64)
        self.pair_bucket = np.array([b for _, b in known] or [0], dtype=np.int64)

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of words of each text, and the buckets of all words and pairs, each with the number of its text."""
        cut = [words(t) for t in texts]
        sizes = np.array([len(w) for w in cut], dtype=np.int64)
        flat = list(chain.from_iterable(cut))
        owner = np.repeat(np.arange(len(texts)), sizes)
        place = np.fromiter(map(self.place.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        crc = self.word[place] if len(self.word) else np.zeros(len(flat), dtype=np.int64)
        tail = np.flatnonzero(place < 0)
        crc[tail] = np.fromiter((crc32(flat[i]) for i in tail.tolist()), dtype=np.int64, count=len(tail))
        left = np.flatnonzero(owner[1:] == owner[:-1])
        key = np.where((place[left] >= 0) & (place[left + 1] >= 0), place[left] * len(self.word) + place[left + 1], -2)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        pair, known = self.pair_bucket[at], self.pair[at] == key
        rest = left[~known]
        state = self.state[place[rest]] if len(self.state) else np.zeros(len(rest), dtype=np.int64)
        no_state = np.flatnonzero(place[rest] < 0)
        state[no_state] = list(map(crc32, repeat(b" "), crc[rest[no_state]].tolist()))
        after = [flat[i + 1] for i in rest.tolist()]
        pair[~known] = np.fromiter(map(crc32, after, state.tolist()), dtype=np.int64, count=len(rest)) % self.buckets
        return sizes, np.concatenate([crc % self.buckets, pair]), np.concatenate([owner, owner[left]])


def _frequent(texts: list[str | None], share: float) -> tuple[int, Counter]:
    """Number of words of a slice, and how often the words and pairs with at least ``share`` of them occur."""
    cut = [words(t) for t in texts]
    flat = list(chain.from_iterable(cut))
    seen = Counter(flat)
    least = share * len(flat)
    found = Counter({(w, None): n for w, n in seen.items() if n >= least})
    place = {w: k for k, w in enumerate(seen)}
    number = np.fromiter(map(place.__getitem__, flat), dtype=np.int64, count=len(flat))
    owner = np.repeat(np.arange(len(cut)), [len(w) for w in cut])
    left = np.flatnonzero(owner[1:] == owner[:-1])
    keys, counts = np.unique(number[left] * len(seen) + number[left + 1], return_counts=True)
    names = list(seen)
    often = counts >= least
    for key, n in zip(keys[often].tolist(), counts[often].tolist()):
        found[names[key // len(seen)], names[key % len(seen)]] = n
    return len(flat), found


def head_vocabulary(docs: DataFrame, *, text_column: str = "text", buckets: int = BUCKETS, share: float = HEAD_SHARE) -> HeadVocabulary:
    """The head of all whole texts.

    What has ``share`` of all words has it in some slice of text, so a task passes on what is frequent in a slice, at most
    ``1 / share`` words and pairs of each. These counts are lower bounds and sum to the number of words at most; the same
    limit on their sums keeps at most ``1 / share`` of each kind, whatever the table's size.
    """

    def work():
        def step(parts):
            held, total = Counter(), 0

            def out():
                return {"a": [a for a, _ in held], "b": [b for _, b in held], "n": list(held.values())}

            for part in parts:
                n, found = _frequent(part[text_column], share)
                held.update(found)
                total += n
                if len(held) > HELD_COUNTS:
                    yield out()
                    held.clear()
            held[None, None] = total
            yield out()

        return step

    folder = new_folder(docs.sparkSession, "frequent-words")
    emitted = emit_rows(docs, [text_column], work, {"a": "binary", "b": "binary", "n": "long"})
    emitted.groupBy("a", "b").agg(F.sum("n").alias("n")).write.parquet(folder)
    counts = docs.sparkSession.read.parquet(folder)
    total = counts.where("a IS NULL").agg(F.sum("n")).first()[0] or 0
    kept = counts.where(F.col("a").isNotNull() & (F.col("n") >= share * total)).select("a", "b").toArrow()
    rows = sorted(zip(kept.column("a").to_pylist(), kept.column("b").to_pylist()), key=lambda r: (r[0], r[1] or b""))
    return HeadVocabulary([a for a, b in rows if b is None], [(a, b) for a, b in rows if b is not None], buckets)


def bucket_totals(docs: DataFrame, head: Broadcast, *, text_column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all whole texts fall into each bucket; tasks count first."""

    def work():
        known = head.value

        def step(parts):
            total = np.zeros(buckets, dtype=np.int64)
            for part in parts:
                total += np.bincount(known.features(part[text_column])[1], minlength=buckets)
            some = np.flatnonzero(total)
            yield {"bucket": some, "n": total[some]}

        return step

    out = np.zeros(buckets, dtype=np.int64)
    emitted = emit_rows(docs, [text_column], work, {"bucket": "long", "n": "long"})
    for bucket, n in emitted.groupBy("bucket").agg(F.sum("n")).collect():  # at most one row a bucket
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    n, total, wanted = len(source), float(source.sum() + len(source)), float(target.sum() + len(source))
    logs = [math.log((t + 1.0) * total / ((s + 1.0) * wanted)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * x) for x in logs], dtype=np.int64).reshape(n)


def gumbel_noise(id_column: str, seed: int) -> Column:
    """Thousandths of a Gumbel variable that the id fixes; a null id counts as an empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", target_text_column: str = "text", percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS, head_share: float = HEAD_SHARE
) -> DataFrame:
    """Draw documents whose words and word pairs are distributed as those of ``target``.

    ``weight`` is the mean gain of a document's features, ``score`` adds Gumbel noise fixed by the id, and the ``percent`` of the
    documents with ``least_words`` or more that score highest are drawn: ``rank`` 1, 2, 3, ..., null for all others. Equal scores
    go by the smaller id, null ids last; rows alike in both are ranked by weight, number of features, and then at random.

    Three passes over whole texts: frequent words and pairs, exact bucket totals, weights. Of the corpus the driver gets the head
    (bounded by ``head_share``) and one number a bucket. The ranks come from a range shuffle and one count for each partition.

    Returns the id, ``n_features``, ``weight``, ``score``, ``rank``, one row for each input row. A null or empty text has no features
    and weight 0; a very long one costs time and memory in proportion, in one task. Repeated rows stay and count each
    time. An empty target or an empty table gives the gains of no features on that side. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    wanted = target.select(F.col(target_text_column).alias("text"))
    head = spark.sparkContext.broadcast(head_vocabulary(texts, buckets=buckets, share=head_share))  # at most 1 / head_share words and pairs
    gains = bucket_gains(bucket_totals(texts, head, buckets=buckets), bucket_totals(wanted, head, buckets=buckets))
    shared = spark.sparkContext.broadcast(gains)

    def work():
        known, gain = head.value, shared.value

        def step(part):
            sizes, bucket, owner = known.features(part["text"])
            n_features = np.maximum(2 * sizes - 1, 0)
            total = np.zeros(len(sizes), dtype=np.int64)
            np.add.at(total, owner, gain[bucket])
            return {"n_features": n_features, "weight": total // np.maximum(n_features, 1)}

        return step

    folder = new_folder(spark, "resampling-weights")
    add_columns(texts, ["id"], ["text"], work, {"n_features": "long", "weight": "long"}, SLICE_BYTES).write.parquet(folder)
    weighed = spark.read.parquet(folder).withColumn("score", F.col("weight") + gumbel_noise("id", seed))
    may = F.col("n_features") >= 2 * least_words - 1
    drawn = weighed.where(may).count() * percent // 100
    best = weighed.where(may).select("*", (-F.col("score")).alias("_down"), F.col("id").isNull().alias("_no_id"))
    placed = with_position(best, ["_down", "_no_id", "id", "weight", "n_features"], copies=True)
    ranked = placed.withColumn("rank", F.when(F.col("position") <= drawn, F.col("position")))
    out = ["n_features", "weight", "score", "rank"]
    others = weighed.where(~may).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select("id", *out).unionByName(others.select("id", *out)).withColumnRenamed("id", id_column)
