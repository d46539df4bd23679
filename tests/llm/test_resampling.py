"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib

import pytest

from tidemark.llm.queries import op13_importance_resampling
from tidemark.llm.resampling import HeadVocabulary, resample


def brute_words(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_features(text):
    words = brute_words(text)
    return words + [a + b" " + b for a, b in zip(words, words[1:])]


def brute(docs, target, percent=25, least=20, buckets=10_000):
    totals = []
    for texts in ([t for _, t in docs], target):
        total = [0] * buckets
        for text in texts:
            for feature in brute_features(text):
                total[zlib.crc32(feature) % buckets] += 1
        totals.append(total)
    s, t = totals
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        found = brute_features(text)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = [r for r in rows if r[1] >= 2 * least - 1]
    may.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for rank, row in enumerate(may[: percent * len(may) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, rows), key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    frame = op13_importance_resampling(spark, sf)
    assert frame.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got(frame) == brute(docs, target)


@pytest.mark.parametrize("share", [2.0**-16, 0.01, 2.0])
def test_head_changes_nothing(spark, docs, texts, share):
    rows = [(i, t) for i, t, _ in texts]
    found = resample(docs, docs.limit(1), percent=60, least_words=3, head_share=share)
    assert got(found) == brute(rows, [docs.limit(1).first().text], percent=60, least=3)


def test_features_without_head(texts):
    for head in (HeadVocabulary([], [], 97), HeadVocabulary([b"the"], [(b"the", b"the"), (b"the", b"lazy")], 97)):
        sizes, bucket, owner = head.features([t for _, t, _ in texts])
        for k, (_, text, _) in enumerate(texts):
            assert sizes[k] == len(brute_words(text))
            assert sorted(bucket[owner == k].tolist()) == sorted(zlib.crc32(f) % 97 for f in brute_features(text))


def test_ties_repeated_rows_and_empty_tables(spark, docs, no_docs):
    text = " ".join(f"w{k}" for k in range(25))
    same = spark.createDataFrame([(3, text)] * 5 + [(None, text)] * 3, "doc_id long, text string")
    rows = resample(same, docs, percent=50).collect()
    assert sorted(r.rank for r in rows if r.rank) == [1, 2, 3, 4]
    assert got(resample(same, no_docs, percent=50)) == brute([(3, text)] * 5 + [(None, text)] * 3, [], percent=50)
    assert resample(no_docs, docs).count() == 0
