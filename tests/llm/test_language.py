"""Language identification and language model scores."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import language_model as lm
from tidemark.llm.language_id import identify_language, train_language_model
from tidemark.llm.queries import in_fold, op2_language_id, op5_language_model

SF = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op2_language_id(spark, SF).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if fold(i, 3) == 1}
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    assert sum(r.rejected for r in found) <= 0.01 * len(found)


def test_training_ignores_the_held_out_fold(docs, spark):
    small = spark.createDataFrame([(i, f"wort haus baum {i}", "de" if i % 2 else "xx") for i in range(60)] + [(None, "nie gelernt", "qq")], "doc_id long, text string, lang string")
    model = train_language_model(small.where(~in_fold(3, 1)))
    assert model.languages == ["de", "xx"]


def test_numerals_are_no_letters(spark, docs):
    rows = spark.createDataFrame([(1, "½ ² ①"), (2, "Ⅷ 12"), (3, "½ a"), (4, "日")], "doc_id long, text string")
    found = {r.doc_id: r for r in identify_language(rows, train_language_model(docs)).collect()}
    assert [(found[k].lang_pred, found[k].score) for k in (1, 2)] == [("und", 0.0)] * 2
    assert found[3].lang_pred != "und" and found[4].lang_pred != "und"


def test_undetermined_rows(docs, no_docs, texts, by_id):
    model = train_language_model(docs)
    found = by_id(identify_language(docs, model))
    for k in (2, 3, 4, 8):
        assert (found[k][0].lang_pred, found[k][0].score, found[k][0].rejected) == ("und", 0.0, True)
    assert found[7][0] == found[7][1] and len(found[None]) == 2
    assert identify_language(no_docs, model).count() == 0
    untrained = train_language_model(no_docs)
    assert {r.lang_pred for r in identify_language(docs, untrained).collect()} == {"und"}


def brute_base(rows, training):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""]
    count = Counter(w for t in training for w in words(t))
    n, v = sum(count.values()), len(count)
    for t in rows:
        ws = words(t)
        yield len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)


def test_base_scores_and_a_better_model(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = sorted(op5_language_model(spark, SF).collect(), key=lambda r: r.doc_id)
    want = brute_base([docs[r.doc_id] for r in found], [t for i, t in docs.items() if fold(i, 7) != 2])
    for r, (n_tokens, n_known, n, base) in zip(found, want):
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n_tokens, n_known, n, fold(r.doc_id, 7) == 2)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_come_by_the_join(docs, monkeypatch, by_id, texts):
    monkeypatch.setattr(lm, "COMMON_SHARE", 0.01)
    found = sorted(lm.score_texts(docs, docs).collect(), key=lambda r: r.base_score)
    want = sorted(brute_base([t for _, t, _ in texts], [t for _, t, _ in texts]), key=lambda x: x[3])
    for r, (n_tokens, n_known, n, base) in zip(found, want):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def brute_scores(texts, training, rate=lm.RATE, damping=lm.DAMPING):
    """The model by dictionaries: hashed rows of features, damped log ratios of observed to expected counts, softmax by classes."""
    words = lambda t: [w.encode() for w in (t or "").lower().split()] + [b""]
    count = Counter(w for t in training for w in words(t))
    n, v = sum(count.values()), len(count)
    order = sorted(count, key=lambda w: (-count[w], w))
    head = order[: lm.CLASSES * lm.CLASS_WORDS]
    place = {w: divmod(k, lm.CLASS_WORDS) for k, w in enumerate(head)}
    mass = Counter()
    for w in head:
        mass[place[w][0]] += count[w]
    tail = n - sum(mass.values()) + v - len(head) + 1
    mass[lm.CLASSES] = tail
    class_chance = {c: m / sum(mass.values()) for c, m in mass.items()}
    word_chance = {c: {} for c in mass}
    for w in head:
        word_chance[place[w][0]][place[w][1]] = count[w] / mass[place[w][0]]
    mask = (1 << 64) - 1

    def mix(a, salt):
        a = ((a ^ salt) * 0x9E3779B97F4A7C15) & mask
        return a ^ (a >> 29)

    def rows(ws, i):
        one = zlib.crc32(ws[i - 1]) if i else 0x5BD1E995
        two = zlib.crc32(ws[i - 2]) if i > 1 else 0x5BD1E995
        return [mix(one, 1), mix((one * 31 & mask) ^ mix(two, 2), 3), mix(two, 4)]

    def word_rows(features, c):
        return [mix(f ^ (c << 40), 5) % lm.WORD_ROWS for f in features]

    seen_class, seen_word, seen_row_class = Counter(), Counter(), Counter()
    for t in training:
        ws = words(t)
        for i, w in enumerate(ws):
            c, k = place.get(w, (lm.CLASSES, 0))
            for f in rows(ws, i):
                seen_class[f % lm.CLASS_ROWS, c] += 1
            if c < lm.CLASSES:
                for r in word_rows(rows(ws, i), c):
                    seen_word[r, k] += 1
                    seen_row_class[r, c] += 1
    out = []
    for t in texts:
        ws, total = words(t), 0.0
        for i, w in enumerate(ws):
            c, k = place.get(w, (lm.CLASSES, 0))
            features = rows(ws, i)
            weight = {x: math.log(p) for x, p in class_chance.items() if p}
            for f in features:
                r = f % lm.CLASS_ROWS
                tokens = sum(seen_class[r, x] for x in class_chance)
                for x, p in class_chance.items():
                    weight[x] += rate * math.log((seen_class[r, x] + damping * p) / ((tokens + damping) * p))
            total += weight[c] - math.log(sum(map(math.exp, weight.values())))
            if c == lm.CLASSES:
                total += math.log((count[w] + 1) / tail)
                continue
            weight = {x: math.log(p) for x, p in word_chance[c].items()}
            for r in word_rows(features, c):
                tokens = sum(seen_row_class[r, x] for x in class_chance)
                for x in weight:
                    p = sum(seen_row_class[r, y] * word_chance[y].get(x, 0) for y in class_chance) / max(tokens, 1)
                    if p:
                        weight[x] += rate * math.log((seen_word[r, x] + damping * p) / ((tokens + damping) * p))
            total += weight[k] - math.log(sum(map(math.exp, weight.values())))
        out.append(total / math.log(10))
    return out


def test_scores_equal_brute_force(spark, monkeypatch):
    texts = ["the cat sat on the mat", "The dog sat on the cat", "a mat a cat a dog", "", None, "the the the", "unseen words here", "on the mat the dog sat"] * 2
    monkeypatch.setattr(lm, "COMMON_SHARE", 0.0)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.score for r in lm.score_texts(rows, rows.where("doc_id < 6")).collect()}
    want = brute_scores(texts, texts[:6])
    assert [found[k] for k in range(len(texts))] == pytest.approx(want, rel=1e-4)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    monkeypatch.setattr(lm, "FAN_IN", 4)
    runs = []
    for parts in (1, 16, 64):
        rows = docs.repartition(parts)
        runs.append({r.doc_id: r for r in lm.score_texts(rows, rows.where("doc_id % 5 <> 0")).collect()})
    for other in runs[1:]:
        assert all(other[i].score == pytest.approx(r.score, rel=1e-6) for i, r in runs[0].items())
    held = [r for i, r in runs[2].items() if i % 5 == 0]
    tokens = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / tokens > sum(r.base_score for r in held) / tokens + 0.05


def test_chances_sum_to_one():
    count = Counter({f"w{k}".encode(): 50 - k for k in range(40)} | {lm.END: 9})
    vocabulary = lm.Vocabulary(dict(count), sum(count.values()) + 5, len(count) + 3)
    gradient = lm.Gradient()
    gradient.learn(lm.Batch(["w1 w2 w3 w1 w2 rare"] * 20, vocabulary))
    weights = gradient.stepped(lm.Weights(vocabulary))
    total = 0.0
    for word in [*list(count), b"other"]:
        text = "w1 w2 " + word.decode() if word != lm.END else "w1 w2"
        batch = lm.Batch([text], vocabulary)
        total += np.exp(lm.log_chances(weights, batch)[2])
    assert total == pytest.approx(1, abs=1e-4)


def test_no_rows_and_no_training(docs, no_docs, texts):
    assert lm.score_texts(no_docs, docs).count() == 0
    found = lm.score_texts(docs, no_docs).collect()
    assert len(found) == len(texts)
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in found)
