import re
from collections import Counter

from tidemark.llm.quality import MEASURES, RULES, Document, Estimate, cascade_order, estimate, quality_cascade
from tidemark.llm.queries import op1_quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    repeated = sum(1 for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:k])
    often = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    inside = {k + j for k in range(len(words) - 4) if often[tuple(words[k : k + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside)


def test_measures(texts):
    more = ["a b c d e a b c d e f", "x y\nx y\n\n \n", "one two three four five six one two three four five", "#|<> & 100%", "a\x0bb\x0cc\xa0d\x1ce"]
    for text in [t for _, t, _ in texts if t is None or len(t) < 30_000] + more:
        d = Document(text)
        assert (d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words) == brute(text)


def test_order_changes_the_cost_and_not_the_verdict(docs):
    names = [r.name for r in RULES]
    one = quality_cascade(docs, order=names)
    other = quality_cascade(docs, order=names[::-1])
    key = lambda r: (str(r.doc_id), r.kept)
    assert sorted(map(key, one.collect())) == sorted(map(key, other.collect()))


def test_short_circuit():
    d = Document("too few")
    assert next(r.name for r in RULES if r.rejects(d)) == "few_words"
    assert "n_repeat_words" not in vars(d) and "lines" not in vars(d)


def test_most_rejections_per_cost_first(docs, no_docs):
    assert cascade_order([Estimate("a", 1e-3, 0.1), Estimate("b", 1e-5, 0.01), Estimate("c", 1e-6, 0.0)]) == ["b", "a", "c"]
    found = estimate(docs, sample_rows=10_000)
    assert [e.rule for e in found] == [r.name for r in RULES]
    assert all(0 <= e.rejected <= 1 for e in found) and found[0].rejected > 0
    assert cascade_order(estimate(no_docs))


def test_rows(docs, no_docs, texts, by_id):
    found = quality_cascade(docs, measures=MEASURES)
    assert found.count() == len(texts)
    rows = by_id(found)
    assert rows[1][0].kept and rows[7][1].kept
    assert not any(rows[k][0].kept for k in (2, 3, 4, 6, 8))
    assert quality_cascade(no_docs).count() == 0


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op1_quality_rules(spark, sf).collect():
        want = brute(docs[r.doc_id])
        assert tuple(r[c] for c in MEASURES) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not any(rule.rejects(Document(docs[r.doc_id])) for rule in RULES))
