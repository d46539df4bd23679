"""Decontamination, licenses and personal data against plain versions."""

import hashlib
import random
import re

import pytest

from tidemark.llm import decontaminate
from tidemark.llm.decontaminate import Benchmark, benchmark_hits, words
from tidemark.llm.licenses import GRANTS, NAMES, SENTENCES, Recognizer, recognizer, scan_licenses
from tidemark.llm import pii
from tidemark.llm.batches import add_columns
from tidemark.llm.pii import all_spans, base_spans, find_personal_data, luhn, redact, score_patterns, trusted_patterns
from tidemark.llm.queries import op6_decontamination, op7_license_scan, op8_pii


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items):
    text, hit, found = brute_words(text), set(), set()
    for item, content in items:
        ws = brute_words(content)
        size = min(13, len(ws))
        for k in range(len(ws) - size + 1 if ws else 0):
            for at in range(len(text) - size + 1):
                if text[at : at + size] == ws[k : k + size]:
                    hit |= set(range(at, at + size))
                    found.add(item)
    return len(text), len(hit), found


def test_search_equals_brute_force():
    draw = random.Random(1)
    for _ in range(60):
        pool = [f"w{k}" for k in range(draw.choice([2, 5, 40]))]
        some = lambda n: " ".join(draw.choice(pool) for _ in range(n))
        items = [(k, some(draw.choice([0, 1, 2, 3, 6, 12, 13, 14, 30]))) for k in range(6)]
        text = some(60) + " " + draw.choice(items)[1] + " " + some(20)
        found, (n, n_hit, hit_items) = Benchmark(items).find(words(text)), brute_hits(text, items)
        assert (sum(b - a for a, b in found[0]), found[1]) == (n_hit, hit_items)


def test_words(texts):
    for _, text, _ in texts:
        assert [w.decode() for w in words(text)] == brute_words(text)


@pytest.mark.parametrize("part", [2 << 20, 40])
def test_rows(spark, docs, no_docs, texts, monkeypatch, part):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part)
    items = [(1, "lazy dog"), (2, "the QUICK brown fox jumps over the lazy dog and runs far away"), (3, None), (4, " "), (None, "faulen Hund"), (1, "lazy dog")]
    found = benchmark_hits(docs, spark.createDataFrame(items, "item_id long, text string"))
    want = []
    for i, t, _ in texts:
        n, hit, got = brute_hits(t, items)
        want.append((str(i), n, hit, sorted(x for x in got if x is not None)))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.hit_items) for r in found.collect()) == sorted(want)
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in benchmark_hits(docs, none).collect()} == {0}
    assert benchmark_hits(no_docs, none).count() == 0


def test_decontamination_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    windows = {}
    for item, text in items:
        ws = brute_words(text)
        for k in range(max(1, len(ws) - 12) if ws else 0):
            windows.setdefault(tuple(ws[k : k + 13]), set()).add(item)
    for r in op6_decontamination(spark, sf).collect():
        text, hit, found = brute_words(docs[r.doc_id]), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(text) - size + 1):
                if (got := windows.get(tuple(text[k : k + size]))) is not None:
                    found |= got
                    hit |= set(range(k, k + size))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(text), len(hit), len(found), digest)
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(text))


def test_license_rules():
    known = recognizer()
    scan = lambda t: known.licenses([n for n, _ in known.sequence(t)])
    assert scan("Foo bar.\nReleased under the MIT License.\nMore text.") == ["MIT"]
    assert scan("licensed under the   Apache License, version 2.0. Released under the MIT License.") == ["Apache-2.0", "MIT"]
    assert scan(SENTENCES["mit-grant"]) == []
    assert scan(SENTENCES["mit-condition"] + "\n" + SENTENCES["mit-grant"]) == []
    assert scan(SENTENCES["mit-grant"] + "\n\n" + SENTENCES["mit-condition"]) == ["MIT"]
    bsd = [SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")]
    assert scan("\n".join(f"{k}. {s}" for k, s in enumerate(bsd))) == ["BSD-3-Clause"]
    assert scan(" ".join(bsd[:3])) == ["BSD-2-Clause"]
    assert scan("The license of this is unknown. MIT is a university.") == []


@pytest.mark.parametrize("spdx", sorted(NAMES))
def test_names_in_running_prose(spdx):
    known = recognizer()
    scan = lambda t: known.licenses([n for n, _ in known.sequence(t)])
    for k, name in enumerate(NAMES[spdx]):
        grant = GRANTS[k % len(GRANTS)]
        assert scan(f"As you know, this project is {grant} the {name}, which we like.\nMore text follows here.") == [spdx]
        assert scan(f"They {grant}\n   the terms of the\n {name} have it.") == [spdx]
        assert scan(f"We once wrote about the {name} in a letter.") == []
    assert scan(f"# SPDX-License-Identifier: {spdx}\nimport os") == [spdx]


def test_spdx_expressions():
    known = recognizer()
    scan = lambda t: known.licenses([n for n, _ in known.sequence(t)])
    assert scan("/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR MIT */") == ["GPL-2.0-only", "Linux-syscall-note", "MIT"]
    assert scan("The SPDX list is long. MIT is on it.") == []


def test_licenses_by_place():
    """A shorter license gives way to a longer one only where its sentences are the same ones."""
    known = recognizer()
    scan = lambda t: known.licenses([n for n, _ in known.sequence(t)])
    two = "\n".join(SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary"))
    three = two + "\n3. " + SENTENCES["bsd-names"]
    assert scan(two) == ["BSD-2-Clause"] and scan(three) == ["BSD-3-Clause"]
    for text in (two + "\n\n" + three, three + "\n\nother words\n\n" + two):
        assert scan(text) == ["BSD-2-Clause", "BSD-3-Clause"]
    assert scan("This library is free software; " + SENTENCES["lgpl21-terms"]) == ["LGPL-2.1-or-later"]
    assert scan(SENTENCES["zlib-warranty"] + " In no event. " + SENTENCES["zlib-grant"]) == ["Zlib"]


def test_license_hint_drops_nothing():
    known = recognizer()
    everything = Recognizer(SENTENCES, [])
    everything.hint = re.compile("")
    for text in [*SENTENCES.values(), "x. " + " ".join(SENTENCES.values())]:
        assert known.sequence(text) == everything.sequence(text)
        assert known.sequence(text)


def test_license_rows(spark, docs, no_docs, texts, sf):
    assert scan_licenses(docs).count() == len(texts)
    assert scan_licenses(no_docs).count() == 0
    lines = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    found = {r.doc_id: r.licenses for r in op7_license_scan(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        assert found[r.doc_id] == ",".join(sorted({v for k, v in lines.items() if k in r.text.split("\n")}))


def brute_spans(text):
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], ["email", "ip", "card", "phone"].index(s[0])))


def test_base_spans_equal_the_plain_expressions(texts):
    draw = random.Random(2)
    drawn = ["".join(draw.choice("ab1029.@@-+ ()é_") for _ in range(draw.randint(5, 80))) for _ in range(4000)]
    drawn += ["a@b.c_d@e.f", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "0000001.2.3.4", "001.02.3.0004", "+1 (555) 010-9999."]
    for text in drawn + [t for _, t, _ in texts]:
        assert base_spans(text or "") == brute_spans(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "@" * 300_000, "a.b-" * 80_000, "+1" * 100_000, "1." * 100_000):
        all_spans(text, frozenset())


def test_patterns_find_unseen_identifiers(spark):
    known = [(k, f'text before badge = "{"%016x" % (0xAB12CD34EF << 24 | k * 7919)}" and after') for k in range(40)]
    fresh = [(100, "the badge = KUNDE-77231 is new"), (101, "the sum = ORDER-77231 is not")]
    rows = spark.createDataFrame(known + fresh, "doc_id long, text string")
    assert [r.pattern for r in trusted_patterns(rows).collect()] == ["name badge"]
    found = {r.doc_id: r for r in find_personal_data(rows).collect()}
    assert found[100].redacted == "the badge = <ID> is new"
    assert found[101].spans == []


def test_identifiers_of_any_length(spark):
    known = [(k, f'badge = "{"%016x" % (0xAB12CD34EF << 24 | k * 7919)}"') for k in range(60)]
    sizes = [4, 7, 8, 128, 129, 4_000, 100_000]
    fresh = [(100 + n, 'the badge = "' + ("K123" * n)[:n] + '" is new') for n in sizes]
    hexes = [(200_000 + n, "see " + ("a1" * n)[:n] + " there") for n in (16, 128, 129, 100_000)]
    rows = spark.createDataFrame(known + fresh + hexes, "doc_id long, text string")
    found = {r.doc_id: r for r in find_personal_data(rows).collect()}
    assert all(found[100 + n].redacted == 'the badge = "<ID>" is new' for n in sizes)
    assert all(found[i].redacted == "see <ID> there" for i, _ in hexes)


def test_trust_at_any_corpus_size(spark, monkeypatch):
    """A pattern seen nine times is trusted among thousands of others, and joined ones give what broadcast ones give."""
    rare = [(k, f"staff code {'%016x' % (0xAB12CD34EF << 24 | k * 7919)} here") for k in range(9)]
    common = [(1000 + k, f"of the {'%016x' % (0xCD12CD34EF << 24 | k * 7919)} here") for k in range(5)]
    prose = [(5000 + k, "one of the many of the words of the text " * 3 + f"in room {k}77") for k in range(300)]
    fresh = [(9000, "his staff code ORDER-77231 and of the ORDER-77231")]
    rows = spark.createDataFrame(rare + common + prose + fresh, "doc_id long, text string")
    whole = {r.doc_id: r for r in find_personal_data(rows, keep=["doc_id", "text"]).collect()}
    assert whole[9000].redacted == "his staff code <ID> and of the ORDER-77231"
    assert all(whole[i].redacted == whole[i].text for i, _ in prose)
    monkeypatch.setattr(pii, "BROADCAST_BYTES", -1)
    assert {r.doc_id: r for r in find_personal_data(rows, keep=["doc_id", "text"]).collect()} == whole


def test_contexts():
    text = 'api_key = "x" one two\nthree four, 5 six'
    contexts = pii.Contexts(text)
    assert contexts.before(text.index("x")) == "name api_key"
    assert contexts.before(text.index("two") + 1) == "words one t"
    assert contexts.before(text.index("four")) is None
    assert contexts.before(text.index("5")) == "words three four"
    assert pii.name_before("a=1", 2) is None and pii.name_before("=1", 1) is None and pii.name_before("1", 0) is None


def test_scores_spread_over_the_graph(spark):
    edges = [("p", i, True, 5) for i in range(20)] + [("p", 100 + i, False, 1) for i in range(4)] + [("q", 100 + i, False, 10) for i in range(4)] + [("r", 900, False, 3)]
    scores = {r.pattern: r.score for r in score_patterns(spark.createDataFrame(edges, "pattern string, instance long, seed boolean, n long")).collect()}
    assert scores["p"] > 0.9 and scores["q"] > 0.7 and scores["r"] == 0


def test_redact():
    assert redact("call +1 2 now", [("phone", 5, 9)]) == "call <PHONE> now"
    assert redact("abcdef", [("ip", 1, 4), ("card", 2, 5)]) == "a<IP>f"
    assert redact(None, []) is None and redact("", []) == ""


def test_personal_data_rows(spark, docs, no_docs, texts, by_id, sf):
    found = by_id(find_personal_data(docs))
    assert found[2][0].spans == [] and found[2][0].redacted is None and found[3][0].redacted == ""
    assert [s.kind for s in next(r for r in found[None] if r.redacted).spans] == ["email", "phone"]
    assert find_personal_data(no_docs).count() == 0
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op8_pii(spark, sf).collect():
        want = brute_spans(text[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in want) for k in ("email", "ip", "card", "phone"))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(filter(None, r.spans.split(",")))


def test_text_item_ids(spark, docs):
    bench = spark.createDataFrame([("b-2", "the quick brown fox"), ("a", "lazy dog"), (None, "over the")], "item_id string, text string")
    found = {r.doc_id: r for r in benchmark_hits(docs.where("doc_id = 1"), bench).collect()}
    assert found[1].hit_items == ["a", "b-2"] and found[1].n_hit == 8


def test_invalid_utf8(spark):
    rows = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    assert op_texts(rows) == ["a\ufffdb"]


def op_texts(rows):
    return [r.back for r in add_columns(rows, ["doc_id"], ["text"], lambda: lambda part: {"back": part["text"]}, {"back": "string"}).collect()]
