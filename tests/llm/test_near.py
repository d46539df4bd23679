"""Near-duplicates, components, archives and the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from __spark_entry__ import queries
from tidemark.llm import simhash, warc
from tidemark.llm.components import connected_components
from tidemark.llm.queries import contaminated, op3_warc, op9_simhash
from tidemark.llm.simhash import cell_masks, fingerprint, near_duplicates, near_links


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, most=4):
    root = list(range(len(fps)))
    find = lambda x: x if root[x] == x else find(root[x])
    a = np.array(fps, dtype=np.uint64)
    for k in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a[k] ^ a[:k]) <= most):
            root[find(k)] = find(int(j))
    return [find(k) for k in range(len(fps))]


def test_fingerprint(texts):
    for text in [t for _, t, _ in texts] + ["A b", "one two three four", "one two three four five"]:
        assert fingerprint(text) % (1 << 64) == brute_fingerprint(text)


def test_every_near_pair_shares_a_cell():
    draw = random.Random(3)
    masks = [m % (1 << 64) for m in cell_masks()]
    counts = lambda x: sum(bin(x >> (2 * s) & 3).count("1") << (2 * s) for s in range(32))
    for _ in range(2000):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randint(0, 4)):
            b ^= 1 << bit
        assert any(counts(a) & m == counts(b) & m for m in masks)


def clusters(n_centres, n_each, seed=4):
    draw = random.Random(seed)
    out = set()
    for _ in range(n_centres):
        at = draw.getrandbits(64)
        for _ in range(n_each):
            out.add(at)
            for bit in draw.sample(range(64), draw.randint(1, 5)):
                at ^= 1 << bit
    return sorted(out)


@pytest.mark.parametrize("part", [2048, 16])
def test_links_connect_all_near_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    monkeypatch.setattr(simhash, "SMALL_CELL", 8)
    fps = clusters(12, 60) + [k for k in range(200)]
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = near_links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    found = {r.node: r.root for r in connected_components(links).collect()}
    want = brute_components(fps)
    own = [found.get(f, f) for f in signed]
    assert len(set(zip(own, want))) == len(set(own)) == len(set(want))


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(k, k + 1) for k in range(100, 400)] + [(5, 1000 + k) for k in range(50)] + [(7, 7)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert {found[k] for k in range(100, 401)} == {100}
    assert {found[1000 + k] for k in range(50)} == {5} and found[5] == 5


def test_near_duplicate_rows(docs, no_docs, texts, by_id):
    found = near_duplicates(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"] and found.count() == len(texts)
    rows = by_id(found)
    assert {rows[k][0].component_id for k in (2, 3, 4)} == {2} and {rows[k][0].fingerprint for k in (2, 3, 4)} == {0}
    assert [r.component_id for r in rows[7]] == [7, 7] and rows[10][0].component_id == 1
    assert near_duplicates(no_docs).count() == 0


def test_simhash_query(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    fps = [brute_fingerprint(t) for _, t in docs]
    root = brute_components(fps)
    least = {}
    for (i, _), r in zip(docs, root):
        least.setdefault(r, i)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in op9_simhash(spark, sf).collect()}
    assert found == {i: (f"{f:016x}", least[r]) for (i, _), f, r in zip(docs, fps, root)}


def brute_archive(pages):
    first = {}
    for i, html in sorted((i, h or "") for i, h in pages if i is not None):
        first.setdefault(html, i)
    for i, html in pages:
        html = html or ""
        again = i is not None and len(html.encode()) >= 100 and first[html] < i
        yield i, len(html.encode()), hashlib.sha256(html.encode()).hexdigest(), "revisit" if again else "response", first[html] if again else None


FALSE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def key(row):
    return tuple("" if x is None else str(x) for x in row)


@pytest.mark.parametrize("segment", [16 << 20, 700])
def test_archives(spark, monkeypatch, segment):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", segment)
    page = "<p>" + "é" * 200 + "</p>"
    pages = [(5, page), (3, page), (9, page), (1, "short"), (2, "short"), (4, None), (6, ""), (7, "x" + FALSE + "y"), (8, FALSE * 3), (None, page), (10, "a\r\n\r\nb\n"), (11, "long " * 5000), (3, page), (12, "WARC/1.1\r\n"), (13, FALSE[:30])]
    rows = spark.createDataFrame([(i, None if i == 1 else f"http://x/{i} WARC/1.1\r\n", h, 7) for i, h in pages], "page_id long, url string, html string, digest int")
    found = warc.archive_round_trip(rows.repartition(2))
    assert sorted(map(key, (r[:5] for r in found.collect()))) == sorted(map(key, brute_archive(pages)))
    assert all(r.intact for r in found.collect())


def test_archives_cut_into_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    pages = [(k, f"<p>{k}</p>" + (FALSE if k % 5 == 0 else "t") * (k % 40)) for k in range(300)]
    rows = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string").coalesce(1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        found = [r[:5] for r in warc.archive_round_trip(rows).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(key, found)) == sorted(map(key, brute_archive(pages)))


def test_no_pages(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_query(spark, sf):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(key, op3_warc(spark, sf).collect())) == sorted(map(key, brute_archive(pages)))


def test_stages_take_effect(spark, docs, sf):
    """Each stage on rows with all that can go wrong; the columns stay, decisions are the operator's."""
    out = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out[name] = stage(spark, docs, sf)
        assert out[name].columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert {r.doc_id for r in out["language_id"].collect()} & {2, 3, 4, 8} == set()
    stays = [r.doc_id for r in out["simhash_near_dedup"].collect()]
    assert stays.count(7) == 1 and stays.count(1) == 1 and 10 not in stays and stays.count(None) == 1
    assert "someone@example.com" not in " ".join(r.text or "" for r in out["pii"].collect())
    assert out["pii"].count() == docs.count()


def test_repeated_ids_keep_their_texts(spark):
    rows = [(7, "one two three four five"), (3, "one two three four five"), (7, "alpha beta gamma delta epsilon"), (None, "one two three four five"), (None, "lone text of its own")]
    want = {(3, "one two three four five"), (7, "alpha beta gamma delta epsilon"), (None, "lone text of its own")}
    for shift in range(len(rows)):
        for order in (rows[shift:] + rows[:shift], (rows[shift:] + rows[:shift])[::-1]):
            found = corpus_pipeline.remove_near_duplicates(spark, spark.createDataFrame(order, "doc_id long, text string"), "")
            assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
            if shift:
                break


def test_last_stage(spark, docs, texts, sf):
    name, encode = corpus_pipeline.STAGES[-1]
    found = encode(spark, docs, sf)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "ids"] and found.count() == len(texts)
    for row in found.collect():
        assert row.n_tokens == len(row.ids) and row.ids_sha256 == hashlib.sha256(",".join(map(str, row.ids)).encode()).hexdigest()
    assert [r.ids for r in found.where("doc_id IN (2, 3)").collect()] == [[], []]
    assert encode(spark, docs.limit(0), sf).count() == 0


def test_blocks_for_any_number_of_fingerprints():
    """Pairs that meet by chance, for each fingerprint, stay bounded while the fingerprints grow a millionfold."""
    for n in (10**5, 10**6, 10**7, 10**8, 10**9, 10**11):
        b = simhash.blocks_for(n)
        assert n * 0.375 ** (32 * (b - 4) / b) < 4
    assert simhash.blocks_for(10**5) == 7


@pytest.mark.parametrize("blocks", [5, 8, 12])
def test_every_near_pair_shares_a_cell_of_any_grid(blocks):
    draw = random.Random(blocks)
    masks = [m % (1 << 64) for m in cell_masks(blocks)]
    counts = lambda x: sum(bin(x >> (2 * s) & 3).count("1") << (2 * s) for s in range(32))
    for _ in range(200):
        a = draw.getrandbits(64)
        b = a ^ sum(1 << bit for bit in draw.sample(range(64), 4))
        assert any(counts(a) & m == counts(b) & m for m in masks)


def test_pipeline(spark, sf):
    """The pipeline's rows are what its stages' decisions leave, worked out from the operators' own results."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {r.doc_id: r for r in queries()["pipeline"](spark, sf).collect()}
    kept = {r.doc_id: r.text for r in corpus_pipeline.identify(spark, docs, sf).collect()}
    order = sorted(kept)
    root = brute_components([brute_fingerprint(kept[i]) for i in order])
    first = {}
    for i, r in zip(order, root):
        first.setdefault(r, i)
    hits = corpus_pipeline.benchmark_hits(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
    dirty = {r.doc_id for r in hits.where(contaminated()).collect()}
    assert set(found) == set(first.values()) - dirty
    assert all(r.n_tokens == len(r.ids) and r.n_tokens > 0 for r in found.values())
