"""Token counts and BPE against the libraries whose files they read."""

import base64
import hashlib
import random
import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe
from tidemark.llm.bpe import SHORT, ByteVocabulary, bpe_decode, bpe_encode
from tidemark.llm.queries import op4_token_counts, op10_bpe
from tidemark.llm.token_counts import CACHED_CHARS, TokenCounter, token_counts

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "abcdeinorst    \n\t.,'éß日😀12|<>▁\xa0\x1c"
HARD = ["", " ", " " * 777 + "a", "a" + " " * 333, "ab" * 3000, "<|endoftext|>a<|endoftext|>", "it's I'LL we've", "é 日本語 😀 ١٢", "<s> <unk> <0x0A>", "▁a▁▁b", "\x00", "aaaa" * 200]


@pytest.fixture(scope="module")
def pieces():
    return TokenCounter(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def letters():
    return ByteVocabulary(BYTES), Tokenizer.from_file(BYTES)


def drawn(n, size, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(1, size))) for _ in range(n)]


def test_counts_equal_the_library(pieces):
    count, library = pieces
    texts = HARD + drawn(3000, 60) + drawn(3, 9000)
    assert count(texts) == [len(x) for x in library.encode(texts)]


def test_ids_equal_the_library(letters):
    own, library = letters
    texts = HARD + drawn(3000, 60) + drawn(3, 9000)
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [own.encode(t) for t in texts] == want
    assert [own.decode(x) for x in want] == library.decode_batch(want, skip_special_tokens=False)


def test_long_words_equal_short_ones(letters):
    own, _ = letters
    draw = random.Random(5)
    for _ in range(300):
        word = bytes(draw.choice(b"abcdeths ") for _ in range(draw.randint(2, SHORT)))
        assert own._long(word) == own._short(word)


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=80))
def test_any_text(pieces, letters, text):
    assert pieces[0]([text]) == [len(pieces[1].encode(text))]
    ids = letters[0].encode(text)
    assert ids == letters[1].encode(text, add_special_tokens=False).ids
    assert letters[0].decode(ids) == text


def test_rows(docs, no_docs, texts, by_id):
    counted = token_counts(docs, PIECES)
    assert counted.columns == ["doc_id", "n_bytes", "n_tokens"]
    found = by_id(counted)
    assert found[2][0][1:] == (0, 0) and found[3][0][1:] == (0, 0)
    assert len(found[7]) == 2 and len(found[None]) == 2
    assert found[6][0].n_bytes == 20_000
    assert counted.count() == len(texts)
    assert token_counts(no_docs, PIECES).count() == 0


def test_round_trip_rows(docs, no_docs, texts):
    coded = bpe_encode(docs, BYTES)
    back = sorted((str(r.doc_id), r.decoded) for r in bpe_decode(coded, BYTES).collect())
    assert back == sorted((str(i), t or "") for i, t, _ in texts)
    assert bpe_encode(no_docs, BYTES, decode=True).count() == 0


def test_batches_of_texts_equal_the_library(letters, monkeypatch):
    """New words are merged many at a time, spaces of any kind stand anywhere, few chunks are kept, long ones never."""
    library = letters[1]
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 500)
    own = ByteVocabulary(BYTES)
    draw = random.Random(8)
    spaces = [" ", "  ", " \n", "\n ", "\t", "\x85", " \x1c ", "\u3000 ", "   ", ".", "é", "it's", "x" * 40, "<|endoftext|>"]
    mixed = ["".join(draw.choice(spaces) for _ in range(draw.randint(0, 9))) for _ in range(2000)]
    for texts in ([], [""], HARD, drawn(3000, 60, seed=7), mixed, HARD + mixed, ["y" * 90 + " " + "z" * 90 + " end"] * 3):
        want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
        packed = own.encode_all(texts)
        assert [list(memoryview(x).cast("i")) for x in packed] == want
        assert bpe._ragged(packed).to_pylist() == want
        assert own.decode_all(bpe._ragged(packed)).to_pylist() == texts
    kept = {*own.known, *own.old}
    assert "end" in kept and max(map(len, kept)) <= bpe.CACHED_CHARS


def test_decoding_of_any_ids_equals_the_library(letters):
    own, library = letters
    draw = random.Random(9)
    rows = [[draw.randrange(len(own.token)) for _ in range(draw.randint(0, 6))] for _ in range(500)]
    packed = bpe._ragged([bpe._packed(x) for x in rows])
    assert own.decode_all(packed).to_pylist() == library.decode_batch(rows, skip_special_tokens=False)
    assert own.decode_all(packed.slice(100, 7)).to_pylist() == [own.decode(x) for x in rows[100:107]]


def test_new_words_are_merged_together(letters, monkeypatch):
    """Invented words, each seen once: hardly any is merged by itself, which took most of the time."""
    own, library = ByteVocabulary(BYTES), letters[1]
    draw = random.Random(10)
    text = " ".join("".join(draw.choice("abcdeinorstéü") for _ in range(draw.randint(4, 14))) for _ in range(20_000))
    alone, merge = [], own.word_ids
    monkeypatch.setattr(own, "word_ids", lambda word: alone.append(word) or merge(word))
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(alone) < 1000


def test_queries_equal_the_libraries(spark, sf, pieces, letters):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op4_token_counts(spark, sf).collect():
        n = len(pieces[1].encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in op10_bpe(spark, sf).collect():
        ids = letters[1].encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(docs[r.doc_id]))


def test_long_words_are_cut_where_no_piece_lies():
    """Words without a space, up to a megabyte: equal to the library, in a time that grows with their length."""
    draw = random.Random(11)
    letters = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    mixed = "".join(draw.choice(["the", "ing", "Zeit", "qx", "é", "日本", "7", "=", "/", "aaaa"]) for _ in range(3000))
    counter = TokenCounter(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in (letters, letters[:50_000] + " " + letters[:47], mixed, "日" * 500 + "x" * 500, base64.b64encode(letters[:60_000].encode()).decode()):
        start = time.perf_counter()
        assert counter([text]) == [len(library.encode(text))]
        assert time.perf_counter() - start < 20
    assert max(map(len, counter.known)) <= CACHED_CHARS
