"""BPE encoding (operator 1) and token counts (operator 4) against the tokenizers library."""

import hashlib
import time
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import ODD, prose
from tokenizers import Tokenizer

from tenure.llm import chunkbpe, prefixcounts
from tenure.llm.blocks import text_bytes


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def counter():
    return prefixcounts.PrefixCounter("word_bpe_49k.json")


def test_encoding_equals_the_library(make_docs, library, rng):
    shared = prose(rng, 900)
    texts = [*ODD, *(prose(rng, rng.randint(1, 60)) + " " + shared + prose(rng, 40) for _ in range(12)), "é" * 9000, "\n" * 9000 + "a" * 300]
    docs = make_docs(texts).withColumnRenamed("source", "n_tokens")
    got = {r.doc_id: r for r in chunkbpe.op1_chunk_bpe(docs).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_shared_passage_is_encoded_once_per_worker(rng):
    import pyarrow as pa

    shared = prose(rng, 3000)
    encoder = chunkbpe.ChunkEncoder("word_bpe_49k.json")
    alone = [chunkbpe.cut_points(*text_bytes(pa.array([t])))[0] for t in (prose(rng, 50) + " " + shared, prose(rng, 300) + " " + shared)]
    encoder.encode_texts(*text_bytes(pa.array([prose(rng, 50) + " " + shared, prose(rng, 300) + " " + shared])))
    assert len(encoder.chunks.young) < sum(map(len, alone)) * 0.75


def test_encode_keeps_columns_and_takes_empty_tables(spark, make_docs):
    docs = make_docs(["a b", "a b"], ids=[1, 1])
    assert chunkbpe.encode(docs).columns == [*docs.columns, "n_tokens", "token_ids"]
    assert [r.token_ids for r in chunkbpe.encode(docs).collect()] == [[320, 321]] * 2
    assert chunkbpe.op1_chunk_bpe(docs.limit(0)).collect() == []
    ids = spark.createDataFrame([([320],), (None,), ([],), ([49407, 320],)], "token_ids array<int>")
    assert [r.decoded for r in chunkbpe.decode(ids).collect()] == ["a</w>", None, "", "<|endoftext|> a</w>"]
    unknown = spark.createDataFrame([([320, 99999, 321],)], "token_ids array<int>")
    assert chunkbpe.decode(unknown).first().decoded == "a</w> b</w>"


def test_counts_at_every_prefix(make_docs, library, rng):
    texts = [*ODD[:8], "don't they're a'r ...'s!! 2024abc", prose(rng, 30)]
    rows = {r.doc_id: r for r in prefixcounts.prefix_counts(make_docs(texts).select("doc_id", "text")).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        table = prefixcounts.prefix_table(rows[i].steps, len(text))
        assert table[-1] == rows[i].n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        assert rows[i].n_bytes == len(text.encode())
        if "<|" in text or "́" in text:
            continue  # words that are not cut inside
        assert table.tolist() == [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]


def test_budget_and_limit(make_docs, library, rng):
    text = prose(rng, 200)
    row = prefixcounts.prefix_counts(make_docs([text]).select("doc_id", "text")).first()
    table = prefixcounts.prefix_table(row.steps, len(text))
    cut = prefixcounts.fit_budget(table, 100)
    assert len(library.encode(text[:cut], add_special_tokens=False).ids) <= 100 < len(library.encode(text, add_special_tokens=False).ids)
    assert prefixcounts.fit_budget(table, 0) == 0
    limits = prefixcounts.op4_token_counts(make_docs([text, "a", None]), limit=10).orderBy("doc_id").collect()
    assert [r.over_limit for r in limits] == [True, False, False]
    assert prefixcounts.op4_token_counts(make_docs([])).collect() == []


def test_prefixes_and_budget_of_words_that_the_library_counts(make_docs, library, rng):
    kanji = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(3000))
    texts = [*ODD[6:8], "a b " + kanji + chr(0xF900) + " c d"]
    rows = {r.doc_id: r for r in prefixcounts.prefix_counts(make_docs(texts).select("doc_id", "text")).collect()}
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for i, text in enumerate(texts[:2]):
        assert prefixcounts.prefix_table(rows[i].steps, len(text)).tolist() == [count(text[:k]) for k in range(len(text) + 1)]
    table = prefixcounts.prefix_table(rows[2].steps, len(texts[2]))
    assert prefixcounts.fit_budget(table, 100) == 4
    assert prefixcounts.fit_budget(table, count(texts[2]) - 1) == len(texts[2]) - 1
    assert prefixcounts.fit_budget(table, count(texts[2])) == len(texts[2])


def test_exact_counts_inside_long_words_that_normalisation_changes(make_docs, library, rng):
    pick = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    decomposed = unicodedata.normalize("NFD", "déjà-vu'llÅngström한국어がぎパ…'sñ'l")
    kanji = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(150))
    texts = [
        "a b " + kanji + chr(0xF900) + " c d",
        decomposed * 6,
        "x" * 90 + unicodedata.normalize("NFD", "é" * 60) + "İ" * 50,
        "<|endoftext|>" * 9 + "don't<|startoftext|><|endofte" + "e\u0301" * 20,
        "." * 60 + "'s\u0301'l\u0301l'" + "\u0301" * 50 + "q\u0323\u0301\u0323" * 8 + "ΣΑΣ\u0301",
        "".join(unicodedata.normalize("NFD", chr(rng.randint(0xAC00, 0xD7A3))) for _ in range(70)),
        *(pick(["e\u0301", "'", "l", "s", "\u0301", "A", "İ", "1", ".", "か\u3099", "\u1112\u1161\u11AB", "\uF900", "\u00A0", "<|endoftext|>", "\u0323"], 60) for _ in range(25)),
    ]
    rows = {r.doc_id: r for r in prefixcounts.prefix_counts(make_docs(texts).select("doc_id", "text")).collect()}
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for i, text in enumerate(texts):
        table = np.concatenate([[0], np.cumsum(np.frombuffer(rows[i].steps, "<i4", len(text)))]).tolist()
        assert table == [count(text[:k]) for k in range(len(text) + 1)]
        assert prefixcounts.exact_table(rows[i].steps, len(text)).tolist() == table


def test_long_words_that_normalisation_changes_take_no_square_time(counter):
    words = [unicodedata.normalize("NFD", "é한が") * 10_000, "e" + "\u0301" * 20_000, "<|endoftext|>" * 20_000]
    for word in words:
        before = time.monotonic()
        assert counter.word(word)[-1] == counter.whole(word)
        assert time.monotonic() - before < 30


def test_words_of_more_tokens_than_16_bits(make_docs, library, rng):
    kanji = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(30_000))
    texts = ["<|endoftext|>" * 40_000, kanji + chr(0xF900) + " a", "<|endoftext|>" * 40_000 + " a b"]
    wholes = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert min(wholes) > 32_767
    rows = {r.doc_id: r for r in prefixcounts.prefix_counts(make_docs(texts).select("doc_id", "text")).collect()}
    assert [rows[i].n_tokens for i in range(3)] == wholes
    assert [int(prefixcounts.prefix_table(rows[i].steps, len(t))[-1]) for i, t in enumerate(texts)] == wholes
    assert [r.n_tokens for r in prefixcounts.op4_token_counts(make_docs(texts)).orderBy("doc_id").collect()] == wholes


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdething'sABZéñß.,!1 ", min_size=1, max_size=70).map(lambda s: s.replace(" ", "")).filter(bool))
def test_word_tables(counter, word):
    assert list(counter.word(word)) == [counter.whole(word[:k]) for k in range(1, len(word) + 1)]


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="abcdeting", min_size=1, max_size=120))
def test_long_pieces(counter, piece):
    assert counter.long_piece(piece) == [len(counter.model.tokenize(piece[:k])) for k in range(1, len(piece) + 1)]


def test_chunks_cover_texts():
    import pyarrow as pa

    data, offsets = text_bytes(pa.array(["é" * 20_000, None, "ab " * 9000]))
    for start, ends in zip(offsets.tolist(), chunkbpe.cut_points(data, offsets)):
        sizes = np.diff([start, *ends])
        assert (sizes <= chunkbpe.MOST).all()
        for a, b in zip([start, *ends], ends):
            data[a:b].tobytes().decode()
