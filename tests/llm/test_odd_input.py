"""Columns with clashing names, words made to share a hash, and entities longer than any bound."""

import hashlib
from itertools import combinations

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import prose
from tokenizers import Tokenizer

from tenure.llm import chunkbpe, decontaminate, linededup, minhash, ppm, prefixcounts, quality, secrets, sharding, suffixes, surrogates

CLASHING = ["_row", "_spans", "_names", "_all", "_bucket", "_rank", "_tie", "_at", "_letters", "_n", "_group", "row", "doc", "words", "print", "key", "tag", "salt", "all", "noise"]


def crowded(docs):
    """`docs` with text columns of all names that operators use inside."""
    return docs.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHING])


def test_clashing_columns_come_back_as_they_were(make_docs, spark, rng):
    item = prose(rng, 40)
    texts = [prose(rng, 60), "Mr John Smith wrote to a@b.com", "password = hunter2hunter2 " + "f" * 40, item, None, ""]
    docs = crowded(make_docs(texts))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    outputs = {
        "secrets": secrets.redact(secrets.secret_scan(docs, secrets.train(docs))),
        "leaks": decontaminate.decontaminate(docs, bench),
        "surrogates": surrogates.replace_pii(docs, "k"),
        "shards": sharding.shuffle_into_shards(docs, shards=2),
        "language": ppm.identify(docs, docs.select("lang", "text").dropna()),
        "tokens": chunkbpe.encode(docs, decoded=True),
        "counts": prefixcounts.prefix_counts(docs),
        "lines": linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs)),
        "near": minhash.keep_one(docs),
    }
    for name, out in outputs.items():
        rows = out.collect()
        assert len(rows) == (len(texts) - 1 if name == "leaks" else len(texts)), name
        for row in rows:
            assert all(row[c] == f"mine {c}" for c in CLASHING), name
    assert 3 not in {r["doc_id"] for r in outputs["leaks"].collect()}


def thue_morse(n, a, b):
    """Words that share a polynomial hash modulo 2 ** 64 with their opposite from 1,024 letters on."""
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


PAIRS = [(thue_morse(n, a, b), thue_morse(n, b, a)) for n in (1024, 4096) for a, b in combinations("qxj", 2)]


def test_words_that_share_a_hash_are_not_taken_for_one_another(make_docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [f"start {x} and {y} end" for x, y in PAIRS] + [f"one {w} two" for pair in PAIRS for w in pair]
    docs = make_docs(texts).coalesce(1)
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    ids = {r["doc_id"]: r["ids_sha256"] for r in chunkbpe.op1_chunk_bpe(docs).collect()}
    assert ids == {i: hashlib.sha256(" ".join(map(str, w)).encode()).hexdigest() for i, w in want.items()}
    counts = {r["doc_id"]: r["n_tokens"] for r in prefixcounts.op4_token_counts(docs).collect()}
    assert counts == {i: len(w) for i, w in want.items()}


def test_shingles_and_lines_of_such_words_differ(make_docs, spark):
    texts = [" ".join(["a", w, "b", "c", "d", w]) for pair in PAIRS for w in pair]
    near = minhash.op2_hyperminhash(make_docs(texts).coalesce(1)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in near)
    lines = make_docs([f"{x}\n{y}\n{x} end\n{y} end" for x, y in PAIRS] + [f"{PAIRS[0][0]}\n{PAIRS[0][0]}"]).coalesce(1)
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r["n_dup_lines"] for r in quality.op9_quality_llr(lines, labels).collect()}
    assert got == {**dict.fromkeys(range(len(PAIRS)), 0), len(PAIRS): 1}


def test_stretches_of_such_words_differ(make_docs):
    x, y = thue_morse(1024, "q", "x"), thue_morse(1024, "x", "q")
    texts = [x, y, x + y]
    got = {r["doc_id"]: r["n_removed"] for r in suffixes.op7_suffix_dedup(make_docs(texts)).collect()}
    grams = lambda t: {t[i : i + 50] for i in range(len(t) - 49)}
    for d, text in enumerate(texts):
        seen = set().union(*(grams(t) for t in texts[:d])) if d else set()
        gone = {j for i in range(len(text) - 49) if text[i : i + 50] in seen for j in range(i, i + 50)}
        assert got[d] == len(gone)


@pytest.mark.parametrize(("entity", "kind"), [
    ("l" * 70 + "@example.org", "email"), ("x@a.b.c.d.e.f.g.h.i.com", "email"), ("y@" + "s" * 80 + ".net", "email"), ("z@" + "d." * 60 + "com", "email"),
])
def test_addresses_of_any_length_are_replaced(make_docs, entity, kind):
    row = surrogates.op10_surrogates(make_docs([f"Write to {entity} today."])).first()
    assert row[f"n_{kind}"] == 1 and entity not in row["text"]


def test_names_of_many_words_are_replaced_whole(make_docs):
    words = ["Juan", "Carlos", "Maria", "Jose", "Garcia", "Lopez", "O'Brien", "Wolfeschlegelsteinhausenbergerdorffwelche"]
    row = surrogates.op10_surrogates(make_docs([f"Then Mr {' '.join(words)} came. Garcia spoke, and Lopez's friend."])).first()
    assert not any(w in row["text"] for w in words)


def test_running_text_without_entities_is_quick(make_docs):
    hard = ["a" * 300_000, "a." * 100_000, "Mr " + "A" * 2_000, "@" * 100_000, "a@" * 50_000, "x@" + "a." * 50_000, "O'" * 50_000]
    rows = surrogates.op10_surrogates(make_docs(hard)).collect()
    assert len(rows) == len(hard)
