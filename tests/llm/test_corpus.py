"""Language ID (8), quality rules (9), sharding (6), the registered queries and the pipeline."""

import collections
import math
import re
import zlib

import __spark_entry__
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import ODD, prose
from tests.llm.test_dedup import brute_components
from tests.llm.test_scans import brute_leaks

from tenure.llm import catalog, ppm, quality, sharding

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_bits(training, text):
    """Code length of a text by method C, straight from the definition."""
    trees = [collections.defaultdict(collections.Counter) for _ in range(ppm.ORDER + 1)]
    seen = set()
    for data in training.values():
        for t in data:
            seen |= set(t.encode())
    out = {}
    for lang in sorted(training):
        trees = collections.defaultdict(collections.Counter)
        for t in training[lang]:
            raw = t.encode()
            for i in range(len(raw)):
                for order in range(min(ppm.ORDER, i) + 1):
                    trees[raw[i - order : i]][raw[i]] += 1
        known = {raw for lang2 in training for t in training[lang2] for raw in contexts(t.encode())}
        bits, raw = 0.0, text.encode()
        for i in range(len(raw)):
            order = min(ppm.ORDER, i)
            while order and raw[i - order : i] not in known:
                order -= 1
            while True:
                follow = trees[raw[i - order : i]]
                total = sum(follow.values()) + len(follow)
                if follow and raw[i] in follow:
                    bits -= math.log2(follow[raw[i]] / total)
                    break
                if follow:
                    bits -= math.log2(len(follow) / total)
                if order == 0:
                    bits += 8
                    break
                order -= 1
        out[lang] = bits
    return out


def contexts(raw):
    return {raw[i - order : i] for i in range(len(raw)) for order in range(min(ppm.ORDER, i) + 1)}


def test_code_lengths(spark, make_docs, rng):
    training = {"aa": ["the cat and the hat", "that thing then"], "bb": ["der Hut und die Katze", "dann das Ding ü"]}
    sample = spark.createDataFrame([(k, t) for k, ts in training.items() for t in ts], "lang string, text string")
    texts = ["the hat", "die Hütte", "zz 日本", "", None, "123 !", "t", "cat " * 400]
    for r in ppm.identify(make_docs(texts).withColumnRenamed("source", "score"), sample).collect():
        text = texts[r.doc_id] or ""
        expected = brute_bits(training, text)
        assert np.allclose(r.code_bits, [expected[k] for k in sorted(expected)], rtol=1e-4, atol=1e-3)
        if not re.search(r"[^\W\d_]", text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == min(sorted(expected), key=expected.get) and 0 < r.score <= 1


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = ppm.op8_ppm_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) > 30


def test_languages_without_training(make_docs):
    assert [(r.lang_pred, r.score) for r in ppm.op8_ppm_language(make_docs(["abc", None], lang=None)).collect()] == [("und", 0.0)] * 2
    assert ppm.op8_ppm_language(make_docs([])).collect() == []


def brute_stats(text):
    words = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = collections.Counter(windows)
    cover = {k for i, w in enumerate(windows) if count[w] > 1 for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


def test_quality_statistics(spark, make_docs, rng):
    texts = [*ODD, *(prose(rng, rng.randint(1, 80)) for _ in range(10))]
    texts += ["\n".join(["same line", "", "same line", " same line", "#$ é"] * 3), "a " * 30, " ".join(prose(rng, 9).split() * 4), "x\r\nx\r\n\x0b\n"]
    labels = spark.createDataFrame([(10, 1), (11, 1), (11, 1), (None, 1), (12, 0), (999, 1)], "doc_id long, quality int")
    for r in quality.op9_quality_llr(make_docs(texts), labels).collect():
        expected = brute_stats(texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected, texts[r.doc_id]
        assert r.base_failed == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (r.base_failed and r.kept)


def test_quality_rejects_junk_and_keeps_prose(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.op9_quality_llr(docs, labels).filter("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in got.collect()}
    assert kept[1] > 0.97 and kept[0] < 0.3


def test_quality_learns_from_every_trusted_document(spark, make_docs):
    texts = [f"w{i:05d} words" for i in range(6000)]
    labels = spark.createDataFrame([(i, 1) for i in range(6000)], "doc_id long, quality int")
    docs = make_docs(texts)
    expected = quality.quality_scores(docs, quality.log_ratios(docs, docs)).collect()
    got = {r.doc_id: r.llr for r in quality.op9_quality_llr(docs, labels).collect()}
    assert got == {r.doc_id: r.llr for r in expected}


def test_quality_without_labels(spark, make_docs, rng):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.op9_quality_llr(make_docs([prose(rng, 30), "", None]), labels).orderBy("doc_id").collect()
    assert [r.kept for r in got] == [True, False, False]
    assert quality.op9_quality_llr(make_docs([]), labels).collect() == []


def test_shards(make_docs, rng, tmp_path, spark):
    texts = [*ODD, *(prose(rng, rng.randint(1, 40)) for _ in range(90)), *["copy"] * 40]
    docs = make_docs(texts).withColumnRenamed("source", "slot")
    placed = sharding.shuffle_into_shards(docs, shards=8, bucket_bytes=3000)
    rows = placed.collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    by = collections.defaultdict(list)
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").encode()) + 1
        by[r.shard].append(r.slot)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    again = sharding.shuffle_into_shards(docs.repartition(7), shards=8, bucket_bytes=3000).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}
    sharding.write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(texts)
    same = make_docs(["x"] * 5, ids=[1] * 5)
    assert sorted(r.shard for r in sharding.op6_shuffle_shards(same).collect()) == [0, 1, 2, 3, 4]
    assert sharding.op6_shuffle_shards(make_docs([])).collect() == []


def test_registered_queries():
    names = __spark_entry__.queries()
    assert sorted({n.split("_")[0] for n in catalog.QUERIES}) == sorted(f"op{k}" for k in range(1, 14))
    assert set(catalog.QUERIES) < set(names) and "pipeline" in names


@pytest.fixture(scope="module")
def stage_outputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    out.append(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def test_pipeline_stages(spark, stage_outputs):
    source = stage_outputs[0]
    texts = [{r.doc_id: r.text for r in df.select("doc_id", "text").collect()} for df in stage_outputs]
    for df in stage_outputs[1:-1]:
        assert df.columns == source.columns
    assert set(texts[1]) == {d for d, t in texts[0].items() if re.search(r"[^\W\d_]", t or "")}
    ids = sorted(texts[1])
    _, component = brute_components([texts[1][d] for d in ids], 80)
    assert set(texts[2]) == {ids[i] for i in component if component[i] == i}
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    ids = sorted(texts[2])
    leaked = {ids[d] for d, _ in brute_leaks([texts[2][d] for d in ids], items)}
    assert leaked and set(texts[3]) == set(ids) - leaked
    assert set(texts[4]) == set(texts[3])
    assert all(not re.search(r"[0-9a-f]{32}|AKIA[A-Z0-9]{12}|password=\S{8}", t) for t in texts[4].values())
    assert texts[5] == texts[4] and all(r.n_tokens == len(r.token_ids) for r in stage_outputs[5].collect())


def test_first_stage_rejects_what_no_tree_codes(spark, make_docs, rng):
    known = spark.read.parquet(f"{SMALL}/documents.parquet")
    foreign = [
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(600)), "Это русский текст о погоде и природе, он довольно длинный. " * 4,
        "Tämä on suomenkielinen teksti, jossa kerrotaan pitkästi järvistä ja metsistä sekä yöttömästä yöstä pohjoisessa. " * 3,
    ]
    docs = known.unionByName(make_docs([*foreign, "Hi", "no 1"], lang=None, ids=[9_000_001, 9_000_002, 9_000_003, 9_000_004, 9_000_005]))
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, SMALL).collect()}
    with_letters = {r.doc_id for r in known.collect() if re.search(r"[^\W\d_]", r.text or "")}
    assert kept == with_letters | {9_000_004, 9_000_005}


def test_last_stage_decodes(spark, make_docs):
    import hashlib

    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in corpus_pipeline.encode_tokens(spark, make_docs([*ODD[:8], "Don't stop, 2024!"]), SMALL).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == ids
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pipeline_run_equals_its_stages(spark, stage_outputs):
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, got.collect())) == sorted(map(str, stage_outputs[-1].collect()))


def test_pipeline_takes_odd_documents(spark, make_docs, rng):
    docs = make_docs([*ODD, *(prose(rng, 40) for _ in range(5))])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() > 5
    empty = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
    assert empty.count() == 0
