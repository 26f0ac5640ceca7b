"""Near-duplicates (operator 2), repeated strings (operator 7) and components against brute force."""

import hashlib
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.classic.dataframe import DataFrame
from tests.llm.conftest import ODD, prose

from tenure.llm import components, minhash, suffixes
from tenure.llm.tables import FREES_SHUFFLES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORDS.findall((text or "").translate(FOLD))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_components(texts, percent):
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = []
    for i in sets:
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                links.append((i, j))
    return sets, smallest_reachable(sets, links)


def near_copies(rng, n, words=120, most_edits=6):
    base = prose(rng, words).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, most_edits)):
            copy[rng.randrange(len(copy))] = prose(rng, 1)
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize(("small", "percent"), [(12, 85), (2, 85), (2, 80)])
def test_near_duplicates(make_docs, rng, monkeypatch, small, percent):
    monkeypatch.setattr(minhash, "SMALL", small)
    texts = [*ODD, *near_copies(rng, 60), *near_copies(rng, 25, 40, 3), *(prose(rng, 50) for _ in range(15))]
    texts += texts[20:30]
    texts[40] = texts[40].upper().replace("É", "é")
    sets, expected = brute_components(texts, percent)
    got = minhash.near_duplicates(make_docs(texts).withColumnRenamed("source", "kept"), percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), expected[i], expected[i] == i) for i in sets}


def test_keep_one_and_odd_ids(make_docs, rng):
    text = prose(rng, 30)
    docs = make_docs([text, text, text, "other words here", None, text], ids=[3, 2, None, 7, 8, 2])
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("2", text), ("2", text), ("None", text), ("7", "other words here"), ("8", None)])
    assert minhash.op2_hyperminhash(docs.limit(0)).collect() == []


def test_two_texts_of_one_id_link_their_groups(make_docs, rng):
    a, b = prose(rng, 30), prose(rng, 30)
    docs = make_docs([a, a, b, b], ids=[1, 5, 5, 9])
    assert {(r.doc_id, r.component_id) for r in minhash.op2_hyperminhash(docs).collect()} == {(1, 1), (5, 1), (9, 1)}


def test_registers_estimate_similarity(spark, rng):
    import numpy as np
    from pyspark.sql import functions as F

    sets = np.random.default_rng(1).integers(0, 2**63, 3000, dtype=np.int64).view(np.uint64)
    a, b = sets[:2000], sets[500:2500]
    ra, rb = (minhash.registers(np.sort(x), np.array([0]))[0].tobytes() for x in (a, b))
    row = spark.createDataFrame([(bytearray(ra), bytearray(rb), 2000, 2000)], "a binary, b binary, n long, m long")
    estimate = row.select(minhash.corrected(minhash._share(F.col("a"), F.col("b")), minhash.chance(F.col("n"), F.col("m")))).first()[0]
    assert abs(estimate - 1500 / 2500) < 0.2


def test_components(spark, rng):
    pairs = [(i, i + 1) for i in range(0, 300)] + [(1000, k) for k in range(1001, 1100)] + [(2000, 2001), (5, 5)]
    rng.shuffle(pairs)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = smallest_reachable({x for p in pairs for x in p}, pairs)
    assert got == expected
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_removed(rows):
    first = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - 49):
            w = b[i : i + 50]
            first[w] = min(first.get(w, d), d)
    out = {}
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, y in zip(b, gone) if not y)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [20_000, 4])
def test_repeated_strings(make_docs, rng, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    base = ["".join(rng.choice("abcd é") for _ in range(400)) for _ in range(5)]
    texts = list(ODD)
    for _ in range(70):
        text = ""
        for _ in range(rng.randint(0, 5)):
            b, i = rng.choice(base), rng.randint(0, 380)
            text += b[i : i + rng.randint(1, 150)] + rng.choice(["", "x" * rng.randint(0, 80), "yz"])
        texts.append(text)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    docs = make_docs(texts, ids=ids).withColumnRenamed("source", "crc").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in suffixes.op7_suffix_dedup(docs).collect()}
    assert got == brute_removed(list(zip(ids, texts)))


@pytest.mark.parametrize("hot", [20_000, 4])
def test_runs_and_many_copies_in_a_text(make_docs, rng, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    line = prose(rng, 30)
    odd = prose(rng, 30)
    period = "".join(rng.choice("abcd") for _ in range(44))
    texts = ["-" * 900 + odd, "=" * 70 + "-" * 700 + odd[5:], "ab" * 400, "x" + "ab" * 300 + "y" + "ba" * 100, period * 20, period[9:] * 7 + line, (line + " ") * 30, (line + "-" * 60) * 20, "-" * 49, "-" * 50 + "=" * 90, "-" * 2000]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    got = {r[0]: tuple(r)[1:] for r in suffixes.op7_suffix_dedup(make_docs(texts, ids=ids).repartition(3)).collect()}
    assert got == brute_removed(list(zip(ids, texts)))


def largest_group(monkeypatch, texts, docs):
    """Most stretches of one anchor that meet in a sort, and the texts that lose bytes."""
    sizes = []
    sort = suffixes._sorted_spans

    def watched(sent, out):
        sizes.append(sent.where("key % 2 = 0").groupBy("h").count().agg({"count": "max"}).first()[0] or 0)
        return sort(sent, out)

    monkeypatch.setattr(suffixes, "_sorted_spans", watched)
    return {r.doc_id: r.n_removed for r in suffixes.op7_suffix_dedup(docs).collect()}, max(sizes)


def test_a_run_of_one_byte_is_one_stretch(make_docs, monkeypatch):
    texts = ["-" * 100_000, "-" * 60_000]
    removed, size = largest_group(monkeypatch, texts, make_docs(texts))
    assert removed == {0: 0, 1: 60_000} and size <= 10


def test_hot_counts_stretches(make_docs, rng, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 40)
    line = prose(rng, 30)
    texts = [" ".join(f"{line} {rng.random()}" for _ in range(30)) for _ in range(3)]
    removed, size = largest_group(monkeypatch, texts, make_docs(texts))
    assert size <= 40
    assert removed == {i: brute_removed(list(enumerate(texts)))[i][1] for i in range(3)}


def shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


@pytest.mark.parametrize("hot", [20_000, 4])
def test_shuffles_go_as_soon_as_their_result_is_written(spark, make_docs, rng, monkeypatch, hot):
    """What stays are the sums of a few numbers; the stretches alone take more than 50 kB."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    line = prose(rng, 60)
    docs = make_docs([f"{line} {prose(rng, 20)}" for _ in range(60)]).repartition(4)
    before, setting = set(shuffle_bytes(spark)), spark.conf.get(FREES_SHUFFLES)
    result = suffixes.remove_repeats(docs)
    until = time.monotonic() + 20
    while (left := sum(size for name, size in shuffle_bytes(spark).items() if name not in before)) > 5_000 and time.monotonic() < until:
        time.sleep(0.2)
    assert left <= 5_000 and result.count() == 59
    assert spark.conf.get(FREES_SHUFFLES) == setting


@pytest.mark.parametrize("hot", [20_000, 4])
def test_more_shared_anchors_than_bits(spark, make_docs, rng, monkeypatch, request, hot):
    """Only stretches around shared anchors are sent, however many anchors are shared and batches there are."""
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "LEAST_BITS", 64)
    monkeypatch.setattr(suffixes, "MOST_BITS", 64)
    sent, sort = [], suffixes._sorted_spans
    monkeypatch.setattr(suffixes, "_sorted_spans", lambda df, out: sent.append(df.count()) or sort(df, out))
    lines = [prose(rng, 40) for _ in range(6)]
    texts = [*ODD, "-" * 900, "=" * 30 + "-" * 700, *(f"{rng.choice(lines)} {prose(rng, 150)} {rng.choice(lines)[7:]}" for _ in range(40))]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    docs = make_docs(texts, ids=ids)
    docs = docs.union(docs.limit(20)).withColumnRenamed("source", "numbers").repartition(4)  # some rows twice
    got = {r[0]: tuple(r)[1:] for r in suffixes.op7_suffix_dedup(docs).collect()}
    assert got == brute_removed(list(zip(ids, texts)))
    assert sum(sent) < sum(len(t or "") for t in texts) / 16 / 2  # about one stretch every 16 bytes in all


def test_anchors_travel_packed_however_many_are_shared(make_docs, rng, monkeypatch):
    """Groups of a few stretches and parts of a few anchors; no anchor is a row."""
    monkeypatch.setattr(suffixes, "MOST_BITS", 64)
    monkeypatch.setattr(suffixes, "LEAST_BITS", 64)
    monkeypatch.setattr(suffixes, "GROUP", 40, raising=False)
    monkeypatch.setattr(suffixes, "PART_BYTES", 2_000, raising=False)
    lines = [prose(rng, 40) for _ in range(6)]
    texts = [f"{rng.choice(lines)} {prose(rng, 60)} {rng.choice(lines)[7:]}" for _ in range(40)]
    texts += [" ".join([lines[0]] * 5), lines[1][:49], texts[3]]
    asked, deal = [], DataFrame.repartitionById
    monkeypatch.setattr(DataFrame, "repartitionById", lambda df, n, to: asked.append((df.count(), n)) or deal(df, n, to))
    got = {r[0]: tuple(r)[1:] for r in suffixes.op7_suffix_dedup(make_docs(texts).repartition(3)).collect()}
    assert got == brute_removed(list(enumerate(texts)))
    (rows, parts) = asked[0]
    n_bytes = sum(len(t.encode()) for t in texts)
    assert parts > 8 and rows <= (parts + 1) * (n_bytes / 16 / 40 + 3)  # about one stretch every 16 bytes; a group asks a part by one row


def test_only_shared_anchors_are_answered_with_yes(spark, make_docs, rng):
    lines = [prose(rng, 60) for _ in range(8)]
    texts = [*lines, lines[0], lines[1][20:300], f"{lines[2]} {lines[2]}", f"{prose(rng, 90)} {prose(rng, 90)}"]
    docs = make_docs(texts).selectExpr("doc_id", "crc32(text) crc", "text").repartition(5, "doc_id")
    rows = suffixes._shared_anchors(docs, 20, 7).collect()
    bits = {r.doc_id: [b >> (7 - i) & 1 for b in r.bits for i in range(8)] for r in rows}
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    anchors = [suffixes.stretches(d, np.array([0, len(d)]))[0] >> np.uint64(20) for d in data]
    several = {h for h in {h for a in anchors for h in a.tolist()} if sum(h in a for a in anchors) > 1}
    wanted = {i: [int(h in several) for h in a.tolist()] for i, a in enumerate(anchors)}
    assert several and {i: b[: len(wanted[i])] for i, b in bits.items()} == {i: w for i, w in wanted.items() if any(w)}


def test_a_lost_answer_counts_as_yes():
    docs = pa.table({"doc_id": [5, 6], "crc": [1, 2], "n": [3, 2]})
    which, sizes = np.array([0, 1, 2, 2, 3], "<i4"), np.array([2, 0, 2], "<i4")
    rows = {"group": [9, 9], "part": [-1, 2], "body": [which.tobytes(), np.packbits([False, False]).tobytes()], "more": [suffixes._packed(docs), None], "sizes": [sizes.tobytes(), None]}
    (found,) = suffixes._listed(iter([suffixes._answer(**rows)]), pa.int64())
    assert found.column("doc_id").to_pylist() == [5] and found.column("bits").to_pylist() == [bytes([0b11000000])]


def test_repeated_rows_and_null_ids(make_docs, rng):
    text = prose(rng, 40)
    docs = make_docs([text, text, text, text], ids=[4, 4, None, 9])
    got = sorted((str(r.doc_id), r.n_removed) for r in suffixes.op7_suffix_dedup(docs).collect())
    assert got == [("4", 0), ("4", 0), ("9", len(text.encode())), ("None", 0)]
    assert suffixes.op7_suffix_dedup(docs.limit(0)).collect() == []


def test_suffix_sort_orders_suffixes(rng):
    import numpy as np

    data = np.frombuffer("".join(rng.choice("ab") for _ in range(3000)).encode(), np.uint8)
    at = np.array([rng.randrange(2900) for _ in range(400)])
    group = np.sort(np.array([rng.randrange(5) for _ in range(400)]))
    order = suffixes.sort_suffixes(suffixes.Extensions(data), at, group)
    key = [(group[i], data[at[i] : at[i] + 50].tobytes()) for i in order]
    assert key == sorted(key) and sorted(order.tolist()) == list(range(400))
