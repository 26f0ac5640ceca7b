"""Resampling (operator 11), conversation repair (operator 12) and line dedup (operator 13) against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.llm.conftest import ODD, prose

from tenure.llm import linededup, resampling, turns

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WHITE = " \t\n\x0b\x0c\r"


# Resampling


def brute_draw(docs, target, longest=1):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def buckets(text):
        words = word.findall((text or "").translate(FOLD))
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]

    features = [(d, *buckets(t)) for d, t in docs]
    s, t = Counter(b for _, _, f in features for b in f), Counter(b for x in target for b in buckets(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    out = []
    for d, n, f in features:
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((o for o in out if o[1] >= 20), key=lambda o: (-o[4], o[0] is None, o[0] or 0))
    for rank, o in enumerate(able[: 10 * len(able) // 100]):
        o[5] = rank + 1
    return sorted(([o[0], *o[2:]] for o in out), key=repr)


@pytest.mark.parametrize("longest", [1, 2])
def test_draw_equals_brute_force(spark, make_docs, rng, longest):
    texts = [*ODD, "w" * 31 + "é " + "y" * 33 + " Ä1_a-B ", *(prose(rng, rng.randint(5, 80)) for _ in range(400))]
    docs = make_docs(texts)
    target = make_docs([prose(rng, 30) for _ in range(20)] + [None])
    got = resampling.resample(docs.withColumnRenamed("lang", "rank"), target, longest=longest)
    assert got.columns == ["id", "n_features", "weight", "score", "rank"]
    want = brute_draw(list(enumerate(texts)), [r["text"] for r in target.select("text").collect()], longest)
    assert sorted((list(r) for r in got.collect()), key=repr) == want


def test_draw_with_ties_nulls_and_nothing(spark, make_docs, rng):
    text = prose(rng, 30)
    docs = make_docs([text] * 60, ids=[None, None, *[5] * 40, *range(18)])
    got = [list(r) for r in resampling.op11_importance_draw(docs, docs.limit(0)).collect()]
    ranked = sorted(r[4] for r in got if r[4] is not None)
    assert ranked == [1, 2, 3, 4, 5, 6] and len(got) == 60
    scores = sorted((-r[3] for r in got))
    assert sorted(-r[3] for r in got if r[4] is not None) == scores[:6]
    assert resampling.op11_importance_draw(docs.limit(0), docs).collect() == []
    short = make_docs(["few words"] * 30)
    assert {r["rank"] for r in resampling.op11_importance_draw(short, docs).collect()} == {None}


@pytest.mark.parametrize("chunk", [3, 1000])
def test_cutoff_is_exact(spark, rng, monkeypatch, chunk):
    monkeypatch.setattr(resampling, "CHUNK", chunk)
    keys = sorted((rng.randint(-5, 5), rng.randint(0, 9), i) for i in range(300))
    shuffled = rng.sample(keys, len(keys))
    df = spark.createDataFrame(shuffled, "less long, ident long, row long").repartition(7)
    for k in (1, 2, 37, 150, 299, 300):
        assert resampling.cutoff_key(df, k) == keys[k - 1]


def test_crc32_of_spans(rng):
    words = [bytes(rng.randrange(256) for _ in range(n)) for n in [0, 1, 2, 31, 32, 33, 200, *rng.choices(range(40), k=200)]]
    ends = np.cumsum([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    got = resampling.crc32_spans(data, np.append(0, ends[:-1]), ends)
    assert got.tolist() == [zlib.crc32(w) for w in words]


# Conversation repair

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def brute_repairs(rows):
    """Per conversation the measures and the digest, by a plain recursion over (row, state)."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        talks[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {conv: brute_repair(rs) for conv, rs in talks.items()}


def brute_repair(rs):
    rs = sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rs:
        end = text.rstrip(WHITE)
        faults.append("b" if not end else "d" if (role, text) in seen else "" if end[-1] in ".!?" else "t")
        seen.add((role, text))

    @lru_cache(None)
    def best(at, state, inserts=2):
        """(cost, audit, lines) of the cheapest, least repair from a row on."""
        options = [(0, "", ())] if at == len(rs) and state in (0, 3) else []
        role = "assistant" if state == 2 else "user"

        def add(cost, letter, line, rest):
            if rest is not None:
                options.append((cost + rest[0], letter + rest[1], line + rest[2]))

        if inserts:
            add(5, "I", (f"{role}:",), best(at, NEXT[state, role[0]], inserts - 1))
        if at < len(rs):
            add(2, "D", (), best(at + 1, state))
            if faults[at] not in ("b", "d"):
                extra, (_, own, text) = 5 * (faults[at] == "t"), rs[at]
                if (state, own[:1]) in NEXT:
                    add(extra, "K", (f"{own}:{text}",), best(at + 1, NEXT[state, own[:1]]))
                add(extra + 1, "R", (f"{role}:{text}",), best(at + 1, NEXT[state, role[0]]))
        return min(options) if options else None

    turns_there = [r[0] for r in rs if r[0] is not None]
    gaps = max(turns_there) - min(turns_there) + 1 - len(set(turns_there)) if turns_there else 0
    initials = [r[1][:1] for r in rs]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    for at in range(len(rs), -1, -1):  # from the end, so that no call goes deep
        for state in range(4):
            best(at, state)
    cost, audit, lines = best(0, 0)
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def odd_turns(rng, n):
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "s", "a"]
    texts = ["Hi.", "What?", "cut off", "", " \n", "Yes!", "ok. ", None, "é."]
    return [
        (c, rng.choice([None, *range(10)]) if rng.random() < 0.5 else t, rng.choice(roles), rng.choice(texts))
        for c in [None, *range(n)] for t in range(rng.randint(0, 14))
    ]


def test_repair_equals_brute_force(spark, rng):
    rows = odd_turns(rng, 250)
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumn("audit", F.lit("mine")).withColumn("place", F.lit(1))
    got = {r[0]: tuple(r[1:]) for r in turns.op12_turn_repair(df).collect()}
    assert got == brute_repairs(rows)


def test_long_conversation_over_many_tasks(spark, rng):
    rows = [(1, t // 2, rng.choice(["user", "assistant", "system"]), f"{t % 300}{rng.choice(['.', ''])}") for t in range(700)] + odd_turns(rng, 5)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        damaged = turns.damage(spark.createDataFrame(rows, TURNS))
        got = {r["conv_id"]: r for r in turns.audits(damaged).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    long = [(1, r["turn"], r["role"], r["text"]) for r in damaged.filter("conv_id = 1").collect()]
    assert tuple(got[1])[1:] == brute_repair([r[1:] for r in long])[:7]


def test_repair_of_nothing_and_real_rows(spark):
    empty = spark.createDataFrame([], TURNS)
    assert turns.op12_turn_repair(empty).collect() == []
    rows = [(7, 0, "system", "Be kind."), (7, 1, "assistant", "Hello."), (7, 2, "assistant", "Well?"), (7, 3, "tool", "")]
    df = spark.createDataFrame(rows, TURNS)
    audited = turns.audits(df)
    assert [(r["audit"], r["cost"], r["blank"], r["illegal"]) for r in audited.collect()] == [("KRKD", 3, 1, 3)]
    fixed = sorted(tuple(r) for r in turns.repair(df, audited).collect())
    assert fixed == [(7, 0, "system", "Be kind.", "K"), (7, 1, "user", "Hello.", "R"), (7, 2, "assistant", "Well?", "K")]


def test_tables_hold_each_vector_and_block():
    tables = turns.BlockTables()
    rng = random.Random(5)
    for _ in range(300):
        vector = rng.randrange(len(tables.vectors))
        block = [rng.randrange(turns.CLASSES) for _ in range(turns.BLOCK)]
        costs, total = tables.vectors[vector], 0
        for kind in block:
            costs, least = turns.normalised(turns.stepped(list(costs), kind))
            total += least
        code = sum(k * turns.CLASSES ** (turns.BLOCK - 1 - i) for i, k in enumerate(block))
        assert tables.vectors[tables.after[vector, code]] == costs and tables.added[vector, code] == total


# Line dedup


def brute_lines(docs, least_chars=40, least_docs=5):
    key = lambda line: line.strip(WHITE).translate(FOLD)
    holders = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(-(1 << 63) if d is None else d)
    gone = {k: max(ds) for k, ds in holders.items() if len(ds) >= least_docs}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), d if d is not None else -(1 << 63)) == (d if d is not None else -(1 << 63))]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def lined_texts(rng, n):
    common = [prose(rng, 25) for _ in range(6)] + ["é" * 40, "é" * 39, " \t" + "A" * 45 + "\r", "a" * 45]
    return ["\n".join(rng.choice(common) if rng.random() < 0.5 else prose(rng, rng.randint(0, 30)) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_line_dedup_equals_brute_force(make_docs, rng):
    texts = [*ODD, *lined_texts(rng, 150), "\n".join(["b" * 50] * 3)] + ["b" * 50] * 8
    ids = [*range(len(texts) - 4), None, None, 20, 20]
    docs = make_docs(texts, ids=ids).repartition(6)
    got = sorted((tuple(r) for r in linededup.op13_line_bitmaps(docs).collect()), key=repr)
    assert got == brute_lines(list(zip(ids, texts)))


def test_line_dedup_keeps_columns_and_takes_clashing_names(make_docs, rng):
    texts = lined_texts(rng, 40)
    docs = make_docs(texts).select("*", *[F.lit(c).alias(c) for c in ("doc", "tag", "keep", "at", "rest", "row", "n_lines")])
    cut = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs))
    assert cut.columns == ["doc_id", "text", "lang", "source", "n_chars", "doc", "tag", "keep", "at", "rest", "row", "n_lines", "n_dropped"][:11] + ["n_lines", "n_dropped"]
    rows = cut.collect()
    assert {(r["doc"], r["tag"], r["keep"], r["row"]) for r in rows} == {("doc", "tag", "keep", "row")}
    assert sorted((r["doc_id"], r["n_dropped"]) for r in rows) == [(d, n) for d, _, n, _ in sorted(brute_lines(list(enumerate(texts))))]
    assert linededup.op13_line_bitmaps(docs.limit(0)).collect() == []


def test_stream_over_any_cuts(monkeypatch):
    """Drops of the streaming pass for any partitions and batches, against a plain count."""

    class Context:
        part = 0

        @classmethod
        def get(cls):
            return cls

        @classmethod
        def partitionId(cls):  # noqa: N802
            return cls.part

    monkeypatch.setattr(linededup, "TaskContext", Context)
    rng = random.Random(2)

    def batch(rows):
        types = (pa.binary(), pa.int64(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["key", "doc", "tag", "at"])

    for _ in range(400):
        rows = [(bytes([0, k]) * 8, d, 0, a) for k in range(rng.randint(1, 6)) for d in rng.sample(range(12), rng.randint(1, 9)) for a in rng.sample(range(20), rng.choice([1, 1, 3]))]
        rows.sort(key=lambda r: (r[0], -r[1], r[3]))
        docs = defaultdict(set)
        for r in rows:
            docs[r[0]].add(r[1])
        want = sorted(r[1:] for r in rows if len(docs[r[0]]) >= 5 and r[1] != max(docs[r[0]]))
        cuts = sorted(rng.randint(0, len(rows)) for _ in range(rng.randint(0, 4)))
        size = rng.randint(1, 9)
        parts = [[batch(p[i : i + size]) for i in range(0, len(p), size)] for p in (rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)]))]
        edges = []
        for Context.part, part in enumerate(parts):
            edges += [e for b in linededup._edges(iter(part)) for e in b.to_pylist()]
        spanning = linededup.spanning_keys(edges)
        got = [tuple(r.values()) for part in parts for b in linededup._stream_drops(iter(part), spanning, 5) for r in b.to_pylist()]
        assert sorted(got) == want
