"""Secret scans (operator 3), decontamination (operator 5) and PII surrogates (operator 10)."""

import collections
import hashlib
import re

from pyspark.sql import functions as F
from tests.llm.conftest import ODD, prose

from tenure.llm import decontaminate, secrets, surrogates
from tenure.llm.spans import match_spans

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def base_spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def secret_texts(rng):
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(20)]
    keys = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(24)) for _ in range(150)]
    texts = [f"é {prose(rng, 20)} token = \"{h}\" {prose(rng, 5)}" for h in hexes]
    texts += [f"{prose(rng, 5)} API_KEY='{k}' AKIA{'Q7' * 9} {prose(rng, 5)}" for k in keys]
    return texts


def test_base_spans(make_docs, rng):
    texts = [*ODD, *secret_texts(rng), "token: password=abcdefgh1", "secret=token:abcdefghij", "AKIAAKIAAKIAAKIA", "AKIA" * 3, "passwd:=x", 'Token":"12345678' * 3, "f" * 31 + "g" + "f" * 32, "password=1234567 password=12345678"]
    got = secrets.op3_markov_secrets(make_docs(texts).withColumnRenamed("source", "secret_spans"))
    for r in got.collect():
        expected = base_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(expected.encode()).hexdigest(), texts[r.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(expected.count(k) for k in ("assign", "access", "hex"))
        assert [s for s in r.spans.split(",") if s and not s.startswith("markov")] == [s for s in expected.split(",") if s]


def test_models_tell_random_from_ordinary(make_docs, spark, rng):
    docs = make_docs([*secret_texts(rng), *(prose(rng, 60) for _ in range(40))])
    ratios = secrets.train(docs)
    random, plain = "Zk3vQ9xW7mB2pL8tR5yN", "renlismokashendurtobawol"
    row = spark.range(1).select(*(secrets.mean_ratio(F.lit(v), ratios) for v in (random, plain))).first()
    assert row[0] > secrets.THRESHOLD > row[1]
    found = secrets.op3_markov_secrets(docs.unionByName(make_docs([f"see {random} there", f"see {plain} there"], ids=[900, 901])))
    spans = {r.doc_id: r.spans for r in found.filter("doc_id >= 900").collect()}
    assert spans == {900: "markov:4:24", 901: ""}


def test_keys_inside_paths_and_chains(make_docs, rng):
    docs = make_docs([*secret_texts(rng), *(prose(rng, 60) for _ in range(40))])
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(signs) for _ in range(24)) for _ in range(100)]
    frames = ["{}", "tolis/mokare/shendurti/{}", "baren/lismo/kashentowol/durtibagra/molisren/tibaren/{}/rentoba", "moka=torenlis_wolgra={}", "shendur-tolis-{}"]
    texts = [f"see {frame.format(k)} there" for frame in frames for k in keys]
    plain = ["tolis/mokare/shendurti/renlisba/wolgra", "moka=torenlis_wolgra=shendurtolis", "renlismokashendur", "4737097684299439"]
    ratios = secrets.train(docs)
    done = secrets.redact(secrets.secret_scan(make_docs(texts + plain), ratios)).orderBy("doc_id").collect()
    for i, frame in enumerate(frames):
        rows = done[100 * i : 100 * i + 100]
        assert sum(k not in r.text for k, r in zip(keys, rows)) >= 85, frame
    assert [r.text for r in done[500:]] == plain
    short = make_docs(["see x8Kq2ZvT9mW4pRb7 there", f"AKIA{'Q7' * 9}/{keys[0]}{keys[1]}"])
    assert [r.text for r in secrets.redact(secrets.secret_scan(short, ratios)).orderBy("doc_id").collect()] == ["see [SECRET] there", "[SECRET]/[SECRET]"]


def test_without_examples_and_empty(make_docs, rng):
    docs = make_docs([None, "", prose(rng, 30)])
    assert secrets.train(docs) is None
    assert [r.spans for r in secrets.op3_markov_secrets(docs).collect()] == ["", "", ""]
    assert secrets.op3_markov_secrets(docs.limit(0)).collect() == []


def test_redaction(make_docs, rng):
    h = "0123456789abcdef" * 2
    texts = [f"a token={h} b {h} c", "nothing", None, f"é{h}"]
    done = secrets.redact(secrets.secret_scan(make_docs(texts), None)).orderBy("doc_id").collect()
    assert [r.text for r in done] == ["a [SECRET] b [SECRET] c", "nothing", None, "é[SECRET]"]


def test_match_spans(spark):
    texts = ["xx12y345", "12", "", "é9é", "abc"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", match_spans(F.col("t"), r"\d+").alias("s")).collect()
    for r in rows:
        assert [(s.start, s.end, s.value) for s in r.s] == [(m.start(), m.end(), m[0]) for m in re.finditer(r"\d+", r.t)]


WORD = re.compile(r"[^\W_]+")


def grams(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else ([tuple(words)] if words else [])


def brute_leaks(texts, items):
    out = {}
    for d, text in enumerate(texts):
        words = WORD.findall((text or "").lower())
        for i, item in enumerate(items):
            own = WORD.findall((item or "").lower())
            size = min(5, len(own))
            if not own or len(words) < size:
                continue
            shingles = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]
            target = collections.Counter(grams(own))
            width, best = len(own) - size + 1, 0
            for a in range(max(1, len(shingles) - width + 1)):
                window = collections.Counter(shingles[a : a + width])
                common = sum((window & target).values())
                best = max(best, common / (sum(window.values()) + sum(target.values()) - common))
            if best >= 0.8:
                out[d, i] = best
    return out


def test_leaks(make_docs, spark, rng):
    items = [prose(rng, rng.randint(14, 60)) for _ in range(20)] + ["only three words", "", None, "same words " * 12]
    texts = list(ODD)
    for k in range(40):
        item = items[k % 20].split()
        cut = rng.randint(0, 2)
        texts.append(f"{prose(rng, rng.randint(0, 40))} {' '.join(item[cut:]).upper()}, {prose(rng, 30)}")
    texts += [" ".join(items[3].split()[:-2]), "it has only three words inside", "same words " * 12, prose(rng, 300), " ".join(w[::-1] for w in items[0].split())]
    bench = spark.createDataFrame(list(enumerate(items)) + [(0, items[0])], "item_id long, text string")
    docs = make_docs(texts).withColumnRenamed("source", "item_id")
    got = decontaminate.op5_simhash_decontamination(docs, bench).collect()
    expected = brute_leaks(texts, items)
    assert {(r.doc_id, r.item_id) for r in got} == set(expected)
    assert all(abs(r.similarity - expected[r.doc_id, r.item_id]) < 1e-9 and r.distance <= decontaminate.RADIUS for r in got)
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in expected}


def test_leaks_whose_parts_stand_in_another_order(make_docs, spark, rng):
    """The window that holds all parts starts where no part of the item stands at its own place."""
    items = [prose(rng, n) for n in (120, 100, 61)]
    texts = [prose(rng, 400)]
    for item in items:
        words = item.split()
        for cut in (20, len(words) // 2, len(words) - 30):
            texts.append(f"{prose(rng, 70)} {' '.join(words[cut:] + words[:cut])} {prose(rng, 90)}")
        texts.append(f"{prose(rng, 15)} {' '.join(words[:30] + words[32:])} {prose(rng, 15)}")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.op5_simhash_decontamination(make_docs(texts), bench).collect()}
    expected = brute_leaks(texts, items)
    assert len(expected) > 6 and set(got) == set(expected)
    for (d, i), best in expected.items():
        words, own = WORD.findall(texts[d]), WORD.findall(items[i])
        target, like = collections.Counter(grams(own)), []
        for a in range(len(words) - len(own) + 1):
            window = collections.Counter(grams(words[a : a + len(own)]))
            common = sum((window & target).values())
            like.append(common / (sum(window.values()) + sum(target.values()) - common))
        assert abs(got[d, i].similarity - best) < 1e-9 and got[d, i].start_word == like.index(max(like))


def test_leaks_of_empty_tables_and_null_ids(make_docs, spark, rng):
    text = prose(rng, 30)
    docs = make_docs([text, text, text], ids=[None, 4, 4])
    bench = spark.createDataFrame([(None, text)], "item_id long, text string")
    got = decontaminate.op5_simhash_decontamination(docs, bench)
    assert sorted(str(r.doc_id) for r in got.collect()) == ["4", "None"]
    assert decontaminate.op5_simhash_decontamination(docs, bench.limit(0)).collect() == []
    assert decontaminate.op5_simhash_decontamination(docs.limit(0), bench).collect() == []
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == 3


def test_blocks_guarantee_the_radius(spark):
    import random

    rng = random.Random(2)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(63)
        b = a
        for bit in rng.sample(range(63), rng.randint(0, decontaminate.RADIUS)):
            b ^= 1 << bit
        rows.append((a, b))
    both = spark.createDataFrame(rows, "a long, b long").select(*(decontaminate.blocks_of(F.col(c), decontaminate.RADIUS).alias(c) for c in "ab"))
    assert both.filter(F.size(F.array_intersect("a", "b")) > 0).count() == 200


PII = [
    "Mail Bob.Smith@Mail5.example.com or bob.smith@mail5.example.com. Call +1 (386) 555-3733 or 386-555-3733.",
    "Card 4111 1111 1111 1111 and 4529526289707589. IP 61.131.143.218 in version 4.0.12. SSN 123-45-6789.",
    "Mr. John Smith met Mrs Anna Smith and Herr Smith; Frau MÜLLER. Господин Иван Петров. Κυρία Μαρια Παπα",
]


def surrogate_texts(docs):
    return {r.doc_id: r for r in surrogates.op10_surrogates(docs).collect()}


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def test_surrogates_are_consistent_and_of_their_type(make_docs):
    got = surrogate_texts(make_docs([*ODD, *PII, *PII]).withColumnRenamed("source", "pii_counts"))
    n = len(ODD)
    for i, text in enumerate(ODD):
        assert (got[i].text, got[i].n_pii) == (text, 0)
    for k in range(3):
        assert got[n + k].text == got[n + 3 + k].text
    first, second, third = (got[n + k].text for k in range(3))
    a, b = re.findall(r"\S+@\S+?(?=\.? |\. |$)", first)[:2]
    assert a.lower().rstrip(".") == b.lower().rstrip(".") and "smith" not in first.lower()
    long, short = re.search(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4})\.$", first).groups()
    assert re.sub(r"\D", "", long)[1:] == re.sub(r"\D", "", short) != "3865553733"
    card, plain, ip, ssn = re.fullmatch(r"Card (\d{4} \d{4} \d{4} \d{4}) and (\d{16})\. IP (\S+) in version 4\.0\.12\. SSN (\d{3}-\d{2}-\d{4})\.", second).groups()
    assert luhn(card) and card[0] == "4" and plain[0] == "4" and luhn(plain) == luhn("4529526289707589")
    assert all(0 <= int(x) <= 255 for x in ip.split(".")) and ip != "61.131.143.218" and ssn != "123-45-6789"
    names = re.fullmatch(r"Mr\. (\S+) (\S+) met Mrs (\S+) (\S+) and Herr (\S+); Frau (\S+)\. Господин (\S+) (\S+)\. Κυρία (\S+) (\S+)", third).groups()
    assert names[0].lower() in surrogates.GIVEN["latin", "m"] and names[2].lower() in surrogates.GIVEN["latin", "f"]
    assert names[1] == names[3] == names[4] != "Smith" and names[5].isupper()
    assert names[6].lower() in surrogates.GIVEN["cyrillic", "m"] and names[8].lower() in surrogates.GIVEN["greek", "f"]
    assert (got[n].n_email, got[n].n_phone, got[n + 1].n_card, got[n + 1].n_ip, got[n + 1].n_ssn, got[n + 2].n_name) == (2, 2, 2, 1, 1, 6)


def test_names_without_title_and_of_several_words(make_docs):
    texts = [
        "Mr John Smith came. Smith said that John's car and Smith's dog and SMITH left; Smithson and smith stayed.",
        "Mr John Michael Smith left, and Michael too.", "Smith is not named here.", "Frau Anna Müller: Müller@web.de, Müller.",
    ]
    got = surrogate_texts(make_docs(texts))
    given, sur, again, first, third, loud = re.fullmatch(r"Mr (\S+) (\S+) came\. (\S+) said that (\S+)'s car and (\S+)'s dog and (\S+) left; Smithson and smith stayed\.", got[0].text).groups()
    assert sur == again == third == loud.capitalize() != "Smith" and given == first != "John" and loud.isupper()
    assert got[0].n_name == 5
    one, middle, last, alone = re.fullmatch(r"Mr (\S+) (\S+) (\S+) left, and (\S+) too\.", got[1].text).groups()
    assert last == sur and one == given and middle == alone != "Michael" and middle.split("-")[0].lower() in surrogates.GIVEN["latin", "m"]
    assert got[2].text == texts[2] and "Müller" not in got[3].text.replace("Müller@", "")


def test_phone_formats(make_docs):
    numbers = ["+33 1 42 68 53 00", "01 42 68 53 00", "01.42.68.53.00", "+49 170 1234567", "0170 1234567", "030 12345678", "030/12345678", "+34 912 345 678", "912 345 678", "912345678", "612 34 56 78", "+44 20 7946 0958", "020 7946 0958", "(020) 7946 0958", "3865553733", "386-555-3733", "+1 (386) 555-3733", "+13865553733"]
    others = ["on 01.02.2024 10 h", "2024-01-02", "at 1700000000", "61.131.143.218", "1.234.567,89", "123-45-6789", "version 10.20.30"]
    got = surrogate_texts(make_docs([f"call {x} now" for x in numbers] + others))
    new = [re.fullmatch(r"call (.*) now", got[i].text)[1] for i in range(len(numbers))]
    for i, (old, x) in enumerate(zip(numbers, new)):
        assert got[i].n_phone == got[i].n_pii == 1 and x != old, old
        assert re.sub(r"\d", "9", x) == re.sub(r"\d", "9", old)
    key = {n: re.sub(r"\D", "", x) for n, x in zip(numbers, new)}
    for a, b, k in [(0, 1, 9), (1, 2, 9), (3, 4, 10), (5, 6, 10), (7, 8, 9), (8, 9, 9), (11, 12, 10), (12, 13, 10), (14, 15, 10), (15, 16, 10), (16, 17, 10)]:
        assert key[numbers[a]][-k:] == key[numbers[b]][-k:]
    assert [got[len(numbers) + i].n_phone for i in range(len(others))] == [0] * len(others)


def test_surrogates_are_distinct(spark):
    entities = [("ip", f"{a}.{b}.1.1") for a in range(1, 9) for b in range(1, 9)] + [("given-m", f"name{k}") for k in range(60)] + [("phone", f"{k}") for k in range(8)]
    table = surrogates.surrogate_table(spark.createDataFrame(entities, "kind string, canonical string"), "key").collect()
    assert len(table) == len(entities) == len({(r.kind, r.surrogate) for r in table})
    assert not {(r.kind, r.surrogate) for r in table} & set(entities)


def test_surrogates_of_an_empty_table(make_docs):
    assert surrogates.op10_surrogates(make_docs([])).collect() == []
    assert [r.n_pii for r in surrogates.op10_surrogates(make_docs([None, "x"])).collect()] == [0, 0]
