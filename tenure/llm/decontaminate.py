"""Benchmark decontamination (operator 5): SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Words are runs of letters and digits in lower case; shingles are five words (an item with fewer words is one
shingle). A window of a document has as many words as the item it may copy. From the places of a document where
a shingle is one of the item's follow all windows that hold enough of them to reach the threshold, wherever these
stand in the item, as a copy may have its parts in another order; the other windows cannot reach it and need no
fingerprint. Windows and items get a 64-bit SimHash of their shingle
counts. Fingerprints are cut into one block more than the Hamming radius: two fingerprints within the radius
agree in a block at least, so a join on (item, block, value) of windows and the items whose shingles laid them finds all of
them. Each candidate is verified by the exact weighted Jaccard similarity of the shingle counts.

Everything is column expressions. A bit table of the benchmark's shingles, of bounded size, travels as a
literal and lets a document drop its other shingles before any row is made of them; the joins behind it are
exact, so its size only changes how much they read.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.llm.spans import fixed_array, once
from tenure.llm.tables import keys, written

SHINGLE = 5
SIMILARITY = 0.8
#: Expected distance at similarity 0.8 is 10 bits with a deviation of 3; the radius leaves more than three deviations.
RADIUS = 20
#: Bits of the table: 128 for each shingle of the benchmark, within these bounds. Each shingle sets three.
LEAST_BITS, MOST_BITS = 1 << 14, 1 << 23
#: Where the three bits lie in the hash: lowest bit of the word's number, lowest bit of the place in the word.
PROBES = [(6, 0), (30, 24), (42, 36)]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column, size: int) -> Column:
    """Hashes of the shingles at each position; none if there are fewer words."""
    n = F.size(words)
    at = F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(words, i, size)))


def fingerprint(shingles: Column) -> Column:
    """SimHash: bit b is set if more than half of the shingles, with repeats, have it set."""

    def bit(b: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0), lambda n, s: n + F.getbit(s, b).cast("int"))
        return F.when(2 * ones > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda done, b: done.bitwiseOR(bit(b)))


def blocks_of(print_: Column, radius: int) -> Column:
    """array<struct<no, value>>: the fingerprint in radius + 1 blocks of nearly equal width."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    cut = [F.struct(F.lit(i).alias("no"), F.shiftrightunsigned(print_, a).bitwiseAND((1 << (b - a)) - 1).alias("value")) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return F.array(*cut)


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays, each value weighted by its count."""
    count = lambda values, x: F.size(F.filter(values, lambda y: y == x))
    common = F.aggregate(F.array_distinct(F.array_intersect(a, b)), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))
    return common / (F.size(a) + F.size(b) - common)


def bench_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, m, size, shingles) of the items with a word: m words, shingles of min(5, m) words."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words")).withColumn("m", F.size("words")).filter("m > 0")
    by_size = F.when(F.col("m") >= SHINGLE, shingles_of(F.col("words"), SHINGLE)).otherwise(F.array(F.xxhash64("words")))
    return words.select("item_id", "m", F.least("m", F.lit(SHINGLE)).alias("size"), by_size.alias("shingles"))


def _word_at(h: Column, mask: int, shift: int) -> Column:
    return F.shiftrightunsigned(h, shift).bitwiseAND(mask).cast("int")


def bit_table(shingles: DataFrame) -> tuple[list[int], int]:
    """The 64-bit words of the table, and the mask of a word's number."""
    n = shingles.count()
    bits = LEAST_BITS
    while bits < 128 * n and bits < MOST_BITS:
        bits *= 2
    mask = bits // 64 - 1
    h = F.col("h")
    probes = [F.struct(_word_at(h, mask, s).alias("at"), F.shiftrightunsigned(h, b).bitwiseAND(63).cast("int").alias("bit")) for s, b in PROBES]
    set_ = shingles.select(F.explode(F.array(*probes)).alias("p")).groupBy("p.at").agg(F.bit_or(F.expr("shiftleft(1L, p.bit)")).alias("word"))
    table = [0] * (mask + 1)
    for row in set_.collect():  # at most MOST_BITS / 64 rows
        table[row["at"]] = row["word"]
    return table, mask


def maybe_in(h: Column, table: list[int], mask: int) -> Column:
    words = fixed_array(table, "bigint")
    probe = lambda s, b: F.getbit(F.element_at(words, _word_at(h, mask, s) + 1), F.shiftrightunsigned(h, b).bitwiseAND(63).cast("int")) == 1
    return reduce(and_, (probe(s, b) for s, b in PROBES))


def window_starts(at: Column, n: Column, length: Column, least: Column) -> Column:
    """Starts of the windows of `length` among n places that hold `least` of the places `at`, which ascend: those around any `least` that follow one another."""
    runs = F.when(F.size(at) >= least, F.sequence(F.lit(0), F.size(at) - least)).otherwise(F.array().cast("array<int>"))
    first = lambda i: F.greatest(F.get(at, i + least - 1) - length + 1, F.lit(0))
    last = lambda i: F.least(F.get(at, i), n - length)
    spans = F.transform(runs, lambda i: F.when(first(i) <= last(i), F.sequence(first(i), last(i))).otherwise(F.array().cast("array<int>")))
    return F.array_distinct(F.flatten(spans))


def leaks(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, threshold: float = SIMILARITY) -> DataFrame:
    """(_row, item_id, start, m, distance, similarity): the best window of each row of `docs` for each item it holds.

    `docs` has `_row`, a number of the row, and `text`. Texts and items that are null, empty or without a word
    match nothing; a document with fewer words than an item is one window. All windows of an item's words are
    judged, wherever its shingles stand in them; of equally similar windows the first counts. Items may repeat and item ids may be null. The bit table fills up beyond some 65,000
    shingles; from there on more rows reach the join, and the result is the same.
    """
    items = written(bench_items(benchmark).withColumn("item_key", F.xxhash64("shingles")))
    places = items.select("m", "size", "item_key", F.explode("shingles").alias("h")).distinct()
    sizes = [r["size"] for r in items.select("size").distinct().collect()]  # at most five
    words = docs.select("_row", once(words_of(F.col("text"))).alias("words"))
    found = None
    for size in sorted(sizes):
        table, mask = bit_table(places.filter(F.col("size") == size).select("h").distinct())
        hashed = words.select("_row", once(shingles_of(F.col("words"), size)).alias("all"))
        marked = F.filter(F.transform("all", lambda h, i: F.when(maybe_in(h, table, mask), F.struct(i.alias("at"), h.alias("h")))), lambda s: s.isNotNull())
        hit = hashed.select("*", once(marked).alias("marked")).filter(F.size("marked") > 0).withColumn("size", F.lit(size))
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        ids = benchmark.select("item_id").limit(0)
        return docs.limit(0).select("_row").join(ids, F.lit(False)).selectExpr("_row", "item_id", "0 start", "0 m", "0 distance", "0D similarity")
    found = written(found)
    anchors = found.select("_row", "size", F.size("all").alias("n"), F.explode("marked").alias("s")).select("_row", "size", "n", F.col("s.at").alias("at"), F.col("s.h").alias("h"))
    whole = F.col("m") - F.col("size") + 1  # shingles of the item
    length = F.least("n", whole)  # and of the window
    least = F.ceil(threshold / (1 + threshold) * (length + whole) - F.lit(1e-6)).cast("int")  # that both have, at the threshold
    held = anchors.join(places, ["h", "size"]).groupBy("_row", "size", "m", "item_key").agg(F.first("n").alias("n"), F.sort_array(F.collect_set("at")).alias("at"))
    # A window is laid for the items of which it holds enough shingles, and meets only these.
    starts = window_starts(F.col("at"), F.col("n"), length, F.greatest(least, F.lit(1)))
    laid = written(held.select("_row", "size", "m", "item_key", length.alias("length"), F.explode(starts).alias("start")))
    windows = laid.select("_row", "size", "m", "start", "length").distinct().join(found.select("_row", "size", "all"), ["_row", "size"])
    windows = windows.select("_row", "size", "m", "start", F.slice("all", F.col("start") + 1, F.col("length")).alias("shingles"))
    windows = written(windows.withColumn("print", fingerprint(F.col("shingles"))))
    forms = items.select("m", "item_key", F.col("shingles").alias("item")).dropDuplicates(["m", "item_key"]).withColumn("print", fingerprint(F.col("item")))
    prints = windows.select("_row", "m", "start", F.col("print").alias("p"))
    left = laid.select("_row", "m", "start", "item_key").join(prints, ["_row", "m", "start"]).select("_row", "m", "start", "item_key", "p", F.explode(blocks_of(F.col("p"), radius)).alias("b"))
    right = forms.select("m", "item_key", F.col("print").alias("q"), F.explode(blocks_of(F.col("print"), radius)).alias("b"))
    distance = F.bit_count(F.col("p").bitwiseXOR(F.col("q")))
    near = left.join(right, ["m", "item_key", "b"]).filter(distance <= radius).select("_row", "m", "start", "item_key", distance.alias("distance")).distinct()
    pairs = near.join(forms.drop("print"), ["m", "item_key"]).join(items.select("m", "item_key", "item_id").distinct(), ["m", "item_key"])
    checked = pairs.join(windows.select("_row", "m", "start", "shingles"), ["_row", "m", "start"])
    scored = checked.withColumn("similarity", similarity(F.col("shingles"), F.col("item"))).filter(F.col("similarity") >= threshold)
    best = F.min(F.struct(-F.col("similarity"), "start", "m", "distance"))
    return scored.groupBy("_row", "item_id").agg(best.alias("b")).select("_row", "item_id", "b.start", "b.m", "b.distance", (-F.col("b.col1")).alias("similarity"))


def numbered(docs: DataFrame) -> DataFrame:
    """row, `_row` and text: the row as a struct, so that no name of its own can clash, and 128 bits of hash of it; equal rows share them, and their result."""
    return docs.select(F.struct(*docs.columns).alias("row"), F.struct(F.xxhash64(*docs.columns), F.xxhash64(F.lit("again"), *docs.columns)).alias("_row"), F.col("text").alias("text"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without a window that copies a benchmark item; columns as they are, whatever their names.

    A null or empty text copies nothing and stays; repeated rows stay or go together; an empty table stays empty, and
    an empty benchmark leaves all rows.
    """
    rows = numbered(docs)
    return rows.join(keys(leaks(rows.select("_row", "text"), benchmark).select("_row")), "_row", "left_anti").select("row.*")


def op5_simhash_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, start_word, n_words, distance and similarity."""
    rows = docs.select(F.struct("doc_id", F.xxhash64("doc_id", "text").alias("no")).alias("_row"), "text")
    found = leaks(rows, benchmark.select("item_id", "text"))
    return found.select(F.col("_row.doc_id").alias("doc_id"), "item_id", F.col("start").alias("start_word"), F.col("m").alias("n_words"), "distance", "similarity")
