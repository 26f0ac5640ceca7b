"""Near-duplicates (operator 2): HyperMinHash registers, banded, estimated, and verified on full shingle sets.

A document is the set of its 5-word shingles. For each of 96 hash functions the smallest value over the set is
kept in 16 bits: its number of leading zeros and the next ten bits, the mantissa. Documents with equal sets are one
class. Bands of four registers put classes into buckets. A pair of one bucket is worth a look if its share of equal
registers, corrected for registers that collide by chance, does not rule out the threshold; it is then verified on
the full sets. Verified links make components.

A bucket of up to SMALL classes is compared in pairs. A larger one is not:
1. A shingle that no other class of large buckets has cannot be shared. A class whose share of such shingles
   exceeds 1 - threshold has no link and leaves.
2. Each class is compared with the pivot of its bucket, the class with the fewest shingles of its own.
3. What is still apart from its pivot is joined exactly, by prefix filtering: sets that reach the threshold share
   one of their rarest shingles, at places that leave room for enough others. Pairs already in one component are
   skipped.
So no group is expanded into all pairs, and no link that would join two components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tenure.llm.blocks import Words, blocks, fresh_worker, mix, text_bytes
from tenure.llm.components import components
from tenure.llm.tables import keys, written

SHINGLE = 5
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Classes in a bucket up to which its pairs are compared directly.
SMALL = 12
#: Standard deviations that an estimate may lie below the threshold before a pair is ruled out.
SLACK = 6.0


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, and the text of each, by text and hash."""
    words = Words(data, offsets)
    hashes = words.hashes(fold=True)
    counts = words.counts()
    out_hash, out_text = [], []
    n = len(hashes) - SHINGLE + 1
    with np.errstate(over="ignore"):
        if n > 0:
            total = hashes[:n].copy()
            for k in range(1, SHINGLE):
                total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
            inside = words.text[:n] == words.text[SHINGLE - 1 :]
            out_hash.append(mix(total[inside]))
            out_text.append(words.text[:n][inside])
        for size in range(1, SHINGLE):  # a text with fewer words is one shingle
            short = np.flatnonzero(counts == size)
            if len(short):
                first = np.searchsorted(words.text, short)
                total = np.full(len(short), size, np.uint64)
                for k in range(size):
                    total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[first + k]
                out_hash.append(mix(total))
                out_text.append(short)
    if not out_hash:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, text = np.concatenate(out_hash), np.concatenate(out_text)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]))
    return hashes[fresh], text[fresh]


def registers(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of the sets that begin at `starts`: leading zeros and mantissa bits of each minimum."""
    seeds = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64))
    smallest = np.empty((len(starts), REGISTERS), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(REGISTERS):
            value = (hashes ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1))
            value ^= value >> np.uint64(32)
            smallest[:, k] = np.minimum.reduceat(value * np.uint64(0xD6E8FEB86659FD93), starts)
    # Leading zeros from the exponent of the value in floating point, exact for 53 bits below the first one bit.
    top = (smallest >> np.uint64(11)).astype(np.float64)
    zeros = np.where(smallest >> np.uint64(11) == 0, 53, 53 - np.frexp(top)[1]).astype(np.uint64)
    mantissa = ((smallest << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return (zeros << np.uint64(MANTISSA) | mantissa).astype(">u2")


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fresh_worker()
    for block in blocks(batches):
        hashes, text = shingle_sets(*text_bytes(block.column("text")))
        n_texts = block.num_rows
        sizes = np.bincount(text, minlength=n_texts) if len(text) else np.zeros(n_texts, np.int64)
        full = np.flatnonzero(sizes)
        starts = np.searchsorted(text, full)
        keys: list[bytes | None] = [None] * n_texts
        values: list[bytes | None] = [None] * n_texts
        if len(full):
            with np.errstate(over="ignore"):
                sums = [np.add.reduceat(mix(hashes ^ np.uint64(seed)), starts) for seed in (0x51ED2701, 0xA511E9B3)]
            packed = np.stack([*sums], axis=1).astype(">u8").tobytes()
            kept = registers(hashes, starts).tobytes()
            for i, at in enumerate(full.tolist()):
                keys[at] = packed[16 * i : 16 * i + 16]
                values[at] = kept[2 * REGISTERS * i : 2 * REGISTERS * (i + 1)]
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(values, pa.binary())], names=["doc_id", "n_shingles", "set_key", "registers"]
        )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, registers); the last two are null for an empty set."""
    kind = docs.schema["doc_id"].dataType
    schema = StructType([StructField("doc_id", kind), StructField("n_shingles", LongType()), StructField("set_key", BinaryType()), StructField("registers", BinaryType())])
    return docs.select("doc_id", "text").mapInArrow(_signed, schema)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fresh_worker()
    for block in blocks(batches):
        hashes, text = shingle_sets(*text_bytes(block.column("text")))
        ends = np.searchsorted(text, np.arange(block.num_rows + 1))
        values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([block.column("rep"), values], names=["rep", "shingles"])


def _share(a: Column, b: Column) -> Column:
    """Share of equal registers of two register strings."""
    equal = F.aggregate(F.sequence(F.lit(0), F.lit(REGISTERS - 1)), F.lit(0), lambda n, k: n + F.when(F.substring(a, 2 * k + 1, F.lit(2)) == F.substring(b, 2 * k + 1, F.lit(2)), 1).otherwise(0))
    return equal / REGISTERS


def chance(n: Column, m: Column) -> Column:
    """Probability that a register of two disjoint sets of n and m shingles is equal: same leading zeros, same mantissa."""
    at = lambda size, z: F.exp(-size * F.pow(F.lit(2.0), -z - 1)) - F.exp(-size * F.pow(F.lit(2.0), -z))
    same = F.aggregate(F.sequence(F.lit(0), F.lit(52)), F.lit(0.0), lambda p, z: p + at(n, z) * at(m, z))
    return same * 2.0**-MANTISSA


def corrected(share: Column, by_chance: Column) -> Column:
    """Jaccard estimate out of the share of equal registers, less those equal by chance."""
    return (share - by_chance) / (1 - by_chance)


def _linked(a: Column, b: Column, percent: int) -> Column:
    common = F.size(F.array_intersect(a, b))
    return 100 * common >= percent * (F.size(a) + F.size(b) - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("_b"))
    return pairs.join(left, "a").join(right, "b").filter(_linked(F.col("_a"), F.col("_b"), percent)).select("a", "b")


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that the registers do not rule out."""
    floor = percent / 100 - SLACK * math.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS)
    left = classes.select(F.col("rep").alias("a"), F.col("registers").alias("_ra"), F.col("n_shingles").alias("_na"))
    right = classes.select(F.col("rep").alias("b"), F.col("registers").alias("_rb"), F.col("n_shingles").alias("_nb"))
    both = pairs.join(left, "a").join(right, "b")
    sizes = 100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb")
    estimate = corrected(_share(F.col("_ra"), F.col("_rb")), chance(F.col("_na"), F.col("_nb")))
    return both.filter(sizes).filter(estimate >= floor).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`, linked at Jaccard >= percent / 100.

    component_id is the smallest id that links reach. Null and empty texts and texts without a word have no
    shingles and are their own component. Rows that share an id are one document, whose links are those of all its
    texts. A null id takes part under no id: its component is null and it is kept. Columns other than doc_id and
    text are not read. A pair at similarity 0.85 shares a
    bucket with probability 1 - 2e-8, one at 0.8 with 1 - 4e-6, closer ones with more.
    """
    signed = written(signatures(docs))
    classes = signed.filter("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
    classes = written(classes)
    edges = written(_class_links(docs, classes, percent))
    labels = components(edges.unionByName(_shared_ids(signed, classes)))
    of_class = classes.join(labels, F.col("rep") == F.col("node"), "left").select("set_key", F.coalesce("component", "rep").alias("_component"))
    found = signed.join(of_class, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _shared_ids(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of texts that share an id."""
    several = signed.filter("set_key is not null and doc_id is not null").groupBy("doc_id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y"), F.count("*").alias("n")).filter("n > 1 and x <> y")
    members = signed.join(several.select("doc_id"), "doc_id").join(classes.select("set_key", "rep"), "set_key").select("doc_id", "rep").distinct()
    first = members.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return members.join(first, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b"))


def _class_links(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Verified links between classes that make up their components."""
    bands = F.array(*(F.struct(F.lit(b).alias("band"), F.substring("registers", 2 * ROWS * b + 1, 2 * ROWS).alias("value")) for b in range(BANDS)))
    rows = classes.select("rep", F.explode(bands).alias("_band")).select("rep", F.xxhash64("_band.band", "_band.value").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(rows.join(sizes, "bucket"))
    reps = keys(members.select("rep"))
    sets = written(_full_sets(docs, reps))
    near = classes.join(reps, "rep", "left_semi")

    small = members.filter(F.col("n") <= SMALL).select("bucket", "rep")
    pairs = small.select("bucket", F.col("rep").alias("a")).join(small.select("bucket", F.col("rep").alias("b")), "bucket").filter("a < b").select("a", "b").distinct()
    large = members.filter(F.col("n") > SMALL).select("bucket", "rep")
    if large.isEmpty():
        return verified(_estimated(pairs, near, percent), sets, percent)

    # 1. Shingles that one class alone has, among the classes of large buckets.
    in_large = sets.join(large.select("rep").distinct(), "rep", "left_semi")
    shingles = in_large.select("rep", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    frequency = shingles.groupBy("s").agg(F.count("*").alias("df"), F.min("rep").alias("rep"))
    frequency = written(frequency)
    own = frequency.filter("df = 1").groupBy("rep").agg(F.count("*").alias("own"))
    able = in_large.select("rep", F.size("shingles").alias("n")).join(own, "rep", "left").fillna(0, ["own"])
    able = written(able.filter(100 * (F.col("n") - F.col("own")) >= percent * F.col("n")))
    # 2. The pivot of each bucket.
    large = written(large.join(able, "rep"))
    pivots = large.groupBy("bucket").agg(F.min(F.struct("own", "rep"))["rep"].alias("pivot"))
    stars = large.join(pivots, "bucket").filter("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    edges = written(verified(_estimated(pairs.unionByName(stars).distinct(), near, percent), sets, percent))
    # 3. Classes apart from the pivot of a bucket meet the others of large buckets by prefix filtering.
    label = written(large.select("rep").distinct().join(components(edges), F.col("rep") == F.col("node"), "left").select("rep", F.coalesce("component", "rep").alias("component")))
    of_pivot = pivots.join(label.select(F.col("rep").alias("pivot"), F.col("component").alias("_with")), "pivot")
    apart = large.join(of_pivot, "bucket").join(label, "rep").filter("component <> _with").select("rep").distinct()
    apart = written(apart)
    if apart.isEmpty():
        return edges
    rest = verified(_prefix_pairs(sets, able, frequency, label, apart, percent), sets, percent)
    return edges.unionByName(rest)


def _full_sets(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, shingles) of the classes in `reps`, out of the text of the document that stands for each."""
    texts = docs.select(F.col("doc_id").alias("rep"), "text")
    kind = docs.schema["doc_id"].dataType
    schema = StructType([StructField("rep", kind), StructField("shingles", ArrayType(LongType()))])
    return texts.join(reps, "rep", "left_semi").mapInArrow(_sets, schema).filter(F.size("shingles") > 0)


def _prefix_pairs(sets: DataFrame, able: DataFrame, frequency: DataFrame, label: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """Pairs of one class of `apart` and any other that share one of their rarest shingles at a place that fits."""
    tokens = sets.join(able.select("rep"), "rep", "left_semi").select("rep", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("df", "s"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    ranked = tokens.join(frequency.select("s", "df"), "s").withColumn("at", place).filter((F.col("at") <= prefix) & (F.col("df") > 1)).join(label, "rep")
    ranked = written(ranked.select("rep", "n", "s", "at", "component"))
    left = ranked.join(apart, "rep", "left_semi").select(F.col("rep").alias("a"), F.col("n").alias("na"), "s", F.col("at").alias("ia"), F.col("component").alias("ca"))
    right = ranked.select(F.col("rep").alias("b"), F.col("n").alias("nb"), "s", F.col("at").alias("ib"), F.col("component").alias("cb"))
    need = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))
    room = 1 + F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    met = (left["s"] == right["s"]) & (F.col("ca") != F.col("cb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (room >= need)
    return left.join(right, met).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def op2_hyperminhash(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    return near_duplicates(docs.select("doc_id", "text"))


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of `docs` that stand for their component, columns as they are; rows with a null id all stay."""
    dropped = keys(near_duplicates(docs.select("doc_id", "text"), percent).filter(~F.col("kept")).select("doc_id"))
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
