"""Importance resampling towards a target distribution (operator 11): hashed word runs, and an exact top-k draw.

Every run of words falls into one of `BUCKETS` buckets. The corpus and the target texts are counted per bucket, an
array of fixed size; the log ratio of the two is a bucket's gain, and a document's weight is the sum of the gains of
its runs, taken from that array for a whole block of texts at once. Gumbel noise, keyed by the document, makes the top k
scores a weighted draw without replacement.

The draw needs no sort of all documents. Keys (score, id, row) are kept sorted in chunks. In each round every chunk
names the median of the keys it has left on either side of the last pivot; the median of these, weighted by the sizes left, is the next
pivot, so at least a quarter of what is left goes in each round, until one key is left: the cutoff. Only the winners
are then sorted, over ranges of keys, and numbered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.llm.blocks import blocks, text_bytes
from tenure.llm.tables import written

BUCKETS = 10_000
SEED = 2024
#: Words of this many bytes or fewer are hashed side by side, byte by byte; longer ones one by one.
SHORT = 32
#: Keys of a chunk, and bytes of text that are hashed at once.
CHUNK = 500_000
TEXT_BYTES = 1_000_000
_IN_WORD = np.array([chr(b).encode("latin-1").isalnum() or b >= 128 for b in range(256)])
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _crc_table() -> np.ndarray:
    """The table of the reflected polynomial 0xEDB88320, by its rule."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc32_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The unsigned crc32 of each byte span."""
    size = end - start
    out = np.full(len(start), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(size, SHORT + 1), kind="stable")
    left = np.searchsorted(-np.minimum(size, SHORT + 1)[order], -np.arange(1, SHORT + 1), "right")
    first = start[order]
    crc = out[order]
    for at in range(SHORT):
        n = int(left[at])
        if not n:
            break
        part = crc[:n]
        crc[:n] = _CRC[(part ^ data[first[:n] + at]) & 0xFF] ^ (part >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > SHORT).tolist():
        out[i] = zlib.crc32(data[start[i]:end[i]])
    return out


class Runs:
    """The buckets of all runs of 1 to `longest` words of a block of texts, and the text of each."""

    def __init__(self, texts: pa.Array, longest: int, buckets: int) -> None:
        raw, offsets = text_bytes(texts)
        data = _FOLD[raw]
        inside = _IN_WORD[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        text = np.searchsorted(offsets, start, "right") - 1
        self.words = np.bincount(text, minlength=len(texts))
        found, where = [crc32_spans(data, start, end)], [text]
        for n in range(2, longest + 1):  # longer runs are spelled out, joined by one space
            begin = np.flatnonzero(text[n - 1:] == text[: len(text) - n + 1]) if len(text) >= n else np.zeros(0, np.int64)
            spelled = [b" ".join(data[start[i + j]:end[i + j]].tobytes() for j in range(n)) for i in begin.tolist()]
            found.append(np.array([zlib.crc32(s) for s in spelled], np.uint32))
            where.append(text[begin])
        self.bucket = np.concatenate(found).astype(np.int64) % buckets
        self.text = np.concatenate(where)
        self.features = np.bincount(self.text, minlength=len(texts))


def bucket_counts(texts: DataFrame, column: str, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many runs of all texts fall into each bucket. A task sends one number per bucket it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for block in blocks(batches, "text", TEXT_BYTES):
            total += np.bincount(Runs(block.column("text"), longest, buckets).bucket, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    counted = texts.select(F.col(column).cast("string").alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most `buckets` rows
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in the target over that in the raw corpus) of each bucket."""
    buckets = len(raw)
    s, t = raw.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def scored(docs: DataFrame, gains: np.ndarray, longest: int = 1, seed: int = SEED, column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """id, n_words, n_features, weight and score of every document. Nulls: no words; the noise key has an empty id."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", TEXT_BYTES):
            runs = Runs(block.column("text"), longest, len(gains))
            # Sums of whole numbers below 2 ** 53 are exact in doubles.
            weight = np.bincount(runs.text, weights=gains[runs.bucket], minlength=block.num_rows).astype(np.int64)
            noise = block.column("noise").to_numpy(zero_copy_only=False).astype(float)
            gumbel = np.floor(-1000 * np.log(-np.log((noise + 0.5) / 4294967296.0))).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), pa.array(runs.words), pa.array(runs.features), pa.array(weight), pa.array(weight + gumbel)],
                ["id", "n_words", "n_features", "weight", "score"],
            )

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    noise = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.col(column).cast("string").alias("text"), noise.alias("noise"))
    return read.mapInArrow(score, "id long, n_words long, n_features long, weight long, score long")


_KEY = np.dtype([("score", np.int64), ("id", np.int64), ("row", np.int64)])


def _keys(negated_score: np.ndarray, ident: np.ndarray, row: np.ndarray) -> np.ndarray:
    out = np.empty(len(row), _KEY)
    out["score"], out["id"], out["row"] = negated_score, ident, row
    return out


def _chunks(keys: DataFrame) -> DataFrame:
    """Sorted chunks of keys (negated score, id with null as the largest, row), each one binary value, written once."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(_keys(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("less", "ident", "row"))))
            if sum(map(len, held)) >= CHUNK:
                yield _packed(held)
                held = []
        if held:
            yield _packed(held)

    return written(keys.select("less", "ident", "row").mapInArrow(pack, "keys binary"))


def _packed(held: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.sort(np.concatenate(held)).tobytes()], pa.binary())], ["keys"])


def _less(keys: np.ndarray, key: tuple[int, int, int]) -> int:
    """How many of the sorted keys come before `key`: three binary searches, one per part."""
    low, high = 0, len(keys)
    for name, value in zip(("score", "id", "row"), key):
        part = keys[name][low:high]
        low, high = low + int(np.searchsorted(part, value, "left")), low + int(np.searchsorted(part, value, "right"))
    return low


def weighted_median(medians: list[tuple[tuple[int, int, int], int]]) -> tuple[int, int, int]:
    """The median at which the sizes, summed in the order of the medians, first reach half."""
    medians = sorted(medians)
    half, at = sum(size for _, size in medians) / 2, 0
    for median, size in medians:
        at += size
        if at >= half:
            return median
    raise ValueError("no keys left")


def cutoff_key(keys: DataFrame, k: int) -> tuple[int, int, int]:
    """The k-th smallest of the distinct keys (less, ident, row), k from 1 on, by weighted medians of chunk medians.

    One job per round. A chunk answers with the number of its keys up to the pivot and, for those left below and
    above it, their median and their number. The driver holds two medians per chunk.
    """
    chunks = _chunks(keys)
    least, most = (-(1 << 63),) * 3, ((1 << 63) - 1,) * 3

    def sides(low: tuple, pivot: tuple | None, high: tuple) -> list:
        """Of each chunk and side of the pivot: size and median of the keys in (low, pivot] and (pivot, high]."""

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = []
            for batch in batches:
                for value in batch.column("keys"):
                    part = np.frombuffer(value.as_buffer(), _KEY)
                    cuts = [_less(part, after(low)), _less(part, after(pivot or high)), _less(part, after(high))]
                    for side, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        if b > a:
                            middle = part[(a + b - 1) // 2]
                            rows.append({"side": side, "size": b - a, "less": int(middle["score"]), "ident": int(middle["id"]), "row": int(middle["row"])})
            schema = pa.schema([(c, pa.int64()) for c in ("side", "size", "less", "ident", "row")])
            yield pa.RecordBatch.from_pylist(rows, schema)

        return chunks.mapInArrow(look, "side long, size long, less long, ident long, row long").collect()

    def after(key: tuple) -> tuple:
        return (*key[:2], key[2] + 1) if key[2] < most[2] else key

    low, high, wanted = least, most, k
    found = sides(low, None, high)
    while True:
        left = [((r["less"], r["ident"], r["row"]), r["size"]) for r in found]
        pivot = weighted_median(left)
        found = sides(low, pivot, high)
        below = sum(r["size"] for r in found if r["side"] == 0)
        if wanted <= below:
            if below == 1:
                return pivot
            high, found = pivot, [r for r in found if r["side"] == 0]
            if wanted == below:
                return pivot
        else:
            low, wanted, found = pivot, wanted - below, [r for r in found if r["side"] == 1]


def draw(scores: DataFrame, k: int) -> DataFrame:
    """id, n_features, weight, score and rank of `scores`: 1 to k for the best scores of drawable rows, null for the others.

    Ties go to the smaller id (null last); of rows that share an id and a score those that come first in `scores`, a
    written table, are drawn first.
    """
    rows = scores.withColumn("row", F.monotonically_increasing_id())
    keyed = rows.withColumns({"less": -F.col("score"), "ident": F.coalesce("id", F.lit((1 << 63) - 1))})
    none = F.lit(None).cast("long").alias("rank")
    if k < 1:
        return rows.select("id", "n_features", "weight", "score", none)
    less, ident, row = cutoff_key(keyed.filter("drawable"), k)
    wins = F.col("drawable") & (F.struct("less", "ident", "row") <= F.struct(*[F.lit(v).cast("long") for v in (less, ident, row)]))
    order = ["less", "ident", "row"]
    winners = written(keyed.filter(wins).repartitionByRange(*order).sortWithinPartitions(*order))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), sum(batch.num_rows for batch in batches)
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([n])], ["part", "n"])

    counts = sorted((r["part"], r["n"]) for r in winners.mapInArrow(sizes, "part long, n long").collect())
    before = dict(zip((p for p, _ in counts), np.cumsum([0, *(n for _, n in counts)]).tolist()))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = before.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            ranks = pa.array(np.arange(at + 1, at + 1 + batch.num_rows), pa.int64())
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "n_features", "weight", "score")), ranks], ["id", "n_features", "weight", "score", "rank"])

    ranked = winners.select("id", "n_features", "weight", "score").mapInArrow(number, "id long, n_features long, weight long, score long, rank long")
    return ranked.unionByName(keyed.filter(~wins).select("id", "n_features", "weight", "score", none))


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), least_words: int = 20, longest: int = 1, buckets: int = BUCKETS, seed: int = SEED, column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """id, n_features, weight, score and rank of every document: a draw of floor(share * N) of the N with `least_words` words or more.

    Words are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased; features are runs of 1 to `longest` words
    joined by a space. A null or empty text has none and weight 0. Ids are integers; rows that share one are drawn
    apart, with the same noise; a null id has the noise of the empty string and comes last among ties. Without target texts all
    gains follow the raw counts alone; an empty table gives an empty result. Other columns are not read.
    """
    gains = bucket_gains(bucket_counts(docs, column, longest, buckets), bucket_counts(target, column, longest, buckets))
    scores = scored(docs, gains, longest, seed, column, id_column)
    drawable = written(scores.withColumn("drawable", F.col("n_words") >= least_words))
    n = drawable.filter("drawable").count()
    return draw(drawable, share[0] * n // share[1])


def op11_importance_draw(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document, drawn towards the texts of the benchmark."""
    return resample(docs, target).withColumnRenamed("id", "doc_id")
