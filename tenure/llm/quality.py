"""Quality rules (operator 9): word and line statistics, and a hashed n-gram likelihood ratio.

Byte 5-grams are hashed into a fixed number of buckets. Two multinomials are estimated over the buckets: one
from all trusted documents (those labelled good), one from all documents. A document's score is the mean over
its n-grams of log(p trusted / p raw), hence free of length. Every document whose score lies below one
threshold is rejected: the mean score of all trusted documents less `spread` standard deviations.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tenure.llm.blocks import Words, blocks, byte_table, mix, text_bytes
from tenure.llm.tables import keys

BUCKETS = 1 << 16
GRAM = 5
WINDOW = 8
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every byte n-gram that lies in one text, and how many each text has."""
    if len(data) < GRAM:
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    values = byte_table(5)[data]
    n = len(data) - GRAM + 1
    with np.errstate(over="ignore"):
        total = values[:n].copy()
        for k in range(1, GRAM):
            total = total * np.uint64(0x9E3779B97F4A7C15) + values[k : k + n]
    whole = np.ones(n, bool)
    for edge in range(1, GRAM):  # n-grams that would run over the end of a text
        at = offsets[1:-1] - edge
        whole[at[(at >= 0) & (at < n)]] = False
    buckets = ((total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)
    return buckets[whole], np.maximum(0, np.diff(offsets) - GRAM + 1)


def _counted(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for block in blocks(batches, column):
        total += np.bincount(gram_buckets(*text_bytes(block.column(column)))[0], minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])


def gram_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """(bucket, n) over all texts: a row per bucket and task is shuffled, no n-gram is."""
    partial = texts.select(column).mapInArrow(lambda batches: _counted(batches, column), "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of all documents labelled good, once each."""
    return keys(labels.filter("quality = 1 and doc_id is not null").select("doc_id"))


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """log(p trusted / p raw) of each bucket. The trusted counts are smoothed with the raw distribution."""
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for into, texts in ((raw, docs), (good, trusted)):
        for row in gram_counts(texts).collect():  # at most BUCKETS rows
            into[row["bucket"]] = row["n"]
    p_raw = (raw + 1) / (raw + 1).sum()
    return np.log((good + BUCKETS * p_raw) / (good.sum() + BUCKETS) / p_raw)


def _repeated(words: Words, n_texts: int) -> np.ndarray:
    """Words of each text that lie in a window of WINDOW words which the text has twice or more."""
    n = len(words.start) - WINDOW + 1
    if n <= 0:
        return np.zeros(n_texts, np.int64)
    hashes = words.hashes()
    with np.errstate(over="ignore"):
        total = hashes[:n].copy()
        for k in range(1, WINDOW):
            total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
        total = mix(total + mix(words.text[:n].astype(np.uint64)))
    inside = np.flatnonzero(words.text[:n] == words.text[WINDOW - 1 :])
    order = np.argsort(total[inside], kind="stable")
    ranked = total[inside][order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(ranked), bool)
    twice[1:] |= same
    twice[:-1] |= same
    found = inside[order[twice]]
    cover = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + WINDOW, -1)
    return np.bincount(words.text[np.cumsum(cover[:-1]) > 0], minlength=n_texts)


def _duplicate_lines(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n_texts = len(offsets) - 1
    if not len(words.start):
        return np.zeros(n_texts, np.int64)
    breaks = np.flatnonzero(data == 0x0A)
    # The line of a word reaches from the break (or text start) before it to the break (or text end) after it.
    before = np.searchsorted(breaks, words.start)
    start = np.maximum(offsets[words.text], np.concatenate([[0], breaks + 1])[before])
    end = np.minimum(offsets[words.text + 1], np.concatenate([breaks, [len(data)]])[before])
    fresh = np.append(True, start[1:] != start[:-1])
    start, end, text = start[fresh], end[fresh], words.text[fresh]
    raw = data.tobytes()
    lines = {(t, raw[a:b]) for t, a, b in zip(text.tolist(), start.tolist(), end.tolist())}
    return np.bincount(text, minlength=n_texts) - np.bincount(np.fromiter((t for t, _ in lines), np.int64, len(lines)), minlength=n_texts)


def _gram_scores(data: np.ndarray, offsets: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The mean log ratio over the n-grams of each text; 0 without any."""
    buckets, n_grams = gram_buckets(data, offsets)
    sums = np.zeros(len(buckets) + 1)
    np.cumsum(ratios[buckets], out=sums[1:])
    return np.diff(sums[np.concatenate([[0], np.cumsum(n_grams)])]) / np.maximum(1, n_grams)


def _rated(batches: Iterator[pa.RecordBatch], ratios: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        score = _gram_scores(*text_bytes(block.column("text")), ratios)
        yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "llr"])


def trusted_scores(docs: DataFrame, ids: DataFrame, ratios: np.ndarray) -> DataFrame:
    """llr of every trusted document. All are scored where they lie, so that no text is shuffled for it."""
    schema = StructType([docs.schema["doc_id"], StructField("llr", DoubleType())])
    rated = docs.select("doc_id", "text").mapInArrow(lambda batches: _rated(batches, ratios), schema)
    return rated.join(ids, "doc_id", "left_semi").select("llr")


def _scored(batches: Iterator[pa.RecordBatch], ratios: np.ndarray, column: str) -> Iterator[pa.RecordBatch]:
    def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        running = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=running[1:])
        return np.diff(running[offsets])

    for block in blocks(batches, column):
        data, offsets = text_bytes(block.column(column))
        n_texts = len(offsets) - 1
        words = Words(data, offsets)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[words.start] += 1
        np.subtract.at(inside, words.end, 1)
        in_word = np.cumsum(inside[:-1], dtype=np.int8) > 0
        score = _gram_scores(data, offsets, ratios)
        stats = [words.counts(), per_text(in_word & ((data & 0xC0) != 0x80), offsets), per_text(_SYMBOLS[data], offsets), _duplicate_lines(data, offsets, words), _repeated(words, n_texts)]
        fields = [pa.array(s, pa.int64()) for s in stats] + [pa.array(score, pa.float64())]
        yield pa.RecordBatch.from_arrays([*block.columns, *fields], names=[*block.schema.names, *_STATS, "llr"])


def quality_scores(docs: DataFrame, ratios: np.ndarray, column: str = "text") -> DataFrame:
    """`docs` with the word and line statistics and `llr`, the score; clashing columns are replaced."""
    kept = docs.drop(*_STATS, "llr")
    schema = StructType([*kept.schema.fields, *(StructField(n, LongType()) for n in _STATS), StructField("llr", DoubleType())])
    return kept.mapInArrow(lambda batches: _scored(batches, ratios, column), schema)


def quality_rules(docs: DataFrame, labels: DataFrame, spread: float = 4.0) -> DataFrame:
    """`docs` with statistics, llr, base_failed and kept.

    A null or empty text has no words, hence base_failed. Texts under 5 bytes score 0. Without trusted
    documents no threshold holds and only base_failed rejects. Labels may repeat or be null. Every document
    is judged by itself, so ties and repeated rows need no rule.
    """
    ids = trusted_ids(labels)
    ratios = log_ratios(docs, docs.select("doc_id", "text").join(ids, "doc_id", "left_semi"))
    seen = trusted_scores(docs, ids, ratios).agg(F.avg("llr").alias("mean"), F.stddev_pop("llr").alias("std")).first()
    threshold = -math.inf if seen["mean"] is None else seen["mean"] - spread * seen["std"]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return quality_scores(docs, ratios).withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("llr") >= F.lit(threshold)))


def op9_quality_llr(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five statistics, base_failed, kept and llr of every document."""
    judged = quality_rules(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    return judged.select("doc_id", *_STATS, "base_failed", "kept", "llr")
