"""Language ID (operator 8): prediction by partial matching over bytes.

Each language has a tree of byte contexts up to three bytes long, counted on a bounded sample of its labelled
documents and then frozen. A byte is coded in the longest context that the tree holds; where the context has
not seen the byte, an escape is paid (method C: distinct followers / (count + distinct followers)) and the
next shorter context is tried, down to a uniform byte. The code length of a whole text under each tree is
exact, in bits. The shortest code wins; the score is its share among 2 ** -bits of all languages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from tenure.llm.blocks import blocks, give_back, text_bytes, worker_cache
from tenure.llm.tables import in_sample, keys

ORDER = 3
#: Labelled documents per language that a tree is counted on at most.
DOCUMENTS_PER_LANGUAGE = 150
UNKNOWN = "und"


def training_sample(docs: DataFrame, per_language: int = DOCUMENTS_PER_LANGUAGE) -> DataFrame:
    """(lang, text) of at most `per_language` documents of each language, drawn by a hash of the id."""
    # Twice as many as wanted by the hash alone, so that only these are put in order.
    share = docs.filter("lang is not null").groupBy("lang").agg(F.least(F.lit(1.0), 2 * per_language / F.count("*")).alias("_share"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")))
    labelled = docs.filter("lang is not null and text is not null and text <> ''").select("doc_id", "lang", "text")
    drawn = labelled.join(keys(share), "lang").filter(in_sample(F.col("_share"), "doc_id"))
    return drawn.withColumn("_rank", rank).filter(F.col("_rank") <= per_language).select("lang", "text")


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, int], int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            data = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
            for size in range(1, ORDER + 2):
                if len(data) < size:
                    break
                code = np.zeros(len(data) - size + 1, np.int64)
                for k in range(size):
                    code = code << 8 | data[k : k + len(code)]
                for key, n in zip(*(x.tolist() for x in np.unique(code | np.int64(size) << 32, return_counts=True))):
                    counts[lang, key] = counts.get((lang, key), 0) + n
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["lang", "gram", "n"])


def gram_counts(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages, and (language, gram, count) of the nodes of their trees. Bounded by the sample, hence collected."""
    counted = sample.mapInArrow(_gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counted.orderBy("lang", "gram").toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    place = {lang: i for i, lang in enumerate(languages)}
    return languages, np.stack([np.asarray([place[x] for x in found.column("lang").to_pylist()], np.int64), found.column("gram").to_numpy(), found.column("n").to_numpy()])


class Trees:
    """Frozen code lengths of all languages: one row of bits per (context, byte)."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        grams = counts[1]
        seen = np.unique(grams[grams >> 32 == 1] & 0xFF).tolist()
        # Bytes that no tree has seen share symbol 0.
        self.symbol = np.zeros(256, np.int64)
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        n = len(self.languages)
        nodes: list[dict[int, list[dict[int, int]]]] = [{} for _ in range(ORDER + 1)]
        for lang, gram, count in zip(*counts.tolist()):
            size, code = gram >> 32, gram & 0xFFFFFFFF
            node = nodes[size - 1].setdefault(code >> 8, [{} for _ in range(n)])
            node[lang][int(self.symbol[code & 0xFF])] = count
        # Row 0 is the empty context; every context of any language has a row, filled from shorter ones.
        self.rows: list[dict[int, int]] = [{} for _ in range(ORDER + 1)]
        self.bits = np.empty((sum(map(len, nodes)), self.width, n), np.float32)
        made = 0
        for order in range(ORDER + 1):
            for context in sorted(nodes[order]):
                if order == 0:
                    base = np.full((self.width, n), 8.0)
                else:
                    base = self.bits[self._row(context & ((1 << 8 * (order - 1)) - 1), order - 1)]
                row = base.astype(np.float64)
                for lang, follow in enumerate(nodes[order][context]):
                    if follow:
                        total = sum(follow.values()) + len(follow)
                        row[:, lang] -= np.log2(len(follow) / total)
                        at = list(follow)
                        row[at, lang] = -np.log2(np.asarray(list(follow.values())) / total)
                self.rows[order][context] = made
                self.bits[made] = row
                made += 1
        self.bits = self.bits.reshape(-1, n)
        # The row of each context of three symbols, found by its last three symbols.
        w = self.width
        back = {int(s): b for b, s in enumerate(self.symbol) if s}
        self.jump = np.zeros(w**ORDER, np.int32)
        self._fill(back)

    def _row(self, context: int, order: int) -> int:
        while context not in self.rows[order]:
            order -= 1
            context &= (1 << 8 * order) - 1
        return self.rows[order][context]

    def _fill(self, back: dict[int, int]) -> None:
        """jump[context] = row of its longest suffix that has a row; shorter contexts first, longer ones over them."""
        w = self.width
        cube = self.jump.reshape((w,) * ORDER)
        for order in range(1, ORDER + 1):
            for context, row in self.rows[order].items():
                at = tuple(int(self.symbol[context >> 8 * k & 0xFF]) for k in range(order - 1, -1, -1))
                cube[(slice(None),) * (ORDER - order) + at] = row

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each text under each language."""
        symbols = self.symbol[data]
        n = len(symbols)
        first = np.zeros(n, np.int64)  # position of each byte in its text, up to ORDER
        for k in range(1, ORDER + 1):
            at = offsets[:-1] + k - 1
            at = at[at < offsets[1:]]
            first[at] = ORDER + 1 - k
        context = np.zeros(n, np.int64)
        for k in range(ORDER, 0, -1):
            context[k:] += symbols[: n - k] * self.width ** (k - 1) if n > k else 0
        rows = self.jump[context].astype(np.int64)
        for at in np.flatnonzero(first):  # near the start of a text only its own bytes are context
            have = ORDER - first[at]
            code = 0
            for b in data[at - have : at].tolist():
                code = code << 8 | b
            rows[at] = self._row(code, int(have))
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        running = np.zeros(n + 1)
        flat = rows * self.width + symbols
        for lang in range(len(self.languages)):
            np.cumsum(self.bits[flat, lang], out=running[1:], dtype=np.float64)
            out[:, lang] = np.diff(running[offsets])
        return out


def _predicted(batches: Iterator[pa.RecordBatch], languages: list[str], counts: np.ndarray, stamp: str, column: str) -> Iterator[pa.RecordBatch]:
    trees: Trees | None = worker_cache("trees", stamp, lambda: Trees(languages, counts) if languages else None)
    give_back()
    for block in blocks(batches, column):
        letters = block.column(block.num_columns - 1).to_numpy(zero_copy_only=False)
        if trees is None:
            names, scores = [UNKNOWN] * block.num_rows, np.zeros(block.num_rows)
            bits = np.zeros((block.num_rows, 0))
        else:
            bits = trees.lengths(*text_bytes(block.column(column)))
            best = bits.argmin(axis=1)
            spare = bits - bits.min(axis=1, keepdims=True)
            scores = np.where(letters, 1 / np.exp2(-np.minimum(spare, 1000.0)).sum(axis=1), 0.0)
            names = [trees.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
        kept = block.schema.names[:-1]
        columns = [*block.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(list(bits), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score", "code_bits"])


def identify(docs: DataFrame, sample: DataFrame, column: str = "text") -> DataFrame:
    """`docs` with lang_pred, score (0 to 1) and code_bits, the code length under each language by name.

    `sample` has lang and text. A null text and a text without a letter are `und` with score 0, as is
    everything if the sample is empty. Equal code lengths go to the first language by name. Clashing columns
    are replaced; every row is judged by itself, so repeated rows need no rule.
    """
    languages, counts = gram_counts(sample)
    stamp = hashlib.sha256(counts.tobytes()).hexdigest() + ",".join(languages)
    kept = docs.drop("lang_pred", "score", "code_bits")
    schema = StructType([*kept.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("code_bits", ArrayType(DoubleType()))])
    letters = F.coalesce(F.col(column).rlike(r"\p{L}"), F.lit(False))
    # The flag travels as the last column, under a name that no other column has.
    return kept.select("*", letters.alias("_letters".rjust(9 + max(map(len, kept.columns)), "_"))).mapInArrow(lambda batches: _predicted(batches, languages, counts, stamp, column), schema)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept back from training; a null id never is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op8_ppm_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learnt from those not held out."""
    sample = training_sample(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text"), sample).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
