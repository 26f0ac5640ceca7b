"""BPE encoding and decoding (operator 1) with content-defined chunk reuse.

A rolling hash over the last bytes of a text decides where its chunks end, so a passage that several
documents share falls into the same chunks in each of them, wherever it stands. A worker encodes such a
chunk once and reuses the result. A chunk's encoding is certain only between its first and its last white
space: the word fragments at its two edges go on in the neighbouring chunks. So every join is repaired: the
open fragments on both sides are encoded again as one window, which grows over further chunks until white
space bounds it on both sides. Beyond white space the two encodings agree exactly, because no token, no
normalisation and no special token reaches across it.

Reuse stays within a Python worker and needs no exchange: sharing results between workers would move every
text and its ids through two shuffles, more than encoding costs. What a worker keeps is bounded.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tenure.llm.blocks import Recent, Words, blocks, byte_table, text_bytes, worker_cache
from tenure.llm.wordbpe import VOCABULARY, WordBpe

#: A chunk ends where the hash of its last 16 bytes has ten zero bits, but not before 256 bytes and at 8 KB at the latest.
WINDOW = 16
CUT_MASK = np.uint64((1 << 10) - 1)
LEAST, MOST = 256, 8192
#: New chunks and words of a worker after which it forgets those that it no longer meets.
CHUNKS_KEPT = 4_000
WORDS_KEPT = 60_000
WHITE = b" \t\n\x0b\x0c\r"


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the WINDOW bytes that end at each position (fewer at the start), by doubling."""
    base = 0x9E3779B97F4A7C15
    out = byte_table(11)[data]
    width = 1
    with np.errstate(over="ignore"):
        while width < WINDOW:
            factor = np.uint64(pow(base, width, 1 << 64))
            out[width:] = out[width:] + out[:-width] * factor
            width *= 2
    return out >> np.uint64(40)


def cut_points(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """For each text of a block the ends of its chunks, always between two characters."""
    fits = (rolling_hashes(data) & CUT_MASK) == 0
    heads = np.append((data & 0xC0) != 0x80, True)
    wanted = np.flatnonzero(fits & heads[1:]) + 1
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        ends = []
        at = a
        # A window that reaches into the text before says nothing about this one.
        for cut in wanted[np.searchsorted(wanted, a + WINDOW) : np.searchsorted(wanted, b)].tolist():
            while cut - at > MOST:
                at = _forced(heads, at)
                ends.append(at)
            if cut - at >= LEAST:
                ends.append(cut)
                at = cut
        while b - at > MOST:
            at = _forced(heads, at)
            ends.append(at)
        if at < b:
            ends.append(b)
        out.append(ends)
    return out


def _forced(heads: np.ndarray, at: int) -> int:
    end = at + MOST
    while not heads[end]:
        end -= 1
    return end


class ChunkEncoder(WordBpe):
    """Encodes texts chunk by chunk; keeps chunks and words that it has met. Ids are held as packed 32-bit integers."""

    def __init__(self, vocabulary: str) -> None:
        super().__init__(vocabulary)
        tokens = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.names = pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.string())
        self.spec = None  # the vocabulary as text is not needed any more
        self.words = Recent(WORDS_KEPT)
        #: chunk -> (head fragment, ids inside, tail fragment or None if there is no white space)
        self.chunks = Recent(CHUNKS_KEPT)

    def word_ids(self, word: bytes) -> bytes:
        known = self.words.get(word)
        if known is None:
            known = array("i", self.encode(word.decode())).tobytes()
            self.words.put(word, known)
        return known

    def learn_chunks(self, chunks: list[bytes]) -> dict[bytes, tuple[bytes, bytes, bytes | None]]:
        """The encoding of each chunk; those that are not kept are encoded together."""
        out = {}
        inner: list[bytes] = []
        fresh: list[tuple[bytes, bytes, bytes | None]] = []
        for chunk in chunks:
            if chunk in out:
                continue
            known = self.chunks.get(chunk)
            if known is not None:
                out[chunk] = known
                continue
            first = next((i for i, c in enumerate(chunk) if c in WHITE), -1)
            if first < 0:
                head, body, tail = chunk, b"", None
            else:
                stop = len(chunk.rstrip(WHITE))
                if stop < len(chunk):
                    last = stop
                else:
                    last = max(chunk.rfind(w) for w in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
                head, body, tail = chunk[:first], chunk[first:last], chunk[last:].lstrip(WHITE)
            out[chunk] = None
            fresh.append((chunk, head, tail))
            inner.append(body)
        offsets = np.zeros(len(inner) + 1, np.int64)
        np.cumsum([len(b) for b in inner], out=offsets[1:])
        words = Words(np.frombuffer(b"".join(inner), np.uint8), offsets)
        distinct, which = words.distinct()
        ids = [self.word_ids(w) for w in distinct]
        picked = list(map(ids.__getitem__, which.tolist()))
        bounds = np.searchsorted(words.text, np.arange(len(inner) + 1)).tolist()
        for (chunk, head, tail), a, b in zip(fresh, bounds, bounds[1:]):
            out[chunk] = (head, b"".join(picked[a:b]), tail)
            self.chunks.put(chunk, out[chunk])
        return out

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The packed ids of each text of a block."""
        raw = data.tobytes()
        texts = []
        for start, ends in zip(offsets[:-1].tolist(), cut_points(data, offsets)):
            texts.append([raw[a:b] for a, b in zip([start, *ends], ends)])
        known = self.learn_chunks([c for chunks in texts for c in chunks])
        # Each text as finished parts in turn with windows over the joins, which are still to be encoded.
        parts: list[tuple[list[bytes], list[bytes]]] = []
        for chunks in texts:
            windows, inside = [], []
            window: list[bytes] = []
            for chunk in chunks:
                head, ids, tail = known[chunk]
                window.append(head)
                if tail is not None:
                    windows.append(b"".join(window))
                    inside.append(ids)
                    window = [tail]
            windows.append(b"".join(window))
            parts.append((windows, inside))
        out = []
        for windows, inside in parts:
            repaired = [self.word_ids(w) if w else b"" for w in windows]
            out.append(b"".join([x for pair in zip(repaired, [*inside, b""]) for x in pair]))
        return out


def _encoder(vocabulary: str) -> ChunkEncoder:
    return worker_cache("chunk encoder", vocabulary, lambda: ChunkEncoder(vocabulary))


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, column: str, decoded: bool) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(vocabulary)
    for block in blocks(batches, column):
        packed = encoder.encode_texts(*text_bytes(block.column(column)))
        sizes = [len(p) // 4 for p in packed]
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))
        columns, names = [*block.columns, pa.array(sizes, pa.int64()), ids], [*block.schema.names, "n_tokens", "token_ids"]
        if decoded:
            columns, names = [*columns, _texts(encoder, ids)], [*names, "decoded"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, column: str = "text", decoded: bool = False) -> DataFrame:
    """`docs` with n_tokens and token_ids, as the tokenizer gives them for the whole text.

    With `decoded` also the text that `decode` makes of the ids, by the same worker, which then holds one tokenizer
    and not two. A null or empty text has an empty list. Columns of these names are replaced. Every row is
    encoded by itself, so repeated rows, ties and empty tables need no rule.
    """
    fields = [StructField("n_tokens", LongType()), StructField("token_ids", ArrayType(IntegerType()))] + [StructField("decoded", StringType())] * decoded
    kept = docs.drop(*[f.name for f in fields])
    return kept.mapInArrow(lambda batches: _encoded(batches, vocabulary, column, decoded), StructType([*kept.schema.fields, *fields]))


def _joined(lists: pa.ListArray, names: pa.Array) -> pa.Array | None:
    """The tokens of each id list joined by spaces, as the library does without a decoder; None if an id is unknown."""
    ids = lists.flatten()
    if len(ids) and not 0 <= pc.min(ids).as_py() <= pc.max(ids).as_py() < len(names):
        return None
    tokens = names.take(ids)
    if tokens.null_count:
        return None
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens), " ")
    return pc.if_else(lists.is_valid(), joined, pa.scalar(None, pa.string()))


def _texts(encoder: ChunkEncoder, lists: pa.ListArray) -> pa.Array:
    """The tokenizer's text of each id list."""
    out = []
    for at in range(0, len(lists), 256):
        part = lists.slice(at, 256)
        texts = _joined(part, encoder.names) if encoder.tokenizer.decoder is None else None
        if texts is None:
            texts = pa.array([None if ids is None else encoder.tokenizer.decode(ids, skip_special_tokens=False) for ids in part.to_pylist()], pa.string())
        out.append(texts)
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


def _decoded(batches: Iterator[pa.RecordBatch], vocabulary: str, column: str) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(vocabulary)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield pa.RecordBatch.from_arrays([*part.columns, _texts(encoder, part.column(column))], names=[*part.schema.names, "decoded"])


def decode(ids: DataFrame, vocabulary: str = VOCABULARY, column: str = "token_ids") -> DataFrame:
    """`ids` with `decoded`, the tokenizer's text of each id list; a null list stays null."""
    kept = ids.drop("decoded")
    return kept.mapInArrow(lambda batches: _decoded(batches, vocabulary, column), StructType([*kept.schema.fields, StructField("decoded", StringType())]))


def op1_chunk_bpe(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    both = encode(docs.select("doc_id", "text"), vocabulary, decoded=True)
    return both.select(
        "doc_id", "n_tokens",
        F.sha2(F.array_join("token_ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
