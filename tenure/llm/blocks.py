"""Arrow batches of texts as byte blocks, and vectorised word hashing over a block.

Helpers of the operators whose work runs in `mapInArrow`. A block holds a few megabytes of whole
texts, or one text of any length, so memory follows the longest text and never the batch.
"""

from __future__ import annotations

import ctypes
import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 500_000
_MULTIPLIER = 0x9E3779B97F4A7C15
#: Masks of the first n of eight bytes, for a little-endian machine.
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_WHITE = np.zeros(256, bool)
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def worker_cache(name: str, stamp: str, make: Callable[[], object]) -> object:
    """A value made once per worker process. A worker holds one: another name or stamp replaces it.

    Functions travel by value, so module globals do not last from task to task.
    """
    held = sys.__dict__.setdefault("_tenure_llm", {})
    if (name, stamp) not in held:
        if held:
            held.clear()
            give_back()
        held[name, stamp] = make()
    return held[name, stamp]


def fresh_worker() -> None:
    """Drop what an earlier operator left in this worker process, and give the memory back."""
    held = sys.__dict__.get("_tenure_llm")
    if held:
        held.clear()
        give_back()


def give_back() -> None:
    """Return freed memory to the system, which allocators otherwise keep for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Recent:
    """A bounded memo: the last `limit` new entries and those of the generation before that are still in use."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key: object) -> object | None:
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key: object, value: object) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `size` bytes of text each, or a single row."""
    for batch in batches:
        texts = batch.column(column)
        lengths = np.nan_to_num(np.asarray(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False), dtype=float))
        ends = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and the offset of each text; null is empty."""
    filled = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    if filled.offset or len(filled) == 0:
        filled = pa.concat_arrays([filled, pa.array([], pa.large_string())])
    n = len(filled)
    offsets = np.frombuffer(filled.buffers()[1], np.int64, n + 1) if n else np.zeros(1, np.int64)
    start, stop = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(filled.buffers()[2], np.uint8, stop) if stop else np.zeros(0, np.uint8)
    return data[start:stop], offsets - start


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a block: byte start, byte end and index of the text of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, self.offsets = data, offsets
        n = len(data)
        solid = ~_WHITE[data]
        edges = offsets[(offsets > 0) & (offsets < n)]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        first[edges] = solid[edges]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        last[edges - 1] = solid[edges - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.text = np.searchsorted(offsets, self.start, "right") - 1

    def hashes(self, fold: bool = False) -> np.ndarray:
        """A keyed 64-bit BLAKE2 value of each word; `fold` takes A-Z for a-z."""
        distinct, which = self.distinct(fold)
        digests = [hashlib.blake2b(word, digest_size=8, key=b"words").digest() for word in distinct]
        return np.frombuffer(b"".join(digests), np.uint64)[which] if digests else np.zeros(0, np.uint64)

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.text, minlength=len(self.offsets) - 1)

    def distinct(self, fold: bool = False) -> tuple[list[bytes], np.ndarray]:
        """The distinct words and the index of each word among them; `fold` takes A-Z for a-z.

        Words are sorted by a quick hash. Equal words share it; different ones may, by design of a text even, so each
        word is compared with the first of its hash byte by byte, and a block where one differs goes through a dict.
        """
        if not len(self.start):
            return [], np.zeros(0, np.int64)
        data = _FOLD[self.data] if fold else self.data
        _, first, inverse = np.unique(span_hashes(data, self.start, self.end), return_index=True, return_inverse=True)
        inverse = inverse.reshape(-1)
        raw = data.tobytes()
        if equal_spans(data, self.start, self.end, first[inverse]):
            return [raw[a:b] for a, b in zip(self.start[first].tolist(), self.end[first].tolist())], inverse
        index: dict[bytes, int] = {}
        which = [index.setdefault(raw[a:b], len(index)) for a, b in zip(self.start.tolist(), self.end.tolist())]
        return list(index), np.array(which, np.int64)


def equal_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray) -> bool:
    """Whether each byte span equals the span with the index `other`."""
    size = end - start
    if not np.array_equal(size, size[other]):
        return False
    moved = np.flatnonzero(other != np.arange(len(start)))
    a, b, left = start[moved], start[other[moved]], size[moved]
    # Eight bytes at each position, read without regard to alignment.
    eights = np.ndarray((len(data) + 1,), np.uint64, np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    for at in range(0, 64, 8):
        if not len(a):
            return True
        differ = eights[a + at] ^ eights[b + at]
        if (differ & _LOW_BYTES[np.minimum(left - at, 8)]).any():
            return False
        longer = left > at + 8
        a, b, left = a[longer], b[longer], left[longer]
    return all(np.array_equal(data[x + 64 : x + n], data[y + 64 : y + n]) for x, y, n in zip(a.tolist(), b.tolist(), left.tolist()))


def mix(values: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64, copy=True)
        z ^= z >> np.uint64(30)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z


def byte_table(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER) + np.uint64(seed))


def powers(n: int, base: int = _MULTIPLIER) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below n."""
    out = np.full(max(1, n), np.uint64(base), np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums of value(byte i) * base ** i, with a leading zero."""
    values = byte_table(7)
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values[data] * powers(len(data)), out=out[1:])
    return out


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A quick 64-bit hash of each byte span, equal for equal spans at any place. Different spans can be made to share it."""
    if not len(start):
        return np.zeros(0, np.uint64)
    prefix = prefix_hashes(data)
    back = powers(len(data), pow(_MULTIPLIER, -1, 1 << 64))
    with np.errstate(over="ignore"):
        return mix((prefix[end] - prefix[start]) * back[start] + (end - start).astype(np.uint64))
