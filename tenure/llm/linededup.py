"""Line dedup (operator 13): lines that many documents share stay in the last of them only.

Each line of some length sends its hash, its document and its position. These are range-partitioned and sorted by
(hash, document descending, position), so the first document of a hash is the one that keeps its lines, and one
pass over a partition finds what to drop. A hash with very many lines spreads over neighbouring partitions: their
edges are summed up first, in two rows per partition, so that each partition knows the first document and the
number of documents of a hash that goes on beyond it. Text does not travel: the result is one compressed bitmap
of kept lines per document, which `apply_bitmaps` lays over the texts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tenure.llm.blocks import blocks
from tenure.llm.tables import written

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
_WHITE = " \t\n\x0b\x0c\r"
_NO_ID = -(1 << 63)
_DROPS = StructType([StructField("doc", LongType()), StructField("tag", LongType()), StructField("at", IntegerType())])
_EDGES = StructType([
    StructField("part", IntegerType()), StructField("side", IntegerType()), StructField("key", BinaryType()),
    StructField("first", LongType()), StructField("last", LongType()), StructField("docs", LongType()),
])


def _identity(id_column: str, column: str) -> list[Column]:
    """doc and tag: the id, and a checksum that tells texts of one id apart."""
    return [F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(column).alias("tag")]


def line_keys(lines: pa.Array) -> pa.Array:
    """Lines without white space at their ends, A-Z in lower case."""
    return pc.ascii_lower(pc.utf8_trim(lines, characters=_WHITE))


def _hashed(batches: Iterator[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    """key, doc, tag and at of each long enough line."""
    for block in blocks(batches):
        lists = pc.split_pattern(pc.fill_null(block.column("text"), "").cast(pa.large_string()), "\n")
        lines, offsets = lists.flatten(), lists.offsets.to_numpy()
        long = np.flatnonzero(pc.greater_equal(pc.utf8_length(lines), least_chars).to_numpy(zero_copy_only=False))
        keys = line_keys(lines.take(pa.array(long)))
        still = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), least_chars).to_numpy(zero_copy_only=False))
        long, keys = long[still], keys.take(pa.array(still)).cast(pa.large_binary()).to_pylist()
        own = np.searchsorted(offsets, long, "right") - 1
        # 128 bits of BLAKE2: two different lines do not share them by chance, nor by anyone's design.
        digests = pa.array([hashlib.blake2b(k, digest_size=16).digest() for k in keys], pa.binary())
        taken = pa.array(own)
        yield pa.RecordBatch.from_arrays([digests, block.column("doc").take(taken), block.column("tag").take(taken), pa.array((long - offsets[own]).astype(np.int32))], ["key", "doc", "tag", "at"])


def _sorted_lines(docs: DataFrame, least_chars: int, column: str, id_column: str) -> DataFrame:
    """key, doc, tag and at of each long enough line, in order over all partitions, written once."""
    texts = docs.select(*_identity(id_column, column), F.col(column).cast("string").alias("text"))
    hashed = texts.mapInArrow(lambda batches: _hashed(batches, least_chars), "key binary, doc long, tag long, at int")
    order = [F.col("key"), F.col("doc").desc(), F.col("tag"), F.col("at")]
    return written(hashed.repartitionByRange(*order).sortWithinPartitions(*order))


class Lines:
    """Sorted rows as arrays."""

    def __init__(self, key: np.ndarray, doc: np.ndarray, tag: np.ndarray, at: np.ndarray) -> None:
        self.key, self.doc, self.tag, self.at = key, doc, tag, at

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Lines:
        column = batch.column("key").cast(pa.binary())
        offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
        key = np.frombuffer(column.buffers()[2], np.uint64, 2 * len(column), int(offsets[0])).reshape(-1, 2)
        return cls(key, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag", "at")))

    def part(self, chosen: slice | np.ndarray) -> Lines:
        return Lines(self.key[chosen], self.doc[chosen], self.tag[chosen], self.at[chosen])

    def after(self, before: Lines | None) -> Lines:
        if before is None:
            return self
        return Lines(*(np.concatenate(pair) for pair in ((before.key, self.key), (before.doc, self.doc), (before.tag, self.tag), (before.at, self.at))))

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The first row of each key, and whether a row is the first of its document within its key."""
        fresh = np.ones(len(self.doc), bool)
        fresh[1:] = (self.key[1:] != self.key[:-1]).any(axis=1)
        first_of_doc = fresh.copy()
        first_of_doc[1:] |= self.doc[1:] != self.doc[:-1]
        return np.flatnonzero(fresh), first_of_doc


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last key of a partition with their first document, last document and number of documents."""
    part = TaskContext.get().partitionId()
    head = tail = None  # [key, first, last, docs]; one list while the partition has one key
    for batch in batches:
        if not batch.num_rows:
            continue
        lines = Lines.of(batch)
        starts, first_of_doc = lines.groups()
        ends = np.append(starts[1:], len(lines.doc))
        for start, end in [(0, int(ends[0])), (int(starts[-1]), len(lines.doc))] if len(starts) > 1 else [(0, len(lines.doc))]:
            key, first, last = lines.key[start].tobytes(), int(lines.doc[start]), int(lines.doc[end - 1])
            docs = int(first_of_doc[start:end].sum())
            if start == 0 and tail is not None and tail[0] == key:
                tail[3] += docs - (tail[2] == first)
                tail[2] = last
            elif end == len(lines.doc) or head is None:
                fresh = [key, first, last, docs]
                head = fresh if head is None and start == 0 else head
                tail = fresh if end == len(lines.doc) or tail is None else tail
    found = [] if head is None else [(0, head)] if head is tail else [(0, head), (1, tail)]
    rows = [{"part": part, "side": side, "key": e[0], "first": e[1], "last": e[2], "docs": e[3]} for side, e in found]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("side", pa.int32()), ("key", pa.binary()), ("first", pa.int64()), ("last", pa.int64()), ("docs", pa.int64())]))


def spanning_keys(edges: list) -> dict[bytes, tuple[int, int]]:
    """First document and number of documents of each key that several partitions hold, from their edges in order."""
    found: dict[bytes, list] = {}
    for e in sorted(edges, key=lambda e: (e["part"], e["side"])):
        key = bytes(e["key"])
        if key in found:
            sums = found[key]
            sums[1] += e["docs"] - (sums[2] == e["first"])
            sums[2], sums[3] = e["last"], sums[3] + 1
        else:
            found[key] = [e["first"], e["docs"], e["last"], 1]
    return {key: (first, docs) for key, (first, docs, _, parts) in found.items() if parts > 1}


def _stream_drops(batches: Iterator[pa.RecordBatch], spanning: dict[bytes, tuple[int, int]], least: int) -> Iterator[pa.RecordBatch]:
    """Lines to drop: those behind the first document of a key that `least` documents have.

    The last key of a batch may go on. Until its `least`-th document comes, its rows are held back, which are those
    of fewer documents than that; from then on only its first document is remembered.
    """
    held: Lines | None = None
    known: tuple[bytes, int, bool] | None = None  # a key that needs no counting: its first document, and whether it drops

    def out(lines: Lines, dropped: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(lines.doc[dropped]), pa.array(lines.tag[dropped]), pa.array(lines.at[dropped].astype(np.int32))], ["doc", "tag", "at"])

    for batch in batches:
        if not batch.num_rows:
            continue
        lines = Lines.of(batch).after(held)
        held = None
        starts, first_of_doc = lines.groups()
        sizes = np.diff(np.append(starts, len(lines.doc)))
        docs = np.add.reduceat(first_of_doc, starts, dtype=np.int64)
        keeper = lines.doc[starts].copy()
        edge = {0, len(starts) - 1}
        for g in edge:  # only the keys at a partition's ends can span partitions, and those are at a batch's ends or alone
            key = lines.key[starts[g]].tobytes()
            if key in spanning:
                keeper[g], docs[g] = spanning[key]
            elif g == 0 and known is not None and known[0] == key:
                keeper[g], docs[g] = known[1], least if known[2] else 0
        last = len(starts) - 1
        key = lines.key[starts[last]].tobytes()
        known = (key, int(keeper[last]), True) if docs[last] >= least else None
        if known is None and key not in spanning:
            held = lines.part(slice(int(starts[last]), None))
        dropped = np.repeat(docs >= least, sizes) & (lines.doc != np.repeat(keeper, sizes))
        yield out(lines, dropped)


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc, tag, n_lines, n_dropped and keep of each document: a bit per line, packed from the lowest and deflated.

    Lines are split at \\n; a null or empty text is one empty line. A line whose key (`line_keys`) has `least_chars`
    code points or more and is found in `least_documents` documents or more stays in the largest id that holds it,
    there with all its repeats, and goes from the others. Ids are integers; rows that share an id are one document,
    and `tag`, a checksum of the text, tells their bitmaps apart; a null id (doc: the smallest long) counts as the
    smallest id. Rows equal in id and text share one bitmap. An empty table gives an empty result.
    """
    lines = _sorted_lines(docs, least_chars, column, id_column)
    spanning = spanning_keys(lines.mapInArrow(_edges, _EDGES).collect())  # two rows per partition
    drops = lines.mapInArrow(lambda batches: _stream_drops(batches, spanning, least_documents), _DROPS)
    text = F.coalesce(F.col(column), F.lit(""))
    sizes = docs.select(*_identity(id_column, column), (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"), F.lit(None).cast("int").alias("at"))
    both = sizes.unionByName(drops.withColumn("n_lines", F.lit(None).cast("long")))
    marked = both.groupBy("doc", "tag").agg(F.max("n_lines").alias("n_lines"), F.collect_set("at").alias("ats"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for n, ats in zip(batch.column("n_lines").to_pylist(), batch.column("ats")):
                keep = np.ones(n, bool)
                keep[ats.values.to_numpy(zero_copy_only=False)] = False
                maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1))
            dropped = pa.compute.list_value_length(batch.column("ats")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc", "tag", "n_lines")), dropped, pa.array(maps, pa.binary())], ["doc", "tag", "n_lines", "n_dropped", "keep"])

    return marked.mapInArrow(pack, "doc long, tag long, n_lines long, n_dropped long, keep binary")


def kept_lines(text: str | None, n_lines: int, keep: bytes) -> str:
    """The lines of a text whose bit is set, joined by \\n."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines, bitorder="little")
    return "\n".join([line for line, bit in zip((text or "").split("\n"), bits) if bit])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """`docs` with the text cut down to its kept lines, and n_lines and n_dropped, which replace columns of these names.

    A null text comes back empty, as does one that lost all its lines. Other columns do not enter Python.
    """
    named = docs.select(F.struct("*").alias("row"), F.col(column).cast("string").alias("text"), *_identity(id_column, column))
    joined = named.join(bitmaps.select("doc", "tag", "n_lines", "n_dropped", "keep"), ["doc", "tag"], "left")
    kept = [f for f in docs.schema.fields if f.name not in (column, "n_lines", "n_dropped")]
    rows = joined.select("text", "n_lines", "n_dropped", "keep", F.struct(F.lit(0).alias("_"), *[F.col("row")[f.name].alias(f"c{i}") for i, f in enumerate(kept)]).alias("rest"))

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                text or "" if not dropped else kept_lines(text, n, keep)
                for text, n, dropped, keep in zip(*(batch.column(c).to_pylist() for c in ("text", "n_lines", "n_dropped", "keep")))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("n_lines"), batch.column("n_dropped"), batch.column("rest")], ["text", "n_lines", "n_dropped", "rest"])

    schema = StructType([StructField("text", StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType()), rows.schema["rest"]])
    laid = rows.mapInArrow(lay, schema)
    by_name = {f.name: F.col("rest")[f"c{i}"].alias(f.name) for i, f in enumerate(kept)}
    ordered = [F.col("text").alias(column) if f.name == column else by_name[f.name] for f in docs.schema.fields if f.name == column or f.name in by_name]
    return laid.select(*ordered, "n_lines", "n_dropped")


def op13_line_bitmaps(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every document."""
    narrow = docs.select("doc_id", "text")
    cut = apply_bitmaps(narrow, keep_bitmaps(narrow))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
    WITH lines AS (
        SELECT rowno, doc_id, line, place, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM (SELECT rowno, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place
            FROM (SELECT row_number() OVER () AS rowno, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
    common AS (SELECT key, max(doc_id) AS holder FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    marked AS (SELECT l.*, c.key IS NOT NULL AND l.doc_id <> c.holder AS dropped FROM lines l LEFT JOIN common c USING (key))
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY rowno"""
