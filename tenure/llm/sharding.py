"""Sharding (operator 6): a two-pass external shuffle.

Pass one scatters the records over buckets by a seeded hash; the number of buckets follows the bytes of the
table, so that one bucket fits in memory whatever the size of the table. Pass two puts each bucket into a
fixed order and shuffles it there (Fisher-Yates). The buckets one after the other are the shuffled table;
its records are dealt to the shards in turn, so the row counts of shards differ by one at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tenure.llm.tables import written

BUCKET_BYTES = 16_000_000
#: Buckets whose row counts are summed up in one task; the sums of these groups are one small row each.
GROUP = 4096


def _permuted(key: tuple, table: pa.Table, seed: int) -> pa.Table:
    """One bucket, sorted by its hashes and then shuffled; `_at` is the place in the bucket."""
    bucket = key[0].as_py()
    table = table.sort_by([("_rank", "ascending"), ("_tie", "ascending")])
    random = np.random.Generator(np.random.PCG64([seed, bucket]))
    order = np.arange(table.num_rows)
    random.shuffle(order)  # Fisher-Yates
    shuffled = table.take(pa.array(order)).drop_columns(["_rank", "_tie"])
    return shuffled.append_column("_at", pa.array(np.arange(table.num_rows), pa.int64()))


def _starts(rows: DataFrame) -> DataFrame:
    """_bucket and _start, the rows of all buckets before it: running sums within groups of buckets, and over the groups."""
    grouped = rows.withColumn("_group", F.floor(F.col("_bucket") / GROUP))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = grouped.groupBy("_group").agg(F.sum("_n").alias("_n")).select("_group", before(Window.orderBy("_group")).alias("_ahead"))
    inside = grouped.select("_bucket", "_group", before(Window.partitionBy("_group").orderBy("_bucket")).alias("_within"))
    return inside.join(groups, "_group").select("_bucket", (F.col("_ahead") + F.col("_within")).alias("_start"))


def shuffle_into_shards(docs: DataFrame, shards: int = 8, seed: int = 42, bucket_bytes: int = BUCKET_BYTES, column: str = "text") -> DataFrame:
    """`docs` with size, shard and slot.

    size is the UTF-8 bytes of the text (null: none) plus 1. shard runs from 0; slot numbers the rows of a
    shard without gaps from 0. Rows equal in every column may swap places, which no one can tell; rows that
    share only an id are scattered by their texts. Null ids and texts are hashed like any value. An empty
    table gives an empty result. Columns named size, shard or slot are replaced.
    """
    columns = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    kept = docs.select(F.struct(*docs.columns).alias("row"))  # so that no name of the caller's can clash
    size = (F.coalesce(F.octet_length(F.col("row")[column]), F.lit(0)) + 1).cast("long")
    total = kept.select(F.sum(size).alias("bytes")).first()["bytes"] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    own = [F.col("row")[c] for c in columns]
    # Other columns than the id enter the hash, so that one id with many rows is scattered too.
    scattered = kept.select("*", F.xxhash64(F.lit(seed), *own).alias("_rank"), F.xxhash64(F.lit(seed + 1), *own).alias("_tie"), size.alias("size"))
    scattered = scattered.withColumn("_bucket", F.pmod("_rank", F.lit(buckets)).cast("int"))
    inner = StructType([f for f in scattered.schema.fields if f.name not in ("_rank", "_tie")] + [StructField("_at", LongType())])
    shuffled = scattered.groupBy("_bucket").applyInArrow(lambda key, table: _permuted(key, table, seed), inner)
    # Rows of each bucket, from the hashes alone: one small row per bucket, numbered through.
    rows = scattered.groupBy("_bucket").agg(F.count("*").alias("_n"))
    starts = _starts(rows)
    place = F.col("_start") + F.col("_at")
    placed = shuffled.join(starts, "_bucket")
    return placed.select(*[F.col("row")[c].alias(c) for c in columns], "size", F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.floor(place / shards).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder per shard; its files, by name, hold its rows in slot order. A shard may span many tasks."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def op6_shuffle_shards(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    sharded = shuffle_into_shards(docs.select("doc_id", "text"))
    return sharded.select(
        "doc_id", "size", F.crc32("text").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast(IntegerType()).alias("grown_shard"),
    )
