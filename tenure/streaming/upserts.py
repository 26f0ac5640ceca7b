"""Keyed upserts, in batches or from a file stream, into hash buckets that a manifest names.

A key always falls into the same bucket. A load is reduced to its newest row per key, meets the rows of the buckets it
touches, and only these are written again, each into a new folder; one rename then publishes the new list of
folders. So a read is a plain scan of one row per key, a load that dies leaves the table as it was, and
readers of the old version are not disturbed. Rows of a key are ordered by the version columns, across loads too,
and by the load number where these are equal: a late load of older rows changes nothing, nor does a load that runs twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tenure.operators.loads import upsert
from tenure.operators.ranking import latest_per_key
from tenure.sources.published import Folder, manifest, publish, sweep

LOAD = "__load"
BUCKET = "__bucket"
#: Buckets of a new table, set with its first load. A bucket should fill a few tasks.
BUCKETS = 32


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _folders(folder: Folder, content: dict, only: set[int] | None = None) -> list[str]:
    return [f"{folder.root}/{at}" for bucket, at in content.get("buckets", {}).items() if only is None or int(bucket) in only]


def _rows(spark: SparkSession, folders: list[str], schema: StructType) -> DataFrame:
    stored = StructType([*schema.fields, StructField(LOAD, LongType())])
    return spark.read.schema(stored).parquet(*folders) if folders else spark.createDataFrame([], stored)


def _write(folder: Folder, rows: DataFrame, keys: Sequence[str], buckets: int) -> str:
    at = f"data/{uuid.uuid4().hex}"
    # Rebalancing writes few files per bucket and splits a bucket that is too big for a task.
    rows.withColumn(BUCKET, _bucket(keys, buckets)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{folder.root}/{at}")
    return at


def append_load(batch: DataFrame, load_id: int, table: str, keys: Sequence[str], version: Sequence[str], buckets: int = BUCKETS) -> None:
    """Merge one load into the table; `version` columns order the rows of a key, highest wins, NULL last.

    NULL keys match each other. `buckets` counts for the first load only.
    """
    spark = batch.sparkSession
    folder = Folder(spark, table)
    before, content = manifest(folder)
    buckets = content.get("n_buckets", buckets)
    order = [F.col(c).desc_nulls_last() for c in [*version, LOAD]]
    schema = batch.schema
    # The load, reduced, is written once: it tells the touched buckets and is merged with them.
    staged = f"{folder.root}/_staged/{uuid.uuid4().hex}"
    latest_per_key(batch.withColumn(LOAD, F.lit(load_id).cast("long")), keys, order).write.parquet(staged)
    newest = _rows(spark, [staged], schema)
    touched = {r[0] for r in newest.select(_bucket(keys, buckets).alias("b")).distinct().collect()}  # at most `buckets`
    if touched:
        current = _rows(spark, _folders(folder, content, touched), schema)
        at = _write(folder, upsert(current, newest, keys, order), keys, buckets)
        named = {**content.get("buckets", {}), **{str(b): f"{at}/{BUCKET}={b}" for b in touched}}
        publish(folder, before, {"buckets": named, "n_buckets": buckets})
    folder.delete(staged[len(folder.root) + 1 :])


def read_current(spark: SparkSession, table: str, schema: StructType, keys: Sequence[str] = ()) -> DataFrame:
    """The newest row per key: a scan of the current folders, without a sort or a shuffle.

    Given `keys`, it is known to hold one row per key of theirs; nothing is done for it.
    """
    folder = Folder(spark, table)
    return _rows(spark, _folders(folder, manifest(folder)[1]), schema).drop(LOAD)


def compact(spark: SparkSession, table: str, schema: StructType, keys: Sequence[str], buckets: int | None = None, keep: int = 1) -> None:
    """Write the table anew in place, into `buckets` buckets if given, and delete all but the last `keep` versions."""
    folder = Folder(spark, table)
    before, content = manifest(folder)
    if before:
        n = buckets or content["n_buckets"]
        rows = _rows(spark, _folders(folder, content), schema)
        at = _write(folder, rows, keys, n)
        filled = [name.split("=")[1] for name in folder.names(at) if name.startswith(f"{BUCKET}=")]
        publish(folder, before, {"buckets": {b: f"{at}/{BUCKET}={b}" for b in filled}, "n_buckets": n})
        sweep(folder, "data", ["buckets"], keep)


def stream_upserts(
    spark: SparkSession,
    source: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    version: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load all files not loaded yet, then stop; the checkpoint remembers what was loaded."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(batch: DataFrame, batch_id: int) -> None:
        append_load(prepare(batch), batch_id, table, keys, version)

    return (
        reader.load(source).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
