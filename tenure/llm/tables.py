"""Reading the tables and cutting lineage in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.sources.published import Folder

#: Rows up to which a list of keys is sent to all tasks; a longer one is joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Spark's setting (4.1 on) that removes the shuffle files of a query at its end.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`, which all executors share, set as the context's checkpoint folder.

    Where neither that setting nor a checkpoint folder of the context is there, a session on one machine (tests) gets
    a folder of its own; on a cluster that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return named or context.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder, and read from there whatever becomes of an executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Stored:
    """Tables written as Parquet below the shared folder, which takes a fraction of a checkpoint's bytes; `free` deletes them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.name = spark, f"stored-{uuid.uuid4().hex}"
        self.count = 0

    def written(self, df: DataFrame) -> DataFrame:
        at = f"{shared_folder(self.spark)}/{self.name}/{self.count}"
        self.count += 1
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def free(self) -> None:
        Folder(self.spark, shared_folder(self.spark)).delete(self.name)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs whose DataFrames are built and run inside leave no shuffle files: these go when the job ends, not when the driver next collects its garbage."""
    before = spark.conf.get(FREES_SHUFFLES, None)
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREES_SHUFFLES)
        else:
            spark.conf.set(FREES_SHUFFLES, before)


def keys(listed: DataFrame) -> DataFrame:
    """Distinct keys, written once, and marked for broadcast if they are few enough."""
    listed = written(listed.distinct())
    return F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed


def in_sample(share: Column, *columns: str) -> Column:
    """Whether the hash of the columns falls into the lowest `share` of all hashes; the same rows each time."""
    return F.pmod(F.xxhash64(F.lit("sample"), *columns), F.lit(1 << 30)) < share * (1 << 30)
