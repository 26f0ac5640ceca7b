"""Session settings shared by every job, and results that several branches of a plan share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# SQL settings the operators are designed for. They may be changed on a running session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split over tasks even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a running session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession) -> Iterator[SparkSession]:
    """The SQL settings while a plan is built; the caller's own are back afterwards.

    The time zone is fixed when Spark resolves the expressions of a plan, so a DataFrame made inside keeps it.
    """
    before = {key: spark.conf.get(key) for key in SQL_SETTINGS}
    try:
        yield tune(spark)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def build(app: str = "tenure", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the SQL settings; `conf` holds extra settings with dots as double underscores."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared(df: DataFrame, scratch: str | None) -> DataFrame:
    """`df` written once to a new folder under `scratch` and read back, so that several branches share one computation.

    `scratch` is a folder that every executor can reach and that the caller cleans up. Without one, `df` itself
    is returned and Spark reuses the exchanges that the branches have in common.
    """
    if scratch is None:
        return df
    folder = f"{scratch}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under `spark.checkpoint.dir`, which the driver and all executors share.

    Where that is unset, a session on one machine (tests) gets a temporary folder; on a cluster that is an error.
    """
    shared_root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared_root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared_root = tempfile.mkdtemp(prefix="scratch-")
    return f"{shared_root}/{uuid.uuid4().hex}"
