"""Keyed loads: upsert, load-missing-only, discovery, staleness, freshness and rejects."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.operators.joins import attach, keep_missing
from tenure.operators.ranking import latest_per_key

LOAD_ID = "_load_id"


def stamp(df: DataFrame, load_id: int) -> DataFrame:
    """Add the load id, the epoch second of the load, as text."""
    return df.withColumn(LOAD_ID, F.lit(str(load_id)))


def load_time(load_id: Column) -> Column:
    """Timestamp of an epoch-second load id given as text."""
    return F.timestamp_seconds(load_id.cast("decimal(38,0)").cast("bigint"))


def upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str], version: Sequence[Column]) -> DataFrame:
    """`base` with the rows of `delta` merged in by key; the newest version wins, at equal versions the delta.

    `version` gives the order, newest first. `base` must hold one row per key; rows that the delta does not
    touch are only filtered (anti-join), never sorted, and the others meet it to compare versions, so a late
    delta with an older version changes nothing. NULL keys match each other.
    """
    newest = latest_per_key(delta, keys, version)
    same = reduce(lambda x, y: x & y, [F.col(f"b.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    touched = base.alias("b").join(newest.select(*keys).alias("n"), same, "left_semi")
    both = touched.withColumn("__late", F.lit(0)).unionByName(newest.withColumn("__late", F.lit(1)))
    settled = latest_per_key(both, keys, [*version, F.col("__late").desc()]).drop("__late")
    return keep_missing(base, newest, list(keys), null_safe=True).unionByName(settled)


def rebuild(loads: DataFrame, keys: Sequence[str], version: Sequence[Column]) -> DataFrame:
    """The same table built in full from all loads."""
    return latest_per_key(loads, keys, version)


def load_missing_only(everything: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `everything` whose key is not loaded yet."""
    return keep_missing(everything, loaded.select(*keys).distinct(), list(keys))


def discover(snapshots: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct entities across snapshots."""
    return reduce(lambda a, b: a.unionByName(b), [s.select(*keys) for s in snapshots]).distinct()


def stale_targets(
    dim: DataFrame,
    facts: DataFrame,
    key: str,
    fact_key: str,
    fact_date: str,
    strength: str,
    min_strength: float,
    as_of: Column,
    stale_days: int,
    always: DataFrame | None = None,
) -> DataFrame:
    """Strong entities whose latest fact is missing or older than `stale_days`, plus a fixed list.

    `always` has the same key; those of its rows not discovered anyway are added.
    """
    latest = facts.groupBy(F.col(fact_key).alias("__key")).agg(F.max(fact_date).alias("__latest"))
    strong = attach(dim.where(F.col(strength) >= min_strength), latest, {key: "__key"}, "left")
    overdue = F.col("__latest").isNull() | (F.datediff(as_of, F.col("__latest")) > stale_days)
    found = strong.where(overdue).drop("__latest")
    if always is None:
        return found
    columns = [c for c in found.columns if c in always.columns]
    found = found.select(*columns)
    return found.unionByName(keep_missing(always.select(*columns), found, [key]))


def freshness(loads: DataFrame, source: str, load_ts: str, as_of: Column, warn_days: int, error_days: int) -> DataFrame:
    """One row per source: last load time, age in days and pass / warn / error (NULL load is an error)."""
    last = loads.groupBy(source).agg(F.max(load_ts).alias("last_load"))
    age = (F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(F.col("last_load").cast("timestamp"))) / 86400.0
    return last.withColumn("age_days", age).withColumn(
        "status",
        F.when(F.col("last_load").isNull() | (F.col("age_days") > error_days), "error")
        .when(F.col("age_days") > warn_days, "warn")
        .otherwise("pass"),
    )


def newest_file(spark: SparkSession, path: str) -> DataFrame:
    """One row: the newest file time below a path (`last_load`) and the number of files. Only the listing is read, no data."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.max("modificationTime").alias("last_load"), F.count(F.lit(1)).alias("n_files"))


def file_freshness(spark: SparkSession, sources: dict[str, tuple[str, int, int]], as_of: Column) -> DataFrame:
    """One row per source: source, last_load, n_files, age_days, status; `sources` gives path, warn and error days.

    The age is that of the newest file, so a source whose load failed grows old whatever its rows say.
    """
    parts = []
    for source, (path, warn, error) in sources.items():
        age = (F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp("last_load")) / 86400.0
        status = F.when(F.col("last_load").isNull() | (age > error), "error").when(age > warn, "warn").otherwise("pass")
        parts.append(newest_file(spark, path).select(F.lit(source).alias("source"), "last_load", "n_files", age.alias("age_days"), status.alias("status")))
    return reduce(DataFrame.unionByName, parts)


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, rejected); a rejected row lists the names of the rules it breaks.

    A rule that evaluates to NULL counts as broken. The load goes on without the rejected rows.
    """
    broken = F.filter(F.array(*[F.when(F.coalesce(ok, F.lit(False)), None).otherwise(F.lit(name)) for name, ok in rules.items()]), lambda r: r.isNotNull())
    marked = df.withColumn("reject_reasons", broken)
    return (
        marked.where(F.size("reject_reasons") == 0).drop("reject_reasons"),
        marked.where(F.size("reject_reasons") > 0),
    )
