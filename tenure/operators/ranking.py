"""Top-1 per key, first/last per tenure, dedup, top-k and spectra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.operators.joins import attach


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    Spark prunes each map task to one row per key before the shuffle (WindowGroupLimit), so a hot
    key sends at most one row per task. `order` must be total for a stable result.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def dedup_most_complete(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    completeness: Sequence[Column],
    tiebreak: Sequence[Column],
    drop_undated: bool = False,
) -> DataFrame:
    """One row per natural key and date: the most complete one.

    `completeness` flags sort TRUE first with NULL above TRUE, as in the warehouse rule this
    follows. An undated row is a key of its own (sentinel date), so an undated and a dated row of
    the same move both stay, unless `drop_undated` is set.
    """
    out = df.withColumn("__day", F.coalesce(date, F.lit("1900-01-01").cast("date")))
    order = [c.desc_nulls_first() for c in completeness]
    out = latest_per_key(out, [*keys, "__day"], [*order, *tiebreak]).drop("__day")
    if drop_undated:
        dated = out.where(F.col(date).isNotNull()).select(*keys).distinct().withColumn("__dated", F.lit(True))
        out = attach(out, dated, list(keys), "left", null_safe=True)
        out = out.where(F.col(date).isNotNull() | F.col("__dated").isNull()).drop("__dated")
    return out


def first_last(
    df: DataFrame,
    group_keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    rank_keys: Sequence[str] | None = None,
    first: str = "first_",
    last: str = "last_",
) -> DataFrame:
    """First and last values per group, in (order) order; `order` must be unique inside a rank group.

    With `rank_keys` coarser than `group_keys` only the group that holds the first (last) row of the
    whole rank group gets its values; the others get NULL. Both levels are plain aggregates.
    """
    group_keys = list(group_keys)
    row = F.struct(*order, *[F.col(v).alias(f"__v_{v}") for v in values])
    out = df.groupBy(*group_keys).agg(F.min(row).alias("__lo"), F.max(row).alias("__hi"))
    if rank_keys is not None and set(rank_keys) != set(group_keys):
        ends = out.groupBy(*rank_keys).agg(F.min("__lo").alias("__rank_lo"), F.max("__hi").alias("__rank_hi"))
        out = attach(out, ends, list(rank_keys), "left", null_safe=True)
        out = out.withColumn("__lo", F.when(F.col("__lo") == F.col("__rank_lo"), F.col("__lo")))
        out = out.withColumn("__hi", F.when(F.col("__hi") == F.col("__rank_hi"), F.col("__hi")))
    return out.select(
        *group_keys,
        *[F.col(f"__lo.__v_{v}").alias(f"{first}{v}") for v in values],
        *[F.col(f"__hi.__v_{v}").alias(f"{last}{v}") for v in values],
    )


def last_period_rows(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """The rows that carry the highest non-NULL period of their key."""
    last = df.where(F.col(period).isNotNull()).groupBy(*keys).agg(F.max(period).alias("__last"))
    return attach(df, last, {**{k: k for k in keys}, period: "__last"}, "left_semi")


def topk(df: DataFrame, order: Sequence[Column], k: int, offset: int = 0) -> DataFrame:
    """The first k rows after `offset`; each task keeps k + offset rows, the driver merges those."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(k)


def spectrum(
    df: DataFrame,
    by: str,
    k: int,
    tiebreak: Sequence[str],
    labels: tuple[str, str],
    label: str,
) -> DataFrame:
    """The k best and the k worst rows, labelled by the sign of `by`.

    With fewer than 2k rows a row is listed at both ends, as in a UNION ALL of two limits. The input is read once: each
    row stands for both ends, and each task keeps its first k of either before the shuffle (WindowGroupLimit).
    """
    ends = df.where(F.col(by).isNotNull()).withColumn("__end", F.explode(F.array(F.lit(0), F.lit(1))))
    ties = [F.col(t).asc_nulls_last() for t in tiebreak]
    order = [F.when(F.col("__end") == 0, F.col(by)).desc(), F.when(F.col("__end") == 1, F.col(by)).asc(), *ties]
    placed = ends.withColumn("__rn", F.row_number().over(Window.partitionBy("__end").orderBy(*order)))
    positive, negative = labels
    return placed.where(F.col("__rn") <= k).drop("__end", "__rn").withColumn(label, F.when(F.col(by) >= 0, positive).otherwise(negative))
