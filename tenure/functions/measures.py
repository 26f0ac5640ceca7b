"""Null-safe measures, season labels and parameter filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, NULL where the denominator is 0 or NULL."""
    return numerator / F.nullif(denominator, F.lit(0))


def gated(gate: Column, measure: Column) -> Column:
    """The measure where the gate holds, else NULL."""
    return F.when(gate, measure)


def season_start_year(season: Column) -> Column:
    """'22/23' -> 2022 and '95/96' -> 1995: two-digit years from 50 on belong to the 1900s."""
    short = F.left(season, F.lit(2)).cast("int")
    return F.when(short >= 50, short + 1900).otherwise(short + 2000)


def season_label(day: Column) -> Column:
    """The season a day falls in, as '2026–27' (en dash); a season starts on 1 July."""
    first = F.year(day) - F.when(F.month(day) >= 7, 0).otherwise(1)
    return F.concat(first.cast("string"), F.lit("–"), F.substring((first + 1).cast("string"), 3, 2))


def recent_seasons(spark: SparkSession, as_of: dt.date, n_back: int) -> DataFrame:
    """The labels of the season `as_of` falls in and of the n_back - 1 seasons before it, newest first."""
    back = spark.range(n_back).select(F.col("id").cast("int").alias("seasons_ago"))
    day = F.add_months(F.lit(as_of), -12 * F.col("seasons_ago"))
    return back.select("seasons_ago", season_label(day).alias("season"))


def like(column: Column, pattern: str) -> Column:
    """Parameter filter; '%' keeps everything except NULL."""
    return column.like(pattern)


def like_or_null(column: Column, pattern: str) -> Column:
    """Parameter filter in which NULL counts as an empty text, so '%' keeps NULL rows too."""
    return F.coalesce(column, F.lit("")).like(pattern)


def contains_ci(column: Column, part: str) -> Column:
    """Case-insensitive substring search."""
    return F.contains(F.lower(column), F.lit(part.lower()))


def share(condition: Column, digits: int) -> Column:
    """Aggregate: percentage of rows that satisfy the condition, rounded."""
    return F.round(100.0 * F.sum(F.when(condition, 1).otherwise(0)) / F.count(F.lit(1)), digits)
