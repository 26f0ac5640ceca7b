"""Column expressions shared by the native operators: match positions, and arrays of fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def match_spans(text: Column, pattern: str | Column) -> Column:
    """array<struct<start, end, value>>: the leftmost non-overlapping matches of `pattern`, in code points.

    `pattern` must not match the empty string. The pieces between the matches give the positions.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(values, F.slice(gaps, 1, F.size(values)), lambda v, g: F.struct(v.alias("value"), F.length(g).alias("gap")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def add(done: Column, pair: Column) -> Column:
        start = done["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.when(F.size(values) == 0, empty).otherwise(F.aggregate(pairs, start, add, lambda done: done["spans"]))


def fixed_array(values: list, kind: str) -> Column:
    """A constant array of many numbers. Spark folds it into one literal; `F.array` of literals would be a tree."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def once(value: Column) -> Column:
    """`value` as a generated column, so that the optimizer cannot copy the expression into lambdas that use it."""
    return F.explode(F.array(value))
