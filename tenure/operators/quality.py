"""Declarative data-quality checks; each failing row or key is one row of the result."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tenure.operators.joins import keep_missing


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their count."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def not_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column combinations that occur more than once; NULLs count as equal."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    return keep_missing(child.where(F.col(foreign_key).isNotNull()), parent, {foreign_key: key})


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the accepted list, with their count; NULL is accepted."""
    return df.where(~F.col(column).isin(*accepted)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def negative_amounts(sources: Sequence[tuple[DataFrame, str, str, str]], key: str, amount: str) -> DataFrame:
    """Rows with a negative amount over several (table, key, amount column, label) sources."""
    parts = [
        df.where(F.col(a) < 0).select(F.col(k).alias(key), F.col(a).alias(amount), F.lit(label).alias("source_model"))
        for df, k, a, label in sources
    ]
    return reduce(lambda x, y: x.unionByName(y), parts)


def overlapping_periods(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Rows of closed periods [start, end] that begin before an earlier period of their key has ended; a NULL end never ends."""
    earlier = Window.partitionBy(*keys).orderBy(start, F.col(end).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    open_end = F.coalesce(end, F.lit("9999-12-31").cast("date"))
    return df.where(F.col(start).isNotNull()).withColumn("__reach", F.max(open_end).over(earlier)).where(F.col("__reach") >= F.col(start)).drop("__reach")


def coverage(df: DataFrame, by: Sequence[str], shares: dict[str, Column]) -> DataFrame:
    """Row count and, per named condition, the share of rows that satisfy it (NULL counts as not)."""
    aggs = [F.avg(F.coalesce(c, F.lit(False)).cast("double")).alias(name) for name, c in shares.items()]
    return (df.groupBy(*by) if by else df).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)


@dataclass
class Checks:
    """The checks of one table.

    `relationships` lists (foreign key, parent table, parent key, severity), `periods` (keys, start, end) of periods
    that must not overlap.
    """

    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)
    relationships: list[tuple[str, str, str, str]] = field(default_factory=list)
    combinations: list[list[str]] = field(default_factory=list)
    non_negative: list[str] = field(default_factory=list)
    periods: list[tuple[list[str], str, str]] = field(default_factory=list)


def _row_checks(spec: Checks) -> list[tuple[str, str, Column]]:
    """(check, column, condition that holds for a failing row) of the checks that look at one row."""
    out = [("not_null", c, F.col(c).isNull()) for c in spec.not_null]
    out += [("accepted_values", c, ~F.col(c).isin(*values)) for c, values in spec.accepted.items()]
    return out + [("non_negative", c, F.col(c) < 0) for c in spec.non_negative]


def _text_key(columns: Sequence[str]) -> Column:
    """One text that is equal for equal columns only; NULLs count as equal."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def run_checks(tables: dict[str, DataFrame], specs: dict[str, Checks]) -> DataFrame:
    """One row per check: table, check, columns, severity, failures, status.

    A table is scanned once: each row is expanded to one small row per key it takes part in (as a key to be unique, as
    a foreign key, as the parent of one) and per row check it fails. Two aggregations, per key and per check,
    settle all checks of all tables together. Only periods need a scan of their own, as they look at neighbours.
    """
    listed: list[tuple[int, str, str, str, str]] = []
    expanded: dict[str, list[Column]] = {}
    periods: list[DataFrame] = []

    def check(table: str, name: str, columns: str, severity: str = "error") -> int:
        listed.append((len(listed), table, name, columns, severity))
        return len(listed) - 1

    def emit(table: str, number: int, kind: str, key: Column, rows: int, parents: int, when: Column) -> None:
        made = F.struct(F.lit(number).alias("id"), F.lit(kind).alias("kind"), key.cast("string").alias("key"), F.lit(rows).alias("rows"), F.lit(parents).alias("parents"))
        expanded.setdefault(table, []).append(F.when(when, made))

    for table, spec in specs.items():
        for name, column, bad in _row_checks(spec):
            emit(table, check(table, name, column), "row", F.lit(None), 1, 0, bad)
        for column in spec.unique:
            emit(table, check(table, "unique", column), "key", F.col(column), 1, 0, F.col(column).isNotNull())
        for columns in spec.combinations:
            emit(table, check(table, "unique_combination", ",".join(columns)), "key", _text_key(columns), 1, 0, F.lit(True))
        for foreign, parent, key, severity in spec.relationships:
            number = check(table, "relationships", foreign, severity)
            # Both sides as the type of the parent's key; what does not fit it has no parent.
            own = F.coalesce(F.col(foreign).try_cast(tables[parent].schema[key].dataType).cast("string"), F.concat(F.lit("?"), F.col(foreign).cast("string")))
            emit(table, number, "link", own, 1, 0, F.col(foreign).isNotNull())
            emit(parent, number, "link", F.col(key), 0, 1, F.col(key).isNotNull())
        for keys, start, end in spec.periods:
            number = check(table, "overlapping_periods", ",".join([*keys, start, end]))
            periods.append(overlapping_periods(tables[table], keys, start, end).agg(F.count(F.lit(1)).alias("failures")).select(F.lit(number).alias("id"), "failures"))
    counts = list(periods)
    if expanded:
        rows = [tables[t].select(F.inline(F.filter(F.array(*made), lambda m: m.isNotNull()))) for t, made in expanded.items()]
        per_key = reduce(DataFrame.unionByName, rows).groupBy("id", "kind", "key").agg(F.sum("rows").alias("rows"), F.max("parents").alias("parents"))
        failing = F.when(F.col("kind") == "row", F.col("rows")).when(F.col("kind") == "key", (F.col("rows") > 1).cast("long")).when(F.col("parents") == 0, F.col("rows"))
        counts.append(per_key.groupBy("id").agg(F.sum(failing).alias("failures")))
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame(listed, "id int, table string, check string, columns string, severity string")
    report = names.join(reduce(DataFrame.unionByName, counts), "id", "left").drop("id") if counts else names.drop("id").withColumn("failures", F.lit(0))
    report = report.withColumn("failures", F.coalesce("failures", F.lit(0)).cast("long"))
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")))


def observed(df: DataFrame, spec: Checks, name: str = "checks") -> tuple[DataFrame, Observation]:
    """`df` that counts the failures of its row checks while it is written, and where to read them afterwards.

    The observation maps `<check>:<column>` to the number of failing rows; no scan is made for it.
    """
    watch = Observation(name)
    counts = [F.count_if(bad).alias(f"{check}:{column}") for check, column, bad in _row_checks(spec)]
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *counts), watch
