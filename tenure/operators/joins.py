"""Join helpers used by the other operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str] | Sequence[str],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Join `right` to `left` and keep only the non-key columns of `right`.

    `on` maps a column of `left` to the column of `right` it must equal (or lists shared names).
    NULL keys match nothing unless `null_safe` is set. `right` should hold one row per key, so
    that a hot key of `left` only ever meets one row and AQE can split it over tasks.
    """
    pairs = dict(on) if isinstance(on, dict) else {c: c for c in on}
    if not null_safe:
        renames = {r: l for l, r in pairs.items() if l != r}
        return left.join(right.withColumnsRenamed(renames) if renames else right, list(pairs), how)
    renamed = {source: f"__key{i}" for i, source in enumerate(pairs.values())}
    condition = reduce(and_, [F.col(l).eqNullSafe(F.col(renamed[r])) for l, r in pairs.items()])
    return left.join(right.withColumnsRenamed(renamed), condition, how).drop(*renamed.values())


def keep_matching(left: DataFrame, right: DataFrame, on: dict[str, str] | Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of `left` with at least one partner in `right` (EXISTS)."""
    return attach(left, _keys(right, on), on, "left_semi", null_safe)


def keep_missing(left: DataFrame, right: DataFrame, on: dict[str, str] | Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of `left` without a partner in `right` (NOT EXISTS); a NULL key counts as missing."""
    return attach(left, _keys(right, on), on, "left_anti", null_safe)


def _keys(right: DataFrame, on: dict[str, str] | Sequence[str]) -> DataFrame:
    return right.select(*(on.values() if isinstance(on, dict) else on))


def case_insensitive(left: DataFrame, right: DataFrame, left_name: str, right_name: str, how: str = "inner") -> DataFrame:
    """Equi-join on the lower-cased names, computed once per side."""
    l = left.withColumn("__lower", F.lower(left_name))
    r = right.withColumn("__lower", F.lower(right_name))
    return l.join(r, "__lower", how).drop("__lower")


def bridge(left: DataFrame, mapping: DataFrame, right: DataFrame, left_key: dict[str, str], right_key: Sequence[str], how: str = "inner") -> DataFrame:
    """Reach `right` through a mapping table: left key -> mapping row -> composite key of `right`."""
    return attach(attach(left, mapping, left_key, how), right, list(right_key), how)


def in_roles(facts: DataFrame, dim: DataFrame, key: str, roles: dict[str, str], columns: dict[str, str], how: str = "left") -> DataFrame:
    """Join one dimension once per role.

    `roles` maps a role prefix to the foreign key in `facts`; `columns` maps a dimension column to
    the suffix it gets, e.g. roles {"from": "from_club_id"} and columns {"club_name": "club"} give
    a column `from_club`.
    """
    out = facts
    for role, foreign_key in roles.items():
        view = dim.select(key, *[F.col(c).alias(f"{role}_{suffix}") for c, suffix in columns.items()])
        out = attach(out, view, {foreign_key: key}, how)
    return out
