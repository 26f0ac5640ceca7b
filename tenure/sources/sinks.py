"""Writing layers and mart extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tenure.sources.published import replace

PRODUCTION = "prod"


def schema_name(layer: str | None, target: str, target_schema: str) -> str:
    """Only the production target writes to the bare layer name; others are prefixed by their schema."""
    if layer is None:
        return target_schema
    return layer.strip() if target == PRODUCTION else f"{target_schema}_{layer.strip()}"


def write_layer(df: DataFrame, root: str, layer: str | None, table: str, target: str, target_schema: str,
                partition_by: Sequence[str] = ()) -> str:
    """Publish a table under its layer; returns the folder, which `published.open_table` reads."""
    path = f"{root}/{schema_name(layer, target, target_schema)}/{table}"
    replace(df, path, partition_by)
    return path


# The marts the pages read, and the column each extract is partitioned by.
EXTRACTS = {"fct_transfer": ["transfer_season"], "fct_recent_moves": [], "dim_player": [], "dim_club": []}


def extract_marts(marts: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Publish the page extracts; reports that filter by season read one partition. `published.open_table` reads them."""
    paths = {}
    for name, by in EXTRACTS.items():
        paths[name] = f"{root}/{name}"
        df = marts[name]
        # Rebalancing keeps few files per season and still splits a season that is too big for a task.
        replace(df.hint("rebalance", *by) if by else df, paths[name], by)
    return paths
