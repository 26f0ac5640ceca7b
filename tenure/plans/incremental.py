"""Incremental fact marts: from the changes of the staged tables to the keys they touch, and only those built again.

`changes` holds, per staged table, the rows that are new, gone or different: both images of a changed row. A key is
touched if any row that its result reads is among them, directly or through what lies between: a game leads to
the players who appeared in it and to the clubs of its season, a rating to the clubs mapped to it, a club to
the players who moved from or to it. Rows of touched keys are built from the tables as they are now, restricted by semi-joins to those keys;
all other rows are taken over as they were. `as_of` must be that of the earlier build: a new one touches every open spell.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.operators.joins import attach, keep_missing
from tenure.plans import marts
from tenure.session import shared

Frames = dict[str, DataFrame]


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks, counted as in bags; for tables that come without a change log."""
    columns = before.columns
    signed = before.withColumn("__n", F.lit(1)).unionByName(after.select(*columns).withColumn("__n", F.lit(-1)))
    return signed.groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n <> 0").drop("__n")


def _either(name: str, tables: Frames, changes: Frames, *columns: str) -> DataFrame:
    """The rows of a table as they are now and, if it changed, as they were."""
    now = tables[name].select(*columns)
    return now.unionByName(changes[name].select(*columns)) if name in changes else now


def _union(frames: list[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, frames).distinct() if frames else None


def touched_clubs(tables: Frames, changes: Frames) -> DataFrame | None:
    """club_id of the clubs whose rating or titles may differ; None if no change reaches a club."""
    found = []
    rated = ["clubelo_club", "clubelo_country"]
    if "ratings" in changes:
        names = changes["ratings"].select(*rated).distinct()
        found.append(attach(_either("mapping", tables, changes, "club_id", *rated), names, rated, "left_semi").select("club_id"))
    if "mapping" in changes:
        found.append(changes["mapping"].select("club_id"))
    found = [f.select(F.col("club_id").cast("long").alias("club_id")) for f in found]
    if {"games", "club_games", "scope"} & changes.keys():
        period = ["competition_id", "season"]
        games = _either("games", tables, changes, "game_id", *period)
        seasons = []
        if "games" in changes:
            seasons.append(changes["games"].select(*period))
        if "club_games" in changes:
            seasons.append(attach(games, changes["club_games"].select("game_id").distinct(), ["game_id"], "left_semi").select(*period))
        if "scope" in changes:
            seasons.append(attach(games, changes["scope"].select("competition_id").distinct(), ["competition_id"], "left_semi").select(*period))
        played = attach(games, _union(seasons), period, "left_semi", null_safe=True).select("game_id").distinct()
        sides = _either("club_games", tables, changes, "game_id", "club_id")
        found.append(attach(sides, played, ["game_id"], "left_semi").select(F.col("club_id").cast("long").alias("club_id")))
    return _union(found)


def touched_players(tables: Frames, changes: Frames) -> DataFrame | None:
    """player_id of all transfers whose row may differ."""
    found = [changes[name].select("player_id") for name in ("transfers", "appearances", "player_valuations") if name in changes]
    if "games" in changes:
        games = changes["games"].select("game_id").distinct()
        found.append(attach(tables["appearances"].select("game_id", "player_id"), games, ["game_id"], "left_semi").select("player_id"))
    clubs = touched_clubs(tables, changes)
    if clubs is not None:
        sides = tables["transfers"].select("player_id", F.explode(F.array(*[F.col(c).cast("long") for c in ("from_club_id", "to_club_id")])).alias("club_id"))
        found.append(attach(sides, clubs, ["club_id"], "left_semi").select("player_id"))
    return _union(found)


def fct_transfer(previous: DataFrame, tables: Frames, changes: Frames, as_of: dt.date | Column, scratch: str | None = None) -> DataFrame:
    """The transfer mart after `changes`: `previous` without the rows of touched players, and theirs built again.

    `tables` are the staged tables with the changes in them, as for `marts.fct_transfer`. Players without an id are one
    player, as they are to the spells. With a `scratch` folder the touched players, which four tables meet, are written once.
    """
    players = touched_players(tables, changes)
    if players is None:
        return previous
    players = shared(players, scratch)
    ours = {name: attach(tables[name], players, ["player_id"], "left_semi", null_safe=True) for name in ("transfers", "appearances", "player_valuations")}
    fresh = marts.fct_transfer({**tables, **ours}, as_of, scratch)
    return keep_missing(previous, players, ["player_id"], null_safe=True).unionByName(fresh)


def touched_names(tables: Frames, changes: Frames) -> DataFrame | None:
    """name, in lower case, of all moves whose row may differ. A move reads the players of its name and their valuations."""
    lower = F.lower("player_name").alias("name")
    found = [changes[name].select(lower) for name in ("recent_moves", "players") if name in changes]
    if "player_valuations" in changes:
        valued = changes["player_valuations"].select("player_id").distinct()
        found.append(attach(_either("players", tables, changes, "player_id", "player_name"), valued, ["player_id"], "left_semi").select(lower))
    titles = {name: changes[name] for name in ("games", "club_games", "scope") if name in changes}
    clubs = touched_clubs(tables, titles)
    if clubs is not None:
        moves = tables["recent_moves"].select(F.col("club_id").cast("long").alias("club_id"), "player_name")
        found.append(attach(moves, clubs, ["club_id"], "left_semi").select(lower))
    return _union(found)


def fct_recent_moves(previous: DataFrame, tables: Frames, changes: Frames, full_grain: bool = False, scratch: str | None = None) -> DataFrame:
    """The mart of recent moves after `changes`, by touched names."""
    names = touched_names(tables, changes)
    if names is None:
        return previous
    names = shared(names, scratch)

    def named(df: DataFrame) -> DataFrame:
        return attach(df.withColumn("__name", F.lower("player_name")), names, {"__name": "name"}, "left_semi", null_safe=True).drop("__name")

    players = named(tables["players"])
    valued = attach(tables["player_valuations"], players.select("player_id").distinct(), ["player_id"], "left_semi")
    ours = {"recent_moves": named(tables["recent_moves"]), "players": players, "player_valuations": valued}
    fresh = marts.fct_recent_moves({**tables, **ours}, full_grain, scratch)
    others = previous.withColumn("__name", F.lower("player_name"))
    kept = keep_missing(others, names.withColumnRenamed("name", "__name"), ["__name"], null_safe=True).drop("__name")
    return kept.unionByName(fresh)
