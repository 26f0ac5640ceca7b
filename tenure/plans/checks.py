"""The declared checks of sources, seeds, models and marts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession

from tenure.operators.loads import file_freshness
from tenure.operators.quality import Checks, run_checks


def _keyed(*columns: str, **more) -> Checks:
    """Unique and not-null columns first; further rules by name."""
    not_null = [*columns, *more.pop("not_null", [])]
    return Checks(unique=list(columns), not_null=not_null, **more)


STAGING_CHECKS = {
    "competitions": _keyed("competition_id"),
    "clubs": _keyed("club_id"),
    "players": _keyed("player_id", non_negative=["market_value_in_eur", "highest_market_value_in_eur"]),
    "transfers": _keyed("transfer_id", not_null=["player_id"], non_negative=["market_value_in_eur", "transfer_fee"]),
    "player_valuations": _keyed(
        "player_valuation_id", not_null=["player_id", "market_value_in_eur"], non_negative=["market_value_in_eur"]),
    "countries": _keyed("country_id"),
    "national_teams": _keyed("national_team_id"),
    "games": _keyed("game_id"),
    "club_games": _keyed("club_game_id", not_null=["game_id", "club_id"]),
    "appearances": _keyed("appearance_id", not_null=["game_id", "player_id"]),
    "game_events": _keyed("game_event_id", not_null=["game_id"]),
    "game_lineups": _keyed("game_lineups_id", not_null=["game_id", "player_id"]),
    "ratings": Checks(
        not_null=["clubelo_club", "clubelo_country", "elo"],
        combinations=[["clubelo_club", "clubelo_country", "rating_from_date"]],
        periods=[(["clubelo_club", "clubelo_country"], "rating_from_date", "rating_to_date")],
    ),
    "recent_moves": Checks(
        not_null=["club_id", "player_name", "direction"], accepted={"direction": ["in", "out"]},
        combinations=[["club_id", "player_name", "transfer_date", "direction"]],
    ),
}
SEED_CHECKS = {
    "mapping": _keyed("club_id", not_null=["clubelo_club", "clubelo_country"]),
    "scope": _keyed("competition_id", accepted={"champion_method": ["league_table", "cup_final"]}),
}
INTERMEDIATE_CHECKS = {
    "club_spells": _keyed("transfer_id"),
    "performance_during_spell": _keyed("transfer_id"),
    "market_value_at_spell_end": Checks(unique=["transfer_id"]),
    "club_elo_at_transfer": _keyed("transfer_id"),
    "season_champions": Checks(
        not_null=["competition_id", "season", "title_type"], accepted={"title_type": ["league", "cup"]}),
    "titles_during_spell": _keyed("transfer_id"),
    "value_trajectory": Checks(not_null=["club_id"]),
    "titles_during_tenure": Checks(not_null=["club_id"]),
}
MART_CHECKS = {
    "dim_player": _keyed("player_id"),
    "dim_club": _keyed("club_id"),
    "dim_team": _keyed("team_id"),
    "fct_transfer": _keyed(
        "transfer_id",
        not_null=["player_id", "league_titles_during_spell", "cup_titles_during_spell"],
        relationships=[
            ("player_id", "dim_player", "player_id", "error"),
            ("from_club_id", "dim_club", "club_id", "warn"),
            ("to_club_id", "dim_club", "club_id", "warn"),
        ],
    ),
    "fct_match": _keyed(
        "match_id", not_null=["home_team_id", "away_team_id"],
        relationships=[("home_team_id", "dim_team", "team_id", "error"), ("away_team_id", "dim_team", "team_id", "error")],
    ),
    "fct_recent_moves": Checks(not_null=["club_id"], accepted={"direction": ["in", "out"]}),
}

# Freshness per source group: warn and error after so many days.
FRESHNESS_DAYS = {"ratings": (7, 30), "results": (1, 3), "market": (8, 14), "recent_moves": (14, 45)}

# The same kinds of checks on the adapter tables; the last one is meant to fail.
ADAPTER_CHECKS = {
    "transfers": _keyed(
        "transfer_id", not_null=["player_id"], non_negative=["transfer_fee", "market_value_in_eur"],
        relationships=[
            ("player_id", "players", "player_id", "error"),
            ("from_club_id", "clubs", "club_id", "warn"),
            ("to_club_id", "clubs", "club_id", "warn"),
        ],
    ),
    "games": _keyed("game_id", combinations=[["competition_id", "season"]]),
}


def for_columns(spec: Checks, table: DataFrame, tables: dict[str, DataFrame]) -> Checks:
    """The checks of a set whose columns and parents are there."""
    have = set(table.columns)
    return replace(
        spec,
        unique=[c for c in spec.unique if c in have],
        not_null=[c for c in spec.not_null if c in have],
        accepted={c: v for c, v in spec.accepted.items() if c in have},
        relationships=[r for r in spec.relationships if r[0] in have and r[1] in tables and r[2] in tables[r[1]].columns],
        combinations=[cs for cs in spec.combinations if have.issuperset(cs)],
        non_negative=[c for c in spec.non_negative if c in have],
        periods=[p for p in spec.periods if have.issuperset([*p[0], p[1], p[2]])],
    )


def check_build(tables: dict[str, DataFrame]) -> DataFrame:
    """The report of all declared checks of the tables given, staged, seed, intermediate or mart, by their names.

    Run after a build, over its written tables; rows with the status 'error' should stop what follows.
    """
    declared = {**STAGING_CHECKS, **SEED_CHECKS, **INTERMEDIATE_CHECKS, **MART_CHECKS}
    return run_checks(tables, {name: for_columns(declared[name], df, tables) for name, df in tables.items() if name in declared})


def source_freshness(spark: SparkSession, folders: dict[str, str], as_of: Column) -> DataFrame:
    """The freshness of each source group by its files, judged by `FRESHNESS_DAYS`; `folders` maps a group to its folder."""
    return file_freshness(spark, {group: (folder, *FRESHNESS_DAYS[group]) for group, folder in folders.items()}, as_of)
