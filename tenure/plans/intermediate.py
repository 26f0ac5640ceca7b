"""Intermediate models: compositions of the operators over staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.functions.text import leading_int
from tenure.operators.joins import attach, keep_matching
from tenure.operators.matching import entity_resolve
from tenure.operators.ranking import last_period_rows
from tenure.operators.temporal import (
    asof_latest,
    count_between,
    first_and_last_until,
    interval_agg,
    nearest_period,
    spells,
)
from tenure.session import shared

LEAGUE, CUP = "league", "cup"


def season_champions(scope: DataFrame, games: DataFrame, club_games: DataFrame) -> DataFrame:
    """One row per title: first place on the last matchday of a league, or the winner of a cup final.

    Only competitions listed in `scope`, by the method given there.
    """
    method = scope.select("competition_id", "champion_method")
    scoped = attach(games.select("game_id", "competition_id", "season", "game_date", "round"), method, ["competition_id"], "inner")
    league = scoped.where(F.col("champion_method") == "league_table").withColumn("matchday", leading_int(F.col("round")))
    deciding = last_period_rows(league, ["competition_id", "season"], "matchday")
    finals = scoped.where((F.col("champion_method") == "cup_final") & (F.lower("round") == "final"))
    columns = ["game_id", "competition_id", "season", "game_date"]

    def titles(matches: DataFrame, title: str, winner: Column) -> DataFrame:
        won = club_games.where(winner).select("game_id", F.col("club_id").alias("champion_club_id"))
        return matches.select(*columns).join(won, "game_id", "inner").select(
            "competition_id", "season", F.lit(title).alias("title_type"), "champion_club_id", F.col("game_date").alias("title_date")
        )

    return titles(deciding, LEAGUE, F.col("own_position") == 1).unionByName(titles(finals, CUP, F.col("is_win")))


def club_spells(transfers: DataFrame) -> DataFrame:
    """One row per transfer: the player's spell at the acquiring club."""
    moves = transfers.select(
        "transfer_id", "player_id", F.col("to_club_id").alias("club_id"), F.col("transfer_date").alias("spell_start_date")
    )
    return spells(moves, ["player_id"], "spell_start_date", "transfer_id")


def performance_during_spell(club_spell: DataFrame, appearances: DataFrame, games: DataFrame) -> DataFrame:
    """Per transfer, the player's appearances for the acquiring club during the spell."""
    played = appearances.select(
        "appearance_id", "game_id", "player_id", F.col("player_club_id").alias("club_id"), "appearance_date",
        "goals", "assists", "minutes_played", "yellow_cards", "red_cards",
    )
    played = attach(played, games.select("game_id", "season"), ["game_id"], "left")
    stats = ["goals", "assists", "minutes_played", "yellow_cards", "red_cards"]
    return interval_agg(
        club_spell, played, ["player_id", "club_id"], "transfer_id", "spell_start_date", "spell_end_date", "appearance_date",
        counts={"matches_played": "appearance_id"}, distinct={"seasons_played": "season"}, sums={c: c for c in stats},
    )


def market_value_at_spell_end(club_spell: DataFrame, valuations: DataFrame, as_of: Column) -> DataFrame:
    """Per transfer, the latest valuation at the end of the spell (at `as_of` while it is open)."""
    cut = club_spell.select("transfer_id", "player_id", F.coalesce("spell_end_date", as_of).alias("cutoff"))
    found = asof_latest(
        cut, valuations, ["player_id"], "cutoff", "valuation_date",
        {"market_value_in_eur": "market_value_at_spell_end"}, ["player_valuation_id"],
        at="market_value_at_spell_end_date", how="inner",
    )
    return found.drop("player_id", "cutoff")


def club_elo_at_transfer(transfers: DataFrame, mapping: DataFrame, ratings: DataFrame, disjoint: bool = True) -> DataFrame:
    """Per transfer, the rating of both clubs on the day: containing period, else nearest start.

    Each distinct (club, day) is looked up once for both roles. Rating periods of one club follow each other
    (`quality.overlapping_periods` lists those that do not); pass `disjoint=False` where they may overlap.
    """
    by_club = mapping.select(F.col("club_id").cast("long").alias("club_id"), "clubelo_club", "clubelo_country").join(
        ratings, ["clubelo_club", "clubelo_country"], "inner"
    )
    asked = transfers.select(
        F.explode(F.array("from_club_id", "to_club_id")).alias("club_id"), "transfer_date"
    ).where("club_id is not null and transfer_date is not null").distinct()
    rated = nearest_period(
        asked, by_club, ["club_id"], "transfer_date", "rating_from_date", "rating_to_date", {"elo": "elo"},
        tiebreak=["clubelo_club", "clubelo_country", "elo"], disjoint=disjoint, how="inner",
    )
    out = transfers.select("transfer_id", "transfer_date", "from_club_id", "to_club_id")
    for side in ("from", "to"):
        view = rated.withColumnRenamed("elo", f"{side}_club_elo")
        out = attach(out, view, {f"{side}_club_id": "club_id", "transfer_date": "transfer_date"}, "left")
    return out.select("transfer_id", "from_club_elo", "to_club_elo")


def titles_during_spell(club_spell: DataFrame, champions: DataFrame) -> DataFrame:
    """Per transfer with at least one title: the club's titles dated inside the spell."""
    counted = count_between(
        club_spell, champions, ["club_id"], ["champion_club_id"], "spell_start_date", "spell_end_date", "title_date",
        {f"{t}_titles_during_spell": F.col("title_type") == t for t in (LEAGUE, CUP)},
    )
    return counted.select("transfer_id", *[f"{t}_titles_during_spell" for t in (LEAGUE, CUP)]).where(
        "league_titles_during_spell + cup_titles_during_spell > 0"
    )


MOVE_KEY = ["club_id", "player_name", "direction", "transfer_date"]


def value_trajectory(
    moves: DataFrame, players: DataFrame, valuations: DataFrame, full_grain: bool = False, scratch: str | None = None
) -> DataFrame:
    """Per move, the resolved player and the first and last valuation at the club up to the move.

    The player is the lowest id with that name (any case) and a valuation at a club of that name.
    Valuations are ranked per (club, player) over all moves of the pair, so of several moves one
    holds the arrival and one the departure value and the others have NULL; `full_grain` ranks per
    move instead. Moves without a valuation up to their date are left out.

    One window per (player, club) finds both; its rows are days, so it stays small. Valuations of pairs that no
    move resolves to leave before it. With a `scratch` folder the resolved moves are written once.
    """
    resolved = entity_resolve(
        moves.select(*MOVE_KEY, "club_name").where("transfer_date is not null"), players, valuations,
        "player_name", "club_name", "player_name", "player_id", "player_id", "current_club_name",
    )
    one = resolved.groupBy(*MOVE_KEY).agg(F.min(F.struct("player_id", "club_name")).alias("__c")).select(
        *MOVE_KEY, "__c.player_id", "__c.club_name"
    )
    one = shared(one, scratch)
    at_club = valuations.select(
        "player_id", F.col("current_club_name").alias("club_name"), "valuation_date", "player_valuation_id",
        F.col("market_value_in_eur").alias("value"),
    )
    at_club = keep_matching(at_club, one.select("player_id", "club_name").distinct(), ["player_id", "club_name"])
    out = first_and_last_until(
        one, at_club, ["player_id", "club_name"], "transfer_date", "valuation_date", ["value"], ["player_valuation_id"]
    ).where("first is not null")
    if not full_grain:
        # Of the moves of a pair the first (in key order) holds the arrival, and of those with the
        # newest last valuation the first holds the departure.
        key = ["transfer_date", "direction", "player_name"]
        pair = Window.partitionBy("club_id", "player_id")
        out = out.withColumns({
            "__in": F.row_number().over(pair.orderBy("first", *key)),
            "__out": F.row_number().over(pair.orderBy(F.col("last").desc(), *key)),
        })
        out = out.withColumns({
            "first": F.when(F.col("__in") == 1, F.col("first")), "last": F.when(F.col("__out") == 1, F.col("last")),
        })
    return out.select(
        *MOVE_KEY, "player_id",
        F.col("first.value").alias("value_at_arrival"), F.col("first.valuation_date").alias("value_at_arrival_date"),
        F.col("last.value").alias("value_at_departure"), F.col("last.valuation_date").alias("value_at_departure_date"),
    )


def titles_during_tenure(trajectory: DataFrame, champions: DataFrame) -> DataFrame:
    """Per departure with at least one title: the club's titles from the arrival value to the move."""
    left = trajectory.where((F.col("direction") == "out") & F.col("value_at_arrival_date").isNotNull() & F.col("transfer_date").isNotNull())
    counted = count_between(
        left.select(*MOVE_KEY, "value_at_arrival_date"), champions, ["club_id"], ["champion_club_id"],
        "value_at_arrival_date", "transfer_date", "title_date",
        {f"{t}_titles_during_tenure": F.col("title_type") == t for t in (LEAGUE, CUP)},
    )
    return counted.drop("value_at_arrival_date").where("league_titles_during_tenure + cup_titles_during_tenure > 0")
