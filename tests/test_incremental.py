"""Incremental marts against a rebuild, for changes in every table."""

import datetime as dt
import random

import pytest
from tests.helpers import rows

from tenure.plans import incremental, marts

AS_OF = dt.date(2024, 1, 1)
SCHEMAS = {
    "transfers": "transfer_id string, player_id long, transfer_date date, transfer_season string, from_club_id long, to_club_id long, transfer_fee double, market_value_in_eur double",
    "appearances": "appearance_id string, game_id long, player_id long, player_club_id long, appearance_date date, goals int, assists int, minutes_played int, yellow_cards int, red_cards int",
    "games": "game_id long, competition_id string, season int, round string, game_date date",
    "club_games": "game_id long, club_id long, own_position int, is_win boolean",
    "player_valuations": "player_valuation_id string, player_id long, valuation_date date, market_value_in_eur double, current_club_name string",
    "scope": "competition_id string, champion_method string",
    "mapping": "club_id long, club_name string, clubelo_club string, clubelo_country string",
    "ratings": "clubelo_club string, clubelo_country string, elo double, rating_from_date date, rating_to_date date",
    "players": "player_id long, player_name string, image_url string",
    "recent_moves": "club_id long, club_name string, season string, direction string, transfer_date date, player_name string, player_wiki_title string, other_club_name string, "
    "transfer_type string, fee_amount double, fee_currency string, source_page string",
}


def made_row(rng, name, i):
    def day(years=4):
        return dt.date(2019, 1, 1) + dt.timedelta(days=rng.randrange(365 * years))

    player, club, game = rng.randrange(25), rng.randrange(12), rng.randrange(60)
    if name == "transfers":
        return (f"t{i}", rng.choice([player, None]) if i % 20 == 0 else player, rng.choice([day(), None]) if i % 9 == 0 else day(), "s", rng.randrange(12), club, rng.choice([None, 0.0, 1e6 * (1 + i % 7)]), 1e6)
    if name == "appearances":
        return (f"a{i}", game, player, club, day(5), i % 3, i % 2, 90, 0, 0)
    if name == "games":
        return (i, f"C{i % 4}", 2019 + i % 5, rng.choice(["1. Matchday", "2. Matchday", "Final"]), day(5))
    if name == "club_games":
        return (i // 2, club, rng.randint(1, 3), rng.random() < 0.5)
    if name == "player_valuations":
        return (f"v{i}", player, day(5), 1e5 * rng.randint(1, 90), f"Club {club}")
    if name == "scope":
        return (f"C{i}", ["league_table", "cup_final"][i % 2])
    if name == "mapping":
        return (i, f"Club {i}", f"E{i}", "X")
    if name == "ratings":
        first = dt.date(2019, 1, 1) + dt.timedelta(days=100 * (i // 12))
        return (f"E{i % 12}", "X", 1000.0 + rng.randint(0, 900), first, first + dt.timedelta(days=60))
    if name == "players":
        return (i, f"{rng.choice(['Ann', 'ann', 'Bo', 'Cy'])} {i % 9}", f"img{i}")
    return (club, f"Club {club}", "s", rng.choice(["in", "out"]), rng.choice([day(5), None]), f"{rng.choice(['ANN', 'Bo', 'Cy'])} {i % 9}", "w", "o", "Transfer", float(i), "EUR", f"p{i}")


SIZES = {"transfers": 70, "appearances": 250, "games": 60, "club_games": 120, "player_valuations": 120, "scope": 4, "mapping": 12, "ratings": 120, "players": 25, "recent_moves": 60}


@pytest.mark.parametrize("changed", [["transfers"], ["appearances", "player_valuations"], ["games"], ["club_games", "ratings"], ["scope", "mapping"], ["recent_moves", "players"]])
def test_incremental_equals_rebuild(spark, changed):
    rng = random.Random(str(changed))
    before = {name: [made_row(rng, name, i) for i in range(n)] for name, n in SIZES.items()}
    after = {name: list(data) for name, data in before.items()}
    for name in changed:  # rows that go, rows that differ, rows that come
        n = len(after[name])
        for i in rng.sample(range(n), max(1, n // 30)):
            after[name][i] = made_row(rng, name, i)
        del after[name][rng.randrange(len(after[name]))]
        if name != "ratings":
            after[name].append(made_row(rng, name, n if name in ("games", "players", "transfers") else n - 1))
    old, new = ({name: spark.createDataFrame(data, SCHEMAS[name]).coalesce(1) for name, data in side.items()} for side in (before, after))
    changes = {name: incremental.changed_rows(old[name], new[name]) for name in changed}
    if set(changed) - {"recent_moves", "players"}:
        step = incremental.fct_transfer(marts.fct_transfer(old, AS_OF), new, changes, AS_OF)
        assert rows(step) == rows(marts.fct_transfer(new, AS_OF).select(*step.columns))
    if set(changed) & {"recent_moves", "players", "player_valuations", "games", "scope"}:
        step = incremental.fct_recent_moves(marts.fct_recent_moves(old), new, changes)
        assert rows(step) == rows(marts.fct_recent_moves(new).select(*step.columns))


def test_only_touched_players_are_built_again(spark):
    rng = random.Random(5)
    tables = {name: spark.createDataFrame([made_row(rng, name, i) for i in range(n)], SCHEMAS[name]) for name, n in SIZES.items()}
    late = spark.createDataFrame([("v900", 3, dt.date(2023, 5, 5), 9e6, "Club 1")], SCHEMAS["player_valuations"])
    changes = {"player_valuations": late}
    assert rows(incremental.touched_players(tables, changes)) == [(3,)]
    assert incremental.touched_clubs(tables, changes) is None
    assert incremental.touched_players(tables, {"recent_moves": tables["recent_moves"]}) is None
    previous = marts.fct_transfer(tables, AS_OF)
    assert incremental.fct_transfer(previous, tables, {}, AS_OF) is previous


def test_touched_players_are_found_once(spark, tmp_path):
    rng = random.Random(6)
    tables = {name: spark.createDataFrame([made_row(rng, name, i) for i in range(n)], SCHEMAS[name]) for name, n in SIZES.items()}
    late = spark.createDataFrame([("v900", 3, dt.date(2023, 5, 5), 9e6, "Club 1")], SCHEMAS["player_valuations"])
    after = {**tables, "player_valuations": tables["player_valuations"].unionByName(late)}
    step = incremental.fct_transfer(marts.fct_transfer(tables, AS_OF), after, {"player_valuations": late}, AS_OF, str(tmp_path))
    written = [spark.read.parquet(str(folder)) for folder in tmp_path.iterdir()]
    assert sorted(df.columns for df in written if "player_id" in df.columns and len(df.columns) == 1) == [["player_id"]]
    assert rows(step) == rows(marts.fct_transfer(after, AS_OF).select(*step.columns))


def test_touched_names_are_found_once(spark, tmp_path):
    rng = random.Random(8)
    tables = {name: spark.createDataFrame([made_row(rng, name, i) for i in range(n)], SCHEMAS[name]) for name, n in SIZES.items()}
    changes = {"recent_moves": tables["recent_moves"].limit(0)}
    step = incremental.fct_recent_moves(marts.fct_recent_moves(tables), tables, changes, scratch=str(tmp_path))
    written = [spark.read.parquet(str(folder)).columns for folder in tmp_path.iterdir()]
    assert written.count(["name"]) == 1
    assert rows(step) == rows(marts.fct_recent_moves(tables).select(*step.columns))
