import datetime as dt

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from tenure.plans import intermediate as im
from tenure.plans import marts, reports

D = dt.date


def indicators(spark, fee, value, end, goals, assists, seasons, elo, titles, open_spell=False):
    transfers = spark.createDataFrame(
        [("t", 1, "P", D(2023, 1, 1), "22/23", 10, "A", 20, "B", fee, value)],
        "transfer_id string, player_id long, player_name string, transfer_date date, transfer_season string, from_club_id long, "
        "from_club_name string, to_club_id long, to_club_name string, transfer_fee double, market_value_in_eur double",
    )
    spell = spark.createDataFrame(
        [("t", 1, 20, D(2023, 1, 1), None if open_spell else D(2024, 1, 1), open_spell)],
        "transfer_id string, player_id long, club_id long, spell_start_date date, spell_end_date date, is_current_spell boolean",
    )
    performance = spark.createDataFrame(
        [("t", 30, seasons, goals, assists, 2500, 3, 0)],
        "transfer_id string, matches_played long, seasons_played long, goals long, assists long, minutes_played long, yellow_cards long, red_cards long",
    )
    at_end = spark.createDataFrame([("t", end, D(2023, 12, 1))], "transfer_id string, market_value_at_spell_end double, market_value_at_spell_end_date date")
    ratings = spark.createDataFrame([("t", *elo)] if elo else [], "transfer_id string, from_club_elo double, to_club_elo double")
    won = spark.createDataFrame([("t", *titles)] if titles else [], "transfer_id string, league_titles_during_spell long, cup_titles_during_spell long")
    return marts.transfer_indicators(transfers, spell, performance, at_end, ratings, won).first()


def test_paid_transfer(spark):
    r = indicators(spark, 1e6, 8e5, 2e6, 8, 2, 1, (1500.0, 1600.0), None)
    assert r["roi_financier"] == pytest.approx(0.2)
    assert (r["value_gained_absolute"], r["cost_per_goal_contribution"], r["cost_per_season"], r["club_elo_delta"]) == (200000, 100000, 1000000, 100)
    assert (r["league_titles_during_spell"], r["cup_titles_during_spell"]) == (0, 0)


def test_zero_fee(spark):
    r = indicators(spark, 0.0, 5e5, 6e5, 3, 1, 1, (1500.0, 1400.0), None)
    assert r["roi_financier"] is None
    assert (r["value_gained_absolute"], r["cost_per_goal_contribution"], r["cost_per_season"], r["club_elo_delta"]) == (100000, 0, 0, -100)


def test_no_performance(spark):
    r = indicators(spark, 1e6, 9e5, 1.2e6, 0, 0, 0, None, None)
    assert r["roi_financier"] == pytest.approx(-0.7)
    assert (r["value_gained_absolute"], r["cost_per_goal_contribution"], r["cost_per_season"], r["club_elo_delta"]) == (-700000, None, None, None)


def test_long_open_tenure(spark):
    r = indicators(spark, 8e6, 15e6, 5e6, 0, 0, 8, None, (2, 1), open_spell=True)
    assert (r["cost_per_goal_contribution"], r["cost_per_season"]) == (None, 1000000)
    assert (r["league_titles_during_spell"], r["cup_titles_during_spell"], r["is_current_spell"]) == (2, 1, True)


def tables(spark):
    scope = spark.createDataFrame([("L", "league_table"), ("C", "cup_final")], "competition_id string, champion_method string")
    games = spark.createDataFrame(
        [(1, "L", 2022, "37. Matchday", D(2023, 5, 20)), (2, "L", 2022, "38. Matchday", D(2023, 5, 27)), (3, "C", 2022, "Final", D(2023, 6, 1)),
         (4, "X", 2022, "Final", D(2023, 6, 2)), (5, "L", 2022, "Play-off", D(2023, 6, 3)), (6, "C", 2022, "Semi-Finals", D(2023, 5, 1))],
        "game_id long, competition_id string, season int, round string, game_date date",
    )
    sides = spark.createDataFrame(
        [(1, 10, 1, False), (1, 20, 2, True), (2, 20, 1, False), (2, 10, 2, True), (3, 20, 4, True), (3, 10, 3, False), (4, 20, 1, True), (5, 20, 1, True), (6, 20, 1, True)],
        "game_id long, club_id long, own_position int, is_win boolean",
    )
    return scope, games, sides


def test_champions(spark):
    assert rows(im.season_champions(*tables(spark)), "competition_id", "title_type", "champion_club_id", "title_date") == [
        ("C", "cup", 20, D(2023, 6, 1)), ("L", "league", 20, D(2023, 5, 27))]


def test_value_trajectory_matches_by_name_not_id(spark):
    moves = spark.createDataFrame(
        [(7, "Real Sociedad", "griezmann", "out", D(2014, 7, 1)), (7, "Real Sociedad", "griezmann", "in", D(2009, 7, 1)),
         (7, "Real Sociedad", "Nobody", "out", D(2014, 7, 1)), (7, "Real Sociedad", "griezmann", "out", None)],
        "club_id long, club_name string, player_name string, direction string, transfer_date date",
    )
    players = spark.createDataFrame([(5, "Griezmann"), (3, "Griezmann"), (1, "Griezmann"), (9, "Nobody")], "player_id long, player_name string")
    valuations = spark.createDataFrame(
        [("a", 3, D(2010, 1, 1), 1e6, 13, "Real Sociedad"), ("b", 3, D(2014, 1, 1), 2e7, 13, "Real Sociedad"), ("c", 3, D(2015, 1, 1), 3e7, 13, "Real Sociedad"),
         ("d", 1, D(2014, 1, 1), 5.0, 13, "Elsewhere"), ("e", 5, D(2012, 1, 1), 7.0, 13, "Real Sociedad")],
        "player_valuation_id string, player_id long, valuation_date date, market_value_in_eur double, current_club_id long, current_club_name string",
    )
    out = im.value_trajectory(moves, players, valuations)
    assert rows(out, "direction", "transfer_date", "player_id", "value_at_arrival", "value_at_departure") == [("out", D(2014, 7, 1), 3, 1e6, 2e7)]


def test_arrival_and_departure_of_one_pair_share_the_values_at_reference_grain(spark):
    moves = spark.createDataFrame(
        [(7, "Club", "P", "in", D(2020, 7, 1)), (7, "Club", "P", "out", D(2022, 7, 1))],
        "club_id long, club_name string, player_name string, direction string, transfer_date date",
    )
    players = spark.createDataFrame([(1, "P")], "player_id long, player_name string")
    valuations = spark.createDataFrame(
        [("a", 1, D(2020, 1, 1), 1.0, "Club"), ("b", 1, D(2022, 1, 1), 2.0, "Club")],
        "player_valuation_id string, player_id long, valuation_date date, market_value_in_eur double, current_club_name string",
    )
    columns = ["direction", "value_at_arrival", "value_at_departure"]
    assert rows(im.value_trajectory(moves, players, valuations), *columns) == [("in", 1.0, None), ("out", None, 2.0)]
    assert rows(im.value_trajectory(moves, players, valuations, full_grain=True), *columns) == [("in", 1.0, 1.0), ("out", 1.0, 2.0)]


def test_recent_moves_keep_nulls(spark):
    moves = spark.createDataFrame(
        [(7, "Club", "26/27", "out", D(2022, 7, 1), "P", "P", "Other", "", 5.0, "EUR", "page"), (7, "Club", "26/27", "out", None, "P", "P", "Other", "", 5.0, "EUR", "page"),
         (7, "Club", "26/27", "in", D(2022, 7, 2), "Q", "Q", "Other", "", 5.0, "EUR", "page")],
        "club_id long, club_name string, season string, direction string, transfer_date date, player_name string, player_wiki_title string, "
        "other_club_name string, transfer_type string, fee_amount double, fee_currency string, source_page string",
    )
    trajectory = spark.createDataFrame(
        [(7, "P", "out", D(2022, 7, 1), 1, 1.0, D(2020, 1, 1), 3.0, D(2022, 1, 1)), (7, "Q", "in", D(2022, 7, 2), 2, 1.0, D(2022, 1, 1), 1.0, D(2022, 1, 1))],
        "club_id long, player_name string, direction string, transfer_date date, player_id long, value_at_arrival double, value_at_arrival_date date, "
        "value_at_departure double, value_at_departure_date date",
    )
    champions = spark.createDataFrame([("L", 2021, "league", 7, D(2021, 5, 1)), ("L", 2021, "cup", 7, D(2022, 7, 1))],
                                      "competition_id string, season int, title_type string, champion_club_id long, title_date date")
    players = spark.createDataFrame([(1, "u")], "player_id long, image_url string")
    out = marts.recent_move_indicators(moves, trajectory, players, im.titles_during_tenure(trajectory, champions))
    assert rows(out, "player_name", "transfer_date", "player_image_url", "value_gained_during_tenure", "fee_vs_last_valuation",
                "league_titles_during_tenure", "cup_titles_during_tenure") == [
        ("P", None, None, None, None, None, None), ("P", D(2022, 7, 1), "u", 2.0, 2.0, 1, 0), ("Q", D(2022, 7, 2), None, None, None, None, None)]


def test_dim_club_takes_the_latest_rating(spark):
    columns = ", ".join(f"cast(null as string) {c}" for c in marts.CLUB_COLUMNS if c != "club_id")
    clubs = spark.sql(f"select id as club_id, {columns} from values (1L), (2L) t(id)")
    mapping = spark.createDataFrame([(1, "Name", "R", "ESP")], "club_id int, club_name string, clubelo_club string, clubelo_country string")
    ratings = spark.createDataFrame(
        [("R", "ESP", 1.0, D(2020, 1, 1), D(2020, 6, 1)), ("R", "ESP", 2.0, D(2020, 6, 2), D(2021, 1, 1)), ("R", "FRA", 9.0, D(2022, 1, 1), D(2023, 1, 1))],
        "clubelo_club string, clubelo_country string, elo double, rating_from_date date, rating_to_date date",
    )
    out = marts.dim_club(clubs, mapping, ratings)
    assert rows(out, "club_id", "current_elo") == [(1, 2.0), (2, None)]
    assert out.where("club_id = 2").first()["crest_url"].endswith("/2.png")


def test_plain_dimensions(spark):
    for columns, build in ((marts.TEAM_COLUMNS, marts.dim_team), (marts.MATCH_COLUMNS, marts.fct_match)):
        wide = spark.range(2).select(*[F.lit(i).alias(c) for i, c in enumerate(columns)], F.lit("x").alias("unused"))
        assert build(wide).columns == columns
    wide = spark.range(1).select(*[F.lit("x").alias(c) for c in marts.PLAYER_COLUMNS], F.lit(1.0).alias("market_value_in_eur"), F.lit(2.0).alias("highest_market_value_in_eur"))
    assert marts.dim_player(wide).columns == [*marts.PLAYER_COLUMNS, "current_market_value_in_eur", "highest_market_value_in_eur"]


def test_kpi_leaves_stale_valuations_out_of_the_mean(spark):
    fct = spark.createDataFrame(
        [("22/23", 1, 100.0, 100.0, -1.0, 5.0), ("22/23", 1, 100.0, 150.0, 0.5, None), ("22/23", 9, 100.0, 250.0, 1.5, 7.0), ("22/23", 1, 100.0, 100.0, None, 9.0), (None, 1, 1.0, 2.0, 8.0, 1.0)],
        "transfer_season string, to_club_id long, market_value_at_transfer double, market_value_at_spell_end double, roi_financier double, cost_per_goal_contribution double",
    )
    clubs = spark.createDataFrame([(1, "Club 1")], "club_id long, club_name string")
    assert tuple(reports.kpi_summary(fct, clubs).first()) == (3, 1.0, 33.0, 6.0)
    assert tuple(reports.kpi_summary(fct, clubs, club="Club%").first()) == (2, 0.5, 50.0, 5.0)


def test_trajectory_reads_valuations_of_resolved_pairs_only(spark):
    moves = spark.createDataFrame([(1, "A", "in", D(2023, 1, 1), "Club 1")], "club_id long, player_name string, direction string, transfer_date date, club_name string")
    players = spark.createDataFrame([(7, "a"), (8, "b")], "player_id long, player_name string")
    valued = [(f"v{i}", i % 2 + 7, D(2022, 1, 1 + i), float(i), f"Club {i % 3}") for i in range(12)]
    valuations = spark.createDataFrame(valued, "player_valuation_id string, player_id long, valuation_date date, market_value_in_eur double, current_club_name string")
    out = im.value_trajectory(moves, players, valuations)
    assert [tuple(r)[4:] for r in out.collect()] == [(7, 4.0, D(2022, 1, 5), 10.0, D(2022, 1, 11))]
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
