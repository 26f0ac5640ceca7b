"""Intervals, as-of lookups, champions and the fact marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.catalog.domain_sql import sql
from tenure.catalog.registry import query
from tenure.operators import temporal
from tenure.operators.joins import attach
from tenure.operators.matching import entity_resolve
from tenure.operators.ranking import last_period_rows
from tenure.functions.text import leading_int
from tenure.plans import adapters as ad
from tenure.plans import intermediate as im
from tenure.plans import incremental, marts
from tenure.session import scratch_folder


def _champions(t: ad.Tables) -> DataFrame:
    return im.season_champions(ad.scope(t), ad.games(t), ad.club_games(t))


def _spells(t: ad.Tables) -> DataFrame:
    return im.club_spells(ad.transfers(t))


@query(sql(["spells"], "SELECT *, spell_end_date IS NULL AS is_current_spell FROM spells"))
def spells(t):
    return _spells(t)


@query(sql(["spells", "appearances"], """
    SELECT s.transfer_id, a.appearance_id, a.appearance_date
    FROM spells s LEFT JOIN appearances a ON s.player_id = a.player_id AND s.club_id = a.player_club_id
        AND s.spell_start_date <= a.appearance_date AND (s.spell_end_date IS NULL OR s.spell_end_date > a.appearance_date)"""))
def interval_join(t):
    played = ad.appearances(t).select("appearance_id", "player_id", F.col("player_club_id").alias("club_id"), "appearance_date")
    out = temporal.interval_join(
        _spells(t), played, ["player_id", "club_id"], "transfer_id", "spell_start_date", "spell_end_date", "appearance_date", how="left"
    )
    return out.select("transfer_id", "appearance_id", "appearance_date")


@query("""
    SELECT s.event_id AS span_id, f.event_id AS fact_id
    FROM events s JOIN events f ON s.user_id = f.user_id AND cast(f.ts AS date) >= cast(s.ts AS date)
        AND cast(f.ts AS date) < cast(s.ts AS date) + 5
    WHERE s.event_type = 'signup' AND f.event_type = 'purchase'""")
def interval_join_overlapping(t):
    day = F.col("ts").cast("date")
    spans = t["events"].where("event_type = 'signup'").select(
        "user_id", F.col("event_id").alias("span_id"), day.alias("from_day"), F.date_add(day, 5).alias("to_day")
    )
    facts = t["events"].where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("fact_id"), day.alias("day"))
    return temporal.overlapping_interval_join(spans, facts, ["user_id"], "from_day", "to_day", "day", bucket_days=4).select("span_id", "fact_id")


@query(sql(["performance"], "SELECT * FROM performance"))
def interval_agg(t):
    return im.performance_during_spell(_spells(t), ad.appearances(t), ad.games(t))


@query(sql(["value_at_end"], "SELECT * FROM value_at_end"))
def asof_latest(t):
    return im.market_value_at_spell_end(_spells(t), ad.player_valuations(t), F.lit(ad.AS_OF))


@query("""
    SELECT f.event_id, p.event_id AS period_event_id
    FROM events f LEFT JOIN (
        SELECT event_id, user_id, cast(ts AS date) AS from_day, cast(ts AS date) + cast(event_id % 5 AS int) AS to_day
        FROM events WHERE event_type = 'signup') p ON f.user_id = p.user_id
    WHERE f.event_type = 'purchase'
    QUALIFY row_number() OVER (PARTITION BY f.event_id
        ORDER BY cast(f.ts AS date) BETWEEN from_day AND to_day DESC, abs(cast(f.ts AS date) - from_day), from_day,
            to_day DESC, p.event_id) = 1""")
def nearest_period(t):
    day = F.col("ts").cast("date")
    periods = t["events"].where("event_type = 'signup'").select(
        "user_id", "event_id", day.alias("from_day"), F.date_add(day, (F.col("event_id") % 5).cast("int")).alias("to_day")
    )
    facts = t["events"].where("event_type = 'purchase'").select("event_id", "user_id", day.alias("day"))
    return temporal.nearest_period(
        facts, periods, ["user_id"], "day", "from_day", "to_day", {"event_id": "period_event_id"}, tiebreak=["event_id"]
    ).select("event_id", "period_event_id")


@query(sql(["elo"], "SELECT * FROM elo"))
def rating_at_transfer(t):
    return im.club_elo_at_transfer(ad.transfers(t), ad.mapping(t), ad.ratings(t))


@query(sql(["champions"], "SELECT * FROM champions"))
def season_champions(t):
    return _champions(t)


@query(sql(["games", "scope"], """
    SELECT game_id, competition_id, season, matchday FROM (
        SELECT game_id, competition_id, season, try_cast(nullif(regexp_extract(round, '^[0-9]+'), '') AS int) AS matchday,
            max(matchday) OVER (PARTITION BY competition_id, season) AS last_matchday
        FROM games)
    WHERE matchday = last_matchday"""), name="last_period_rows")
def _last_period_rows(t):
    rows = ad.games(t).withColumn("matchday", leading_int(F.col("round")))
    return last_period_rows(rows, ["competition_id", "season"], "matchday").select("game_id", "competition_id", "season", "matchday")


@query(sql(["games", "scope"], """
    SELECT game_id, competition_id FROM games JOIN scope USING (competition_id) WHERE champion_method = 'league_table'"""))
def allowlist_scope(t):
    leagues = ad.scope(t).where("champion_method = 'league_table'").select("competition_id")
    return attach(ad.games(t), leagues, ["competition_id"], "inner").select("game_id", "competition_id")


@query(sql(["titles"], "SELECT * FROM titles"))
def titles_in_spell(t):
    return im.titles_during_spell(_spells(t), _champions(t))


def _trajectory(t: ad.Tables, full_grain: bool = False) -> DataFrame:
    return im.value_trajectory(ad.recent_moves(t), ad.players(t), ad.player_valuations(t), full_grain)


@query(sql(["trajectory"], "SELECT * FROM trajectory"))
def value_trajectory(t):
    return _trajectory(t)


@query(sql(["candidates", "player_valuations"], """
    SELECT c.club_id, c.player_name, c.direction, c.transfer_date, c.player_id,
        arg_min(market_value_in_eur, (valuation_date, player_valuation_id)) AS value_at_arrival, min(valuation_date) AS value_at_arrival_date,
        arg_max(market_value_in_eur, (valuation_date, player_valuation_id)) AS value_at_departure, max(valuation_date) AS value_at_departure_date
    FROM candidates c JOIN player_valuations v
        ON c.player_id = v.player_id AND c.club_name = v.current_club_name AND c.transfer_date >= v.valuation_date
    GROUP BY ALL"""))
def value_trajectory_full_grain(t):
    return _trajectory(t, full_grain=True)


@query(sql(["tenure_titles"], "SELECT * FROM tenure_titles"))
def titles_in_tenure(t):
    return im.titles_during_tenure(_trajectory(t), _champions(t))


@query(sql(["candidates"], "SELECT club_id, player_name, direction, transfer_date, player_id FROM candidates"), name="entity_resolve")
def _entity_resolve(t):
    found = entity_resolve(
        ad.recent_moves(t), ad.players(t), ad.player_valuations(t), "player_name", "club_name", "player_name", "player_id",
        "player_id", "current_club_name",
    )
    return found.select(*im.MOVE_KEY, "player_id")


_FCT_TRANSFER = sql(["transfers", "spells", "performance", "value_at_end", "elo", "titles"], """
    SELECT transfer_id, t.player_id, from_club_id, to_club_id, transfer_date, transfer_season, transfer_fee,
        t.market_value_in_eur AS market_value_at_transfer, spell_end_date, spell_end_date IS NULL AS is_current_spell,
        market_value_at_spell_end, market_value_at_spell_end_date, matches_played AS matches_played_during_spell,
        seasons_played AS seasons_played_during_spell, goals AS goals_during_spell, assists AS assists_during_spell,
        minutes_played AS minutes_played_during_spell, yellow_cards AS yellow_cards_during_spell,
        red_cards AS red_cards_during_spell, from_club_elo, to_club_elo,
        coalesce(league_titles_during_spell, 0) AS league_titles_during_spell,
        coalesce(cup_titles_during_spell, 0) AS cup_titles_during_spell,
        (market_value_at_spell_end - t.market_value_in_eur - transfer_fee) / nullif(transfer_fee, 0) AS roi_financier,
        market_value_at_spell_end - t.market_value_in_eur - transfer_fee AS value_gained_absolute,
        transfer_fee / nullif(goals + assists, 0) AS cost_per_goal_contribution,
        transfer_fee / nullif(seasons_played, 0) AS cost_per_season, to_club_elo - from_club_elo AS club_elo_delta
    FROM transfers t JOIN spells USING (transfer_id) LEFT JOIN performance USING (transfer_id)
        LEFT JOIN value_at_end USING (transfer_id) LEFT JOIN elo USING (transfer_id) LEFT JOIN titles USING (transfer_id)""")


@query(_FCT_TRANSFER)
def fct_transfer(t):
    needed = ["transfers", "appearances", "games", "club_games", "player_valuations", "scope", "mapping", "ratings"]
    return marts.fct_transfer(ad.domain(t, *needed), ad.AS_OF, scratch_folder(t.spark))


_FCT_RECENT_MOVES = sql(["recent_moves", "trajectory", "tenure_titles", "players"], """
    SELECT m.club_id, m.club_name, season, m.direction, m.transfer_date, m.player_name, player_wiki_title, other_club_name,
        transfer_type, cast(fee_amount AS double) AS fee_amount, fee_currency, source_page, image_url AS player_image_url,
        value_at_arrival, value_at_arrival_date, value_at_departure, value_at_departure_date, league_titles_during_tenure,
        cup_titles_during_tenure,
        CASE WHEN m.direction = 'out' THEN value_at_departure - value_at_arrival END AS value_gained_during_tenure,
        CASE WHEN m.direction = 'out' THEN cast(fee_amount AS double) - value_at_departure END AS fee_vs_last_valuation
    FROM recent_moves m
        LEFT JOIN trajectory v ON m.club_id = v.club_id AND m.player_name = v.player_name AND m.direction = v.direction
            AND m.transfer_date = v.transfer_date
        LEFT JOIN players p ON v.player_id = p.player_id
        LEFT JOIN tenure_titles l ON m.club_id = l.club_id AND m.player_name = l.player_name AND m.direction = l.direction
            AND m.transfer_date = l.transfer_date""")


@query(_FCT_RECENT_MOVES)
def fct_recent_moves(t):
    needed = ["games", "club_games", "player_valuations", "scope", "players", "recent_moves"]
    mart = marts.fct_recent_moves(ad.domain(t, *needed), scratch=scratch_folder(t.spark))
    return mart.withColumn("fee_amount", F.col("fee_amount").cast("double"))


_TRANSFER_TABLES = ["transfers", "appearances", "games", "club_games", "player_valuations", "scope", "mapping", "ratings"]
_MOVE_TABLES = ["games", "club_games", "player_valuations", "scope", "players", "recent_moves"]


@query(_FCT_TRANSFER)
def incremental_fct_transfer(t):
    """The mart of the tables without their newest rows, brought up to date by these: late transfers, valuations and appearances."""
    scratch = scratch_folder(t.spark)
    ad.share_lines(t, scratch)
    after = ad.domain(t, *_TRANSFER_TABLES)
    late = {
        "transfers": F.col("transfer_date") >= "2001-07-20", "player_valuations": F.col("valuation_date") >= "2001-10-25",
        "appearances": F.col("appearance_date") >= "2001-10-25",
    }
    before = {**after, **{name: after[name].where(~rows) for name, rows in late.items()}}
    changes = {name: after[name].where(rows) for name, rows in late.items()}
    return incremental.fct_transfer(marts.fct_transfer(before, ad.AS_OF, scratch), after, changes, ad.AS_OF, scratch)


@query(_FCT_RECENT_MOVES)
def incremental_fct_recent_moves(t):
    """The same for the moves: the newest valuations are late, and the moves of some days were read with another fee."""
    scratch = scratch_folder(t.spark)
    ad.share_lines(t, scratch)
    after = ad.domain(t, *_MOVE_TABLES)
    late = F.col("valuation_date") >= "2001-10-25"
    reread = F.col("transfer_date").between("2001-07-20", "2001-07-24")
    moves, valuations = after["recent_moves"], after["player_valuations"]
    wrong = moves.withColumn("fee_amount", F.when(reread, F.lit(0).cast("decimal(38,6)").cast(moves.schema["fee_amount"].dataType)).otherwise(F.col("fee_amount")))
    before = {**after, "recent_moves": wrong, "player_valuations": valuations.where(~late)}
    changes = {"recent_moves": moves.where(reread).unionByName(wrong.where(reread)), "player_valuations": valuations.where(late)}
    fresh = incremental.fct_recent_moves(marts.fct_recent_moves(before, scratch=scratch), after, changes, scratch=scratch)
    return fresh.withColumn("fee_amount", F.col("fee_amount").cast("double"))


@query(sql(["ratings", "mapping"], """
    SELECT cast(r_regionkey AS bigint) AS club_id, r_name AS club_code, 'Club ' || r_regionkey AS club_name, 'C' || r_regionkey AS domestic_competition_id,
        'Coach ' || r_regionkey AS coach_name, cast(20 + r_regionkey AS int) AS squad_size, r_regionkey * 1.5::double AS average_age,
        r_regionkey AS foreigners_number, r_regionkey / 10.0::double AS foreigners_percentage, r_regionkey AS national_team_players,
        'Stadium ' || r_regionkey AS stadium_name, r_regionkey * 1000 AS stadium_seats, '+' || r_regionkey AS net_transfer_record,
        2001 AS last_season, elo AS current_elo,
        'https://tmssl.akamaized.net/images/wappen/tiny/' || r_regionkey || '.png' AS crest_url
    FROM region LEFT JOIN (
        SELECT m.club_id, elo FROM mapping m JOIN ratings USING (clubelo_club, clubelo_country)
        QUALIFY row_number() OVER (PARTITION BY m.club_id ORDER BY rating_to_date DESC) = 1) e ON r_regionkey = e.club_id"""))
def dim_club(t):
    key = F.col("r_regionkey")
    text = key.cast("string")
    clubs = t["region"].select(
        key.cast("long").alias("club_id"), F.col("r_name").alias("club_code"), F.concat(F.lit("Club "), text).alias("club_name"),
        F.concat(F.lit("C"), text).alias("domestic_competition_id"), F.concat(F.lit("Coach "), text).alias("coach_name"),
        (key + 20).alias("squad_size"), (key * 1.5).alias("average_age"), key.alias("foreigners_number"),
        (key / 10.0).alias("foreigners_percentage"), key.alias("national_team_players"),
        F.concat(F.lit("Stadium "), text).alias("stadium_name"), (key * 1000).alias("stadium_seats"),
        F.concat(F.lit("+"), text).alias("net_transfer_record"), F.lit(2001).alias("last_season"),
    )
    return marts.dim_club(clubs, ad.mapping(t), ad.ratings(t))
