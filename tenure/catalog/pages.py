"""Page reports, rankings and measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenure.catalog.domain_sql import sql
from tenure.catalog.registry import query
from tenure.functions import measures
from tenure.operators import ranking
from tenure.operators.joins import in_roles
from tenure.plans import adapters as ad
from tenure.plans import reports

# The reports filter by season and club; these stand for a reader's choice.
SEASON, CLUB = "9%", "Club%"
_SCOPED = "transfer_season LIKE '{s}' AND coalesce(tc.club_name, '') LIKE '{c}'"
_FCT = "transfer_mart f LEFT JOIN clubs tc ON tc.club_id = f.to_club_id"
_SEASON_YEAR = "cast(left(transfer_season, 2) AS int) + if(cast(left(transfer_season, 2) AS int) >= 50, 1900, 2000)"


def _fct(t):
    return ad.transfer_mart(t), ad.players(t), ad.clubs_with_crest(t)


@query(sql(["transfer_mart", "clubs"], f"""
    SELECT count(*) AS transfers_analyzed,
        round(avg(roi_financier) FILTER (market_value_at_spell_end != market_value_at_transfer), 6) AS avg_roi_financier,
        round(100.0 * count(*) FILTER (market_value_at_spell_end = market_value_at_transfer) / count(*), 0) AS pct_stale_valuation,
        round(median(cost_per_goal_contribution), 6) AS median_cost_per_goal
    FROM {_FCT} WHERE roi_financier IS NOT NULL AND {_SCOPED.format(s='%', c='%')}"""))
def kpi_summary(t):
    fct, _, clubs = _fct(t)
    out = reports.kpi_summary(fct, clubs)
    return out.withColumns({c: F.round(c, 6) for c in ("avg_roi_financier", "median_cost_per_goal")})


@query(sql(["transfer_mart", "clubs"], f"""
    SELECT transfer_id, transfer_season, tc.club_name FROM {_FCT} WHERE {_SCOPED.format(s=SEASON, c=CLUB)}"""))
def param_filter(t):
    fct, _, clubs = _fct(t)
    rows = reports.in_scope(fct, clubs, SEASON, CLUB).select("transfer_id", "transfer_season", "to_club_id")
    return rows.join(clubs.select(F.col("club_id").alias("to_club_id"), "club_name"), "to_club_id", "left").drop("to_club_id")


@query(sql(["transfer_mart", "players", "clubs"], f"""
    SELECT player_name, p.image_url, tc.club_name AS to_club, tc.crest_url, roi_financier
    FROM {_FCT} JOIN players p ON p.player_id = f.player_id
    WHERE roi_financier IS NOT NULL AND transfer_fee >= 1000000 AND {_SCOPED.format(s='%', c='%')}
    ORDER BY roi_financier DESC, transfer_id LIMIT 6"""))
def hero_players(t):
    return reports.hero_players(*_fct(t))


def _spectrum_sql(by: str, positive: str, negative: str, label: str, columns: str, extra: str = "") -> str:
    part = f"""SELECT {columns}, f.transfer_id FROM {_FCT} JOIN players p ON p.player_id = f.player_id {extra}
        WHERE {by} IS NOT NULL AND transfer_fee >= 1000000 AND {_SCOPED.format(s='%', c='%')} ORDER BY {by} {{}}, f.transfer_id LIMIT 6"""
    return sql(["transfer_mart", "players", "clubs"], f"""
        SELECT * EXCLUDE (transfer_id), CASE WHEN {by} >= 0 THEN '{positive}' ELSE '{negative}' END AS {label}
        FROM (({part.format('DESC')}) UNION ALL ({part.format('ASC')}))""")


@query(_spectrum_sql("roi_financier", "Gained value", "Lost value", "roi_direction", """player_name, p.image_url, transfer_date,
    tc.club_name AS to_club, tc.crest_url, transfer_fee, market_value_at_transfer, market_value_at_spell_end,
    market_value_at_spell_end_date, roi_financier, goals_during_spell, assists_during_spell"""))
def spectrum(t):
    return reports.roi_spectrum(*_fct(t))


@query(_spectrum_sql("club_elo_delta", "Stepped up", "Stepped down", "elo_direction", """player_name, p.image_url, transfer_date,
    fc.club_name AS from_club, tc.club_name AS to_club, tc.crest_url, club_elo_delta""", "LEFT JOIN clubs fc ON fc.club_id = f.from_club_id"))
def elo_spectrum(t):
    return reports.elo_spectrum(*_fct(t))


@query(sql(["transfer_mart", "players", "clubs"], f"""
    SELECT player_name, p.image_url, transfer_date, tc.club_name AS to_club, tc.crest_url, transfer_fee, goals_during_spell,
        assists_during_spell, cost_per_goal_contribution
    FROM {_FCT} JOIN players p ON p.player_id = f.player_id
    WHERE cost_per_goal_contribution IS NOT NULL AND transfer_fee >= 1000000 AND {_SCOPED.format(s=SEASON, c=CLUB)}
    ORDER BY cost_per_goal_contribution, transfer_id LIMIT 12"""))
def cost_efficiency(t):
    return reports.cost_efficiency(*_fct(t), season=SEASON, club=CLUB)


@query(sql(["transfer_mart", "players", "clubs"], f"""
    SELECT player_name, p.image_url, transfer_date, tc.club_name AS to_club, tc.crest_url, market_value_at_transfer,
        market_value_at_spell_end, market_value_at_spell_end_date, value_gained_absolute, goals_during_spell, assists_during_spell
    FROM {_FCT} JOIN players p ON p.player_id = f.player_id
    WHERE transfer_fee = 0 AND value_gained_absolute IS NOT NULL AND {_SCOPED.format(s='%', c='%')}
    ORDER BY value_gained_absolute DESC, transfer_id LIMIT 12"""))
def zero_cost_topk(t):
    return reports.best_free_transfers(*_fct(t))


@query(sql(["transfer_mart"], f"SELECT DISTINCT transfer_season, {_SEASON_YEAR} AS season_start_year FROM transfer_mart"))
def season_start_year(t):
    return reports.seasons(ad.transfer_mart(t))


@query(sql(["transfer_mart", "clubs"], "SELECT DISTINCT tc.club_name FROM transfer_mart f JOIN clubs tc ON tc.club_id = f.to_club_id"))
def distinct_list(t):
    fct, _, clubs = _fct(t)
    return reports.acquiring_clubs(fct, clubs)


@query(sql(["transfer_mart", "recent_mart", "players"], """
    SELECT player_name FROM transfer_mart f JOIN players p ON p.player_id = f.player_id
    UNION SELECT player_name FROM recent_mart WHERE direction = 'out' AND value_gained_during_tenure IS NOT NULL"""))
def union_distinct(t):
    fct, players, _ = _fct(t)
    return reports.player_list(fct, ad.recent_mart(t), players)


@query(sql(["transfer_mart", "recent_mart", "clubs"], """
    SELECT tc.club_name FROM transfer_mart f JOIN clubs tc ON tc.club_id = f.to_club_id
    UNION SELECT tc.club_name FROM recent_mart w JOIN clubs tc ON tc.club_id = w.club_id"""))
def recent_clubs(t):
    fct, _, clubs = _fct(t)
    return reports.recent_clubs(fct, ad.recent_mart(t), clubs)


@query(sql(["players"], """
    SELECT player_name, image_url, "position", country_of_citizenship, current_club_name, current_market_value_in_eur
    FROM players WHERE player_name = 'Player 7' ORDER BY current_market_value_in_eur DESC NULLS LAST, player_id LIMIT 1"""))
def profile_lookup(t):
    return reports.player_profile(ad.players(t), "Player 7")


@query(sql(["transfer_mart", "players", "clubs"], """
    SELECT fc.club_name AS from_club, fc.crest_url AS from_crest, tc.club_name AS to_club, tc.crest_url AS to_crest, transfer_date,
        transfer_fee, market_value_at_transfer, market_value_at_spell_end, market_value_at_spell_end_date, roi_financier,
        value_gained_absolute, goals_during_spell, assists_during_spell
    FROM transfer_mart f JOIN players p ON p.player_id = f.player_id LEFT JOIN clubs fc ON fc.club_id = f.from_club_id
        LEFT JOIN clubs tc ON tc.club_id = f.to_club_id
    WHERE player_name = 'Player 7'"""))
def entity_history(t):
    return reports.player_transfers(*_fct(t), "Player 7")


@query(sql(["recent_mart", "clubs"], """
    SELECT w.club_name, tc.crest_url, other_club_name, direction, transfer_date, fee_amount, value_at_arrival, value_at_departure,
        value_gained_during_tenure, fee_vs_last_valuation
    FROM recent_mart w LEFT JOIN clubs tc ON tc.club_id = w.club_id WHERE player_name = 'Mover 101'"""))
def entity_recent_moves(t):
    return reports.player_recent_moves(ad.recent_mart(t), ad.clubs_with_crest(t), "Mover 101")


_NEWEST = f"SELECT transfer_season FROM transfer_mart ORDER BY {_SEASON_YEAR} DESC NULLS LAST LIMIT 1"


@query(sql(["transfer_mart"], f"""
    SELECT transfer_season, {_SEASON_YEAR} AS season_start_year FROM transfer_mart ORDER BY season_start_year DESC NULLS LAST LIMIT 1"""))
def current_window_season(t):
    return reports.current_window_season(ad.transfer_mart(t))


@query(sql(["transfer_mart", "clubs"], f"""
    SELECT count(*) AS total, count(tc.club_id) AS with_known_club,
        count(*) FILTER (transfer_fee > 0) AS fee_confirmed
    FROM {_FCT} WHERE transfer_season = ({_NEWEST})"""))
def window_counts(t):
    fct, _, clubs = _fct(t)
    return reports.current_window_counts(fct, clubs)


@query(sql(["transfer_mart"], f"""
    SELECT round(100.0 * count(*) FILTER (transfer_fee > 0) / count(*), 1) AS pct_fee_confirmed
    FROM transfer_mart WHERE transfer_season = (
        SELECT transfer_season FROM (SELECT DISTINCT transfer_season FROM transfer_mart)
        ORDER BY {_SEASON_YEAR} DESC NULLS LAST LIMIT 1 OFFSET 1)"""))
def prior_period_rate(t):
    return reports.prior_season_fee_rate(ad.transfer_mart(t))


@query(sql(["transfer_mart", "players", "clubs"], f"""
    SELECT player_name, p.image_url, tc.club_name AS to_club, tc.crest_url, current_market_value_in_eur, transfer_date
    FROM transfer_mart f JOIN players p ON p.player_id = f.player_id JOIN clubs tc ON tc.club_id = f.to_club_id
    WHERE transfer_season = ({_NEWEST}) ORDER BY transfer_date DESC, transfer_id LIMIT 20"""))
def current_window(t):
    return reports.current_window(*_fct(t))


@query(sql(["recent_mart", "clubs"], """
    SELECT w.club_name, tc.crest_url, player_image_url, player_name, other_club_name AS from_club, transfer_date, transfer_type,
        fee_amount, fee_currency
    FROM recent_mart w LEFT JOIN clubs tc ON tc.club_id = w.club_id
    WHERE direction = 'in' ORDER BY transfer_date DESC NULLS LAST, w.club_id, player_name LIMIT 30"""))
def recent_arrivals(t):
    return reports.recent_arrivals(ad.recent_mart(t), ad.clubs_with_crest(t))


@query(sql(["recent_mart"], """
    SELECT club_name AS from_club, other_club_name AS to_club, fee_amount, value_at_arrival, value_at_departure,
        value_gained_during_tenure, fee_vs_last_valuation
    FROM recent_mart WHERE direction = 'out' AND lower(player_name) LIKE '%over 10%'
    ORDER BY transfer_date DESC NULLS LAST, club_id, player_name LIMIT 1"""))
def name_search(t):
    return reports.departure_example(ad.recent_mart(t), "OVER 10")


_DEPARTURES = """SELECT player_name, player_image_url, transfer_date, w.club_name AS sold_by, tc.crest_url, other_club_name AS sold_to,
    value_at_arrival, value_at_arrival_date, value_at_departure, value_at_departure_date, value_gained_during_tenure, fee_amount,
    fee_vs_last_valuation
    FROM recent_mart w LEFT JOIN clubs tc ON tc.club_id = w.club_id
    WHERE direction = 'out' AND value_gained_during_tenure IS NOT NULL
    ORDER BY value_gained_during_tenure {}, w.club_id, player_name LIMIT 6"""


@query(sql(["recent_mart", "clubs"], f"""
    SELECT *, CASE WHEN value_gained_during_tenure >= 0 THEN 'Gained value' ELSE 'Lost value' END AS roi_direction
    FROM (({_DEPARTURES.format('DESC')}) UNION ALL ({_DEPARTURES.format('ASC')}))"""))
def departures_spectrum(t):
    return reports.departures_spectrum(ad.recent_mart(t), ad.clubs_with_crest(t))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk(t):
    return ranking.topk(t["orders"].select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 10)


@query("""
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(t):
    events = t["events"].select("user_id", "event_id", "event_type", "value", "ts")
    return ranking.latest_per_key(events, ["user_id"], [F.col("ts").desc_nulls_first(), F.col("event_id").desc()]).drop("ts")


@query("""
    SELECT user_id, event_type, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value
    FROM events GROUP BY user_id, event_type""")
def first_last_value(t):
    return ranking.first_last(t["events"], ["user_id", "event_type"], ["ts", "event_id"], ["value"])


@query("""
    SELECT user_id, event_type, max(value) FILTER ((ts, event_id) = lo) AS first_value, max(value) FILTER ((ts, event_id) = hi) AS last_value
    FROM (SELECT *, min((ts, event_id)) OVER (PARTITION BY user_id) AS lo, max((ts, event_id)) OVER (PARTITION BY user_id) AS hi FROM events)
    GROUP BY user_id, event_type""")
def first_last_rank_grain(t):
    return ranking.first_last(t["events"], ["user_id", "event_type"], ["ts", "event_id"], ["value"], rank_keys=["user_id"])


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax / nullif(l_discount, 0) AS ratio, l_tax - l_discount AS difference
    FROM lineitem""")
def safe_ratio(t):
    tax, discount = F.col("l_tax"), F.col("l_discount")
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", measures.safe_ratio(tax, discount).alias("ratio"),
        (tax - discount).alias("difference"),
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice - 1000 END AS closed_margin,
        CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 0.5::double END AS open_share FROM orders""")
def gated_measures(t):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return t["orders"].select(
        "o_orderkey", measures.gated(status == "F", price - 1000).alias("closed_margin"),
        measures.gated(status == "O", price * 0.5).alias("open_share"),
    )


@query("""
    SELECT o_orderkey, first || '–' || substr(cast(first + 1 AS varchar), 3, 2) AS season
    FROM (SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) >= 7 THEN 0 ELSE 1 END AS first FROM orders)""")
def season_label(t):
    return t["orders"].select("o_orderkey", measures.season_label(F.col("o_orderdate").cast("date")).alias("season"))


@query(sql(["transfer_mart", "clubs"], """
    SELECT transfer_id, fc.club_name AS from_club, tc.club_name AS to_club
    FROM transfer_mart f LEFT JOIN clubs fc ON fc.club_id = f.from_club_id LEFT JOIN clubs tc ON tc.club_id = f.to_club_id"""))
def role_playing_join(t):
    fct = ad.transfer_mart(t).select("transfer_id", "from_club_id", "to_club_id")
    roles = {"from": "from_club_id", "to": "to_club_id"}
    return in_roles(fct, ad.clubs(t), "club_id", roles, {"club_name": "club"}).select("transfer_id", "from_club", "to_club")
