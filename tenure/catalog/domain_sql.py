"""SQL text of the adapter tables and models, for the side-by-side check of the queries."""

from __future__ import annotations

AS_OF = "DATE '2001-12-31'"
_SEASON = "lpad(cast(year({d}) % 100 AS varchar), 2, '0') || '/' || lpad(cast((year({d}) + 1) % 100 AS varchar), 2, '0')"
_DAY = "cast(o_orderdate AS date)"
_FEE = "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 0.0::double ELSE o_totalprice END"
_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

TABLES: dict[str, str] = {
    "transfers": f"""
        SELECT cast(o_orderkey AS varchar) AS transfer_id, o_custkey AS player_id, {_DAY} AS transfer_date,
            {_SEASON.format(d='o_orderdate')} AS transfer_season, o_orderkey % 7 AS from_club_id,
            o_orderkey % 5 AS to_club_id, {_FEE} AS transfer_fee, o_totalprice * 0.8::double AS market_value_in_eur
        FROM orders""",
    "lines": f"""
        SELECT l.*, o_custkey AS player_id, {_LINE_ID} AS line_id
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey""",
    "appearances": """
        SELECT line_id AS appearance_id, l_orderkey AS game_id, player_id, l_suppkey % 5 AS player_club_id,
            cast(l_shipdate AS date) AS appearance_date, cast(l_quantity AS int) % 3 AS goals,
            cast(l_quantity AS int) % 2 AS assists, cast(l_quantity AS int) AS minutes_played,
            l_linenumber % 2 AS yellow_cards, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS red_cards
        FROM lines""",
    "player_valuations": """
        SELECT line_id AS player_valuation_id, player_id, cast(l_shipdate AS date) AS valuation_date,
            l_extendedprice AS market_value_in_eur, 'Club ' || (l_suppkey % 5) AS current_club_name
        FROM lines""",
    "games": f"""
        SELECT o_orderkey AS game_id, o_orderpriority AS competition_id, cast(year(o_orderdate) AS int) AS season,
            CASE WHEN o_orderstatus = 'F' THEN 'Final' ELSE month(o_orderdate) || '. Matchday' END AS round,
            {_DAY} AS game_date
        FROM orders""",
    "club_games": """
        SELECT o_orderkey AS game_id, (o_orderkey + away) % 5 AS club_id, 1 + (o_custkey + away) % 3 AS own_position,
            (o_custkey + away) % 2 = 0 AS is_win
        FROM orders, (VALUES (0), (1)) sides(away)""",
    "scope": """
        SELECT * FROM (VALUES ('1-URGENT', 'league_table'), ('2-HIGH', 'league_table'), ('3-MEDIUM', 'cup_final'),
            ('4-NOT SPECIFIED', 'cup_final')) v(competition_id, champion_method)""",
    "mapping": """
        SELECT r_regionkey AS club_id, 'Club ' || r_regionkey AS club_name, r_name AS clubelo_club,
            'R' || (r_regionkey % 2) AS clubelo_country
        FROM region""",
    "ratings": f"""
        SELECT clubelo_club, clubelo_country, 1500 + count(*)::double AS elo, min({_DAY}) AS rating_from_date,
            min({_DAY}) + 60 AS rating_to_date
        FROM orders JOIN mapping ON o_orderkey % 5 = mapping.club_id
        GROUP BY clubelo_club, clubelo_country, date_trunc('quarter', o_orderdate)""",
    "players": """
        SELECT c_custkey AS player_id, 'Player ' || (c_custkey % 100) AS player_name,
            'https://img.example.com/' || c_custkey AS image_url, c_mktsegment AS "position",
            cast(c_nationkey AS varchar) AS country_of_citizenship, 'Club ' || (c_custkey % 5) AS current_club_name,
            c_acctbal AS current_market_value_in_eur
        FROM customer""",
    "clubs": """
        SELECT cast(r_regionkey AS bigint) AS club_id, 'Club ' || r_regionkey AS club_name,
            'https://crest.example.com/' || r_regionkey AS crest_url
        FROM region""",
    "raw_recent_moves": f"""
        SELECT o_orderkey % 5 AS club_id, 'Club ' || (o_orderkey % 5) AS club_name, {_SEASON.format(d='o_orderdate')} AS season,
            CASE WHEN o_orderkey % 2 = 0 THEN 'in' ELSE 'out' END AS direction,
            CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE day(o_orderdate) || ' ' || monthname(o_orderdate) || ' ' || year(o_orderdate)
                || CASE WHEN o_orderkey % 4 = 0 THEN '[c]' ELSE '' END END AS date,
            'PLAYER ' || (o_custkey % 100) || CASE WHEN o_orderkey % 6 = 0 THEN '[a]' ELSE '' END AS player_name,
            'Player_' || (o_custkey % 100) AS player_wiki_title, 'Club ' || (o_orderkey % 7) || '[b]' AS other_club_name,
            CASE WHEN o_orderkey % 9 = 0 THEN '' WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'Transfer' END AS transfer_type,
            CASE WHEN o_orderkey % 8 != 0 THEN
                CASE o_orderkey % 3 WHEN 0 THEN '€' WHEN 1 THEN '£' ELSE '$' END || (o_orderkey % 90) || '.5 million' END AS fee_text,
            'Page ' || o_orderkey AS source_page
        FROM orders""",
    "clean_recent_moves": r"""
        SELECT club_id, club_name, season, direction, player_wiki_title, transfer_type, fee_text, source_page,
            regexp_replace(player_name, '\[.*?\]', '', 'g') AS player_name,
            regexp_replace(other_club_name, '\[.*?\]', '', 'g') AS other_club_name,
            cast(try_strptime(regexp_replace(date, '\[.*?\]', '', 'g'), '%d %B %Y') AS date) AS transfer_date,
            try_cast(regexp_replace(fee_text, '[^0-9.]', '', 'g') AS decimal(10,2)) * 1000000 AS fee_amount,
            CASE WHEN fee_text LIKE '€%' THEN 'EUR' WHEN fee_text LIKE '£%' THEN 'GBP' WHEN fee_text LIKE '$%' THEN 'USD' END AS fee_currency
        FROM raw_recent_moves""",
    "recent_moves": """
        SELECT * FROM clean_recent_moves
        QUALIFY row_number() OVER (
            PARTITION BY club_id, player_name, direction, coalesce(transfer_date, DATE '1900-01-01')
            ORDER BY (transfer_date IS NOT NULL) DESC NULLS FIRST, (transfer_type != '') DESC NULLS FIRST,
                transfer_type NULLS LAST, fee_amount NULLS LAST, other_club_name NULLS LAST, season NULLS LAST,
                player_wiki_title NULLS LAST, source_page NULLS LAST, fee_text NULLS LAST) = 1""",
    "champions": """
        SELECT competition_id, season, 'league' AS title_type, club_id AS champion_club_id, game_date AS title_date
        FROM (SELECT games.*, try_cast(nullif(regexp_extract(round, '^[0-9]+'), '') AS int) AS matchday,
                max(matchday) OVER (PARTITION BY competition_id, season) AS last_matchday
            FROM games JOIN scope USING (competition_id) WHERE champion_method = 'league_table') g
        JOIN club_games USING (game_id)
        WHERE matchday = last_matchday AND own_position = 1
        UNION ALL
        SELECT competition_id, season, 'cup', club_id, game_date
        FROM games JOIN scope USING (competition_id) JOIN club_games USING (game_id)
        WHERE champion_method = 'cup_final' AND lower(round) = 'final' AND is_win""",
    "spells": """
        SELECT transfer_id, player_id, to_club_id AS club_id, transfer_date AS spell_start_date,
            lead(transfer_date) OVER (PARTITION BY player_id ORDER BY transfer_date NULLS LAST, transfer_id) AS spell_end_date
        FROM transfers""",
    "performance": """
        SELECT s.transfer_id, count(a.appearance_id) AS matches_played, count(DISTINCT g.season) AS seasons_played,
            cast(coalesce(sum(goals), 0) AS bigint) AS goals, cast(coalesce(sum(assists), 0) AS bigint) AS assists,
            cast(coalesce(sum(minutes_played), 0) AS bigint) AS minutes_played,
            cast(coalesce(sum(yellow_cards), 0) AS bigint) AS yellow_cards, cast(coalesce(sum(red_cards), 0) AS bigint) AS red_cards
        FROM spells s
        LEFT JOIN appearances a ON s.player_id = a.player_id AND s.club_id = a.player_club_id
            AND s.spell_start_date <= a.appearance_date
            AND (s.spell_end_date IS NULL OR s.spell_end_date > a.appearance_date)
        LEFT JOIN games g ON a.game_id = g.game_id
        GROUP BY s.transfer_id""",
    "value_at_end": f"""
        SELECT s.transfer_id, v.market_value_in_eur AS market_value_at_spell_end, v.valuation_date AS market_value_at_spell_end_date
        FROM spells s JOIN player_valuations v
            ON s.player_id = v.player_id AND v.valuation_date <= coalesce(s.spell_end_date, {AS_OF})
        QUALIFY row_number() OVER (PARTITION BY s.transfer_id ORDER BY v.valuation_date DESC, v.player_valuation_id DESC) = 1""",
    "club_days": """
        SELECT DISTINCT club_id, transfer_date FROM (
            SELECT from_club_id AS club_id, transfer_date FROM transfers UNION ALL SELECT to_club_id, transfer_date FROM transfers)""",
    "rated_days": """
        SELECT d.club_id, d.transfer_date, r.elo
        FROM club_days d JOIN mapping m ON d.club_id = m.club_id JOIN ratings r USING (clubelo_club, clubelo_country)
        QUALIFY row_number() OVER (PARTITION BY d.club_id, d.transfer_date
            ORDER BY d.transfer_date BETWEEN r.rating_from_date AND r.rating_to_date DESC,
                abs(d.transfer_date - r.rating_from_date), r.rating_from_date) = 1""",
    "elo": """
        SELECT transfer_id, f.elo AS from_club_elo, g.elo AS to_club_elo
        FROM transfers t
        LEFT JOIN rated_days f ON t.from_club_id = f.club_id AND t.transfer_date = f.transfer_date
        LEFT JOIN rated_days g ON t.to_club_id = g.club_id AND t.transfer_date = g.transfer_date""",
    "titles": """
        SELECT transfer_id, count(*) FILTER (title_type = 'league') AS league_titles_during_spell,
            count(*) FILTER (title_type = 'cup') AS cup_titles_during_spell
        FROM spells s JOIN champions c ON s.club_id = c.champion_club_id AND s.spell_start_date <= c.title_date
            AND (s.spell_end_date IS NULL OR s.spell_end_date > c.title_date)
        GROUP BY transfer_id""",
    "candidates": """
        SELECT w.club_id, w.club_name, w.player_name, w.direction, w.transfer_date, p.player_id
        FROM recent_moves w JOIN players p ON lower(p.player_name) = lower(w.player_name)
        WHERE EXISTS (SELECT 1 FROM player_valuations v WHERE v.player_id = p.player_id AND v.current_club_name = w.club_name)
        QUALIFY row_number() OVER (PARTITION BY w.club_id, w.player_name, w.direction, w.transfer_date ORDER BY p.player_id) = 1""",
    "known_values": """
        SELECT c.*, market_value_in_eur AS value, valuation_date AS day, (valuation_date, player_valuation_id) AS place,
            (transfer_date, direction, player_name) AS move
        FROM candidates c JOIN player_valuations v ON v.player_id = c.player_id AND v.current_club_name = c.club_name
        WHERE valuation_date <= transfer_date""",
    "ends": """
        SELECT club_id, player_id, min((place, move)) AS opening, max(place) AS top
        FROM known_values GROUP BY club_id, player_id""",
    "closings": """
        SELECT k.club_id, k.player_id, min((place, move)) AS closing
        FROM known_values k JOIN ends e ON k.club_id = e.club_id AND k.player_id = e.player_id AND k.place = e.top
        GROUP BY k.club_id, k.player_id""",
    "trajectory": """
        SELECT k.club_id, player_name, direction, transfer_date, k.player_id,
            max(value) FILTER ((place, move) = opening) AS value_at_arrival, max(day) FILTER ((place, move) = opening) AS value_at_arrival_date,
            max(value) FILTER ((place, move) = closing) AS value_at_departure, max(day) FILTER ((place, move) = closing) AS value_at_departure_date
        FROM known_values k JOIN ends e ON k.club_id = e.club_id AND k.player_id = e.player_id
            JOIN closings c ON k.club_id = c.club_id AND k.player_id = c.player_id
        GROUP BY ALL""",
    "tenure_titles": """
        SELECT t.club_id, t.player_name, t.direction, t.transfer_date,
            count(*) FILTER (title_type = 'league') AS league_titles_during_tenure,
            count(*) FILTER (title_type = 'cup') AS cup_titles_during_tenure
        FROM trajectory t JOIN champions c ON t.club_id = c.champion_club_id AND t.value_at_arrival_date <= c.title_date
            AND t.transfer_date > c.title_date
        WHERE t.direction = 'out' AND t.value_at_arrival_date IS NOT NULL
        GROUP BY ALL""",
    "transfer_mart": f"""
        SELECT *, value_gained_absolute / nullif(transfer_fee, 0) AS roi_financier,
            transfer_fee / nullif(goals_during_spell + assists_during_spell, 0) AS cost_per_goal_contribution
        FROM (SELECT cast(o_orderkey AS varchar) AS transfer_id, o_custkey AS player_id, o_orderkey % 7 AS from_club_id,
                o_orderkey % 5 + o_orderkey % 2 AS to_club_id, {_DAY} AS transfer_date,
                CASE WHEN o_orderkey % 17 != 0 THEN {_SEASON.format(d='o_orderdate')} END AS transfer_season,
                ({_FEE}) * 10 AS transfer_fee, o_totalprice * 2 AS market_value_at_transfer,
                o_totalprice * (2 + o_orderkey % 5) AS market_value_at_spell_end, {_DAY} + 100 AS market_value_at_spell_end_date,
                o_orderkey % 4 AS goals_during_spell, o_orderkey % 3 AS assists_during_spell,
                CASE WHEN o_orderkey % 19 != 0 THEN cast(o_orderkey % 601 - 300 AS double) END AS club_elo_delta,
                market_value_at_spell_end - market_value_at_transfer - transfer_fee AS value_gained_absolute
            FROM orders)""",
    "recent_mart": f"""
        SELECT o_orderkey % 7 AS club_id, 'Club ' || (o_orderkey % 7) AS club_name,
            CASE WHEN o_orderkey % 2 = 1 THEN 'out' ELSE 'in' END AS direction,
            CASE WHEN o_orderkey % 13 != 0 THEN {_DAY} END AS transfer_date, 'Mover ' || o_orderkey AS player_name,
            'https://img.example.com/' || o_orderkey AS player_image_url, 'Club ' || (o_orderkey % 4) AS other_club_name,
            'Transfer' AS transfer_type, CASE WHEN o_orderkey % 8 != 0 THEN o_totalprice END AS fee_amount, 'EUR' AS fee_currency,
            CASE WHEN o_orderkey % 6 != 0 THEN o_totalprice * 0.5::double END AS value_at_arrival, {_DAY} - 400 AS value_at_arrival_date,
            CASE WHEN o_orderkey % 6 != 0 THEN 200000.0::double END AS value_at_departure, {_DAY} - 10 AS value_at_departure_date,
            CASE WHEN direction = 'out' THEN value_at_departure - value_at_arrival END AS value_gained_during_tenure,
            CASE WHEN direction = 'out' THEN fee_amount - value_at_departure END AS fee_vs_last_valuation
        FROM orders""",
}

# Which tables each table reads.
READS: dict[str, list[str]] = {
    "appearances": ["lines"], "player_valuations": ["lines"], "ratings": ["mapping"],
    "clean_recent_moves": ["raw_recent_moves"], "recent_moves": ["clean_recent_moves"],
    "champions": ["games", "scope", "club_games"], "spells": ["transfers"],
    "performance": ["spells", "appearances", "games"], "value_at_end": ["spells", "player_valuations"],
    "club_days": ["transfers"], "rated_days": ["club_days", "mapping", "ratings"], "elo": ["transfers", "rated_days"],
    "titles": ["spells", "champions"], "candidates": ["recent_moves", "players", "player_valuations"],
    "known_values": ["candidates", "player_valuations"], "ends": ["known_values"], "closings": ["known_values", "ends"],
    "trajectory": ["known_values", "ends", "closings"],
    "tenure_titles": ["trajectory", "champions"],
}


def sql(needs: list[str], body: str) -> str:
    """`body` with the needed tables, and what they read, as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in READS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for need in needs:
        add(need)
    # Shared tables are computed once, not once per use.
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n]})" for n in ordered) + "\n" + body
