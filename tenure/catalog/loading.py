"""Loads, staging, joins and data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tenure.catalog.domain_sql import sql
from tenure.catalog.registry import query
from tenure.operators import joins, loads, matching, quality
from tenure.plans import adapters as ad
from tenure.plans import intermediate as im
from tenure.plans.checks import ADAPTER_CHECKS, check_build
from tenure.session import scratch_folder
from tenure.sources.readers import flatten
from tenure.sources.staging import parse_spec, project
from tenure.streaming.upserts import append_load, read_current

AS_OF = ad.AS_OF.isoformat()


@query("""
    SELECT o_orderkey AS order_id, cast(o_custkey AS int) AS customer, cast(o_orderdate AS date) AS order_date, o_totalprice AS amount,
        o_orderstatus AS status FROM orders""")
def stage_project_cast(t):
    spec = "order_id:long=o_orderkey customer:int=o_custkey order_date:date=o_orderdate amount:double=o_totalprice status=o_orderstatus"
    return project(t["orders"], parse_spec(spec))


@query("""
    SELECT event_id, cast(json_extract(props, '$.k') AS bigint) AS props__k, user_id AS payload__user_id, event_type AS payload__kind__event_type
    FROM events""")
def json_flatten(t):
    nested = t["events"].select(
        "event_id", F.from_json("props", "k bigint").alias("props"),
        F.struct(F.col("user_id").alias("userId"), F.struct(F.col("event_type").alias("eventType")).alias("kind")).alias("payload"),
    )
    return flatten(nested)


_LOADS = """loads AS (
    SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS version FROM orders WHERE o_orderdate < DATE '1999-01-01'
    UNION ALL SELECT o_orderkey, 'U', o_totalprice + 1, 2 FROM orders WHERE o_orderdate >= DATE '1998-01-01'
    UNION ALL SELECT o_orderkey, 'V', o_totalprice + 2, 3 FROM orders WHERE o_orderdate >= DATE '2000-01-01'),
    merged AS (SELECT * FROM loads QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1)"""


def _loads(t):
    def rows(status, add, version):
        return t["orders"].select("o_orderkey", status.alias("o_orderstatus"), (F.col("o_totalprice") + add).alias("o_totalprice"), F.lit(version).alias("version"), "o_orderdate")

    base = rows(F.col("o_orderstatus"), 0, 1).where("o_orderdate < '1999-01-01'").drop("o_orderdate")
    first = rows(F.lit("U"), 1, 2).where("o_orderdate >= '1998-01-01'").drop("o_orderdate")
    second = rows(F.lit("V"), 2, 3).where("o_orderdate >= '2000-01-01'").drop("o_orderdate")
    return base, first, second


def _version():
    return [F.col("version").desc()]


@query(f"WITH {_LOADS} SELECT * FROM merged")
def merge_upsert(t):
    base, first, second = _loads(t)
    return loads.upsert(base, first.unionByName(second), ["o_orderkey"], _version())


@query(f"WITH {_LOADS} SELECT * FROM merged")
def upsert_store(t):
    """The same table kept as loads: three of them, then the oldest again, which changes nothing."""
    base, first, second = _loads(t)
    table = scratch_folder(t.spark)
    for number, load in ((1, base), (2, first), (3, second), (1, base)):
        append_load(load, number, table, ["o_orderkey"], ["version"], buckets=8)
    return read_current(t.spark, table, base.schema)


@query(f"""WITH {_LOADS} SELECT 0::bigint AS missing, 0::bigint AS extra, count(*) AS n_rows FROM merged""")
def rebuild_equals_upsert(t):
    base, first, second = _loads(t)
    keys = ["o_orderkey"]
    step = loads.upsert(loads.upsert(base, first, keys, _version()), second, keys, _version())
    full = loads.rebuild(base.unionByName(first).unionByName(second), keys, _version())
    # Rows counted with a sign per side: anything that does not cancel out differs.
    columns = full.columns
    both = full.withColumn("__n", F.lit(1)).unionByName(step.withColumn("__n", F.lit(-1)))
    left_over = both.groupBy(*columns).agg(F.sum("__n").alias("__d"), F.count_if(F.col("__n") == 1).alias("__full"))
    return left_over.agg(
        F.sum(F.greatest("__d", F.lit(0))).alias("missing"), F.sum(F.greatest(-F.col("__d"), F.lit(0))).alias("extra"),
        F.sum("__full").alias("n_rows"),
    )


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def load_missing_only(t):
    loaded = t["orders"].where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return loads.load_missing_only(t["customer"].select("c_custkey", "c_name"), loaded, ["c_custkey"])


@query("SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def snapshot_discover(t):
    years = [t["orders"].where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    return loads.discover(years, ["o_custkey", "o_orderpriority"])


@query(f"""
    WITH found AS (
        SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS latest FROM orders GROUP BY 1) ON o_custkey = c_custkey
        WHERE c_acctbal >= 1700 AND (latest IS NULL OR date_diff('day', cast(latest AS date), DATE '{AS_OF}') > 300))
    SELECT * FROM found
    UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey NOT IN (SELECT c_custkey FROM found)""")
def stale_targets(t):
    facts = t["orders"].select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    always = t["customer"].where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    return loads.stale_targets(
        t["customer"].select("c_custkey", "c_name", "c_acctbal"), facts, "c_custkey", "o_custkey", "day", "c_acctbal", 1700,
        F.lit(ad.AS_OF), 300, always,
    )


@query("""
    SELECT event_type, cast(to_timestamp(max(epoch(date_trunc('second', ts)))) AT TIME ZONE 'UTC' AS date) AS last_load,
        CASE WHEN date_diff('second', max(date_trunc('second', ts)), TIMESTAMP '2024-02-08') / 86400.0 > 30 THEN 'error'
            WHEN date_diff('second', max(date_trunc('second', ts)), TIMESTAMP '2024-02-08') / 86400.0 > 7 THEN 'warn' ELSE 'pass' END AS status
    FROM events GROUP BY event_type""")
def freshness(t):
    load_id = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")
    rows = t["events"].select("event_type", loads.load_time(load_id).alias("load_ts"))
    out = loads.freshness(rows, "event_type", "load_ts", F.lit("2024-02-08").cast("date"), 7, 30)
    return out.select("event_type", F.col("last_load").cast("date").alias("last_load"), "status")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, reasons FROM (
        SELECT *, concat_ws(',', CASE WHEN NOT l_quantity < 45 THEN 'quantity' END, CASE WHEN NOT l_discount <= 0.08::double THEN 'discount' END,
            CASE WHEN NOT l_returnflag IN ('A', 'N') THEN 'flag' END) AS reasons FROM lineitem)
    WHERE reasons != ''""")
def quarantine_rejects(t):
    _, rejected = loads.quarantine(t["lineitem"], {
        "quantity": F.col("l_quantity") < 45, "discount": F.col("l_discount") <= 0.08, "flag": F.col("l_returnflag").isin("A", "N"),
    })
    return rejected.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.concat_ws(",", "reject_reasons").alias("reasons"))


@query("""
    SELECT l_returnflag, count(*) AS n_rows, round(avg(CASE WHEN l_discount > 0 THEN 1.0 ELSE 0.0 END), 9) AS discounted,
        round(avg(CASE WHEN l_tax = l_discount THEN 1.0 ELSE 0.0 END), 9) AS stale
    FROM lineitem GROUP BY l_returnflag""")
def coverage_report(t):
    out = quality.coverage(t["lineitem"], ["l_returnflag"], {"discounted": F.col("l_discount") > 0, "stale": F.col("l_tax") == F.col("l_discount")})
    return out.withColumns({c: F.round(c, 9) for c in ("discounted", "stale")})


@query("SELECT l_orderkey, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def dq_unique(t):
    return quality.not_unique(t["lineitem"], "l_orderkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_combo(t):
    return quality.not_unique_combination(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query(sql(["transfers"], "SELECT transfer_id FROM transfers WHERE transfer_fee IS NULL"))
def dq_not_null(t):
    return quality.null_rows(ad.transfers(t), "transfer_fee").select("transfer_id")


@query(sql(["transfers", "clubs"], "SELECT transfer_id, from_club_id FROM transfers WHERE from_club_id IS NOT NULL AND from_club_id NOT IN (SELECT club_id FROM clubs)"))
def dq_relationships(t):
    return quality.orphans(ad.transfers(t), "from_club_id", ad.clubs(t), "club_id").select("transfer_id", "from_club_id")


@query("SELECT o_orderstatus, count(*) AS n_records FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
def dq_accepted_values(t):
    return quality.unaccepted_values(t["orders"], "o_orderstatus", ["F", "O"])


@query("""
    SELECT c_custkey AS key, c_acctbal AS amount, 'customer' AS source_model FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier WHERE s_acctbal < 0
    UNION ALL SELECT o_orderkey, o_totalprice, 'orders' FROM orders WHERE o_totalprice < 0""")
def dq_non_negative(t):
    return quality.negative_amounts([
        (t["customer"], "c_custkey", "c_acctbal", "customer"), (t["supplier"], "s_suppkey", "s_acctbal", "supplier"),
        (t["orders"], "o_orderkey", "o_totalprice", "orders"),
    ], "key", "amount")


@query(sql(["transfers", "clubs", "players", "games"], """
    SELECT 'transfers' AS "table", 'not_null' AS "check", 'player_id' AS columns, 'error' AS severity,
        count(*) FILTER (player_id IS NULL) AS failures, 'pass' AS status FROM transfers
    UNION ALL SELECT 'transfers', 'non_negative', 'transfer_fee', 'error', count(*) FILTER (transfer_fee < 0), 'pass' FROM transfers
    UNION ALL SELECT 'transfers', 'non_negative', 'market_value_in_eur', 'error', count(*) FILTER (market_value_in_eur < 0), 'pass' FROM transfers
    UNION ALL SELECT 'transfers', 'not_null', 'transfer_id', 'error', count(*) FILTER (transfer_id IS NULL), 'pass' FROM transfers
    UNION ALL SELECT 'transfers', 'unique', 'transfer_id', 'error', count(*), 'pass' FROM (SELECT transfer_id FROM transfers GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'transfers', 'relationships', 'player_id', 'error', count(*), 'pass' FROM transfers WHERE player_id NOT IN (SELECT player_id FROM players)
    UNION ALL SELECT 'transfers', 'relationships', 'from_club_id', 'warn', count(*), 'warn' FROM transfers WHERE from_club_id NOT IN (SELECT club_id FROM clubs)
    UNION ALL SELECT 'transfers', 'relationships', 'to_club_id', 'warn', count(*), 'pass' FROM transfers WHERE to_club_id NOT IN (SELECT club_id FROM clubs)
    UNION ALL SELECT 'games', 'not_null', 'game_id', 'error', count(*) FILTER (game_id IS NULL), 'pass' FROM games
    UNION ALL SELECT 'games', 'unique', 'game_id', 'error', count(*), 'pass' FROM (SELECT game_id FROM games GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'games', 'unique_combination', 'competition_id,season', 'error', count(*), 'error'
        FROM (SELECT competition_id, season FROM games GROUP BY 1, 2 HAVING count(*) > 1)"""))
def dq_report(t):
    tables = {"transfers": ad.transfers(t), "clubs": ad.clubs(t), "players": ad.players(t), "games": ad.games(t)}
    return quality.run_checks(tables, ADAPTER_CHECKS)


_SOURCES = ["customer", "documents", "events", "lineitem", "nation", "orders", "pages", "part", "region", "supplier"]


@query("SELECT unnest(" + str(_SOURCES) + ") AS source, 'pass' AS status")
def freshness_by_files(t):
    """The tables against the day of the newest of them; they were written together."""
    newest = reduce(lambda a, b: a.unionByName(b), [loads.newest_file(t.spark, f"{t.folder}/{name}.parquet") for name in _SOURCES])
    as_of = newest.agg(F.max("last_load")).first()[0]
    return loads.file_freshness(t.spark, {name: (f"{t.folder}/{name}.parquet", 7, 30) for name in _SOURCES}, F.lit(as_of)).select("source", "status")


# What the declared sets hold for the adapter tables, written out: table, check, columns, severity.
_DECLARED = """
    transfers unique transfer_id error | transfers not_null transfer_id error | transfers not_null player_id error
    transfers non_negative market_value_in_eur error | transfers non_negative transfer_fee error
    player_valuations unique player_valuation_id error | player_valuations not_null player_valuation_id error
    player_valuations not_null player_id error | player_valuations not_null market_value_in_eur error
    player_valuations non_negative market_value_in_eur error
    games unique game_id error | games not_null game_id error
    club_games not_null game_id error | club_games not_null club_id error
    appearances unique appearance_id error | appearances not_null appearance_id error | appearances not_null game_id error
    appearances not_null player_id error
    ratings not_null clubelo_club error | ratings not_null clubelo_country error | ratings not_null elo error
    ratings unique_combination clubelo_club,clubelo_country,rating_from_date error
    ratings overlapping_periods clubelo_club,clubelo_country,rating_from_date,rating_to_date error
    recent_moves not_null club_id error | recent_moves not_null player_name error | recent_moves not_null direction error
    recent_moves accepted_values direction error | recent_moves unique_combination club_id,player_name,transfer_date,direction error
    mapping unique club_id error | mapping not_null club_id error | mapping not_null clubelo_club error | mapping not_null clubelo_country error
    scope unique competition_id error | scope not_null competition_id error | scope accepted_values champion_method error
    champions not_null competition_id error | champions not_null season error | champions not_null title_type error
    champions accepted_values title_type error
    fct_match unique match_id error | fct_match not_null match_id error | fct_match not_null home_team_id error | fct_match not_null away_team_id error
    fct_match relationships home_team_id error | fct_match relationships away_team_id error
    dim_team unique team_id error | dim_team not_null team_id error"""
_ACCEPTED = {"direction": "'in', 'out'", "champion_method": "'league_table', 'cup_final'", "title_type": "'league', 'cup'"}


def _failures(table: str, check: str, columns: str) -> str:
    if check == "not_null":
        return f"SELECT count(*) FROM {table} WHERE {columns} IS NULL"
    if check == "non_negative":
        return f"SELECT count(*) FROM {table} WHERE {columns} < 0"
    if check == "accepted_values":
        return f"SELECT count(*) FROM {table} WHERE {columns} NOT IN ({_ACCEPTED[columns]})"
    if check == "relationships":
        return f"SELECT count(*) FROM {table} WHERE {columns} NOT IN (SELECT team_id FROM dim_team)"
    if check == "overlapping_periods":
        return f"""SELECT count(*) FROM (SELECT rating_from_date, max(coalesce(rating_to_date, DATE '9999-12-31')) OVER (PARTITION BY clubelo_club, clubelo_country
            ORDER BY rating_from_date, rating_to_date NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {table}) WHERE reach >= rating_from_date"""
    some = f" WHERE {columns} IS NOT NULL" if check == "unique" else ""
    return f"SELECT count(*) FROM (SELECT {columns} FROM {table}{some} GROUP BY {columns} HAVING count(*) > 1)"


def _declared_sql() -> str:
    rows = [entry.split() for line in _DECLARED.splitlines() for entry in line.split("|") if entry.strip()]
    named = {"champions": "season_champions"}
    counted = " UNION ALL ".join(
        f"""SELECT '{named.get(t, t)}' AS "table", '{c}' AS "check", '{cols}' AS columns, '{severity}' AS severity, ({_failures(t, c, cols)}) AS failures"""
        for t, c, cols, severity in rows
    )
    marts = """fct_match AS (SELECT o_orderkey AS match_id, o_custkey % 30 AS home_team_id, nullif(o_custkey % 31, 30) AS away_team_id FROM orders),
        dim_team AS (SELECT n_nationkey AS team_id FROM nation)"""
    tables = ["transfers", "player_valuations", "games", "club_games", "appearances", "ratings", "recent_moves", "mapping", "scope", "champions"]
    return sql(tables, f", {marts} SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM ({counted})")


@query(_declared_sql())
def dq_declared(t):
    """All declared checks over every adapter table, a seed, an intermediate model and two marts, in one report."""
    names = ["transfers", "player_valuations", "games", "club_games", "appearances", "ratings", "recent_moves", "mapping", "scope"]
    built = ad.domain(t, *names)
    built["season_champions"] = im.season_champions(built["scope"], built["games"], built["club_games"])
    cust = F.col("o_custkey")
    built["fct_match"] = t["orders"].select(F.col("o_orderkey").alias("match_id"), (cust % 30).alias("home_team_id"), F.nullif(cust % 31, F.lit(30)).alias("away_team_id"))
    built["dim_team"] = t["nation"].select(F.col("n_nationkey").alias("team_id"))
    return check_build(built)


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_inner(t):
    nations = t["nation"].select("n_nationkey", "n_name")
    return joins.attach(t["customer"].select("c_custkey", "c_nationkey"), nations, {"c_nationkey": "n_nationkey"}, "inner").select("c_custkey", "n_name")


@query("""
    SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def join_left_chain(t):
    out = joins.attach(t["orders"].select("o_orderkey", "o_custkey"), t["customer"].select("c_custkey", "c_name", "c_nationkey"), {"o_custkey": "c_custkey"})
    out = joins.attach(out, t["nation"], {"c_nationkey": "n_nationkey"})
    return joins.attach(out, t["region"], {"n_regionkey": "r_regionkey"}).select("o_orderkey", "c_name", "n_name", "r_name")


@query(sql(["ratings", "mapping"], """
    SELECT r_name, rating_from_date, elo FROM region JOIN mapping m ON r_regionkey = m.club_id JOIN ratings USING (clubelo_club, clubelo_country)"""))
def bridge_join(t):
    mapping = ad.mapping(t).select("club_id", "clubelo_club", "clubelo_country")
    out = joins.bridge(t["region"], mapping, ad.ratings(t), {"r_regionkey": "club_id"}, ["clubelo_club", "clubelo_country"])
    return out.select("r_name", "rating_from_date", "elo")


@query("SELECT p_partkey, shouted FROM part JOIN (SELECT DISTINCT upper(p_name) AS shouted FROM part) ON lower(p_name) = lower(shouted)")
def ci_name_join(t):
    names = t["part"].select(F.upper("p_name").alias("shouted")).distinct()
    return joins.case_insensitive(t["part"].select("p_partkey", "p_name"), names, "p_name", "shouted").select("p_partkey", "shouted")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def semi_exists(t):
    returned = t["lineitem"].where("l_returnflag = 'R'")
    return joins.keep_matching(t["orders"].select("o_orderkey"), returned, {"o_orderkey": "l_orderkey"})


_CODES = {f"NATION_{i}": f"N{i:02d}" for i in range(20)}


@query("""
    SELECT c_custkey, n_name, CASE WHEN n_nationkey < 20 THEN 'N' || lpad(cast(n_nationkey AS varchar), 2, '0') END AS code
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def code_map_join(t):
    rows = joins.attach(t["customer"].select("c_custkey", "c_nationkey"), t["nation"].select("n_nationkey", "n_name"), {"c_nationkey": "n_nationkey"}, "inner")
    return matching.with_code(rows.select("c_custkey", "n_name"), "n_name", _CODES, "code")


@query("""
    SELECT p_partkey, CASE p_name WHEN 'small ring' THEN 'ring, small' WHEN 'red widget' THEN 'widget, red' ELSE p_brand END AS matched FROM part""")
def override_match(t):
    overrides = {"small ring": "ring, small", "red widget": "widget, red"}
    return t["part"].select("p_partkey", matching.override(F.col("p_brand"), F.col("p_name"), overrides).alias("matched"))
