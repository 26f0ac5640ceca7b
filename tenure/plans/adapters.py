"""Domain-shaped staged tables over a sales star schema (orders, lineitem, customer, region).

Lets every model run on those tables: an order is a transfer of its customer, a line item is both
an appearance and a valuation, a region is a club and an order priority is a competition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.session import shared
from tenure.sources.staging import stage_recent_moves

AS_OF = dt.date(2001, 12, 31)
SCOPE = [("1-URGENT", "league_table"), ("2-HIGH", "league_table"), ("3-MEDIUM", "cup_final"), ("4-NOT SPECIFIED", "cup_final")]


class Tables:
    """The Parquet tables of one folder, opened on demand."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self.opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]


def _club(key: Column) -> Column:
    return F.concat(F.lit("Club "), key.cast("string"))


def _two_digits(year: Column) -> Column:
    return F.lpad((year % 100).cast("string"), 2, "0")


def short_season(day: Column) -> Column:
    """Calendar-year season label '98/99'."""
    return F.concat(_two_digits(F.year(day)), F.lit("/"), _two_digits(F.year(day) + 1))


def _fee() -> Column:
    key = F.col("o_orderkey")
    return F.when(key % 11 == 0, None).when(key % 4 == 0, 0.0).otherwise(F.col("o_totalprice"))


def transfers(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t["orders"].select(
        F.col("o_orderkey").cast("string").alias("transfer_id"), F.col("o_custkey").alias("player_id"),
        day.alias("transfer_date"), short_season(day).alias("transfer_season"),
        (F.col("o_orderkey") % 7).alias("from_club_id"), (F.col("o_orderkey") % 5).alias("to_club_id"),
        _fee().alias("transfer_fee"), (F.col("o_totalprice") * 0.8).alias("market_value_in_eur"),
    )


_OWNED = "__owned_lines"


def _owned(t: Tables) -> DataFrame:
    """Line items with the customer of their order."""
    owners = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("player_id"))
    return t["lineitem"].join(owners, "l_orderkey", "inner").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "player_id", "l_shipdate", "l_quantity", "l_extendedprice", "l_returnflag"
    )


def share_lines(t: Tables, scratch: str) -> None:
    """Join the line items to their owners once, for all tables of `t` that are made of them."""
    t.opened[_OWNED] = shared(_owned(t), scratch)


def _lines(t: Tables) -> DataFrame:
    owned = t.opened[_OWNED] if _OWNED in t.opened else _owned(t)
    return owned.withColumn("line_id", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


def appearances(t: Tables) -> DataFrame:
    return _lines(t).select(
        F.col("line_id").alias("appearance_id"), F.col("l_orderkey").alias("game_id"), "player_id",
        (F.col("l_suppkey") % 5).alias("player_club_id"), F.col("l_shipdate").cast("date").alias("appearance_date"),
        (F.col("l_quantity").cast("int") % 3).alias("goals"), (F.col("l_quantity").cast("int") % 2).alias("assists"),
        F.col("l_quantity").cast("int").alias("minutes_played"), (F.col("l_linenumber") % 2).alias("yellow_cards"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("red_cards"),
    )


def player_valuations(t: Tables) -> DataFrame:
    return _lines(t).select(
        F.col("line_id").alias("player_valuation_id"), "player_id", F.col("l_shipdate").cast("date").alias("valuation_date"),
        F.col("l_extendedprice").alias("market_value_in_eur"), _club(F.col("l_suppkey") % 5).alias("current_club_name"),
    )


def games(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t["orders"].select(
        F.col("o_orderkey").alias("game_id"), F.col("o_orderpriority").alias("competition_id"), F.year(day).alias("season"),
        F.when(F.col("o_orderstatus") == "F", "Final").otherwise(F.concat(F.month(day).cast("string"), F.lit(". Matchday"))).alias("round"),
        day.alias("game_date"),
    )


def club_games(t: Tables) -> DataFrame:
    """Two rows per game: the home side, and the away side with the opposite result."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    sides = F.array(*[
        F.struct(
            ((key + away) % 5).alias("club_id"), (1 + (cust + away) % 3).cast("int").alias("own_position"),
            ((cust + away) % 2 == 0).alias("is_win"),
        )
        for away in (0, 1)
    ])
    return t["orders"].select(key.alias("game_id"), F.inline(sides))


def scope(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(SCOPE, "competition_id string, champion_method string")


def mapping(t: Tables) -> DataFrame:
    return t["region"].select(
        F.col("r_regionkey").alias("club_id"), _club(F.col("r_regionkey")).alias("club_name"), F.col("r_name").alias("clubelo_club"),
        F.concat(F.lit("R"), (F.col("r_regionkey") % 2).cast("string")).alias("clubelo_country"),
    )


def ratings(t: Tables) -> DataFrame:
    """Per club and quarter a 60-day rating period from the first order of the quarter, with gaps."""
    day = F.col("o_orderdate").cast("date")
    quarters = t["orders"].groupBy(
        (F.col("o_orderkey") % 5).cast("int").alias("club_id"), F.trunc(day, "quarter").alias("quarter")
    ).agg(F.min(day).alias("rating_from_date"), (1500 + F.count(F.lit(1))).cast("double").alias("elo"))
    named = mapping(t).select("club_id", "clubelo_club", "clubelo_country")
    return quarters.join(named, "club_id", "inner").select(
        "clubelo_club", "clubelo_country", "elo", "rating_from_date", F.date_add("rating_from_date", 60).alias("rating_to_date")
    )


def players(t: Tables) -> DataFrame:
    """Customers under a hundred shared names."""
    key = F.col("c_custkey")
    return t["customer"].select(
        key.alias("player_id"), F.concat(F.lit("Player "), (key % 100).cast("string")).alias("player_name"),
        F.concat(F.lit("https://img.example.com/"), key.cast("string")).alias("image_url"),
        F.col("c_mktsegment").alias("position"), F.col("c_nationkey").cast("string").alias("country_of_citizenship"),
        _club(key % 5).alias("current_club_name"), F.col("c_acctbal").alias("current_market_value_in_eur"),
    )


def clubs(t: Tables) -> DataFrame:
    return t["region"].select(F.col("r_regionkey").cast("long").alias("club_id"), _club(F.col("r_regionkey")).alias("club_name"))


def clubs_with_crest(t: Tables) -> DataFrame:
    return clubs(t).withColumn("crest_url", F.concat(F.lit("https://crest.example.com/"), F.col("club_id").cast("string")))


def raw_recent_moves(t: Tables) -> DataFrame:
    """Page rows with footnote markers, text dates (some missing) and fee texts."""
    key, cust, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date")
    sign = F.when(key % 3 == 0, "€").when(key % 3 == 1, "£").otherwise("$")
    return t["orders"].select(
        (key % 5).alias("club_id"), _club(key % 5).alias("club_name"), short_season(day).alias("season"),
        F.when(key % 2 == 0, "in").otherwise("out").alias("direction"),
        F.when(key % 13 == 0, "").otherwise(F.concat(F.date_format(day, "d MMMM yyyy"), F.when(key % 4 == 0, "[c]").otherwise(""))).alias("date"),
        F.concat(F.lit("PLAYER "), (cust % 100).cast("string"), F.when(key % 6 == 0, "[a]").otherwise("")).alias("player_name"),
        F.concat(F.lit("Player_"), (cust % 100).cast("string")).alias("player_wiki_title"),
        F.concat(_club(key % 7), F.lit("[b]")).alias("other_club_name"),
        F.when(key % 9 == 0, "").when(key % 10 == 0, None).otherwise("Transfer").alias("transfer_type"),
        F.when(key % 8 != 0, F.concat(sign, (key % 90).cast("string"), F.lit(".5 million"))).alias("fee_text"),
        F.concat(F.lit("Page "), key.cast("string")).alias("source_page"),
    )


def recent_moves(t: Tables) -> DataFrame:
    return stage_recent_moves(raw_recent_moves(t))


_STAGED = {
    "transfers": transfers, "appearances": appearances, "games": games, "club_games": club_games,
    "player_valuations": player_valuations, "scope": scope, "mapping": mapping, "ratings": ratings,
    "players": players, "recent_moves": recent_moves,
}


def domain(t: Tables, *names: str) -> dict[str, DataFrame]:
    """The named staged tables, or all that the fact marts need."""
    return {name: _STAGED[name](t) for name in names or _STAGED}


def transfer_mart(t: Tables) -> DataFrame:
    """A table with the columns of the transfer mart that the reports read, straight from orders."""
    key, price, day = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate").cast("date")
    base = t["orders"].select(
        key.cast("string").alias("transfer_id"), F.col("o_custkey").alias("player_id"),
        (key % 7).alias("from_club_id"), (key % 5 + key % 2).alias("to_club_id"), day.alias("transfer_date"),
        F.when(key % 17 != 0, short_season(day)).alias("transfer_season"), (_fee() * 10).alias("transfer_fee"),
        (price * 2).alias("market_value_at_transfer"), (price * (2 + key % 5)).alias("market_value_at_spell_end"),
        F.date_add(day, 100).alias("market_value_at_spell_end_date"),
        (key % 4).alias("goals_during_spell"), (key % 3).alias("assists_during_spell"),
        F.when(key % 19 != 0, (key % 601 - 300).cast("double")).alias("club_elo_delta"),
    )
    gained = F.col("market_value_at_spell_end") - F.col("market_value_at_transfer") - F.col("transfer_fee")
    contributions = F.col("goals_during_spell") + F.col("assists_during_spell")
    return base.withColumns({
        "roi_financier": gained / F.nullif("transfer_fee", F.lit(0)),
        "value_gained_absolute": gained,
        "cost_per_goal_contribution": F.col("transfer_fee") / F.nullif(contributions, F.lit(0)),
    })


def recent_mart(t: Tables) -> DataFrame:
    """A table with the columns of the recent-moves mart, straight from orders (one row per order)."""
    key, price, day = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate").cast("date")
    leaving = key % 2 == 1
    return t["orders"].select(
        (key % 7).alias("club_id"), _club(key % 7).alias("club_name"),
        F.when(leaving, "out").otherwise("in").alias("direction"), F.when(key % 13 != 0, day).alias("transfer_date"),
        F.concat(F.lit("Mover "), key.cast("string")).alias("player_name"),
        F.concat(F.lit("https://img.example.com/"), key.cast("string")).alias("player_image_url"),
        _club(key % 4).alias("other_club_name"), F.lit("Transfer").alias("transfer_type"),
        F.when(key % 8 != 0, price).alias("fee_amount"), F.lit("EUR").alias("fee_currency"),
        F.when(key % 6 != 0, price * 0.5).alias("value_at_arrival"), F.date_sub(day, 400).alias("value_at_arrival_date"),
        F.when(key % 6 != 0, F.lit(200000.0)).alias("value_at_departure"), F.date_sub(day, 10).alias("value_at_departure_date"),
        F.when(leaving & (key % 6 != 0), 200000.0 - price * 0.5).alias("value_gained_during_tenure"),
        F.when(leaving & (key % 6 != 0) & (key % 8 != 0), price - 200000.0).alias("fee_vs_last_valuation"),
    )
