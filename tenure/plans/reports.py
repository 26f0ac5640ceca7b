"""Page reports over the marts. Parameters are literals; '%' means no filter.

Every limit has a unique order. Filters and limits act on the fact; the display columns of the
dimensions are joined to the few rows that are left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.functions.measures import contains_ci, like, like_or_null, season_start_year, share
from tenure.operators.joins import attach, in_roles, keep_matching
from tenure.operators.ranking import spectrum, topk
from tenure.operators.stats import exact_median

MIN_FEE = 1_000_000


def in_scope(fct: DataFrame, dim_club: DataFrame, season: str, club: str) -> DataFrame:
    """Season and acquiring-club filter; an unknown club counts as an empty name."""
    out = fct.where(like(F.col("transfer_season"), season))
    if club == "%":
        return out
    names = dim_club.select("club_id", F.col("club_name").alias("__club"))
    return attach(out, names, {"to_club_id": "club_id"}).where(like_or_null(F.col("__club"), club)).drop("__club")


def _known_players(fct: DataFrame, dim_player: DataFrame) -> DataFrame:
    """Facts whose player exists (the inner join of the page, before its limit)."""
    return keep_matching(fct, dim_player, ["player_id"])


def _with_player(df: DataFrame, dim_player: DataFrame) -> DataFrame:
    return attach(df, dim_player.select("player_id", "player_name", "image_url"), ["player_id"])


def _with_club(df: DataFrame, dim_club: DataFrame, name: str, key: str = "to_club_id", crest: str = "crest_url") -> DataFrame:
    return attach(df, dim_club.select("club_id", F.col("club_name").alias(name), F.col("crest_url").alias(crest)), {key: "club_id"})


def seasons(fct: DataFrame) -> DataFrame:
    """Distinct seasons, newest first."""
    found = fct.select("transfer_season").distinct()
    return found.withColumn("season_start_year", season_start_year(F.col("transfer_season"))).orderBy(
        F.col("season_start_year").desc_nulls_last(), F.col("transfer_season").asc_nulls_last()
    )


def acquiring_clubs(fct: DataFrame, dim_club: DataFrame) -> DataFrame:
    """Distinct names of clubs that acquired someone."""
    named = keep_matching(dim_club, fct.select("to_club_id").distinct(), {"club_id": "to_club_id"})
    return named.select("club_name").distinct().orderBy(F.col("club_name").asc_nulls_last())


def kpi_summary(fct: DataFrame, dim_club: DataFrame, season: str = "%", club: str = "%") -> DataFrame:
    """Number of transfers with a ratio, mean ratio without stale valuations, stale share, median cost.

    A valuation equal to the one at the transfer was never refreshed; such rows force the ratio to
    -100 % and stay out of the mean.
    """
    rows = in_scope(fct.where(F.col("roi_financier").isNotNull()), dim_club, season, club)
    stale = F.col("market_value_at_spell_end") == F.col("market_value_at_transfer")
    figures = rows.agg(
        F.count(F.lit(1)).alias("transfers_analyzed"),
        F.avg(F.when(~stale, F.col("roi_financier"))).alias("avg_roi_financier"),
        share(stale, 0).alias("pct_stale_valuation"),
    )
    median = exact_median(rows, "cost_per_goal_contribution", "median_cost_per_goal")
    # Two one-row results side by side.
    return figures.unionByName(median, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("transfers_analyzed", "avg_roi_financier", "pct_stale_valuation", "median_cost_per_goal")]
    )


def hero_players(fct: DataFrame, dim_player: DataFrame, dim_club: DataFrame, season: str = "%", club: str = "%", k: int = 6) -> DataFrame:
    """The k best ratios among transfers with a real fee."""
    rows = in_scope(fct.where(F.col("roi_financier").isNotNull() & (F.col("transfer_fee") >= MIN_FEE)), dim_club, season, club)
    order = [F.col("roi_financier").desc(), F.col("transfer_id").asc()]
    best = topk(_known_players(rows, dim_player).select("transfer_id", "player_id", "to_club_id", "roi_financier"), order, k)
    return _with_club(_with_player(best, dim_player), dim_club, "to_club").orderBy(*order).select(
        "player_name", "image_url", "to_club", "crest_url", "roi_financier"
    )


def _transfer_spectrum(fct: DataFrame, dim_player: DataFrame, dim_club: DataFrame, by: str, labels: tuple[str, str], label: str,
                       season: str, club: str, k: int, keep: Sequence[str]) -> DataFrame:
    rows = in_scope(fct.where(F.col(by).isNotNull() & (F.col("transfer_fee") >= MIN_FEE)), dim_club, season, club)
    ends = spectrum(
        _known_players(rows, dim_player).select("transfer_id", "player_id", "from_club_id", "to_club_id", *keep),
        by, k, ["transfer_id"], labels, label,
    )
    return _with_club(_with_player(ends, dim_player), dim_club, "to_club")


def roi_spectrum(fct: DataFrame, dim_player: DataFrame, dim_club: DataFrame, season: str = "%", club: str = "%", k: int = 6) -> DataFrame:
    """The k biggest gains and the k biggest losses relative to the fee."""
    keep = ["transfer_date", "transfer_fee", "market_value_at_transfer", "market_value_at_spell_end",
            "market_value_at_spell_end_date", "roi_financier", "goals_during_spell", "assists_during_spell"]
    out = _transfer_spectrum(fct, dim_player, dim_club, "roi_financier", ("Gained value", "Lost value"), "roi_direction", season, club, k, keep)
    return out.orderBy(F.col("roi_financier").desc(), "transfer_id").select(
        "player_name", "image_url", "transfer_date", "to_club", "crest_url", *keep[1:], "roi_direction"
    )


def elo_spectrum(fct: DataFrame, dim_player: DataFrame, dim_club: DataFrame, season: str = "%", club: str = "%", k: int = 6) -> DataFrame:
    """The k biggest steps up and the k biggest steps down by club rating."""
    out = _transfer_spectrum(fct, dim_player, dim_club, "club_elo_delta", ("Stepped up", "Stepped down"), "elo_direction",
                             season, club, k, ["transfer_date", "club_elo_delta"])
    out = in_roles(out, dim_club, "club_id", {"from": "from_club_id"}, {"club_name": "club"})
    return out.orderBy(F.col("club_elo_delta").desc(), "transfer_id").select(
        "player_name", "image_url", "transfer_date", "from_club", "to_club", "crest_url", "club_elo_delta", "elo_direction"
    )


def _ranked_transfers(rows: DataFrame, dim_player: DataFrame, dim_club: DataFrame, order: list[Column], k: int, keep: Sequence[str]) -> DataFrame:
    best = topk(_known_players(rows, dim_player).select("transfer_id", "player_id", "to_club_id", *keep), order, k)
    return _with_club(_with_player(best, dim_player), dim_club, "to_club").orderBy(*order).select(
        "player_name", "image_url", "transfer_date", "to_club", "crest_url", *keep[1:]
    )


def cost_efficiency(fct: DataFrame, dim_player: DataFrame, dim_club: DataFrame, season: str = "%", club: str = "%", k: int = 12) -> DataFrame:
    """The k lowest costs per goal or assist among transfers with a real fee."""
    rows = in_scope(fct.where(F.col("cost_per_goal_contribution").isNotNull() & (F.col("transfer_fee") >= MIN_FEE)), dim_club, season, club)
    order = [F.col("cost_per_goal_contribution").asc(), F.col("transfer_id").asc()]
    return _ranked_transfers(rows, dim_player, dim_club, order, k, [
        "transfer_date", "transfer_fee", "goals_during_spell", "assists_during_spell", "cost_per_goal_contribution"])


def best_free_transfers(fct: DataFrame, dim_player: DataFrame, dim_club: DataFrame, season: str = "%", club: str = "%", k: int = 12) -> DataFrame:
    """The k biggest value gains among transfers recorded at fee 0."""
    rows = in_scope(fct.where((F.col("transfer_fee") == 0) & F.col("value_gained_absolute").isNotNull()), dim_club, season, club)
    order = [F.col("value_gained_absolute").desc(), F.col("transfer_id").asc()]
    return _ranked_transfers(rows, dim_player, dim_club, order, k, [
        "transfer_date", "market_value_at_transfer", "market_value_at_spell_end", "market_value_at_spell_end_date",
        "value_gained_absolute", "goals_during_spell", "assists_during_spell"])


def player_list(fct: DataFrame, recent: DataFrame, dim_player: DataFrame) -> DataFrame:
    """Names of players with a transfer or a priced departure."""
    moved = keep_matching(dim_player, fct.select("player_id").distinct(), ["player_id"]).select("player_name")
    left = recent.where((F.col("direction") == "out") & F.col("value_gained_during_tenure").isNotNull()).select("player_name")
    return moved.unionByName(left).distinct().orderBy(F.col("player_name").asc_nulls_last())


def player_profile(dim_player: DataFrame, player: str) -> DataFrame:
    """The most valuable player of that name."""
    order = [F.col("current_market_value_in_eur").desc_nulls_last(), F.col("player_id").asc()]
    return topk(dim_player.where(F.col("player_name") == player), order, 1).select(
        "player_name", "image_url", "position", "country_of_citizenship", "current_club_name", "current_market_value_in_eur"
    )


def player_transfers(fct: DataFrame, dim_player: DataFrame, dim_club: DataFrame, player: str) -> DataFrame:
    """All transfers of the players of that name, newest first, with both clubs."""
    mine = keep_matching(fct, dim_player.where(F.col("player_name") == player), ["player_id"])
    out = in_roles(mine, dim_club, "club_id", {"from": "from_club_id", "to": "to_club_id"}, {"club_name": "club", "crest_url": "crest"})
    return out.orderBy(F.col("transfer_date").desc_nulls_last(), F.col("transfer_id").asc()).select(
        "from_club", "from_crest", "to_club", "to_crest", "transfer_date", "transfer_fee", "market_value_at_transfer",
        "market_value_at_spell_end", "market_value_at_spell_end_date", "roi_financier", "value_gained_absolute",
        "goals_during_spell", "assists_during_spell",
    )


def player_recent_moves(recent: DataFrame, dim_club: DataFrame, player: str) -> DataFrame:
    """All page moves under that name, newest first."""
    mine = recent.where(F.col("player_name") == player)
    out = attach(mine, dim_club.select("club_id", "crest_url"), ["club_id"])
    return out.orderBy(F.col("transfer_date").desc_nulls_last(), "club_id", "direction").select(
        "club_name", "crest_url", "other_club_name", "direction", "transfer_date", "fee_amount", "value_at_arrival",
        "value_at_departure", "value_gained_during_tenure", "fee_vs_last_valuation",
    )


def recent_clubs(fct: DataFrame, recent: DataFrame, dim_club: DataFrame) -> DataFrame:
    """Names of clubs with a transfer in or a page move."""
    ids = fct.select(F.col("to_club_id").alias("club_id")).union(recent.select("club_id")).distinct()
    return keep_matching(dim_club, ids, ["club_id"]).select("club_name").distinct().orderBy(F.col("club_name").asc_nulls_last())


def _season_pick(fct: DataFrame, back: int) -> DataFrame:
    found = fct.select("transfer_season").distinct().withColumn("season_start_year", season_start_year(F.col("transfer_season")))
    return topk(found, [F.col("season_start_year").desc_nulls_last(), F.col("transfer_season").asc()], 1, back)


def current_window_season(fct: DataFrame) -> DataFrame:
    """The newest season."""
    return _season_pick(fct, 0)


def current_window_counts(fct: DataFrame, dim_club: DataFrame) -> DataFrame:
    """Transfers of the newest season: all, with a known acquiring club, with a fee."""
    rows = fct.where(F.col("transfer_season") == current_window_season(fct).select("transfer_season").scalar())
    known = attach(rows, dim_club.select("club_id", F.lit(1).alias("__known")), {"to_club_id": "club_id"})
    return known.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("__known").alias("with_known_club"),
        F.sum(F.when(F.col("transfer_fee") > 0, 1).otherwise(0)).alias("fee_confirmed"),
    )


def prior_season_fee_rate(fct: DataFrame) -> DataFrame:
    """Share of the second-newest season's transfers that carry a fee, in percent."""
    rows = fct.where(F.col("transfer_season") == _season_pick(fct, 1).select("transfer_season").scalar())
    return rows.agg(share(F.col("transfer_fee") > 0, 1).alias("pct_fee_confirmed"))


def current_window(fct: DataFrame, dim_player: DataFrame, dim_club: DataFrame, club: str = "%", k: int = 20) -> DataFrame:
    """The newest k transfers of the newest season with a known club and player."""
    rows = fct.where(F.col("transfer_season") == current_window_season(fct).select("transfer_season").scalar())
    named = dim_club if club == "%" else dim_club.where(like_or_null(F.col("club_name"), club))
    rows = _known_players(keep_matching(rows, named, {"to_club_id": "club_id"}), dim_player)
    order = [F.col("transfer_date").desc_nulls_last(), F.col("transfer_id").asc()]
    newest = topk(rows.select("transfer_id", "player_id", "to_club_id", "transfer_date"), order, k)
    faces = dim_player.select("player_id", "player_name", "image_url", "current_market_value_in_eur")
    return _with_club(attach(newest, faces, ["player_id"]), dim_club, "to_club").orderBy(*order).select(
        "player_name", "image_url", "to_club", "crest_url", "current_market_value_in_eur", "transfer_date"
    )


MOVE_ORDER = ["club_id", "player_name", "direction"]


def recent_arrivals(recent: DataFrame, dim_club: DataFrame, club: str = "%", k: int = 30) -> DataFrame:
    """The newest k arrivals."""
    rows = recent.where((F.col("direction") == "in") & like_or_null(F.col("club_name"), club))
    order = [F.col("transfer_date").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in MOVE_ORDER]]
    newest = topk(rows, order, k)
    return attach(newest, dim_club.select("club_id", "crest_url"), ["club_id"]).orderBy(*order).select(
        "club_name", "crest_url", "player_image_url", "player_name", F.col("other_club_name").alias("from_club"),
        "transfer_date", "transfer_type", "fee_amount", "fee_currency",
    )


def departure_example(recent: DataFrame, name_part: str) -> DataFrame:
    """The newest departure of a player whose name contains the text."""
    rows = recent.where((F.col("direction") == "out") & contains_ci(F.col("player_name"), name_part))
    order = [F.col("transfer_date").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in MOVE_ORDER]]
    return topk(rows, order, 1).select(
        F.col("club_name").alias("from_club"), F.col("other_club_name").alias("to_club"), "fee_amount", "value_at_arrival",
        "value_at_departure", "value_gained_during_tenure", "fee_vs_last_valuation",
    )


def departures_spectrum(recent: DataFrame, dim_club: DataFrame, club: str = "%", k: int = 6) -> DataFrame:
    """The k departures with the biggest gain and the k with the biggest loss in value at the club."""
    rows = recent.where((F.col("direction") == "out") & like_or_null(F.col("club_name"), club))
    ends = spectrum(rows, "value_gained_during_tenure", k, [*MOVE_ORDER, "transfer_date"], ("Gained value", "Lost value"), "roi_direction")
    return attach(ends, dim_club.select("club_id", "crest_url"), ["club_id"]).orderBy(
        F.col("value_gained_during_tenure").desc(), *MOVE_ORDER, "transfer_date"
    ).select(
        "player_name", "player_image_url", "transfer_date", F.col("club_name").alias("sold_by"), "crest_url",
        F.col("other_club_name").alias("sold_to"), "value_at_arrival", "value_at_arrival_date", "value_at_departure",
        "value_at_departure_date", "value_gained_during_tenure", "fee_amount", "fee_vs_last_valuation", "roi_direction",
    )
