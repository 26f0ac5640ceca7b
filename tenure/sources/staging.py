"""Staging: one declarative projection per source table (rename and strict cast, no joins).

Each entry lists the output columns in order as `name`, `name=source` or `name:type=source`.
Columns without a type keep the type given after '::'.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tenure.functions.text import (
    fee_amount,
    fee_currency,
    parse_text_date,
    strip_markers,
    surrogate_key,
)
from tenure.operators.ranking import dedup_most_complete
from tenure.sources.published import open_table, replace


@dataclass(frozen=True)
class Item:
    name: str
    type: str
    source: str


def parse_spec(text: str) -> list[Item]:
    """'a:long b:date=c' -> [Item(a, long, a), Item(b, date, c)]; the default type is string."""
    items = []
    for word in text.split():
        left, _, source = word.partition("=")
        name, _, kind = left.partition(":")
        items.append(Item(name, kind or "string", source or name))
    return items


# CSV tables. Key columns are those the loader merges on.
MARKET = {
    "appearances": """
        appearance_id game_id:long player_id:long player_name player_club_id:long
        player_current_club_id:long competition_id appearance_date:date=date goals:int assists:int
        minutes_played:int yellow_cards:int red_cards:int""",
    "club_games": """
        game_id:long club_id:long own_goals:int own_position:int own_manager_name opponent_id:long
        opponent_goals:int opponent_position:int opponent_manager_name hosting is_win:boolean""",
    "clubs": """
        club_id:long club_code club_name=name domestic_competition_id coach_name squad_size:int
        average_age:double foreigners_number:int foreigners_percentage:double
        national_team_players:int stadium_name stadium_seats:int net_transfer_record
        last_season:int url""",
    "competitions": """
        competition_id competition_code competition_name=name competition_type=type
        competition_sub_type=sub_type country_id:long country_name domestic_league_code
        confederation total_clubs:int url""",
    "countries": """
        country_id:long country_name country_code confederation total_clubs:int total_players:int
        average_age:double url""",
    "game_events": """
        game_event_id game_id:long event_date:date=date minute:int event_type=type club_id:long
        club_name player_id:long player_assist_id:int player_in_id:int description""",
    "game_lineups": """
        game_lineups_id game_id:long game_date:date=date club_id:long player_id:long player_name
        lineup_type=type position shirt_number=number team_captain:boolean""",
    "games": """
        game_id:long competition_id competition_type season:int round game_date:date=date
        home_club_id:long home_club_name home_club_manager_name home_club_formation
        home_club_goals:int home_club_position:int
        away_club_id:long away_club_name away_club_manager_name away_club_formation
        away_club_goals:int away_club_position:int
        aggregate stadium attendance:int referee url""",
    "national_teams": """
        national_team_id:long national_team_name=name team_code country_id:long country_name
        country_code confederation team_image_url squad_size:int average_age:double
        foreigners_number:int foreigners_percentage:double total_market_value:double
        fifa_ranking:int last_season:int url""",
    "player_valuations": """
        player_id:long valuation_date:date=date market_value_in_eur:double current_club_id:long
        current_club_name player_club_domestic_competition_id""",
    "players": """
        player_id:long player_code first_name last_name player_name=name date_of_birth:date
        country_of_birth city_of_birth country_of_citizenship position sub_position foot
        height_in_cm:double agent_name current_club_id:long current_club_name
        current_club_domestic_competition_id current_national_team_id:long international_caps:int
        international_goals:int last_season:int contract_expiration_date:date
        market_value_in_eur:double highest_market_value_in_eur:double image_url url""",
    "transfers": """
        player_id:long player_name transfer_date:date transfer_season from_club_id:long
        from_club_name to_club_id:long to_club_name transfer_fee:double market_value_in_eur:double""",
}

# Hash keys of the tables that have no key column of their own: output name and source columns.
HASH_KEYS = {
    "club_games": ("club_game_id", ["club_id", "game_id"]),
    "player_valuations": ("player_valuation_id", ["player_id", "date"]),
    "transfers": ("transfer_id", ["player_id", "transfer_date", "from_club_id", "to_club_id"]),
}

# Natural keys the loader merges on.
PRIMARY_KEYS = {
    "competitions": ["competition_id"],
    "countries": ["country_id"],
    "national_teams": ["national_team_id"],
    "clubs": ["club_id"],
    "players": ["player_id"],
    "games": ["game_id"],
    "club_games": ["club_id", "game_id"],
    "appearances": ["appearance_id"],
    "game_events": ["game_event_id"],
    "game_lineups": ["game_lineups_id"],
    "player_valuations": ["player_id", "date"],
    "transfers": ["player_id", "transfer_date", "from_club_id", "to_club_id"],
}

# API tables, after flattening nested objects to a__b.
RESULTS = {
    "competitions": """
        competition_id:long=id competition_name=name competition_code=code competition_type=type plan
        number_of_available_seasons:int area_id:long=area__id area_name=area__name
        area_code=area__code current_season_id:long=current_season__id
        current_season_start_date:date=current_season__start_date
        current_season_end_date:date=current_season__end_date
        current_season_matchday:int=current_season__current_matchday""",
    "matches": """
        match_id:long=id match_utc_timestamp:timestamp=utc_date match_status=status matchday:int stage
        competition_id:long=competition__id competition_name=competition__name
        competition_code=competition__code season_id:long=season__id
        season_start_date:date=season__start_date season_end_date:date=season__end_date
        home_team_id:long=home_team__id home_team_name=home_team__name
        away_team_id:long=away_team__id away_team_name=away_team__name winner=score__winner
        half_time_home_goals:int=score__half_time__home half_time_away_goals:int=score__half_time__away
        full_time_home_goals:int=score__full_time__home full_time_away_goals:int=score__full_time__away
        extra_time_home_goals:int=score__extra_time__home extra_time_away_goals:int=score__extra_time__away
        penalties_home_goals:int=score__penalties__home penalties_away_goals:int=score__penalties__away""",
    "teams": """
        team_id:long=id team_name=name team_short_name=short_name team_code=tla address website
        founded_year:int=founded club_colors stadium_name=venue area_id:long=area__id
        area_name=area__name coach_id:long=coach__id coach_name=coach__name
        coach_nationality=coach__nationality coach_contract_start:date=coach__contract__start
        coach_contract_until:date=coach__contract__until""",
}

RATINGS = {
    "ratings": """
        clubelo_club=club clubelo_country=country division_level:int=level elo:double
        rating_from_date:date=from_date rating_to_date:date=to_date""",
}


def strict_cast(df: DataFrame, column: str, kind: str) -> Column:
    """ANSI cast: a value that does not fit fails the job. Whole numbers may be written '3.0', never '3.7'."""
    c = F.col(column)
    if kind in ("int", "long") and isinstance(df.schema[column].dataType, StringType):
        # Anything but zeros behind the point stays in the text, on which the cast fails.
        return F.regexp_replace(F.trim(c), r"(?<=[0-9])\.0*$", "").cast(kind)
    return c.cast(kind)


def reject_reason(df: DataFrame, item: Item) -> Column:
    """Why a cell does not fit its column; NULL if it fits or is NULL."""
    c = F.col(item.source)
    text = F.trim(c.cast("string"))
    if item.type in ("int", "long") and isinstance(df.schema[item.source].dataType, StringType):
        fits = F.regexp_replace(F.trim(c), r"(?<=[0-9])\.0*$", "").try_cast(item.type).isNotNull()
        reason = F.when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), "out of range").otherwise("not a whole number")
    else:
        fits = c.try_cast(item.type).isNotNull()
        reason = F.lit({"double": "not a number", "boolean": "not a boolean", "date": "not a date", "timestamp": "not a timestamp"}.get(item.type, f"not of type {item.type}"))
    return F.when(c.isNotNull() & ~fits, reason)


def project_split(df: DataFrame, spec: list[Item], keys: dict[str, Column] | None = None) -> DataFrame:
    """Rename and cast by spec in one pass; a cell that does not fit is NULL and listed in `rejects` as (column, text, reason).

    Rows with an empty list are the good ones. Written once with `write_split`, good and rejected rows are apart without
    another scan. `project` is the strict form, which fails the job instead.
    """
    marks = [
        F.when(reject_reason(df, i).isNotNull(), F.struct(F.lit(i.name).alias("column"), F.col(i.source).cast("string").alias("text"), reject_reason(df, i).alias("reason")))
        for i in spec if i.type != "string"
    ]
    rejects = F.filter(F.array(*marks), lambda m: m.isNotNull()) if marks else F.array().cast("array<struct<column:string,text:string,reason:string>>")
    # What does not fit is taken out before the strict cast, so both forms read a cell alike.
    safe = df.withColumns({f"__cell{n}": F.when(reject_reason(df, i).isNull(), F.col(i.source)) for n, i in enumerate(spec)})
    return safe.select(
        *[k.alias(n) for n, k in (keys or {}).items()],
        *[strict_cast(safe, f"__cell{n}", i.type).alias(i.name) for n, i in enumerate(spec)], rejects.alias("rejects"),
    )


def stage_market_split(table: str, raw: DataFrame) -> DataFrame:
    """`stage_market` that lists bad cells in `rejects` instead of failing."""
    keys = {}
    if table in HASH_KEYS:
        name, sources = HASH_KEYS[table]
        keys[name] = surrogate_key(*[F.col(c) for c in sources])
    return project_split(raw, parse_spec(MARKET[table]), keys)


def write_split(split: DataFrame, root: str) -> None:
    """Publish a staged table with its rejects, good and rejected rows in folders of their own, by one write."""
    replace(split.withColumn("rejected", F.size("rejects") > 0), root, ["rejected"])


def good_rows(spark: SparkSession, root: str) -> DataFrame:
    return open_table(spark, root).where("rejected = 'false'").drop("rejected", "rejects")


def rejected_cells(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """keys..., column, text and reason of each bad cell."""
    return open_table(spark, root).where("rejected = 'true'").select(*keys, F.inline("rejects"))


def project(df: DataFrame, spec: list[Item]) -> DataFrame:
    """Rename and cast by spec."""
    return df.select(*[strict_cast(df, i.source, i.type).alias(i.name) for i in spec])


def stage_market(table: str, raw: DataFrame) -> DataFrame:
    """One of the twelve CSV tables, with its hash key in front where it has one."""
    spec = parse_spec(MARKET[table])
    if table not in HASH_KEYS:
        return project(raw, spec)
    name, sources = HASH_KEYS[table]
    columns = [strict_cast(raw, i.source, i.type).alias(i.name) for i in spec]
    return raw.select(surrogate_key(*[F.col(c) for c in sources]).alias(name), *columns)


def stage_results(table: str, flat: DataFrame) -> DataFrame:
    """One of the three API tables."""
    return project(flat, parse_spec(RESULTS[table]))


def stage_ratings(raw: DataFrame) -> DataFrame:
    return project(raw, parse_spec(RATINGS["ratings"]))


def stage_recent_moves(raw: DataFrame, drop_undated: bool = False) -> DataFrame:
    """Page moves: markers stripped, date and fee parsed, one row per natural key and date."""
    clean = raw.select(
        F.col("club_id").cast("long").alias("club_id"), "club_name", "season", "direction",
        "player_wiki_title", "transfer_type", "fee_text", "source_page",
        strip_markers(F.col("player_name")).alias("player_name"),
        strip_markers(F.col("other_club_name")).alias("other_club_name"),
        parse_text_date(F.col("date")).alias("transfer_date"),
        fee_amount(F.col("fee_text")).alias("fee_amount"),
        fee_currency(F.col("fee_text")).alias("fee_currency"),
    )
    rest = ["transfer_type", "fee_amount", "other_club_name", "season", "player_wiki_title", "source_page", "fee_text"]
    return dedup_most_complete(
        clean,
        ["club_id", "player_name", "direction"],
        "transfer_date",
        [F.col("transfer_date").isNotNull(), F.col("transfer_type") != ""],
        [F.col(c).asc_nulls_last() for c in rest],
        drop_undated,
    )
