"""Load jobs: CSV tables into keyed loads, club mapping, and moves out of fetched pages.

Fetching is left to the caller; every job starts from a DataFrame or files of what was fetched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tenure.functions.mentions import mention_amounts
from tenure.operators import html
from tenure.operators.joins import attach, keep_missing
from tenure.operators.loads import LOAD_ID, stamp
from tenure.operators.matching import (
    ACCEPT_THRESHOLD,
    COUNTRY_CODES,
    NAME_OVERRIDES,
    fuzzy_block_match,
    pick_candidate,
    with_code,
)
from tenure.operators.ranking import latest_per_key
from tenure.sources.readers import CORRUPT, read_market
from tenure.sources.staging import PRIMARY_KEYS, stage_market
from tenure.streaming.upserts import append_load, read_current

RAW_MOVE_COLUMNS = [
    "club_id", "club_name", "season", "direction", "date", "player_name", "player_wiki_title", "other_club_name",
    "transfer_type", "fee_text", "source_page",
]
RAW_MOVE_KEY = ["club_id", "player_name", "date", "direction"]


def load_market_table(spark: SparkSession, folder: str, table: str, root: str, load_id: int) -> DataFrame:
    """Load one CSV table as load `load_id` and return the table as it then stands.

    Malformed lines go to `<root>/rejected/<table>` and do not stop the load. Loading the same id
    again changes nothing. Of rows with one key in a load the highest by all columns stays.
    """
    raw = read_market(spark, folder, table)
    rejected = raw.where(F.col(CORRUPT).isNotNull())
    stamp(rejected, load_id).write.mode("overwrite").parquet(f"{root}/rejected/{table}/load={load_id}")
    good = stamp(raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT), load_id)
    append_load(good, load_id, f"{root}/{table}", PRIMARY_KEYS[table], [LOAD_ID, *[c for c in good.columns if c != LOAD_ID]])
    return read_current(spark, f"{root}/{table}", StructType(good.schema.fields), PRIMARY_KEYS[table])


def staged_market_table(spark: SparkSession, folder: str, table: str, root: str, load_id: int) -> DataFrame:
    """`load_market_table`, staged."""
    return stage_market(table, load_market_table(spark, folder, table, root, load_id))


def club_mapping(clubs: DataFrame, competitions: DataFrame, rated: DataFrame, threshold: float = ACCEPT_THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mapping, rejected, skipped) between clubs and rated names of the same country.

    `rated` holds clubelo_club and clubelo_country, one row per name. Clubs of a country without
    ratings are skipped; clubs whose best score is too low are rejected, with
    their best miss and its score for review by hand.
    """
    countries = competitions.select(F.col("competition_id").alias("domestic_competition_id"), "country_name")
    placed = attach(clubs.select("club_id", "club_name", "domestic_competition_id"), countries, ["domestic_competition_id"], "left")
    coded = with_code(placed, "country_name", COUNTRY_CODES, "clubelo_country").select("club_id", "club_name", "clubelo_country")
    names = rated.select("clubelo_club", "clubelo_country").distinct()
    matched = fuzzy_block_match(
        coded, names, ["clubelo_country"], "club_id", "club_name", "clubelo_club", "clubelo_club", threshold, NAME_OVERRIDES
    )
    mapping = matched.where("source != 'rejected'").select(
        "club_id", "club_name", F.col("matched_name").alias("clubelo_club"), "clubelo_country"
    )
    rejected = matched.where("source = 'rejected'").select("club_id", "club_name", "clubelo_country", F.col("best_name").alias("best_miss"), "best_score")
    skipped = keep_missing(coded, names, ["clubelo_country"])
    return mapping, rejected, skipped


def page_moves(hits: DataFrame, sections: DataFrame, articles: DataFrame) -> DataFrame:
    """Raw moves of the searched clubs and seasons.

    `hits` are search results (club_id, club_name, season, rank, page_id, title), `sections` the
    page sections (page_id, section, heading, html) and `articles` the player articles
    (title, text). Per search the first fitting page is taken, of it the first section about
    transfers, and of that all tables. A fee the table does not give is looked for in the player's
    article, near the destination club. Of rows with the same key the last one stays.
    """
    search = ["club_id", "season"]
    picked = pick_candidate(hits, search, "rank", "title", "season", "club_name").select(
        *search, "club_name", "page_id", F.col("title").alias("source_page")
    )
    about = sections.where(F.contains(F.lower("heading"), F.lit("transfer")))
    first = latest_per_key(about, ["page_id"], [F.col("section").asc()]).select("page_id", "html")
    pages = attach(picked.select("page_id").distinct(), first, ["page_id"], "inner")
    rows = html.move_rows(html.html_rows(pages, ["page_id"], "html"), ["page_id"])
    moves = attach(rows, picked, ["page_id"], "inner")
    # Each player article is read once, for all destinations that moves ask it for.
    asked = html.needs_prose_fee(moves, "club_name").groupBy("player_wiki_title").agg(F.collect_set("destination_club").alias("__clubs"))
    told = attach(asked, articles.select("title", "text"), {"player_wiki_title": "title"}, "inner")
    each = told.select("player_wiki_title", F.explode(mention_amounts(F.col("text"), F.col("__clubs"))).alias("__told"))
    fees = each.select("player_wiki_title", F.col("__told.term").alias("destination_club"), F.col("__told.amount").alias("__fee"))
    destination = F.when(F.col("direction") == "in", F.col("club_name")).otherwise(F.col("other_club_name"))
    marked = moves.withColumn("destination_club", destination).withColumn("__open", html.prose_fee_wanted())
    priced = attach(marked, fees, ["player_wiki_title", "destination_club"], "left").withColumn(
        "fee_text", F.when(F.col("__open"), F.col("__fee")).otherwise(F.col("fee_text"))
    )
    order = [F.col(c).desc() for c in ("season", "page_id", "table_no", "row_no")]
    return latest_per_key(priced, RAW_MOVE_KEY, order).select(*RAW_MOVE_COLUMNS)
