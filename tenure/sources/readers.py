"""Lazy scans with declared schemas; no inference."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tenure.sources.staging import MARKET, RATINGS, parse_spec

CORRUPT = "_corrupt_record"

# Competitions with a checked rule for their season champion.
CHAMPION_SCOPE = [
    ("ES1", "LaLiga", "league_table"),
    ("GB1", "Premier League", "league_table"),
    ("FR1", "Ligue 1", "league_table"),
    ("L1", "Bundesliga", "league_table"),
    ("IT1", "Serie A", "league_table"),
    ("PO1", "Liga Portugal", "league_table"),
    ("NL1", "Eredivisie", "league_table"),
    ("CDR", "Copa del Rey", "cup_final"),
    ("FAC", "FA Cup", "cup_final"),
    ("DFB", "DFB-Pokal", "cup_final"),
    ("CIT", "Coppa Italia", "cup_final"),
    ("NLP", "KNVB Beker", "cup_final"),
    ("CL", "UEFA Champions League", "cup_final"),
    ("EL", "UEFA Europa League", "cup_final"),
    ("UCOL", "UEFA Conference League", "cup_final"),
]
SCOPE_SCHEMA = "competition_id string, competition_name string, champion_method string"
MAPPING_SCHEMA = "club_id int, club_name string, clubelo_club string, clubelo_country string"

# Nested API documents.
RESULTS_SCHEMAS = {
    "competitions": """
        id long, name string, code string, type string, plan string, numberOfAvailableSeasons int,
        area struct<id:long, name:string, code:string>,
        currentSeason struct<id:long, startDate:string, endDate:string, currentMatchday:int>""",
    "teams": """
        id long, name string, shortName string, tla string, address string, website string,
        founded int, clubColors string, venue string, area struct<id:long, name:string>,
        coach struct<id:long, name:string, nationality:string,
                     contract:struct<start:string, until:string>>""",
    "matches": """
        id long, utcDate string, status string, matchday int, stage string,
        competition struct<id:long, name:string, code:string>,
        season struct<id:long, startDate:string, endDate:string>,
        homeTeam struct<id:long, name:string>, awayTeam struct<id:long, name:string>,
        score struct<winner:string, halfTime:struct<home:int, away:int>,
                     fullTime:struct<home:int, away:int>, extraTime:struct<home:int, away:int>,
                     penalties:struct<home:int, away:int>>""",
}


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a path by their header, read in one distributed pass over the lines; files without a line are left out."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("line"))
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").collect():  # a row per file
        names = next(csv.reader([row["header"].lstrip("\ufeff")]))
        found.setdefault(tuple(n.strip() for n in names), []).append(unquote(row["file"]))
    return found


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV files as text columns, matched by header name; malformed lines are kept in `_corrupt_record`.

    Each file may have its own order of columns and more of them: files with one header are read together by it, and
    the groups are united by name. A file that lacks one of `columns` fails the read.
    """
    parts = []
    for header, files in headers(spark, path).items():
        missing = [c for c in columns if c not in header]
        if missing:
            raise ValueError(f"{files[0]} lacks columns {missing}")
        schema = StructType([StructField(n, StringType()) for n in header] + [StructField(CORRUPT, StringType())])
        rows = (
            spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).option("escape", '"').csv(files)
        )
        parts.append(rows.select(*columns, CORRUPT))
    if not parts:
        return spark.createDataFrame([], StructType([StructField(n, StringType()) for n in [*columns, CORRUPT]]))
    return reduce(DataFrame.unionByName, parts)


def read_market(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the twelve CSV tables: `<folder>/<table>.csv` (a file or a folder of files)."""
    columns = list(dict.fromkeys(i.source for i in parse_spec(MARKET[table])))
    return read_csv(spark, f"{folder}/{table}.csv", columns)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, [i.source for i in parse_spec(RATINGS["ratings"])])


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed lines)."""
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT), raw.where(F.col(CORRUPT).isNotNull())


def read_results(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One of the three API tables from JSON lines, flattened to a__b in snake case."""
    return flatten(spark.read.schema(RESULTS_SCHEMAS[table]).json(path))


def snake(name: str) -> str:
    """'currentSeason' -> 'current_season'."""
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def flatten(df: DataFrame, separator: str = "__") -> DataFrame:
    """Every leaf of nested structs as one column named by its path."""

    def leaves(schema: StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, StructType):
                out += leaves(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(snake(p) for p in here)))
        return out

    return df.select(*leaves(df.schema, ()))


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small versioned CSV with declared key types."""
    return spark.read.schema(schema).option("header", True).csv(path)


def champion_scope(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHAMPION_SCOPE, SCOPE_SCHEMA)
