import datetime as dt

from tests.helpers import rows
from pyspark.sql import functions as F

from tenure.plans import ingest, marts
from tenure.sources import sinks, staging
from tenure.sources.readers import champion_scope


def test_loading_twice_and_again(spark, tmp_path):
    folder, root = str(tmp_path / "csv"), str(tmp_path / "raw")
    (tmp_path / "csv").mkdir()
    header = ",".join(dict.fromkeys(i.source for i in staging.parse_spec(staging.MARKET["countries"])))
    first = f"{header}\n1,Spain,ES,europa,42,1000,25.1,u\n2,France,FR,europa,40,900,24.0,u\n"
    (tmp_path / "csv" / "countries.csv").write_text(first)
    assert ingest.load_market_table(spark, folder, "countries", root, 100).count() == 2
    (tmp_path / "csv" / "countries.csv").write_text(f"{header}\n2,France,FR,europa,41,901,24.5,u\n3,Italy\n4,Malta,MT,europa,1,10,26.0,u\n")
    ingest.load_market_table(spark, folder, "countries", root, 200)
    staged = ingest.staged_market_table(spark, folder, "countries", root, 200)
    assert rows(staged, "country_id", "total_clubs") == [(1, 42), (2, 41), (4, 1)]
    rejected = spark.read.parquet(f"{root}/rejected/countries")
    assert rows(rejected, "_corrupt_record", "load") == [("3,Italy", 200)]


def test_club_mapping(spark):
    clubs = spark.createDataFrame(
        [(1, "Real Madrid Club de Fútbol", "ES1"), (2, "Atlético de Madrid", "ES1"), (3, "Real Madrid B", "ES1"), (4, "FC Copenhagen", "DK1"),
         (5, "Boca Juniors", "AR1"), (6, "Fortuna Düsseldorf", "L1"), (7, "Manchester City FC", "GB1"), (8, "Unknown", None)],
        "club_id long, club_name string, domestic_competition_id string",
    )
    competitions = spark.createDataFrame(
        [("ES1", "Spain"), ("DK1", "Denmark"), ("AR1", "Argentina"), ("L1", "Germany"), ("GB1", "England")], "competition_id string, country_name string")
    rated = spark.createDataFrame(
        [("Real Madrid", "ESP"), ("Atletico", "ESP"), ("Barcelona", "ESP"), ("FC Kobenhavn", "DEN"), ("Fortuna Koeln", "GER"), ("Man City", "ENG"), ("Man United", "ENG")],
        "clubelo_club string, clubelo_country string",
    )
    mapping, rejected, skipped = ingest.club_mapping(clubs, competitions, rated)
    assert rows(mapping, "club_id", "clubelo_club", "clubelo_country") == [
        (1, "Real Madrid", "ESP"), (2, "Atletico", "ESP"), (4, "FC Kobenhavn", "DEN"), (7, "Man City", "ENG")]
    # The reserve side may meet no first team; the other has a best miss below the threshold.
    assert rows(rejected, "club_id", "best_miss") == [(3, None), (6, "Fortuna Koeln")]
    assert 0 < rejected.where("club_id = 6").first()["best_score"] < 0.75
    assert rows(skipped, "club_id") == [(5,), (8,)]


TABLE = """<table class="wikitable"><tr><th>Date</th><th>Player</th><th>{side}</th><th>Type</th></tr>
<tr><td>1 July 2026</td><td><a href="/wiki/Ann_Lee">Ann Lee</a></td><td>Porto</td><td>Transfer</td></tr>
<tr><td>2 July 2026</td><td><a href="/wiki/Bo_Ray">Bo Ray</a></td><td>Braga</td><td>Loan</td></tr>
<tr><td>2 July 2026</td><td>No Link</td><td>Lens</td><td></td></tr></table>"""


def test_moves_from_pages(spark):
    hits = spark.createDataFrame(
        [(1, "Real Vila CF", "2026–27", 1, 10, "2026–27 Other CF season"), (1, "Real Vila CF", "2026–27", 2, 11, "2026–27 Real Vila CF season"),
         (2, "Lonely FC", "2026–27", 1, 10, "2026–27 Other CF season")],
        "club_id long, club_name string, season string, rank int, page_id long, title string",
    )
    sections = spark.createDataFrame(
        [(11, 1, "Kits", TABLE.format(side="To")), (11, 3, "Transfers", TABLE.format(side="Transfer from") + TABLE.format(side="Loaned to").replace("Ann_Lee", "Cy_Fox").replace("Ann Lee", "Cy Fox")),
         (11, 4, "More transfers", TABLE.format(side="To")), (10, 1, "Transfers", TABLE.format(side="To"))],
        "page_id long, section int, heading string, html string",
    )
    articles = spark.createDataFrame(
        [("Ann_Lee", "She signed for Real Vila CF for a fee of €12.5 million."), ("Bo_Ray", "Real Vila CF paid a fee of €9m."), ("Cy_Fox", "Joined Porto for £3m. Real Vila CF got him for €99m " + "z" * 500)],
        "title string, text string",
    )
    out = ingest.page_moves(hits, sections, articles)
    assert out.columns == ingest.RAW_MOVE_COLUMNS
    assert rows(out, "player_name", "direction", "other_club_name", "fee_text") == [
        ("Ann Lee", "in", "Porto", "€12.5 million"), ("Bo Ray", "in", "Braga", None), ("Bo Ray", "out", "Braga", None), ("Cy Fox", "out", "Porto", "£3m"),
        ("No Link", "in", "Lens", None), ("No Link", "out", "Lens", None)]
    staged = staging.stage_recent_moves(out).where("player_name = 'Ann Lee'").first()
    assert (staged["transfer_date"], float(staged["fee_amount"]), staged["fee_currency"], staged["source_page"]) == (
        dt.date(2026, 7, 1), 12500000.0, "EUR", "2026–27 Real Vila CF season")


def empty(spark, spec, extra=()):
    frame = spark.range(0).select(*[F.lit(None).cast(i.type if i.type != "long" else "bigint").alias(i.name) for i in staging.parse_spec(spec)])
    for c in extra:
        frame = frame.withColumn(c, F.lit(None).cast("string"))
    return frame


def test_all_marts_build_and_extract(spark, tmp_path):
    tables = {t: empty(spark, spec, [staging.HASH_KEYS[t][0]] if t in staging.HASH_KEYS else []) for t, spec in staging.MARKET.items()}
    tables |= {t: empty(spark, staging.RESULTS[t]) for t in ("teams", "matches")}
    tables["ratings"] = empty(spark, staging.RATINGS["ratings"])
    tables["scope"] = champion_scope(spark)
    tables["mapping"] = spark.createDataFrame([], "club_id int, club_name string, clubelo_club string, clubelo_country string")
    raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in ingest.RAW_MOVE_COLUMNS))
    tables["recent_moves"] = staging.stage_recent_moves(raw)
    built = marts.all_marts(tables, dt.date(2026, 7, 1))
    assert all(df.count() == 0 for df in built.values())
    paths = sinks.extract_marts(built, str(tmp_path))
    assert set(paths) == set(sinks.EXTRACTS)
