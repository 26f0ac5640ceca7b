import datetime as dt
import json
import os
import random

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from tenure import session
from tenure.operators import loads, quality
from tenure.plans import checks
from tenure.sources import published, readers, sinks, staging
from tenure.streaming import upserts

SAMPLES = {"int": "7", "long": "12", "double": "1.5", "boolean": "1", "date": "2020-01-31", "string": "text"}
TYPES = {"int": "int", "long": "bigint", "double": "double", "boolean": "boolean", "date": "date", "string": "string", "timestamp": "timestamp"}


@pytest.mark.parametrize("table", sorted(staging.MARKET))
def test_market_tables_from_csv(spark, tmp_path, table):
    spec = staging.parse_spec(staging.MARKET[table])
    sources = list(dict.fromkeys(i.source for i in spec))
    kinds = {i.source: i.type for i in spec}
    header = [*reversed(sources), "new_column"]
    lines = [",".join(header), ",".join([SAMPLES[kinds[c]] for c in reversed(sources)] + ["x"])]
    (tmp_path / f"{table}.csv").write_text("\n".join(lines) + "\n")
    good, bad = readers.split_corrupt(readers.read_market(spark, str(tmp_path), table))
    staged = staging.stage_market(table, good)
    expected = [(i.name, TYPES[i.type]) for i in spec]
    if table in staging.HASH_KEYS:
        expected.insert(0, (staging.HASH_KEYS[table][0], "string"))
    assert staged.dtypes == expected
    row = staged.first()
    assert all(row[i.name] is not None for i in spec) and bad.collect() == []
    assert set(staging.PRIMARY_KEYS[table]) <= set(sources)


def test_csv_keeps_malformed_lines_apart(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("club,country,level,elo,from_date,to_date\nA,ESP,1,1500.5,2020-01-01,2020-02-01\nB,ESP,1\n")
    good, bad = readers.split_corrupt(readers.read_ratings(spark, str(tmp_path / "ratings.csv")))
    assert rows(staging.stage_ratings(good), "clubelo_club", "elo", "rating_to_date") == [("A", 1500.5, dt.date(2020, 2, 1))]
    assert [r["_corrupt_record"] for r in bad.collect()] == ["B,ESP,1"]
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "ratings.csv"), ["club", "missing"])


def test_strict_cast_takes_3_0_and_fails_on_text(spark):
    df = spark.createDataFrame([("3.0",), (None,)], "x string")
    assert rows(staging.project(df, staging.parse_spec("n:int=x"))) == [(3,), (None,)]
    with pytest.raises(Exception):
        staging.project(spark.createDataFrame([("three",)], "x string"), staging.parse_spec("n:int=x")).collect()


def test_hash_key(spark):
    import hashlib
    raw = spark.createDataFrame([("1", "2020-01-01", None, "2")], "player_id string, transfer_date string, from_club_id string, to_club_id string")
    for c in ("player_name", "transfer_season", "from_club_name", "to_club_name", "transfer_fee", "market_value_in_eur"):
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    text = "1-2020-01-01-_dbt_utils_surrogate_key_null_-2"
    assert staging.stage_market("transfers", raw).first()["transfer_id"] == hashlib.md5(text.encode()).hexdigest()


def test_api_tables_from_nested_json(spark, tmp_path):
    match = {
        "id": 1, "utcDate": "2026-08-01T18:00:00Z", "status": "FINISHED", "matchday": 3, "stage": "REGULAR",
        "competition": {"id": 2, "name": "League", "code": "L"}, "season": {"id": 3, "startDate": "2026-08-01", "endDate": "2027-05-01"},
        "homeTeam": {"id": 4, "name": "H"}, "awayTeam": {"id": 5, "name": "A"},
        "score": {"winner": "HOME_TEAM", "halfTime": {"home": 1, "away": 0}, "fullTime": {"home": 2, "away": 0}},
    }
    (tmp_path / "matches.json").write_text(json.dumps(match) + "\n")
    row = staging.stage_results("matches", readers.read_results(spark, str(tmp_path / "matches.json"), "matches")).first()
    assert (row["match_id"], row["season_end_date"], row["home_team_id"], row["full_time_home_goals"], row["penalties_away_goals"]) == (
        1, dt.date(2027, 5, 1), 4, 2, None)
    team = {"id": 9, "shortName": "T", "founded": 1900, "clubColors": "red", "venue": "V", "area": {"id": 1, "name": "E"},
            "coach": {"id": 8, "name": "C", "contract": {"start": "2024-07", "until": "2027-06"}}}
    (tmp_path / "teams.json").write_text(json.dumps(team) + "\n")
    row = staging.stage_results("teams", readers.read_results(spark, str(tmp_path / "teams.json"), "teams")).first()
    assert (row["team_id"], row["team_short_name"], row["coach_name"], row["coach_contract_until"]) == (9, "T", "C", dt.date(2027, 6, 1))
    competition = {"id": 1, "name": "League", "numberOfAvailableSeasons": 5, "currentSeason": {"id": 3, "startDate": "2026-08-01", "currentMatchday": 4}}
    (tmp_path / "competitions.json").write_text(json.dumps(competition) + "\n")
    row = staging.stage_results("competitions", readers.read_results(spark, str(tmp_path / "competitions.json"), "competitions")).first()
    assert (row["number_of_available_seasons"], row["current_season_start_date"], row["current_season_matchday"]) == (5, dt.date(2026, 8, 1), 4)


def test_seeds(spark, tmp_path):
    (tmp_path / "map.csv").write_text("club_id,club_name,clubelo_club,clubelo_country\n3,1.FC Köln,Koeln,GER\n")
    seed = readers.read_seed(spark, str(tmp_path / "map.csv"), readers.MAPPING_SCHEMA)
    assert seed.dtypes[0] == ("club_id", "int") and seed.first()["clubelo_club"] == "Koeln"
    scope = readers.champion_scope(spark)
    assert rows(scope.groupBy("champion_method").count()) == [("cup_final", 8), ("league_table", 7)]


def test_layers_and_extracts(spark, tmp_path):
    assert sinks.schema_name("marts", "prod", "me") == "marts"
    assert sinks.schema_name("marts", "dev", "me") == "me_marts"
    assert sinks.schema_name(None, "dev", "me") == "me"
    df = spark.createDataFrame([("22/23", 1), ("23/24", 2)], "transfer_season string, id long")
    path = sinks.write_layer(df, str(tmp_path), "marts", "t", "dev", "me")
    sinks.write_layer(df.where("id = 1"), str(tmp_path), "marts", "t", "dev", "me")
    assert path.endswith("/me_marts/t") and published.open_table(spark, path).count() == 1
    paths = sinks.extract_marts({name: df for name in sinks.EXTRACTS}, str(tmp_path / "x"))
    back = published.open_table(spark, paths["fct_transfer"])
    assert rows(back, "id", "transfer_season") == [(1, "22/23"), (2, "23/24")]
    plan = back.where("transfer_season = '22/23'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transfer_season" in plan


def test_upsert_and_rebuild(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], "id long, v string, load int")
    delta = spark.createDataFrame([(2, "B", 2), (2, "B2", 3), (3, "c", 2), (None, "N", 2)], "id long, v string, load int")
    order = [F.col("load").desc()]
    merged = loads.upsert(base, delta, ["id"], order)
    assert rows(merged, "id", "v") == [(1, "a"), (2, "B2"), (3, "c"), (None, "N")]
    assert rows(merged) == rows(loads.rebuild(base.unionByName(delta), ["id"], order))
    assert rows(loads.upsert(merged, delta, ["id"], order)) == rows(merged)


def test_stamp_and_freshness(spark):
    df = loads.stamp(spark.createDataFrame([("s",)], "source string"), 1704067200)
    assert df.select(loads.load_time(F.col("_load_id")).cast("string")).first()[0] == "2024-01-01 00:00:00"
    timed = df.withColumn("at", loads.load_time(F.col("_load_id")))
    for day, status in ((2, "pass"), (10, "warn"), (40, "error")):
        as_of = F.lit(dt.date(2024, 1, 1) + dt.timedelta(days=day))
        assert loads.freshness(timed, "source", "at", as_of, *checks.FRESHNESS_DAYS["ratings"]).first()["status"] == status


def test_csv_files_of_a_table_may_differ_in_their_headers(spark, tmp_path):
    folder = tmp_path / "odd name.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name,n\n1,x,10\n2,y\n")
    (folder / "b.csv").write_text('n,"id",name\n30,3,"z, ""q"""\n')
    (folder / "c.csv").write_text("name,extra,n,id\nw,ignored,40,4\n")
    (folder / "d.csv").write_text("")
    (folder / "e.csv").write_text("id,name,n\n")
    got = readers.read_csv(spark, str(folder), ["id", "name", "n"])
    assert rows(got.where("_corrupt_record is null"), "id", "name", "n") == [("1", "x", "10"), ("3", 'z, "q"', "30"), ("4", "w", "40")]
    assert [(r["id"], r["_corrupt_record"]) for r in got.collect() if r["_corrupt_record"]] == [("2", "2,y")]
    assert sorted(len(files) for files in readers.headers(spark, str(folder)).values()) == [1, 1, 2]
    (folder / "f.csv").write_text("id,n\n5,50\n")
    with pytest.raises(ValueError, match="name"):
        readers.read_csv(spark, str(folder), ["id", "name", "n"])


def test_freshness_by_files_reads_no_data(spark, tmp_path):
    now = 1_700_000_000
    for name, days in (("results", 2), ("market", 20), ("ratings", 1)):
        (tmp_path / name / "load=1").mkdir(parents=True)
        for i in range(2):
            file = tmp_path / name / "load=1" / f"part-{i}.parquet"
            file.write_bytes(b"not read")
            os.utime(file, (now - 86400 * (days + 5 * i),) * 2)
    report = checks.source_freshness(spark, {n: str(tmp_path / n) for n in ("results", "market", "ratings")}, F.timestamp_seconds(F.lit(now)))
    assert rows(report, "source", "age_days", "status", "n_files") == [("market", 20.0, "error", 2), ("ratings", 1.0, "pass", 2), ("results", 2.0, "warn", 2)]
    assert "content" not in report._jdf.queryExecution().executedPlan().toString()


def test_stale_targets(spark):
    clubs = spark.createDataFrame([(1, "Fresh", 1800.0), (2, "Old", 1800.0), (3, "Never", 1700.0), (4, "Weak", 1600.0), (5, "Unrated", None)], "id long, name string, elo double")
    facts = spark.createDataFrame([(1, dt.date(2026, 5, 1)), (2, dt.date(2025, 1, 1)), (2, dt.date(2024, 1, 1))], "club long, at date")
    always = spark.createDataFrame([(5, "Unrated"), (2, "Old")], "id long, name string")
    out = loads.stale_targets(clubs, facts, "id", "club", "at", "elo", 1700, F.lit(dt.date(2026, 6, 1)), 300, always)
    assert rows(out) == [(2, "Old"), (3, "Never"), (5, "Unrated")]


def test_quarantine(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id long, x int")
    good, bad = loads.quarantine(df, {"positive": F.col("x") > 0, "known": F.col("x").isNotNull()})
    assert rows(good, "id") == [(1,)]
    assert {r["id"]: list(r["reject_reasons"]) for r in bad.collect()} == {2: ["positive"], 3: ["positive", "known"]}


def test_checks_report(spark):
    tables = {
        "child": spark.createDataFrame([(1, 1, "in", -1.0), (1, 9, "x", None), (None, None, None, 2.0)], "id long, parent long, kind string, fee double"),
        "parent": spark.createDataFrame([(1,)], "id long"),
    }
    specs = {"child": quality.Checks(unique=["id"], not_null=["id"], accepted={"kind": ["in", "out"]}, non_negative=["fee"],
                                     relationships=[("parent", "parent", "id", "warn")], combinations=[["id", "kind"]])}
    got = {(r["check"], r["columns"]): (r["failures"], r["status"]) for r in quality.run_checks(tables, specs).collect()}
    assert got == {("not_null", "id"): (1, "error"), ("accepted_values", "kind"): (1, "error"), ("non_negative", "fee"): (1, "error"),
                   ("unique", "id"): (1, "error"), ("unique_combination", "id,kind"): (0, "pass"), ("relationships", "parent"): (1, "warn")}


def test_all_checks_of_a_table_take_one_scan(spark, tmp_path):
    for name, n in (("child", 50), ("parent", 20)):
        spark.range(n).select("id", (F.col("id") % 30).alias("up"), F.lit("x").alias("kind")).write.parquet(str(tmp_path / name))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in ("child", "parent")}
    specs = {
        "child": quality.Checks(unique=["id", "up"], not_null=["id", "kind"], accepted={"kind": ["y"]}, combinations=[["up", "kind"]], relationships=[("up", "parent", "id", "warn")]),
        "parent": quality.Checks(unique=["id"], relationships=[("up", "child", "id", "error")]),
    }
    report = quality.run_checks(tables, specs)
    got = {(r["table"], r["check"], r["columns"]): r["failures"] for r in report.collect()}
    assert got == {
        ("child", "unique", "id"): 0, ("child", "unique", "up"): 20, ("child", "not_null", "id"): 0, ("child", "not_null", "kind"): 0, ("child", "accepted_values", "kind"): 50,
        ("child", "unique_combination", "up,kind"): 20, ("child", "relationships", "up"): 10, ("parent", "unique", "id"): 0, ("parent", "relationships", "up"): 0,
    }
    assert report._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2


def test_row_checks_are_counted_by_the_write_itself(spark, tmp_path):
    df = spark.range(10).withColumn("v", F.when(F.col("id") > 6, F.col("id") - 8))
    watched, watch = quality.observed(df, quality.Checks(not_null=["v"], non_negative=["v"]))
    watched.write.parquet(str(tmp_path / "t"))
    assert watch.get == {"rows": 10, "not_null:v": 7, "non_negative:v": 1}


def test_links_compare_by_value_across_types(spark):
    child = spark.createDataFrame([("1",), ("01",), ("x",), (None,)], "up string")
    report = quality.run_checks({"c": child, "p": spark.range(3)}, {"c": quality.Checks(relationships=[("up", "p", "id", "error")])})
    assert report.first()["failures"] == 1


def test_declared_checks_cover_all_tables():
    groups = [checks.STAGING_CHECKS, checks.SEED_CHECKS, checks.INTERMEDIATE_CHECKS, checks.MART_CHECKS]
    specs = [s for g in groups for s in g.values()]
    assert sum(len(s.relationships) for s in specs) == 5
    assert sum(len(s.combinations) for s in specs) == 2
    assert set(staging.MARKET) <= set(checks.STAGING_CHECKS)


def test_stream_of_files_equals_one_batch(spark, tmp_path):
    rng = random.Random(1)
    data = [(rng.randrange(20), i, rng.random()) for i in range(120)]
    schema = spark.createDataFrame(data[:1], "id long, seq long, v double").schema
    source, table, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))

    def feed(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        q = upserts.stream_upserts(spark, source, schema, table, mark, ["id"], ["seq"], files_per_batch=1)
        q.awaitTermination(120)
        assert q.exception() is None

    feed(data[:40])
    feed(data[40:80])
    run()
    feed(data[80:])
    run()
    current = upserts.read_current(spark, table, schema, ["id"])
    assert rows(current) == rows(loads.rebuild(spark.createDataFrame(data, schema), ["id"], [F.col("seq").desc()]))
    # A load that runs again changes nothing.
    upserts.append_load(spark.createDataFrame(data[80:], schema), 2, table, ["id"], ["seq"])
    again = upserts.read_current(spark, table, schema, ["id"])
    assert rows(again) == rows(current)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Sort", "Exchange", "Window"))
    kept = rows(current)
    upserts.compact(spark, table, schema, ["id"], buckets=3)
    assert rows(upserts.read_current(spark, table, schema, ["id"])) == kept
    assert len(published.versions(published.Folder(spark, table))) == 1
    assert len(list((tmp_path / "table" / "data").iterdir())) == 1


def test_upserts_compare_versions_between_loads_and_touch_few_buckets(spark, tmp_path):
    schema, table = "id long, seq long, v string", str(tmp_path / "t")
    typed = spark.createDataFrame([], schema).schema

    def load(data, n):
        upserts.append_load(spark.createDataFrame(data, typed), n, table, ["id"], ["seq"], buckets=8)

    def current():
        return rows(upserts.read_current(spark, table, typed))

    def buckets():
        return published.manifest(published.Folder(spark, table))[1]["buckets"]

    load([(i, 10, "a") for i in range(40)] + [(None, 1, "n")], 1)
    first = buckets()
    load([(3, 5, "older"), (4, None, "undated")], 2)  # late rows with an older version, or none
    assert current() == sorted([(i, 10, "a") for i in range(40)] + [(None, 1, "n")], key=repr)
    load([(3, 10, "same"), (None, 2, "m")], 3)  # at equal versions the later load
    assert (3, 10, "same") in current() and (None, 2, "m") in current() and len(current()) == 41
    load([(3, 10, "a")], 1)  # an earlier load that runs again
    assert (3, 10, "same") in current()
    changed = {b for b, at in buckets().items() if first.get(b) != at}
    assert 0 < len(changed) < len(first)
    load([], 4)
    assert len(current()) == 41


def test_a_load_that_dies_before_it_is_published_leaves_the_table(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    old = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "id long, seq long, v string")
    new = spark.createDataFrame([(1, 2, "A"), (3, 2, "c")], old.schema)
    upserts.append_load(old, 1, table, ["id"], ["seq"])

    def die(*_):
        raise OSError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(upserts, "publish", die)
        with pytest.raises(OSError):
            upserts.append_load(new, 2, table, ["id"], ["seq"])
    assert rows(upserts.read_current(spark, table, old.schema)) == [(1, 1, "a"), (2, 1, "b")]
    upserts.append_load(new, 2, table, ["id"], ["seq"])
    assert rows(upserts.read_current(spark, table, old.schema)) == [(1, 2, "A"), (2, 1, "b"), (3, 2, "c")]


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path):
    folder = published.Folder(spark, str(tmp_path / "t"))
    assert published.publish(folder, 0, {"table": "x"}) == 1
    with pytest.raises(published.VersionConflict):
        published.publish(folder, 0, {"table": "y"})
    assert published.manifest(folder) == (1, {"table": "x"})


def test_a_failed_replace_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "mart")
    published.replace(spark.range(5), root)
    broken = spark.range(100).repartition(4).withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="midway"):
        published.replace(broken, root)
    assert rows(published.open_table(spark, root)) == [(i,) for i in range(5)]
    reading = published.open_table(spark, root)
    published.replace(spark.range(7), root)  # over its own old version as well
    assert reading.count() == 5 and published.open_table(spark, root).count() == 7
    published.sweep(published.Folder(spark, root), "data", ["table"], keep=1)
    assert published.open_table(spark, root).count() == 7 and len(list((tmp_path / "mart" / "data").iterdir())) == 1
    with pytest.raises(FileNotFoundError):
        published.open_table(spark, str(tmp_path / "none"))


def test_shared_results_lie_in_the_callers_folder(spark, tmp_path):
    df = session.shared(spark.range(5), str(tmp_path / "scratch"))
    assert df.count() == 5
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()
    assert len(list((tmp_path / "scratch").iterdir())) == 1
    same = spark.range(5)
    assert session.shared(same, None) is same


def test_late_older_delta_changes_nothing(spark):
    base = spark.createDataFrame([(1, "new", 5), (2, "b", 1)], "id long, v string, load int")
    delta = spark.createDataFrame([(1, "old", 3), (2, "B", 2)], "id long, v string, load int")
    order = [F.col("load").desc()]
    assert rows(loads.upsert(base, delta, ["id"], order), "id", "v") == [(1, "new"), (2, "B")]
    assert rows(loads.upsert(base, delta, ["id"], order)) == rows(loads.rebuild(base.unionByName(delta), ["id"], order))


def test_strict_cast_refuses_fractions(spark):
    df = spark.createDataFrame([("3.0",), (" 4 ",), ("5.",), (None,)], "x string")
    assert rows(df.select(staging.strict_cast(df, "x", "int").alias("x"))) == [(3,), (4,), (5,), (None,)]
    for bad in ("3.7", "3.00000001", "x", ""):
        df = spark.createDataFrame([(bad,)], "x string")
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            df.select(staging.strict_cast(df, "x", "int")).collect()


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    folder = tmp_path / "swapped.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("club,country\nA,ENG\n")
    (folder / "b.csv").write_text("country,club\nESP,B\n")
    with pytest.raises(Exception, match="CSV header"):
        readers.read_csv(spark, str(folder), ["club", "country"]).collect()


def test_ratings_declare_disjoint_periods(spark):
    from tenure.plans.checks import STAGING_CHECKS

    day = lambda d: dt.date(2024, 1, d)
    data = [("a", "X", 1.0, day(1), day(9)), ("a", "X", 2.0, day(5), day(12)), ("b", "X", 3.0, day(1), day(4)), ("b", "X", 4.0, day(5), None)]
    ratings = spark.createDataFrame(data, "clubelo_club string, clubelo_country string, elo double, rating_from_date date, rating_to_date date")
    got = {r["check"]: (r["failures"], r["status"]) for r in quality.run_checks({"ratings": ratings}, {"ratings": STAGING_CHECKS["ratings"]}).where("failures > 0").collect()}
    assert got == {"overlapping_periods": (1, "error")}


def test_overlapping_periods(spark):
    day = lambda d: dt.date(2024, 1, d)
    data = [("a", day(1), day(5)), ("a", day(6), day(9)), ("a", day(9), day(10)), ("b", day(1), None), ("b", day(3), day(4)), ("c", day(1), day(20)), ("c", day(2), day(3)), ("c", day(15), day(30))]
    df = spark.createDataFrame(data, "k string, s date, e date")
    assert {(r["k"], r["s"].day) for r in quality.overlapping_periods(df, ["k"], "s", "e").collect()} == {("a", 9), ("b", 3), ("c", 2), ("c", 15)}


def test_bad_cells_are_listed_and_split_by_one_write(spark, tmp_path):
    spec = {i.source: i for i in staging.parse_spec(staging.MARKET["appearances"])}
    good = {c: SAMPLES[i.type] for c, i in spec.items()}
    dates = [c for c, i in spec.items() if i.type == "date"]
    ints = [c for c, i in spec.items() if i.type in ("int", "long")]
    data = [good, {**good, dates[0]: "31.01.2020", ints[0]: "1e3"}, {**good, ints[1]: None}]
    raw = spark.createDataFrame([tuple(d[c] for c in spec) for d in data], ", ".join(f"`{c}` string" for c in spec))
    split = staging.stage_market_split("appearances", raw)
    strict = staging.stage_market("appearances", raw.limit(1))
    assert split.columns == [*strict.columns, "rejects"]
    root = str(tmp_path / "appearances")
    staging.write_split(split, root)
    kept = staging.good_rows(spark, root)
    assert kept.count() == 2 and kept.columns == strict.columns and rows(strict)[0] in [tuple(r) for r in kept.collect()]
    name = {i.source: i.name for i in spec.values()}
    assert sorted(rows(staging.rejected_cells(spark, root, []), "column", "text", "reason")) == sorted(
        [(name[dates[0]], "31.01.2020", "not a date"), (name[ints[0]], "1e3", "not a whole number")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_market("appearances", raw).collect()
    assert staging.good_rows(spark, root)._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [isnotnull(rejected") == 1
