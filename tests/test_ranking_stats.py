import datetime as dt
import random
import statistics

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from tenure.functions import measures
from tenure.operators import ranking
from tenure.operators.stats import exact_median


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [5.0, 1.0, 3.0], [0.0, 0.0, 0.0, 7.0], [-3.5, -1.0, 0.0, 2.0], [2.0] * 9 + [100.0],
    [random.Random(4).uniform(-1e6, 1e6) for _ in range(501)], [random.Random(5).gauss(0, 1) for _ in range(600)],
    [1e-300, 1e300, -1e300, 5.0], [float(i // 3) for i in range(100)],
])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    assert exact_median(df, "x", "m").collect()[0]["m"] == pytest.approx(statistics.median(values), rel=1e-12, abs=1e-300)


def test_median_of_nothing(spark):
    assert exact_median(spark.createDataFrame([], "x double"), "x", "m").collect()[0]["m"] is None


def test_spectrum_lists_both_ends_and_labels_by_sign(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", -1.0), ("c", 0.0), ("d", None), ("e", 3.0)], "id string, x double")
    out = ranking.spectrum(df, "x", 2, ["id"], ("up", "down"), "sign")
    assert rows(out, "id", "sign") == [("a", "up"), ("b", "down"), ("c", "up"), ("e", "up")]
    assert ranking.spectrum(df, "x", 6, ["id"], ("up", "down"), "sign").count() == 8


def test_spectrum_reads_its_input_once(spark, tmp_path):
    spark.range(1000).select("id", (F.col("id") * 37 % 1000 - 500).alias("x")).write.parquet(str(tmp_path / "t"))
    out = ranking.spectrum(spark.read.parquet(str(tmp_path / "t")), "x", 3, ["id"], ("up", "down"), "sign")
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("WindowGroupLimit") >= 2
    assert rows(out, "x") == [(-498,), (-499,), (-500,), (497,), (498,), (499,)]


def test_dedup_keeps_the_most_complete_and_the_undated(spark):
    d = dt.date(2026, 6, 15)
    df = spark.createDataFrame(
        [(1, "x", d, "", 1), (1, "x", d, "Loan", 2), (1, "x", None, "Loan", 3), (1, "y", d, "Loan", 4), (1, "y", d, None, 5), (2, "z", None, "", 6)],
        "club long, name string, day date, kind string, n long",
    )
    args = (["club", "name"], "day", [F.col("day").isNotNull(), F.col("kind") != ""], [F.col("n")])
    # An unknown type sorts above a known one.
    assert rows(ranking.dedup_most_complete(df, *args), "n") == [(2,), (3,), (5,), (6,)]
    assert rows(ranking.dedup_most_complete(df, *args, drop_undated=True), "n") == [(2,), (5,), (6,)]


def test_top1_is_pruned_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    out = ranking.latest_per_key(df, ["k"], [F.col("id").desc()])
    assert rows(out) == [(0, 99), (1, 97), (2, 98)]
    plan = out._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_first_last_rank_grain_leaves_one_holder(spark):
    df = spark.createDataFrame([(1, "in", 1, 10.0), (1, "out", 2, 20.0), (1, "out", 3, 30.0)], "who long, dir string, at long, v double")
    assert rows(ranking.first_last(df, ["who", "dir"], ["at"], ["v"])) == [(1, "in", 10.0, 10.0), (1, "out", 20.0, 30.0)]
    assert rows(ranking.first_last(df, ["who", "dir"], ["at"], ["v"], ["who"])) == [(1, "in", 10.0, None), (1, "out", None, 30.0)]


def test_season_rules(spark):
    df = spark.createDataFrame([("95/96",), ("22/23",), ("50/51",), ("49/50",)], "s string")
    assert rows(df.select("s", measures.season_start_year(F.col("s")))) == [("22/23", 2022), ("49/50", 2049), ("50/51", 1950), ("95/96", 1995)]
    labels = [r["season"] for r in measures.recent_seasons(spark, dt.date(2026, 6, 30), 2).orderBy("seasons_ago").collect()]
    assert labels == ["2025–26", "2024–25"]
    assert measures.recent_seasons(spark, dt.date(2026, 7, 1), 1).first()["season"] == "2026–27"
    assert measures.recent_seasons(spark, dt.date(1999, 8, 31), 1).first()["season"] == "1999–00"


def test_parameter_filters_and_ratio(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), (None, 1.0, 2.0)], "s string, x double, y double")
    assert df.where(measures.like(F.col("s"), "%")).count() == 1
    assert df.where(measures.like_or_null(F.col("s"), "%")).count() == 2
    assert [r[0] for r in df.select(measures.safe_ratio(F.col("x"), F.col("y"))).collect()] == [None, 0.5]
