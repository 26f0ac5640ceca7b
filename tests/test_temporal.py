import datetime as dt
import random

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from tenure.operators import temporal


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_spells_same_day_undated_and_unknown_entity(spark):
    moves = spark.createDataFrame(
        [(1, "a", day(0)), (1, "c", day(5)), (1, "b", day(5)), (1, "d", day(9)), (1, "e", None), (2, "f", day(3)),
         (None, "g", day(1)), (None, "h", day(2))],
        "who long, id string, start date",
    )
    out = {r["id"]: (r["spell_end_date"], r["is_current_spell"]) for r in temporal.spells(moves, ["who"], "start", "id").collect()}
    assert out == {
        "a": (day(5), False), "b": (day(5), False), "c": (day(9), False), "d": (None, True), "e": (None, True),
        "f": (None, True), "g": (day(2), False), "h": (None, True),
    }


def test_times_must_be_dates(spark):
    moves = spark.sql("select 1 who, 'a' id, timestamp'2020-01-01 10:00:00' start")
    with pytest.raises(TypeError):
        temporal.spells(moves, ["who"], "start", "id")


def moves_and_facts(spark, seed, hot=0.0):
    rng = random.Random(seed)
    who = lambda: 0 if rng.random() < hot else rng.randrange(1, 6)
    moves = [(f"m{i:03d}", who(), rng.randrange(3), None if rng.random() < 0.05 else day(rng.randrange(40))) for i in range(80)]
    facts = [(f"f{i:03d}", who(), rng.randrange(3), day(rng.randrange(45)), rng.randrange(4), rng.randrange(3)) for i in range(400)]
    return (
        spark.createDataFrame(moves, "id string, who long, club long, start date"),
        spark.createDataFrame(facts, "fact string, who long, club long, at date, goals int, season int"),
    )


@pytest.mark.parametrize("seed,hot", [(1, 0.0), (2, 0.4), (3, 0.9)])
def test_interval_operators_equal_the_plain_range_join(spark, seed, hot):
    moves, facts = moves_and_facts(spark, seed, hot)
    spans = temporal.spells(moves, ["who"], "start", "id", "end", "open").persist()
    f = facts.withColumnsRenamed({"who": "w", "club": "c"})
    inside = (
        (F.col("who") == F.col("w")) & (F.col("club") == F.col("c")) & (F.col("start") <= F.col("at"))
        & (F.col("end").isNull() | (F.col("end") > F.col("at")))
    )
    naive = spans.join(f, inside, "left")
    assert rows(temporal.interval_join(spans, facts, ["who", "club"], "id", "start", "end", "at", how="left"), "id", "fact") == rows(naive, "id", "fact")
    assert rows(temporal.interval_join(spans, facts, ["who", "club"], "id", "start", "end", "at"), "id", "fact") == rows(spans.join(f, inside), "id", "fact")
    wide = spans.select("id", "who", "club", "start", "end")
    assert rows(temporal.overlapping_interval_join(wide, facts, ["who", "club"], "start", "end", "at", 7), "id", "fact") == rows(spans.join(f, inside), "id", "fact")
    agg = temporal.interval_agg(
        spans, facts, ["who", "club"], "id", "start", "end", "at",
        counts={"n": "fact"}, sums={"goals": "goals"}, distinct={"seasons": "season"},
    )
    expected = naive.groupBy("id").agg(
        F.count("fact").alias("n"), F.count_distinct("season").alias("seasons"), F.coalesce(F.sum("goals"), F.lit(0)).alias("goals")
    )
    assert rows(agg, "id", "n", "seasons", "goals") == rows(expected, "id", "n", "seasons", "goals")
    counted = temporal.count_between(
        wide, facts, ["club"], ["club"], "start", "end", "at", {"some": F.col("goals") > 0, "rest": F.col("goals") == 0}
    )
    by_club = (F.col("club") == F.col("c")) & (F.col("start") <= F.col("at")) & (F.col("end").isNull() | (F.col("end") > F.col("at")))
    expected = spans.join(f, by_club, "left").groupBy("id").agg(F.count_if(F.col("goals") > 0).alias("some"), F.count_if(F.col("goals") == 0).alias("rest"))
    assert rows(counted, "id", "some", "rest") == rows(expected, "id", "some", "rest")


def test_interval_agg_reads_facts_once(spark):
    spans = spark.createDataFrame([("a", 1, day(0), day(10)), ("b", 1, day(10), None)], "id string, who long, start date, end date")
    facts = spark.range(40).select(F.lit(1).alias("who"), F.date_add(F.lit(day(0)), F.col("id").cast("int")).alias("at"), (F.col("id") % 3).alias("season"), "id")
    agg = temporal.interval_agg(spans, facts.withColumnRenamed("id", "fact"), ["who"], "id", "start", "end", "at", counts={"n": "fact"}, distinct={"seasons": "season"})
    assert rows(agg, "id", "n", "seasons") == [("a", 10, 3), ("b", 30, 3)]
    assert agg._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


def test_title_on_the_last_day_does_not_count_and_on_the_first_does(spark):
    spans = spark.createDataFrame([("a", 1, day(0), day(10)), ("b", 1, day(10), None), ("c", None, day(0), None)], "id string, club long, start date, end date")
    titles = spark.createDataFrame([(1, day(10), True), (1, day(0), True), (1, day(10), False)], "club long, at date, league boolean")
    out = temporal.count_between(spans, titles, ["club"], ["club"], "start", "end", "at", {"league": F.col("league"), "cup": ~F.col("league")})
    assert rows(out, "id", "league", "cup") == [("a", 1, 0), ("b", 1, 1), ("c", 0, 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_asof_latest_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    left = [(i, 0 if rng.random() < 0.5 else rng.randrange(1, 5), None if rng.random() < 0.1 else day(rng.randrange(30))) for i in range(120)]
    right = [(i, 0 if rng.random() < 0.5 else rng.randrange(1, 5), day(rng.randrange(30)), rng.random()) for i in range(90)]
    l = spark.createDataFrame(left, "id long, who long, at date")
    r = spark.createDataFrame(right, "vid long, who long, ts date, value double")
    out = temporal.asof_latest(l, r, ["who"], "at", "ts", {"value": "found"}, ["vid"], at="found_at")
    got = {x["id"]: (x["found"], x["found_at"]) for x in out.collect()}
    for i, who, at in left:
        best = max(((ts, vid, v) for vid, w, ts, v in right if w == who and at is not None and ts <= at), default=None)
        assert got[i] == ((best[2], best[0]) if best else (None, None))
    inner = temporal.asof_latest(l, r, ["who"], "at", "ts", {"value": "found"}, ["vid"], how="inner")
    assert inner.count() == sum(1 for v in got.values() if v[1] is not None)


@pytest.mark.parametrize("seed,longest", [(1, 3), (2, 12), (3, 25)])
def test_nearest_period_equals_brute_force(spark, seed, longest):
    rng = random.Random(seed)
    facts = [(i, rng.randrange(4), day(rng.randrange(60))) for i in range(150)]
    periods = []
    for i in range(40):
        start = rng.randrange(60)
        periods.append((i, rng.randrange(3), day(start), None if rng.random() < 0.05 else day(start + rng.randrange(longest))))
    f = spark.createDataFrame(facts, "id long, who long, at date")
    p = spark.createDataFrame(periods, "pid long, owner long, start date, end date")
    out = temporal.nearest_period(f, p, {"who": "owner"}, "at", "start", "end", {"pid": "pid"}, ["pid"])
    got = {x["id"]: x["pid"] for x in out.collect()}
    assert len(got) == len(facts)
    for i, who, at in facts:
        def rank(x):
            pid, _, start, end = x
            inside = end is not None and start <= at <= end
            return (not inside, abs((at - start).days), start, -(end or dt.date.min).toordinal(), pid)
        mine = sorted((x for x in periods if x[1] == who), key=rank)
        assert got[i] == (mine[0][0] if mine else None)


def test_nearest_period_disjoint_plan_gives_the_same(spark):
    p = spark.createDataFrame([(1, day(0), day(4), 10.0), (1, day(10), day(14), 20.0)], "who long, start date, end date, elo double")
    f = spark.createDataFrame([(i, 1, day(i)) for i in range(20)] + [(99, 2, day(1))], "id long, who long, at date")
    both = [rows(temporal.nearest_period(f, p, ["who"], "at", "start", "end", {"elo": "elo"}, disjoint=d), "id", "elo") for d in (True, False)]
    assert both[0] == both[1]
    assert dict(both[0])[5] == 10.0 and dict(both[0])[6] == 20.0 and dict(both[0])[99] is None


def test_no_pairs_and_no_whole_group_in_the_spell_plan(spark):
    moves, facts = moves_and_facts(spark, 1)
    plan = temporal.spells(moves, ["who"], "start", "id")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "partial_max" in plan
