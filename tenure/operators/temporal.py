"""Tenure intervals, interval joins, as-of and nearest-period lookup.

All times are dates. That bounds the work per key: before any window is opened, rows are reduced
to one row per key and day, so even a key that holds a third of all rows brings at most one row
per calendar day to a task. The result of the window goes back to the full rows through an
equi-join on (key, day), which AQE splits if a key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tenure.operators.joins import attach

FAR_FUTURE = "9999-12-31"


def _need_date(df: DataFrame, *columns: str) -> None:
    for c in columns:
        if not isinstance(df.schema[c].dataType, DateType):
            raise TypeError(f"{c} must be a date column; cast it first")


def _all_set(columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def spells(
    moves: DataFrame,
    entity: Sequence[str],
    start: str,
    order_id: str,
    end: str = "spell_end_date",
    current: str = "is_current_spell",
) -> DataFrame:
    """Turn dated moves into half-open spells [start, end); the last one stays open (NULL end).

    A spell ends at the entity's next move in (start, order_id) order. Of several moves on one day
    the highest id opens the real spell and the others are empty, [d, d). So only the highest id
    per day needs the next day: an aggregate per (entity, day) finds it, with map-side combine, and
    `lead` runs over distinct days only. `order_id` must be unique per entity and day.
    Undated moves sort last and end nothing.
    """
    _need_date(moves, start)
    entity = list(entity)
    days = (
        moves.where(F.col(start).isNotNull())
        .groupBy(*entity, start)
        .agg(F.max(order_id).alias("__last"))
        .withColumn("__next", F.lead(start).over(Window.partitionBy(*entity).orderBy(F.col(start).asc_nulls_last())))
    )
    joined = attach(moves, days, [*entity, start], "left", null_safe=True)
    return (
        joined.withColumn(end, F.when(F.col(order_id) == F.col("__last"), F.col("__next")).otherwise(F.col(start)))
        .withColumn(current, F.col(end).isNull())
        .drop("__last", "__next")
    )


def asof_points(
    points: DataFrame,
    series: DataFrame,
    keys: Sequence[str],
    at: str,
    ts: str,
    values: Sequence[str],
    inclusive: bool = True,
) -> DataFrame:
    """For each point, the latest series row of the same key at (or strictly before) its date.

    Both sides must already hold one row per key and day; use `asof_latest` for raw rows. One
    shuffle by key carries both sides, and no pairs are formed. Points without an earlier row
    keep NULL values.
    """
    keys = list(keys)
    hit = F.struct(F.col(ts), *[F.col(v) for v in values])
    first, second = (0, 1) if inclusive else (1, 0)
    facts = series.where(_all_set([*keys, ts])).select(
        *keys, F.col(ts).alias("__at"), F.lit(first).alias("__side"), hit.alias("__hit")
    )
    asked = points.select(*keys, F.col(at).alias("__at"), F.lit(second).alias("__side")).withColumn(
        "__hit", F.lit(None).cast(facts.schema["__hit"].dataType)
    )
    w = Window.partitionBy(*keys).orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        facts.unionByName(asked)
        .withColumn("__hit", F.last("__hit", ignorenulls=True).over(w))
        .where(F.col("__side") == second)
    )
    return found.select(
        *keys,
        F.col("__at").alias(at),
        F.col(f"__hit.{ts}").alias(ts),
        *[F.col(f"__hit.{v}").alias(v) for v in values],
    )


def first_and_last_until(
    points: DataFrame,
    series: DataFrame,
    keys: Sequence[str],
    at: str,
    ts: str,
    values: Sequence[str],
    tiebreak: Sequence[str],
) -> DataFrame:
    """Add to each point the first and the last series row of its key up to its date, as structs.

    The structs `first` and `last` hold `ts`, the tie-break columns and the values; they are NULL
    where nothing precedes. The points of one key must be bounded (here: one move per day and
    direction), as they pass through the window themselves. Rows of one day are reduced first.
    """
    keys = list(keys)
    row = F.struct(F.col(ts), *[F.col(c) for c in (*tiebreak, *values)])
    daily = (
        series.where(_all_set([*keys, ts]))
        .groupBy(*keys, F.col(ts).alias("__at"))
        .agg(F.min(row).alias("__lo"), F.max(row).alias("__hi"))
        .withColumn("__side", F.lit(0))
    )
    asked = points.where(_all_set([*keys, at])).withColumns({"__at": F.col(at), "__side": F.lit(1)})
    w = Window.partitionBy(*keys).orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        daily.unionByName(asked, allowMissingColumns=True)
        .withColumns({"first": F.first("__lo", ignorenulls=True).over(w), "last": F.last("__hi", ignorenulls=True).over(w)})
        .where(F.col("__side") == 1)
        .drop("__at", "__side", "__lo", "__hi")
    )


def asof_latest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: dict[str, str],
    tiebreak: Sequence[str],
    at: str | None = None,
    how: str = "left",
) -> DataFrame:
    """Add to each row of `left` the latest `right` row with right_ts <= left_ts and equal keys.

    `values` maps columns of `right` to output names and `at` names the output column for the
    date found. Of several rows on one day the one with the highest `tiebreak` wins.
    """
    _need_date(left, left_ts)
    _need_date(right, right_ts)
    keys = list(keys)
    daily = (
        right.where(_all_set([*keys, right_ts]))
        .groupBy(*keys, F.col(right_ts).alias("__ts"))
        .agg(F.max(F.struct(*tiebreak, *[F.col(c).alias(f"__v_{c}") for c in values])).alias("__best"))
        .select(*keys, "__ts", *[F.col(f"__best.__v_{c}").alias(name) for c, name in values.items()])
    )
    asked = left.where(_all_set([*keys, left_ts])).select(*keys, F.col(left_ts).alias("__point")).distinct()
    found = asof_points(asked, daily, keys, "__point", "__ts", list(values.values()))
    if how == "inner":
        found = found.where(F.col("__ts").isNotNull())
    out = attach(left, found, {**{k: k for k in keys}, left_ts: "__point"}, how)
    return out.withColumnRenamed("__ts", at) if at else out.drop("__ts")


def interval_agg(
    spans: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    span_id: str,
    start: str,
    end: str,
    date: str,
    counts: dict[str, str] | None = None,
    sums: dict[str, str] | None = None,
    distinct: dict[str, str] | None = None,
) -> DataFrame:
    """Aggregate, per span, the facts of the same keys dated in [start, end); NULL end is open.

    The spans of one key must not overlap, as is the case for the output of `spells`. Facts are
    first summed per (keys, day, distinct columns) with map-side combine. These sums pass through the
    window that finds their span and are added up where they lie, so the pairs of the range join are
    never formed, facts are shuffled twice in all, and a hot key brings at most one row per day and
    combination of distinct values to the window. Every span id appears once and has one key; a span
    without facts has zeros.
    `counts`, `sums` and `distinct` map output names to fact columns.
    """
    _need_date(spans, start, end)
    _need_date(facts, date)
    keys, counts, sums, distinct = list(keys), counts or {}, sums or {}, distinct or {}
    distinct_columns = sorted(set(distinct.values()))
    cells = (
        facts.where(_all_set([*keys, date]))
        .groupBy(*keys, F.col(date).alias("__at"), *[F.col(c).alias(f"__d_{c}") for c in distinct_columns])
        .agg(
            F.lit(1).alias("__side"),
            *[F.count(c).alias(f"__n_{o}") for o, c in counts.items()],
            *[F.sum(c).alias(f"__s_{o}") for o, c in sums.items()],
        )
    )
    # Empty spans [d, d) can hold no fact and would hide the real span of that day.
    live = spans.where(_all_set([*keys, start]) & (F.col(end).isNull() | (F.col(end) > F.col(start)))).select(
        *keys,
        F.col(start).alias("__at"),
        F.lit(0).alias("__side"),
        F.struct(F.col(span_id).alias("id"), F.col(end).alias("end")).alias("__span"),
    )
    w = Window.partitionBy(*keys).orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (
        live.unionByName(cells, allowMissingColumns=True)
        .withColumn("__span", F.last("__span", ignorenulls=True).over(w))
        .where((F.col("__side") == 1) & F.col("__span").isNotNull())
        .where(F.col("__span.end").isNull() | (F.col("__span.end") > F.col("__at")))
        .withColumn(span_id, F.col("__span.id"))
    )
    # Grouped by the keys as well, the rows need no further shuffle.
    result = inside.groupBy(*keys, span_id).agg(
        *[F.sum(f"__n_{o}").alias(o) for o in counts],
        *[F.count_distinct(f"__d_{c}").alias(o) for o, c in distinct.items()],
        *[F.sum(f"__s_{o}").alias(o) for o in sums],
    )
    out = attach(spans.select(span_id), result.drop(*keys), [span_id], "left")
    return out.select(span_id, *[F.coalesce(o, F.lit(0)).alias(o) for o in (*counts, *distinct, *sums)])


def interval_join(
    spans: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    span_id: str,
    start: str,
    end: str,
    date: str,
    how: str = "inner",
) -> DataFrame:
    """Row-level range join for spans that do not overlap within a key.

    Each fact dated in [start, end) gets the id and bounds of its span. The span of a day is looked
    up once per distinct (keys, day) and attached to the facts of that day. With how="left" the
    spans without facts are kept, with NULL fact columns.
    """
    _need_date(spans, start, end)
    _need_date(facts, date)
    keys = list(keys)
    live = spans.where(_all_set([*keys, start]) & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    days = facts.where(_all_set([*keys, date])).select(*keys, date).distinct()
    hit = asof_points(days, live.select(*keys, start, span_id, end), keys, date, start, [span_id, end])
    hit = hit.where(F.col(span_id).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(date))))
    inside = attach(facts, hit, [*keys, date], "inner")
    if how == "inner":
        return inside
    # Every hit day has a fact, so the spans in use are known without the facts themselves.
    unused = attach(spans, hit.select(span_id).distinct(), [span_id], "left_anti")
    return inside.unionByName(unused.select(*keys, span_id, start, end), allowMissingColumns=True)


def overlapping_interval_join(
    spans: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    date: str,
    bucket_days: int = 32,
) -> DataFrame:
    """Inner range join for spans that may overlap: every (span, fact) with date in [start, end).

    Time is cut into buckets of `bucket_days`; a span is listed under each bucket it touches and
    meets only the facts of that bucket, so a hot key is spread over its buckets. The buckets stop
    at the latest fact, which no open span needs to pass.
    """
    _need_date(spans, start, end)
    _need_date(facts, date)
    keys = list(keys)

    def bucket(c: Column) -> Column:
        return F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / bucket_days)

    last_day = facts.agg(F.max(date)).scalar()
    live = spans.where(_all_set([*keys, start]) & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    live = live.withColumn("__until", F.least(F.coalesce(F.date_sub(end, 1), last_day), last_day)).where(
        F.col("__until") >= F.col(start)
    )
    listed = live.withColumn("__bucket", F.explode(F.sequence(bucket(F.col(start)), bucket(F.col("__until"))))).drop("__until")
    dated = facts.where(F.col(date).isNotNull()).withColumn("__bucket", bucket(F.col(date)))
    return (
        listed.join(dated, [*keys, "__bucket"], "inner")
        .where((F.col(start) <= F.col(date)) & (F.col(end).isNull() | (F.col(end) > F.col(date))))
        .drop("__bucket")
    )


def count_between(
    spans: DataFrame,
    events: DataFrame,
    span_key: Sequence[str],
    event_key: Sequence[str],
    start: str,
    end: str,
    date: str,
    measures: dict[str, Column],
) -> DataFrame:
    """Add to each span the number of events dated in [start, end) that satisfy each measure.

    Spans may overlap freely: the count is the running total before `end` minus the running total
    before `start`, so spans and events never meet pairwise. A NULL end is open; spans with a NULL
    key or start get 0.
    """
    _need_date(spans, start, end)
    _need_date(events, date)
    span_key, event_key = list(span_key), list(event_key)
    keys = [f"__k{i}" for i in range(len(event_key))]
    named = {name: f"__m{i}" for i, name in enumerate(measures)}
    daily = (
        events.select(*[F.col(c).alias(k) for c, k in zip(event_key, keys)], F.col(date).alias("__ts"),
                      *[condition.cast("long").alias(named[m]) for m, condition in measures.items()])
        .where(_all_set([*keys, "__ts"]))
        .groupBy(*keys, "__ts")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in named.values()])
    )
    upto = Window.partitionBy(*keys).orderBy("__ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = daily.select(*keys, "__ts", *[F.sum(c).over(upto).alias(c) for c in named.values()])
    bounded = spans.withColumn("__to", F.coalesce(end, F.lit(FAR_FUTURE).cast("date")))
    asked = (
        bounded.select(*[F.col(c).alias(k) for c, k in zip(span_key, keys)],
                       F.explode(F.array(F.col(start), F.col("__to"))).alias("__point"))
        .where(_all_set([*keys, "__point"]))
        .distinct()
    )
    before = asof_points(asked, running, keys, "__point", "__ts", list(named.values()), inclusive=False).drop("__ts")
    on_key = dict(zip(span_key, keys))
    out = attach(bounded, _suffixed(before, named.values(), "_from"), {**on_key, start: "__point"}, "left")
    out = attach(out, _suffixed(before, named.values(), "_to"), {**on_key, "__to": "__point"}, "left")
    usable = _all_set([*span_key, start]) & (F.col("__to") > F.col(start))
    for name, c in named.items():
        inside = F.coalesce(f"{c}_to", F.lit(0)) - F.coalesce(f"{c}_from", F.lit(0))
        out = out.withColumn(name, F.when(usable, inside).otherwise(F.lit(0)).cast("long"))
    return out.drop("__to", *[c + s for c in named.values() for s in ("_from", "_to")])


def _suffixed(df: DataFrame, columns, suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in columns})


def nearest_period(
    facts: DataFrame,
    periods: DataFrame,
    keys: dict[str, str] | Sequence[str],
    at: str,
    start: str,
    end: str,
    values: dict[str, str],
    tiebreak: Sequence[str] = (),
    disjoint: bool = False,
    how: str = "left",
) -> DataFrame:
    """Add the period that contains `at`, or else the one whose start is nearest.

    Periods are closed, [start, end]. Preference: containing first, then the least distance in days
    from `at` to the start, then the earlier start, then the later end, then the lowest `tiebreak`.
    Each distinct (key, day) is resolved once, from the last period starting at or before it and
    the first one starting after it. If periods of a key can overlap, an older period may still
    contain the day when the last one does not; those days (and only those) go through a bucketed
    containment join. Set `disjoint` if the periods of a key never overlap.
    """
    _need_date(facts, at)
    _need_date(periods, start, end)
    pairs = dict(keys) if isinstance(keys, dict) else {k: k for k in keys}
    ks = [f"__k{i}" for i in range(len(pairs))]
    spans = (
        periods.select(
            *[F.col(c).alias(k) for c, k in zip(pairs.values(), ks)],
            F.col(start).alias("__start"), F.col(end).alias("__end"),
            *[F.col(t).alias(f"__t{i}") for i, t in enumerate(tiebreak)],
            *[F.col(c).alias(f"__v{i}") for i, c in enumerate(values)],
        )
        .where(_all_set([*ks, "__start"]))
    )
    order = [F.col("__end").desc_nulls_last(), *[F.col(f"__t{i}").asc_nulls_last() for i in range(len(tiebreak))]]
    spans = spans.withColumn("__rn", F.row_number().over(Window.partitionBy(*ks, "__start").orderBy(*order))).where("__rn = 1")
    period = F.struct("__start", "__end", *[f"__v{i}" for i in range(len(values))])
    spans = spans.select(*ks, F.col("__start").alias("__at"), F.lit(0).alias("__side"), period.alias("__p"), F.col("__end").alias("__reach"))
    asked = facts.select(*[F.col(c).alias(k) for c, k in zip(pairs, ks)], F.col(at).alias("__at")).where(_all_set([*ks, "__at"])).distinct()
    stacked = spans.unionByName(asked.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    back = Window.partitionBy(*ks).orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(*ks).orderBy(F.col("__at").desc(), F.col("__side").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = (
        stacked.withColumn("__prev", F.last("__p", ignorenulls=True).over(back))
        .withColumn("__reach", F.max("__reach").over(back))
        .withColumn("__next", F.last("__p", ignorenulls=True).over(ahead))
        .where(F.col("__side") == 1)
    )
    covered = F.coalesce(F.col("__prev.__end") >= F.col("__at"), F.lit(False))
    gap_back = F.datediff("__at", F.col("__prev.__start"))
    gap_ahead = F.datediff(F.col("__next.__start"), F.col("__at"))
    nearest = F.when(F.col("__prev").isNull(), F.col("__next")).when(F.col("__next").isNull(), F.col("__prev")).otherwise(
        F.when(gap_back <= gap_ahead, F.col("__prev")).otherwise(F.col("__next"))
    )
    found = seen.withColumn("__pick", F.when(covered, F.col("__prev")).otherwise(nearest))
    if not disjoint:
        open_days = found.where(~covered & F.coalesce(F.col("__reach") >= F.col("__at"), F.lit(False))).select(*ks, F.col("__at").alias("__day"))
        inside = overlapping_interval_join(
            spans.select(*ks, "__p", F.col("__at").alias("__from"), F.date_add("__reach", 1).alias("__to")).where("__to is not null"),
            open_days, ks, "__from", "__to", "__day",
        )
        best = inside.groupBy(*ks, "__day").agg(F.max_by("__p", "__from").alias("__older"))
        found = attach(found, best, {**{k: k for k in ks}, "__at": "__day"}, "left").withColumn("__pick", F.coalesce("__older", "__pick"))
    found = found.select(*ks, "__at", *[F.col(f"__pick.__v{i}").alias(name) for i, name in enumerate(values.values())])
    return attach(facts, found, {**dict(zip(pairs, ks)), at: "__at"}, how)
