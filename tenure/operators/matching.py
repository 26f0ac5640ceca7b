"""Entity resolution by name, overrides, code maps and blocked fuzzy matching."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.functions.names import has_reserve_marker, name_tokens, title_accepts
from tenure.functions.similarity import best_in_chunk
from tenure.operators.joins import attach, keep_missing
from tenure.operators.ranking import latest_per_key
from tenure.session import shared

# Country name to rating-country code, and checked name overrides.
COUNTRY_CODES = {
    "Austria": "AUT", "Belgium": "BEL", "Croatia": "CRO", "Czech Republic": "CZE",
    "Denmark": "DEN", "England": "ENG", "France": "FRA", "Germany": "GER",
    "Greece": "GRE", "Italy": "ITA", "Netherlands": "NED", "Norway": "NOR",
    "Poland": "POL", "Portugal": "POR", "Romania": "ROM", "Russia": "RUS",
    "Scotland": "SCO", "Serbia": "SRB", "Spain": "ESP", "Sweden": "SWE",
    "Switzerland": "SUI", "Türkiye": "TUR", "Ukraine": "UKR",
}
NAME_OVERRIDES = {
    "West Bromwich Albion": "West Brom",
    "Wolverhampton Wanderers": "Wolves",
    "Heart of Midlothian FC": "Hearts",
    "Stade Rennais FC": "Rennes",
    "Deportivo de La Coruña": "Depor",
    "SpVgg Greuther Fürth": "Fuerth",
    "FC Copenhagen": "FC Kobenhavn",
    "Union Saint-Gilloise": "St Gillis",
    "Red Star Belgrade": "Crvena Zvezda",
    "FCSB": "Steaua",
    "1.FC Köln": "Koeln",
    "1.FC Nuremberg": "Nuernberg",
    "PFK Krylya Sovetov Samara": "Kryliya Sovetov",
    "FC Dinamo 1948": "Dinamo Bucuresti",
    "Grasshopper Club Zurich": "Grasshoppers",
    "Chornomorets Odesa": "Chernomorets",
    "FC Rapid 1923": "Rapid Bucuresti",
}
ACCEPT_THRESHOLD = 0.75
#: Names of a block that meet at a time.
LEFT_CHUNK, RIGHT_CHUNK = 250, 500


def entity_resolve(
    rows: DataFrame,
    entities: DataFrame,
    evidence: DataFrame,
    row_name: str,
    row_context: str,
    entity_name: str,
    entity_id: str,
    evidence_id: str,
    evidence_context: str,
    how: str = "inner",
) -> DataFrame:
    """Give each row the lowest entity id with the same name (any case) that has evidence in its context.

    The evidence is reduced to distinct (id, context) and the candidates to one id per
    (name, context) before they meet the rows, so a name shared by many entities forms no pairs.
    """
    seen = evidence.where(F.col(evidence_context).isNotNull()).select(
        F.col(evidence_id).alias("__id"), F.col(evidence_context).alias("__context")
    ).distinct()
    named = entities.select(F.col(entity_id).alias("__id"), F.lower(entity_name).alias("__name"))
    lowest = named.join(seen, "__id", "inner").groupBy("__name", "__context").agg(F.min("__id").alias(entity_id))
    keyed = rows.withColumn("__lower", F.lower(row_name))
    return attach(keyed, lowest, {"__lower": "__name", row_context: "__context"}, how).drop("__lower")


def literal_map(mapping: dict, key: Column) -> Column:
    """Look a value up in a small fixed mapping; NULL if absent."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def with_code(df: DataFrame, name: str, codes: dict[str, str], out: str) -> DataFrame:
    """Add the code of a fixed name -> code map; names outside it get NULL."""
    return df.withColumn(out, literal_map(codes, F.col(name)))


def override(automatic: Column, name: Column, overrides: dict[str, str]) -> Column:
    """A manual override wins over the automatic match."""
    return F.coalesce(literal_map(overrides, name), automatic)


def pick_candidate(candidates: DataFrame, keys: Sequence[str], rank: str, title: str, season: str, name: str, top: int | None = None) -> DataFrame:
    """Per search, the first of its hits whose title names the season and the entity; `top` looks at the first hits only."""
    seen = candidates if top is None else candidates.where(F.col(rank) <= top)
    accepted = seen.where(title_accepts(F.col(title), F.col(season), F.col(name)))
    return latest_per_key(accepted, keys, [F.col(rank).asc()])


def first_section(headings: Column, term: str) -> Column:
    """0-based index of the first heading that mentions the term (any case); NULL if none does."""
    marked = F.transform(headings, lambda h, i: F.when(F.contains(F.lower(h), F.lit(term.lower())), i))
    return F.array_min(F.filter(marked, lambda i: i.isNotNull()))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0))


def _chunked(side: DataFrame, block: Sequence[str], rows: int, item: Column, chunk: str, chunks: str) -> DataFrame:
    """Arrays of about `rows` items of one block, dealt by the hash of `__id`; `chunks` is their number in the block."""
    sizes = side.groupBy(*block).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(chunks))
    dealt = attach(side, sizes, block, "inner").withColumn(chunk, F.pmod(F.xxhash64("__id"), F.col(chunks)).cast("int"))
    return dealt.groupBy(*block, chunks, chunk).agg(F.array_sort(F.collect_list(item)).alias("__items"))


def best_set_matches(left: DataFrame, right: DataFrame, block: Sequence[str]) -> DataFrame:
    """(block..., __id, __match, __score): the best right name for each left token set of a block, whatever its score.

    `left` has (block..., __id), `right` also __first, a struct of (order, name); __id holds the sorted distinct
    tokens joined by a space, once per block. Each side of a block is dealt into chunks of bounded size, and each pair
    of chunks is one row, so a large block spreads over tasks and no pair of names becomes a row. Within a pair of
    chunks `best_partners` bounds all scores by character counts and computes those that can still win. The best of a
    name over the chunks of the other side is an aggregate with map-side combine.
    """
    block = list(block)
    lefts = _chunked(left, block, LEFT_CHUNK, F.col("__id"), "__lc", "__lcs")
    ranked = F.struct(F.col("__first"), F.col("__id").alias("id"))
    rights = _chunked(right, block, RIGHT_CHUNK, ranked, "__rc", "__rcs")
    # The chunk numbers of the other side are part of the join key, so that no key holds a whole block.
    width = rights.select(*block, "__rcs").distinct()
    spread = attach(lefts, width, block, "inner").withColumn("__rc", F.explode(F.sequence(F.lit(0), F.col("__rcs") - 1))).drop("__rcs")
    met = spread.join(rights.drop("__rcs").withColumnRenamed("__items", "__others"), [*block, "__rc"], "inner")
    found = met.select(*block, "__items", "__others", best_in_chunk("__items", F.col("__others")["id"]).alias("__best"))
    each = found.select(*block, "__others", F.explode(F.arrays_zip("__items", "__best")).alias("__one"))
    hit = F.element_at("__others", F.col("__one.__best.at") + 1)["__first"]
    scored = each.select(*block, F.col("__one.__items").alias("__id"), F.struct((-F.col("__one.__best.score")).alias("less"), hit.alias("first")).alias("__hit"))
    best = scored.groupBy(*block, "__id").agg(F.min("__hit").alias("__hit"))
    return best.select(*block, "__id", F.col("__hit.first.name").alias("__match"), (-F.col("__hit.less")).alias("__score"))


def fuzzy_block_match(
    left: DataFrame,
    right: DataFrame,
    block: Sequence[str],
    left_id: str,
    left_name: str,
    right_name: str,
    right_order: str,
    threshold: float = ACCEPT_THRESHOLD,
    overrides: dict[str, str] | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Match each left row to its best right name of the same block by token-set score.

    Returns one row per left row whose block occurs on the right: (left_id, left_name, block...,
    matched_name, score, source, best_name, best_score), where source is 'manual' for an override,
    'auto' for a score of at least `threshold` (rounded to three digits) and 'rejected' (NULL match
    and score) below it. best_name and best_score are the best right name whatever its score, so a
    rejected name shows its best miss; they are NULL if no right name of the block may match. A
    reserve marker must be on both sides or on neither. Among equal scores the first right name by
    `right_order` wins. Names without a token take no part.

    Names are reduced to distinct token sets per block first, so copies of a name cost nothing; see
    `best_set_matches` for the search.
    """
    block = list(block)
    guarded = [*block, "__reserve"]

    def normalised(side: DataFrame, name: str) -> DataFrame:
        distinct = side.where(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in [*block, name]]))
        names = distinct.select(F.col(name).alias("__name")).distinct().withColumn("__raw", name_tokens(F.col("__name")))
        names = names.select(
            "__name", F.concat_ws(" ", F.array_sort(F.array_distinct("__raw"))).alias("__id"), has_reserve_marker(F.col("__raw")).alias("__reserve")
        )
        return attach(distinct.withColumn("__name", F.col(name)), names, ["__name"], "inner")

    known = right.select(*block).distinct()
    named = normalised(attach(left, known, block, "left_semi"), left_name)
    candidates = normalised(right, right_name).where("__id <> ''").groupBy(*guarded, "__id").agg(
        F.min(F.struct(F.col(right_order).alias("order"), F.col(right_name).alias("name"))).alias("__first")
    )
    sets = named.where("__id <> ''").select(*guarded, "__id").distinct()
    best = best_set_matches(shared(sets, scratch), shared(candidates, scratch), guarded)
    out = attach(named, best, [*guarded, "__id"], "left")
    manual = literal_map(overrides, F.col(left_name)) if overrides else F.lit(None).cast("string")
    rounded = F.round("__score", 3)
    accepted = rounded >= threshold
    return out.select(
        left_id, left_name, *block,
        F.coalesce(manual, F.when(accepted, F.col("__match"))).alias("matched_name"),
        F.when(manual.isNotNull(), F.lit(1.0)).otherwise(F.when(accepted, rounded)).alias("score"),
        F.when(manual.isNotNull(), "manual").when(accepted, "auto").otherwise("rejected").alias("source"),
        F.col("__match").alias("best_name"), rounded.alias("best_score"),
    )
