"""One query per staging spec: text columns made of orders, staged, against the same casts in SQL.

Also the marts that only pick columns of a staged table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.catalog.registry import query
from tenure.plans import marts
from tenure.sources.staging import (
    HASH_KEYS,
    MARKET,
    RATINGS,
    RESULTS,
    Item,
    parse_spec,
    project_split,
    stage_market,
    stage_ratings,
    stage_results,
)

_DAY = "cast(cast(o_orderdate AS date) AS string)"
#: The text of a source column by the type it is staged as; `n` tells columns apart.
_TEXT = {
    "int": "cast(o_orderkey % (90 + {n}) AS string) || CASE WHEN o_orderkey % 2 = 0 THEN '.0' ELSE '' END",
    "long": "cast(o_custkey + {n} AS string)",
    "double": "cast(o_orderkey % 1000 AS string) || '.25'",
    "boolean": "CASE WHEN o_orderkey % 3 = {n} % 3 THEN '1' ELSE '0' END",
    "date": _DAY,
    "timestamp": _DAY + " || 'T20:15:00Z'",
    "string": "'text {n} ' || cast(o_orderkey % 50 AS string)",
}
_CAST = {
    "int": "cast(cast({c} AS double) AS int)", "long": "cast(cast({c} AS double) AS bigint)", "double": "cast({c} AS double)", "boolean": "cast({c} AS boolean)",
    "date": "cast({c} AS date)", "timestamp": "cast(replace(replace({c}, 'T', ' '), 'Z', '') AS timestamp)", "string": "{c}",
}


def _texts(spec: list[Item]) -> dict[str, str]:
    """SQL of the text of each source column; one order in thirteen has none."""
    kinds: dict[str, str] = {}
    for item in spec:
        kinds.setdefault(item.source, item.type)
    return {c: f"CASE WHEN o_orderkey % 13 <> {n} % 13 THEN {_TEXT[kind].format(n=n)} END" for n, (c, kind) in enumerate(kinds.items())}


def _sql(table: str, spec: list[Item], only: list[str] | None = None) -> str:
    inner = ", ".join(f'{text} AS "{c}"' for c, text in _texts(spec).items())
    columns = [f"{_CAST[i.type].format(c=chr(34) + i.source + chr(34))} AS {i.name}" for i in spec if only is None or i.name in only]
    if table in HASH_KEYS:
        name, sources = HASH_KEYS[table]
        parts = ", ".join(f"coalesce(\"{c}\", '_dbt_utils_surrogate_key_null_')" for c in sources)
        columns.insert(0, f"md5(concat_ws('-', {parts})) AS {name}")
    return f"SELECT {', '.join(columns)} FROM (SELECT {inner} FROM orders)"


def _raw(t, spec: list[Item]) -> DataFrame:
    return t["orders"].select(*[F.expr(text).alias(c) for c, text in _texts(spec).items()])


def _register(name: str, table: str, spec: list[Item], stage) -> None:
    query(_sql(table, spec), name)(lambda t: stage(_raw(t, spec)))


for _table, _spec in MARKET.items():
    _register(f"stage_{_table}", _table, parse_spec(_spec), lambda raw, table=_table: stage_market(table, raw))
for _table, _spec in RESULTS.items():
    _register(f"stage_api_{_table}", f"api_{_table}", parse_spec(_spec), lambda raw, table=_table: stage_results(table, raw))
_register("stage_ratings", "ratings", parse_spec(RATINGS["ratings"]), stage_ratings)

# A table with a column of every type, one order in seven with a bad cell, some with two.
_SPLIT = "o_orderkey:long=key a_int:int=a b_long:long=b c_double:double=c d_flag:boolean=d e_date:date=e f_time:timestamp=f g_text=g"
_BAD = [
    "cast(o_orderkey AS string) AS key",
    "CASE o_orderkey % 70 WHEN 0 THEN '3.7' WHEN 7 THEN '99999999999' WHEN 14 THEN 'seven' ELSE cast(o_custkey AS string) || '.0' END AS a",
    "CASE o_orderkey % 70 WHEN 21 THEN '12345678901234567890' ELSE cast(o_custkey AS string) END AS b",
    "CASE o_orderkey % 70 WHEN 28 THEN '1,5' WHEN 14 THEN 'x' ELSE cast(o_custkey AS string) || '.5' END AS c",
    "CASE o_orderkey % 70 WHEN 35 THEN 'maybe' ELSE CASE WHEN o_custkey % 2 = 0 THEN 'true' ELSE '0' END END AS d",
    "CASE o_orderkey % 70 WHEN 42 THEN '2020-02-30' WHEN 49 THEN 'June' ELSE cast(cast(o_orderdate AS date) AS string) END AS e",
    "CASE o_orderkey % 70 WHEN 56 THEN 'noon' ELSE cast(cast(o_orderdate AS date) AS string) || ' 20:15:00' END AS f",
    "CASE WHEN o_orderkey % 70 = 63 THEN NULL ELSE 'text' END AS g",
]


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 70 NOT IN (0, 7, 14) THEN cast(o_custkey AS int) END AS a_int,
        CASE WHEN o_orderkey % 70 <> 21 THEN o_custkey END AS b_long, CASE WHEN o_orderkey % 70 NOT IN (28, 14) THEN o_custkey + 0.5::double END AS c_double,
        CASE WHEN o_orderkey % 70 <> 35 THEN o_custkey % 2 = 0 END AS d_flag, CASE WHEN o_orderkey % 70 NOT IN (42, 49) THEN cast(o_orderdate AS date) END AS e_date,
        CASE WHEN o_orderkey % 70 <> 56 THEN cast(cast(o_orderdate AS date) AS timestamp) + INTERVAL '20 hours 15 minutes' END AS f_time,
        CASE WHEN o_orderkey % 70 <> 63 THEN 'text' END AS g_text,
        CASE WHEN o_orderkey % 70 = 14 THEN 2 WHEN o_orderkey % 7 = 0 AND o_orderkey % 70 <> 63 THEN 1 ELSE 0 END::int AS n_rejects
    FROM orders""")
def stage_split_rows(t):
    split = project_split(t["orders"].selectExpr(*_BAD), parse_spec(_SPLIT))
    return split.withColumn("n_rejects", F.size("rejects")).drop("rejects")


@query("""
    SELECT o_orderkey, "column", "text", reason FROM orders, (VALUES
        (0, 'a_int', '3.7', 'not a whole number'), (7, 'a_int', '99999999999', 'out of range'), (14, 'a_int', 'seven', 'not a whole number'),
        (14, 'c_double', 'x', 'not a number'), (21, 'b_long', '12345678901234567890', 'out of range'), (28, 'c_double', '1,5', 'not a number'),
        (35, 'd_flag', 'maybe', 'not a boolean'), (42, 'e_date', '2020-02-30', 'not a date'), (49, 'e_date', 'June', 'not a date'),
        (56, 'f_time', 'noon', 'not a timestamp')) bad(k, "column", "text", reason)
    WHERE o_orderkey % 70 = k""")
def stage_split_rejects(t):
    split = project_split(t["orders"].selectExpr(*_BAD), parse_spec(_SPLIT))
    return split.where(F.size("rejects") > 0).select("o_orderkey", F.inline("rejects"))


_PLAYERS, _TEAMS, _MATCHES = parse_spec(MARKET["players"]), parse_spec(RESULTS["teams"]), parse_spec(RESULTS["matches"])


@query(_sql("players", _PLAYERS, [*marts.PLAYER_COLUMNS, "market_value_in_eur", "highest_market_value_in_eur"]).replace("AS market_value_in_eur", "AS current_market_value_in_eur"))
def dim_player(t):
    return marts.dim_player(stage_market("players", _raw(t, _PLAYERS)))


@query(_sql("api_teams", _TEAMS, marts.TEAM_COLUMNS))
def dim_team(t):
    return marts.dim_team(stage_results("teams", _raw(t, _TEAMS)))


@query(_sql("api_matches", _MATCHES, marts.MATCH_COLUMNS))
def fct_match(t):
    return marts.fct_match(stage_results("matches", _raw(t, _MATCHES)))
