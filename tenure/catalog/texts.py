"""Text clean-up, extraction and name matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenure.catalog.domain_sql import sql
from tenure.catalog.registry import query
from tenure.functions import mentions, names, text
from tenure.operators import html, matching
from tenure.plans import adapters as ad
from tenure.plans import ingest
from tenure.sources.staging import stage_recent_moves


@query(sql(["raw_recent_moves"], r"""
    SELECT source_page, regexp_replace(player_name, '\[.*?\]', '', 'g') AS player_name,
        regexp_replace(other_club_name, '\[.*?\]', '', 'g') AS other_club_name FROM raw_recent_moves"""))
def strip_markers(t):
    return ad.raw_recent_moves(t).select("source_page", *[text.strip_markers(F.col(c)).alias(c) for c in ("player_name", "other_club_name")])


@query(sql(["clean_recent_moves"], "SELECT source_page, transfer_date FROM clean_recent_moves"))
def parse_text_date(t):
    return ad.raw_recent_moves(t).select("source_page", text.parse_text_date(F.col("date")).alias("transfer_date"))


@query(sql(["clean_recent_moves"], "SELECT source_page, cast(fee_amount AS double) AS fee_amount FROM clean_recent_moves"))
def fee_amount(t):
    return ad.raw_recent_moves(t).select("source_page", text.fee_amount(F.col("fee_text")).cast("double").alias("fee_amount"))


@query(sql(["clean_recent_moves"], "SELECT source_page, fee_currency FROM clean_recent_moves"))
def fee_currency(t):
    return ad.raw_recent_moves(t).select("source_page", text.fee_currency(F.col("fee_text")).alias("fee_currency"))


@query(sql(["recent_moves"], "SELECT * REPLACE (cast(fee_amount AS double) AS fee_amount) FROM recent_moves"))
def dedup_most_complete(t):
    return ad.recent_moves(t).withColumn("fee_amount", F.col("fee_amount").cast("double"))


@query(sql(["recent_moves"], """
    SELECT * REPLACE (cast(fee_amount AS double) AS fee_amount) FROM recent_moves m
    WHERE transfer_date IS NOT NULL OR NOT EXISTS (SELECT 1 FROM recent_moves d WHERE d.club_id = m.club_id
        AND d.player_name = m.player_name AND d.direction = m.direction AND d.transfer_date IS NOT NULL)"""))
def dedup_drop_undated(t):
    out = stage_recent_moves(ad.raw_recent_moves(t), drop_undated=True)
    return out.withColumn("fee_amount", F.col("fee_amount").cast("double"))


@query(r"""
    SELECT o_orderkey, md5(concat_ws('-', cast(o_orderkey AS varchar), cast(cast(o_orderdate AS date) AS varchar),
        coalesce(cast(nullif(o_custkey % 3, 0) AS varchar), '_dbt_utils_surrogate_key_null_'))) AS surrogate
    FROM orders""")
def surrogate_key(t):
    key = text.surrogate_key(F.col("o_orderkey"), F.col("o_orderdate").cast("date"), F.nullif(F.col("o_custkey") % 3, F.lit(0)))
    return t["orders"].select("o_orderkey", key.alias("surrogate"))


@query(r"""
    SELECT p_partkey, try_cast(nullif(regexp_extract(label, '^[0-9]+'), '') AS int) AS number
    FROM (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'Final' ELSE p_size || '. ' || p_brand END AS label FROM part)""")
def leading_int(t):
    label = F.when(F.col("p_size") % 7 == 0, "Final").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(". "), F.col("p_brand")))
    return t["part"].select("p_partkey", text.leading_int(label).alias("number"))


@query("SELECT c_custkey, 'https://img.example.com/' || c_custkey || '.png' AS url FROM customer")
def url_from_key(t):
    return t["customer"].select("c_custkey", text.url_from_key("https://img.example.com/", F.col("c_custkey"), ".png").alias("url"))


@query("SELECT c_custkey, url_decode('Jo%C3%A3o_' || c_custkey || '+%28' || c_mktsegment || '%29') AS title FROM customer")
def href_title(t):
    href = F.concat(F.lit("/wiki/Jo%C3%A3o_"), F.col("c_custkey").cast("string"), F.lit("+%28"), F.col("c_mktsegment"), F.lit("%29"))
    return t["customer"].select("c_custkey", text.href_title(href).alias("title"))


_CELL = """CASE o_orderkey % 8 WHEN 0 THEN '€' || (o_orderkey % 90) || 'M + €10M variables' WHEN 1 THEN '£' || (o_orderkey % 70) || '.5 million'
    WHEN 2 THEN 'Free transfer' WHEN 3 THEN 'Loan (€2m)' WHEN 4 THEN 'None' WHEN 5 THEN '-' WHEN 6 THEN '' ELSE 'Undisclosed' END"""
_AMOUNT = "(?i)" + text.AMOUNT


def _fee_cells(t):
    return t["orders"].select("o_orderkey", F.expr(_CELL).alias("cell"), F.when(F.col("o_orderkey") % 11 == 0, F.col("o_orderpriority")).otherwise("").alias("type"))


@query(f"SELECT o_orderkey, nullif(regexp_extract(cell, '{_AMOUNT}', 1), '') AS fee FROM (SELECT o_orderkey, {_CELL} AS cell FROM orders)")
def fee_from_cell(t):
    return _fee_cells(t).select("o_orderkey", text.first_amount(F.col("cell")).alias("fee"))


@query(f"""
    SELECT o_orderkey, CASE WHEN type != '' OR cell = '' THEN type WHEN lower(cell) LIKE '%loan%' THEN 'Loan'
        WHEN lower(cell) LIKE '%free%' THEN 'Free transfer' WHEN lower(cell) LIKE '%none%' OR trim(cell) IN ('-', '') THEN ''
        WHEN regexp_matches(cell, '{_AMOUNT}') THEN 'Transfer' ELSE type END AS type
    FROM (SELECT o_orderkey, {_CELL} AS cell, CASE WHEN o_orderkey % 11 = 0 THEN o_orderpriority ELSE '' END AS type FROM orders)""")
def infer_type(t):
    return _fee_cells(t).select("o_orderkey", text.infer_type(F.col("type"), F.col("cell")).alias("type"))


_STRICT = "(?i)" + text.AMOUNT_IN_CONTEXT


_TERMS = ["and", "an", "der", "die", "que", "ent"]
# Each term splits the text; the pieces' lengths give the places of its mentions. A term must not overlap itself.
_MENTIONS = rf"""
    WITH told AS (
        SELECT doc_id, replace(text, ', ', ', for a fee of £' || (doc_id % 89) || '.2m, or €' || (doc_id % 71) || ' million, ') AS body FROM documents),
    asked AS (SELECT doc_id, body, term FROM told, (SELECT unnest({{terms}}) AS term)),
    pieces AS (
        SELECT doc_id, term, body, unnest(string_split(body, term)) AS piece, generate_subscripts(string_split(body, term), 1) AS n FROM asked),
    mentions AS (
        SELECT doc_id, term, body, n, sum(length(piece)) OVER w + length(term) * (n - 1) AS idx, count(*) OVER (PARTITION BY doc_id, term) AS pieces
        FROM pieces WINDOW w AS (PARTITION BY doc_id, term ORDER BY n)),
    windows AS (
        SELECT doc_id, term, n, body[cast(greatest(idx - 100, 0) + 1 AS bigint):cast(idx + 400 AS bigint)] AS w FROM mentions WHERE n < pieces),
    hits AS (
        SELECT doc_id, term, n, coalesce(nullif(regexp_extract(w, '{_STRICT}', 1), ''), nullif(regexp_extract(w, '{_AMOUNT}', 1), '')) AS hit FROM windows),
    fees AS (SELECT doc_id, term, arg_min(hit, n) AS fee FROM hits WHERE hit IS NOT NULL GROUP BY doc_id, term)
    """


def _told():
    key = F.col("doc_id")
    told = F.concat(F.lit(", for a fee of £"), (key % 89).cast("string"), F.lit(".2m, or €"), (key % 71).cast("string"), F.lit(" million, "))
    return F.replace(F.col("text"), F.lit(", "), told)


@query(_MENTIONS.replace("{terms}", str(["and"])) + "SELECT doc_id, fee FROM documents LEFT JOIN fees USING (doc_id)")
def mention_window_extract(t):
    found = mentions.mention_amounts(_told(), F.array(F.lit("and")))
    return t["documents"].select("doc_id", F.try_element_at(found, F.lit(1))["amount"].alias("fee"))


@query(_MENTIONS.replace("{terms}", str(_TERMS)) + "SELECT doc_id, term, fee FROM fees")
def mention_amounts(t):
    """Several terms of one text, one of them the beginning of another, in one pass over each text."""
    found = mentions.mention_amounts(_told(), F.array(*map(F.lit, _TERMS)))
    return t["documents"].select("doc_id", F.inline(found)).withColumnRenamed("amount", "fee")


_PAGE_TERMS = ["and", "der", "que"]


@query(_MENTIONS.replace("{terms}", str(_PAGE_TERMS)) + """, found AS (
        SELECT page_id, ['and', 'der', 'que'][page_id % 3 + 1] AS destination, CASE WHEN page_id % 4 = 0 THEN 'End of loan' ELSE 'Transfer' END AS kind FROM pages)
    SELECT page_id AS club_id, 'FC Club' || page_id AS club_name, '2026–27' AS season, 'out' AS direction, '1 July 2026' AS date, 'P' || page_id AS player_name,
        'Doc_' || page_id AS player_wiki_title, destination AS other_club_name, kind AS transfer_type,
        CASE WHEN kind = 'Transfer' THEN fee END AS fee_text, '2026–27 Club' || page_id || ' season' AS source_page
    FROM found LEFT JOIN fees ON fees.doc_id = page_id AND term = destination
    UNION ALL SELECT page_id, 'FC Club' || page_id, '2026–27', 'out', '2 July 2026', 'Q' || page_id, NULL, 'Lens', '', NULL, '2026–27 Club' || page_id || ' season' FROM found
    UNION ALL SELECT page_id, 'FC Club' || page_id, '2026–27', 'in', '', 'R' || page_id, NULL, 'Last club', 'Transfer', '€' || page_id % 50 || 'm', '2026–27 Club' || page_id || ' season' FROM found""")
def page_job(t):
    """The whole page job: pick of the hit, first section about transfers, tables with and without a direction, fees from the articles, last row per key."""
    key = F.col("page_id")
    number = key.cast("string")
    club = F.concat(F.lit("Club"), number)

    def hit(rank, page, season):
        return F.struct(F.lit(rank).alias("rank"), page.alias("page_id"), F.concat(F.lit(season + " "), club, F.lit(" season")).alias("title"))

    asked = t["pages"].select(key.alias("club_id"), F.concat(F.lit("FC "), club).alias("club_name"), F.lit("2026–27").alias("season"),
                              F.inline(F.array(hit(1, key + 1, "2025–26"), hit(2, key, "2026–27"), hit(3, key + 2, "2026–27"))))
    term = F.element_at(F.array(*map(F.lit, _PAGE_TERMS)), (key % 3 + 1).cast("int"))
    kind = F.when(key % 4 == 0, "End of loan").otherwise("Transfer")
    out = F.concat(
        F.lit('<table class="wikitable"><tr><th>Date</th><th>Player</th><th>To</th><th>Type</th></tr><tr><td>1 July 2026</td><td><a href="/wiki/Doc_'), number, F.lit('">P'), number,
        F.lit("</a></td><td>"), term, F.lit("</td><td>"), kind, F.lit("</td></tr><tr><td>2 July 2026</td><td>Q"), number, F.lit("</td><td>Lens</td><td></td></tr></table>"),
    )
    undirected = F.lit('<table class="wikitable"><tr><th>Date</th><th>Player</th><th>Type</th></tr><tr><td>3 July 2026</td><td>Nobody</td><td>Loan</td></tr></table>')
    row = lambda other: F.concat(F.lit("<tr><td>R"), number, F.lit(f"</td><td>{other}</td><td>€"), (key % 50).cast("string"), F.lit("m</td></tr>"))
    moved = F.concat(F.lit('<table class="wikitable"><tr><th>Player</th><th>From</th><th>Fee</th></tr>'), row("First club"), row("Last club"), F.lit("</table>"))
    parts = F.array(
        F.struct(F.lit(1).alias("section"), F.lit("History").alias("heading"), moved.alias("html")),
        F.struct(F.lit(5).alias("section"), F.lit("Transfers in winter").alias("heading"), undirected.alias("html")),
        F.struct(F.lit(3).alias("section"), F.lit("Summer transfers").alias("heading"), F.concat(out, undirected, moved).alias("html")),
    )
    sections = t["pages"].select("page_id", F.inline(parts))
    articles = t["documents"].select(F.concat(F.lit("Doc_"), F.col("doc_id").cast("string")).alias("title"), _told().alias("text"))
    return ingest.page_moves(asked, sections, articles)


_NAME = "'FC ' || p_name || ' (' || p_type || ') Manchester ' || CASE WHEN p_size % 3 = 0 THEN 'U21' ELSE 'Club' END"
_GENERIC = ", ".join(f"'{w}'" for w in names.GENERIC_WORDS)


def _token_sql(name: str) -> str:
    words = rf"string_split_regex(regexp_replace(lower(regexp_replace({name}, '\(.*?\)', ' ', 'g')), '[^a-z0-9\s]', ' ', 'g'), '\s+')"
    kept = f"list_filter({words}, lambda w: w != '' AND w NOT IN ({_GENERIC}))"
    return f"list_transform({kept}, lambda w: CASE w WHEN 'manchester' THEN 'man' WHEN 'monchengladbach' THEN 'gladbach' ELSE w END)"


@query(f"SELECT DISTINCT {_NAME} AS name, array_to_string({_token_sql(_NAME)}, ' ') AS tokens FROM part")
def name_tokens(t):
    distinct = t["part"].select(F.expr(_NAME).alias("name")).distinct()
    return distinct.select("name", F.array_join(names.name_tokens(F.col("name")), " ").alias("tokens"))


_LEFT = "p_name || CASE WHEN p_size % 2 = 0 THEN ' B' ELSE '' END"
_RIGHT = "p_name || CASE WHEN p_size % 3 = 0 THEN ' U21' WHEN p_size % 5 = 0 THEN ' reserves' ELSE '' END"


@query("SELECT p_partkey FROM part WHERE (p_size % 2 = 0) = (p_size % 3 = 0 OR p_size % 5 = 0)")
def reserve_guard(t):
    both = t["part"].select("p_partkey", F.expr(_LEFT).alias("a"), F.expr(_RIGHT).alias("b"))
    marked = [names.has_reserve_marker(names.split_words(F.lower(c))) for c in ("a", "b")]
    return both.where(marked[0] == marked[1]).select("p_partkey")


@query(r"""
    WITH turns AS (SELECT conv_id, turn, list_distinct(list_filter(string_split_regex(lower(text), '\s+'), lambda w: w != '')) AS words FROM conversations)
    SELECT a.conv_id, a.turn, round(len(list_intersect(a.words, b.words))
        / nullif(len(list_distinct(list_concat(a.words, b.words))), 0)::double, 9) AS similarity
    FROM turns a JOIN turns b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def token_jaccard_match(t):
    words = F.array_distinct(names.split_words(F.lower("text")))
    turns = t["conversations"].select("conv_id", "turn", words.alias("words"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("words").alias("next_words"))
    score = F.round(matching.jaccard(F.col("words"), F.col("next_words")), 9)
    return turns.join(following, ["conv_id", "turn"], "inner").select("conv_id", "turn", score.alias("similarity"))


@query("""
    SELECT search, page_id, title FROM (
        SELECT page_id // 5 AS search, page_id, page_id % 5 + 1 AS rank,
            CASE WHEN page_id % 2 = 0 THEN '2026–27 ' ELSE '2025–26 ' END || url AS title,
            CASE page_id // 5 % 3 WHEN 0 THEN 'example.net' WHEN 1 THEN 'example.com' ELSE 'example.org' END AS word FROM pages)
    WHERE contains(title, '2026–27') AND contains(lower(title), word)
    QUALIFY row_number() OVER (PARTITION BY search ORDER BY rank) = 1""")
def candidate_title_match(t):
    key = F.col("page_id")
    search = F.floor(key / 5)
    hits = t["pages"].select(
        search.alias("search"), "page_id", (key % 5 + 1).alias("rank"), F.lit("2026–27").alias("season"),
        F.concat(F.when(key % 2 == 0, "2026–27 ").otherwise("2025–26 "), F.col("url")).alias("title"),
        F.concat(F.lit("FC "), F.when(search % 3 == 0, "example.NET").when(search % 3 == 1, "example.COM").otherwise("example.ORG")).alias("name"),
    )
    return matching.pick_candidate(hits, ["search"], "rank", "title", "season", "name").select("search", "page_id", "title")


_LINKS = "<li><a[^>]*>([^<]*)</a>"


@query(f"""
    SELECT page_id, cast(nullif(list_position(list_transform(regexp_extract_all(html, '{_LINKS}', 1), lambda h: contains(lower(h), 'er')), true), 0) - 1 AS int) AS section
    FROM pages""")
def first_section(t):
    headings = F.regexp_extract_all("html", F.lit(_LINKS), F.lit(1))
    return t["pages"].select("page_id", matching.first_section(headings, "ER").alias("section"))


def _pages_with_table(t):
    """Each page with a transfer table in front of its own markup."""
    key = F.col("page_id")

    def club(mod: int):
        return F.concat(F.lit("Club "), (key % mod).cast("string"))

    table = F.concat(
        F.lit('<table class="wikitable sortable"><tr><th>Player</th><th>Transfer from</th><th>Fee</th></tr><tr><td rowspan="2"><a href="'),
        F.col("url"), F.lit('">P'), key.cast("string"), F.lit("</a></td><td>"), club(7), F.lit("<sup> [a]</sup></td><td>€"),
        (key % 90).cast("string"), F.lit("m</td></tr><tr><td>"), club(5), F.lit("</td><td>Free</td></tr>"),
        F.lit('<tr><td colspan="2">Q'), key.cast("string"), F.lit("</td><td>Loan</td></tr></table>"),
    )
    return t["pages"].select("page_id", F.concat(table, F.col("html")).alias("html"))


_CELLS = """
    SELECT page_id, 0 AS table_no, row_no, col_no, CASE col_no WHEN 0 THEN 'Player' WHEN 1 THEN 'Transfer from' ELSE 'Fee' END AS header,
        CASE WHEN col_no = 0 THEN CASE WHEN row_no = 3 THEN 'Q' ELSE 'P' END || page_id
            WHEN col_no = 1 THEN CASE row_no WHEN 1 THEN 'Club ' || (page_id % 7) || '[a]' WHEN 2 THEN 'Club ' || (page_id % 5) ELSE '' END
            ELSE CASE row_no WHEN 1 THEN '€' || (page_id % 90) || 'm' WHEN 2 THEN 'Free' ELSE 'Loan' END END AS text,
        CASE WHEN col_no = 0 AND row_no < 3 THEN url END AS href
    FROM pages, (VALUES (1), (2), (3)) r(row_no), (VALUES (0), (1), (2)) c(col_no)"""


@query(_CELLS)
def html_tables(t):
    return html.html_tables(_pages_with_table(t), ["page_id"], "html")


@query("""
    SELECT page_id, 0 AS table_no, row_no, 'in' AS direction, '' AS date, CASE WHEN row_no = 3 THEN 'Q' ELSE 'P' END || page_id AS player_name,
        CASE WHEN row_no < 3 THEN url_decode(url) END AS player_wiki_title,
        CASE row_no WHEN 1 THEN 'Club ' || (page_id % 7) || '[a]' WHEN 2 THEN 'Club ' || (page_id % 5) ELSE '' END AS other_club_name,
        CASE row_no WHEN 1 THEN 'Transfer' WHEN 2 THEN 'Free transfer' ELSE 'Loan' END AS transfer_type,
        CASE WHEN row_no = 1 THEN '€' || (page_id % 90) || 'm' END AS fee_text
    FROM pages, (VALUES (1), (2), (3)) r(row_no)""")
def page_moves(t):
    return html.move_rows(html.html_rows(_pages_with_table(t), ["page_id"], "html"), ["page_id"])


_MARKERS = ", ".join(f"'{m}'" for m in names.RESERVE_MARKERS)

# All pairs of one block are scored. The longest common subsequence of two rests is built up character by character:
# `line[j + 1]` is its length over the characters of `a` so far and the first j of `b`.
_FUZZY = f"""
    WITH RECURSIVE sides AS (
        SELECT p_partkey, p_brand, p_size, true AS is_left, p_name || ' ' || p_type AS name FROM part
        UNION ALL SELECT p_partkey, p_brand, p_size, false, {{candidate}} FROM part),
    named AS (SELECT *, list_sort(list_distinct({_token_sql("name")})) AS tokens FROM sides),
    marked AS (SELECT *, len(list_intersect(tokens, [{_MARKERS}])) > 0 AS reserve FROM named),
    met AS (
        SELECT l.p_partkey, l.tokens AS x, r.tokens AS y, r.p_partkey AS other, r.name AS candidate
        FROM marked l JOIN marked r USING (p_brand, p_size, reserve) WHERE l.is_left AND NOT r.is_left AND len(l.tokens) > 0 AND len(r.tokens) > 0),
    split AS (
        SELECT x, y, array_to_string(list_sort(list_intersect(x, y)), ' ') AS common,
            array_to_string(list_filter(x, lambda w: NOT list_contains(y, w)), ' ') AS a,
            array_to_string(list_filter(y, lambda w: NOT list_contains(x, w)), ' ') AS b
        FROM (SELECT DISTINCT x, y FROM met)),
    rests AS (SELECT DISTINCT a, b FROM split),
    grown AS (
        SELECT a, b, 0 AS i, list_transform(range(len(b) + 1), lambda j: 0::BIGINT) AS line FROM rests
        UNION ALL
        SELECT a, b, i + 1, list_reduce(
            list_concat([[0::BIGINT]], list_transform(range(1, len(b) + 1), lambda j: [j])),
            lambda done, j: list_append(done, CASE WHEN a[i + 1] = b[j[1]] THEN line[j[1]] + 1 ELSE greatest(line[j[1] + 1], done[len(done)]) END))
        FROM grown WHERE i < len(a)),
    sized AS (
        SELECT s.*, g.line[len(s.b) + 1] AS lcs, len(common) AS c, len(common) + (common <> '')::INT + len(s.a) AS m, len(common) + (common <> '')::INT + len(s.b) AS n
        FROM split s JOIN grown g ON g.a = s.a AND g.b = s.b AND g.i = len(s.a)),
    scored AS (
        SELECT x, y, CASE WHEN common <> '' AND (a = '' OR b = '') THEN 1.0::DOUBLE
            WHEN common = '' THEN 1.0::DOUBLE - (len(a) + len(b) - 2 * lcs)::DOUBLE / (m + n)
            ELSE greatest(1.0::DOUBLE - (len(a) + len(b) - 2 * lcs)::DOUBLE / (m + n), 1.0::DOUBLE - (m - c)::DOUBLE / (c + m), 1.0::DOUBLE - (n - c)::DOUBLE / (c + n)) END AS score
        FROM sized),
    best AS (
        SELECT p_partkey, candidate, score FROM met JOIN scored USING (x, y)
        QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, other, candidate) = 1)
    SELECT p_partkey, name, p_brand, p_size, CASE WHEN round(score, 3) >= 0.75 THEN candidate END AS matched_name,
        CASE WHEN round(score, 3) >= 0.75 THEN round(score, 3) END AS score, CASE WHEN round(score, 3) >= 0.75 THEN 'auto' ELSE 'rejected' END AS source,
        candidate AS best_name, round(score, 3) AS best_score
    FROM marked LEFT JOIN best USING (p_partkey) WHERE is_left"""


def _fuzzy(t, candidate):
    block = ["p_brand", "p_size"]
    left = t["part"].select("p_partkey", *block, F.concat_ws(" ", "p_name", "p_type").alias("name"))
    right = t["part"].select("p_partkey", *block, candidate.alias("candidate"))
    return matching.fuzzy_block_match(left, right, block, "p_partkey", "name", "candidate", "p_partkey")


@query(_FUZZY.replace("{candidate}", "p_name || 's ' || left(p_type, 4)"))
def fuzzy_block_match(t):
    return _fuzzy(t, F.concat(F.col("p_name"), F.lit("s "), F.left("p_type", F.lit(4))))


@query(_FUZZY.replace("{candidate}", "reverse(p_name) || ' ' || right(p_type, 3) || p_partkey % 9"))
def fuzzy_best_miss(t):
    """Names that are mostly too far from any candidate: the best miss of each and its score."""
    return _fuzzy(t, F.concat(F.reverse("p_name"), F.lit(" "), F.right("p_type", F.lit(3)), (F.col("p_partkey") % 9).cast("string")))
