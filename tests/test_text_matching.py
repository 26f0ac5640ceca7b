import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from tenure.functions import mentions, names, text
from tenure.functions.similarity import best_partners, lcs_length, token_set_ratio
from tenure.operators import html, matching
from tenure.sources.staging import stage_recent_moves


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("out")).first()["out"]


def test_markers_dates_and_fees(spark):
    c = F.col("x")
    assert one(spark, text.strip_markers(c), x="Monaco[a] [12]") == "Monaco "
    assert one(spark, text.parse_text_date(c), x="15 June 2026[c]") == dt.date(2026, 6, 15)
    assert one(spark, text.parse_text_date(c), x="5 June 2026") == dt.date(2026, 6, 5)
    assert one(spark, text.parse_text_date(c), x="June 2026") is None
    assert one(spark, text.fee_amount(c), x="€70.5 million") == Decimal("70500000")
    assert one(spark, text.fee_amount(c), x="1.2.3") is None
    assert one(spark, text.fee_amount(c), x=None) is None
    assert [one(spark, text.fee_currency(c), x=v) for v in ("€1m", "£1m", "$1m", "1m €", None)] == ["EUR", "GBP", "USD", None, None]
    assert one(spark, text.leading_int(c), x="38. Matchday") == 38
    assert one(spark, text.leading_int(c), x="Final") is None


def test_fee_cell_and_type(spark):
    c, k = F.col("x"), F.col("t")
    assert one(spark, text.first_amount(c), x="€70M + €10M variables") == "€70M"
    assert one(spark, text.first_amount(c), x="around € 70 million") == "€ 70 million"
    assert one(spark, text.first_amount(c), x="€70") is None
    cases = {("", "€70M + €10M variables"): "Transfer", ("", "Loan"): "Loan", ("", "Free"): "Free transfer", ("", "None"): "",
             ("", "-"): "", ("", ""): "", ("End of loan", "€1m"): "End of loan", ("", "Undisclosed"): ""}
    for (kind, cell), expected in cases.items():
        assert one(spark, text.infer_type(k, c), t=kind, x=cell) == expected
    assert one(spark, text.may_have_fee(k).cast("string"), t=" Loan ") == "false"
    assert one(spark, text.may_have_fee(k).cast("string"), t="Transfer") == "true"


def test_href_title(spark):
    assert one(spark, text.href_title(F.col("x")), x="/wiki/Jo%C3%A3o_F%C3%A9lix") == "João_Félix"
    assert one(spark, text.href_title(F.col("x")), x="/wiki/A+B") == "A+B"
    assert one(spark, text.href_title(F.col("x")), x="/wiki/100%_Wolf_%C3%A9") == "100%_Wolf_é"
    assert one(spark, text.href_title(F.col("x")), x="/wiki/100%_x") == "100%_x"


def windows(body, term, before=100, after=400):
    out, start = [], 0
    while True:
        idx = body.find(term, start)
        if idx == -1:
            return out
        out.append(body[max(0, idx - before) : idx + after])
        start = idx + 1


def test_mention_windows_equal_a_plain_scan(spark):
    rng = random.Random(7)
    cases = [("aaaa", "aa"), ("x(a.b)x(a.b)", "(a.b)"), ("Málaga\nMálaga " * 60, "Málaga"), ("none", "zz"), (r"a\Eb a\Eb", r"a\Eb")]
    cases += [("".join(rng.choice("ab .é€") for _ in range(1500)), "ab") for _ in range(3)]
    df = spark.createDataFrame([(i, b, t) for i, (b, t) in enumerate(cases)], "i int, body string, term string")
    got = {r["i"]: r["w"] for r in df.select("i", text.mention_windows(F.col("body"), F.col("term")).alias("w")).collect()}
    assert got == {i: windows(b, t) for i, (b, t) in enumerate(cases)}


def test_amount_near_a_mention(spark):
    said = F.col("x")
    club = F.lit("Real Madrid")
    body = "He left Real Madrid. " + "z" * 500 + " He joined Real Madrid for a fee reported to be between €6.2m and €10m."
    assert one(spark, text.mention_amount(said, club), x=body) == "€6.2m"
    assert one(spark, text.mention_amount(said, club), x="Real Madrid " + "z" * 500 + " €5m") is None
    assert one(spark, text.mention_amount(said, club), x="Signed £12 million by Real Madrid.") == "£12 million"
    assert one(spark, text.mention_amount(said, club), x="no club") is None


def test_names(spark):
    df = spark.createDataFrame([("Atlético de Madrid",), ("1.FC Köln (women)",), ("Manchester United FC",), ("Real Sociedad B",), ("The Club",)], "n string")
    got = {r["n"]: list(r["t"]) for r in df.select("n", names.name_tokens(F.col("n")).alias("t")).collect()}
    assert got == {
        "Atlético de Madrid": ["atletico", "de", "madrid"], "1.FC Köln (women)": ["1", "koln"],
        "Manchester United FC": ["man", "united"], "Real Sociedad B": ["real", "sociedad", "b"], "The Club": [],
    }


def test_candidate_title(spark):
    df = spark.createDataFrame(
        [(1, 1, "2026–27 Real Madrid CF season", "Villarreal CF"), (1, 2, "2026–27 Villarreal CF season", "Villarreal CF"),
         (2, 1, "2025–26 Villarreal CF season", "Villarreal CF"), (3, 4, "2026–27 Villarreal CF season", "Villarreal CF")],
        "q long, rank int, title string, name string",
    ).withColumn("season", F.lit("2026–27"))
    out = matching.pick_candidate(df, ["q"], "rank", "title", "season", "name")
    assert rows(out, "q", "rank") == [(1, 2), (3, 4)]
    assert rows(matching.pick_candidate(df, ["q"], "rank", "title", "season", "name", top=3), "q", "rank") == [(1, 2)]


def test_amounts_near_many_mentions_equal_one_by_one(spark):
    rng = random.Random(21)
    terms = ["Porto", "Porto B", "Real Madrid", "Real", "Ma(d", "Sporting CP", "é.", "", None, "B"]
    parts = [*[t for t in terms if t], "€5m", "£1.2 million", "for a fee of $30m", "fee", "nothing", "x" * 60, ". ", "\n", "€"]
    data = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(60)] + [(60, None), (61, "")]
    df = spark.createDataFrame(data, "i int, body string")
    many = df.select("i", mentions.mention_amounts(F.col("body"), F.array(*[F.lit(t) for t in terms])).alias("found"))
    got = {(r["i"], f["term"]): f["amount"] for r in many.collect() for f in r["found"]}
    single = df.select("i", *[text.mention_amount(F.col("body"), F.lit(t)).alias(f"t{k}") for k, t in enumerate(terms) if t]).collect()
    want = {(r["i"], t): r[f"t{k}"] for r in single for k, t in enumerate(terms) if t and r[f"t{k}"] is not None}
    assert got == want and len(want) > 100


def test_prefix_pattern_takes_the_longest_term():
    import re

    pattern = re.compile(mentions.prefix_pattern(["ab", "abcd", "abx", "b", "a.c"]))
    assert [m.group() for m in pattern.finditer("abcd abx abc b a.c axc")] == ["abcd", "abx", "ab", "b", "a.c"]
    long = "n" * 3000
    assert re.compile(mentions.prefix_pattern([long, long + "x"])).search(long + "x").group() == long + "x"


def test_first_section(spark):
    df = spark.createDataFrame([(1, ["History", "Summer transfers", "Transfers"]), (2, ["x", None]), (3, [])], "i int, h array<string>")
    assert rows(df.select("i", matching.first_section(F.col("h"), "transfer"))) == [(1, 1), (2, None), (3, None)]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for ch in a:
        prev = 0
        for j, other in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if ch == other else max(row[j], row[j - 1])
    return row[-1]


def test_similarity_rules():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(12))) for _ in range(2))
        assert lcs_length(a, b) == slow_lcs(a, b)
    assert token_set_ratio(["real", "madrid"], ["real"]) == 1.0
    assert token_set_ratio([], ["real"]) == 0.0
    assert token_set_ratio(["atletico", "madrid"], ["real", "madrid"]) < 0.75
    assert token_set_ratio(["fortuna", "dusseldorf"], ["fortuna", "koln"]) < 0.75


def name_pool(seed, n):
    rng = random.Random(seed)
    words = ["real", "madrid", "atletico", "sporting", "united", "city", "porto", "braga", "vila", "b", "u21", "de", "la", "rovers", "roverz", "portos"]

    def word():
        w = rng.choice(words)
        if rng.random() < 0.3:
            i = rng.randrange(len(w) + 1)
            w = w[:i] + rng.choice("abcdé") + w[i + rng.randrange(2):]
        return w

    return [" ".join(word() for _ in range(rng.randrange(1, 5))) for _ in range(n)]


def norm(n):
    import unicodedata
    plain = unicodedata.normalize("NFKD", n).encode("ascii", "ignore").decode().lower()
    return [names.WORD_ALIASES.get(w, w) for w in plain.split() if w not in names.GENERIC_WORDS]


@pytest.mark.parametrize("seed,threshold", [(1, 0.75), (2, 0.75), (3, 0.7), (4, 0.9)])
def test_fuzzy_match_equals_all_pairs(spark, seed, threshold):
    rng = random.Random(seed)
    left = [(i, n, rng.choice("XY")) for i, n in enumerate(name_pool(seed, 60))] + [(900, "FCSB", "X"), (901, "porto", "Z"), (902, "porto", None)]
    right = [(i, n, rng.choice("XY")) for i, n in enumerate(name_pool(seed + 100, 60))]
    l = spark.createDataFrame(left, "id long, name string, block string")
    r = spark.createDataFrame(right, "ord long, cand string, block string")
    out = matching.fuzzy_block_match(l, r, ["block"], "id", "name", "cand", "ord", threshold, {"FCSB": "Steaua"})
    found = out.collect()
    got = {x["id"]: (x["matched_name"], x["score"], x["source"]) for x in found}
    missed = {x["id"]: (x["best_name"], x["best_score"]) for x in found}
    marked = lambda ts: any(t in names.RESERVE_MARKERS for t in ts)
    assert set(got) == {i for i, _, b in left if b in ("X", "Y")}
    for i, n, b in left:
        if i >= 900:
            continue
        best, match = -1.0, None
        for _, cand, cb in right:
            if cb != b or marked(norm(n)) != marked(norm(cand)):
                continue
            score = token_set_ratio(norm(n), norm(cand))
            if score > best:
                best, match = score, cand
        if norm(n) and best > 0:
            assert missed[i] == (match, pytest.approx(best, abs=6e-4)), n
        if round(best, 3) >= threshold:
            assert got[i] == (match, pytest.approx(round(best, 3)), "auto"), n
        else:
            assert got[i] == (None, None, "rejected"), n
    assert got[900] == ("Steaua", 1.0, "manual")


def test_best_partners_equal_all_pairs():
    rng = random.Random(11)
    syllables = ["ba", "to", "ren", "lis", "mo", "ka", "shen", "dur", "x", "zq"]

    def name():
        return sorted({"".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 4))})

    for round_ in range(60):
        left, right = ([name() for _ in range(rng.randint(1, 30))] for _ in "lr")
        if round_ % 10 == 0:  # beyond 64 characters
            left.append(["q" * 80, "ab"])
            right.append(["q" * 70])
        scores, at, _ = best_partners(left, right)
        for i, tokens in enumerate(left):
            every = [token_set_ratio(tokens, other) for other in right]
            assert scores[i] == pytest.approx(max(every)) and at[i] == every.index(max(every))


def test_a_large_block_scores_few_pairs_and_spreads(spark, monkeypatch):
    """Chunks smaller than the block, names far from one another: the result is that of one chunk, bounds rule most pairs out."""
    rng = random.Random(12)
    pool = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(2)) for _ in range(1200)]
    l = spark.createDataFrame([(i, n, "X") for i, n in enumerate(pool[:600])], "id long, name string, block string")
    r = spark.createDataFrame([(i, n, "X") for i, n in enumerate(pool[600:] + pool[:50])], "ord long, cand string, block string")

    def run():
        out = matching.fuzzy_block_match(l, r, ["block"], "id", "name", "cand", "ord", 0.5)
        return sorted(tuple(x) for x in out.collect())

    whole = run()
    monkeypatch.setattr(matching, "LEFT_CHUNK", 37)
    monkeypatch.setattr(matching, "RIGHT_CHUNK", 90)
    assert run() == whole and len(whole) == 600
    assert all(x[-1] == 1.0 and x[5] == "auto" for x in whole if x[0] < 50)
    assert all(x[-2] is not None for x in whole)


PAGE = """
<table class="infobox"><tr><th>skip</th></tr><tr><td>me</td></tr></table>
<table class="wikitable sortable"><tbody>
<tr><th>Date</th><th>Player</th><th>{h}</th><th>Type</th><th>Fee</th></tr>
<tr><td rowspan="2">1 July 2026</td><td><a href="/wiki/Flag"><img></a><a href="/wiki/Jo%C3%A3o">João <b>F.</b></a><sup>[a]</sup></td><td>Porto</td><td></td><td>€70M + €10M variables</td></tr>
<tr><td>Rui</td><td><a href="/wiki/Braga">Braga</a></td><td>Loan</td><td></td></tr>
<tr><td colspan="2">wide</td><td>Vila</td></tr>
<tr><td>2 July 2026<td>open<td>Lens
</tbody></table>"""


def test_table_cells_with_spans(spark):
    grid = {row: [(c["text"], c["href"]) for c in cells] for _, row, cells, _ in html.page_rows(PAGE.format(h="From"))}
    assert grid[1] == [("1 July 2026", None), ("JoãoF.[a]", "/wiki/Jo%C3%A3o"), ("Porto", None), ("", None), ("€70M + €10M variables", None)]
    assert grid[2] == [("1 July 2026", None), ("Rui", None), ("Braga", "/wiki/Braga"), ("Loan", None), ("", None)]
    assert grid[3] == [("wide", None), ("", None), ("Vila", None), ("", None), ("", None)]
    assert grid[4] == [("2 July 2026", None), ("open", None), ("Lens", None), ("", None), ("", None)]


def test_rowspan_over_two_columns_repeats_in_both(spark):
    page = '<table class="wikitable"><tr><th>A</th><th>B</th><th>C</th></tr><tr><td rowspan="2" colspan="2">x</td><td>1</td></tr><tr><td>2</td></tr></table>'
    assert [c["text"] for _, _, cells, _ in html.page_rows(page) for c in cells] == ["x", "", "1", "x", "x", "2"]


def test_broken_pages_stay_with_themselves(spark):
    head = '<table class="wikitable"><tr><th>Player</th><th>From</th></tr>'
    nested = head + "<tr><td>Rui<table><tr><td>x</td></tr></table></td><td>Club</td></tr></table>"
    pages = [(1, head + '<tr><td colspan="²">Ana</td><td>Porto</td></tr></table>'), (2, "<![foo[x]]>" + head + "<tr><td>Eva</td><td>Lens</td></tr></table>"),
             (3, nested), (4, head + '<tr><td rowspan="2" colspan="5000000">Wide</td></tr><tr><td>gone</td></tr></table>'), (5, None)]
    read = html.html_rows(spark.createDataFrame(pages, "page_id long, html string"), ["page_id"], "html")
    assert rows(html.move_rows(read, ["page_id"]), "page_id", "player_name", "other_club_name")[:1] == [(1, "Ana", "Porto")]
    assert (3, "Ruix", "Club") in rows(html.move_rows(read, ["page_id"]), "page_id", "player_name", "other_club_name")
    rejects = {r["page_id"]: (r["dropped"], r["error"]) for r in html.page_rejects(read, ["page_id"]).collect()}
    assert rejects[4] == (1, None) and set(rejects) <= {2, 4} and (2 not in rejects or rejects[2][1])


def test_last_column_of_a_header_holds_the_value(spark):
    page = '<table class="wikitable"><tr><th>Player</th><th>To</th><th>Left from</th><th>Player</th></tr><tr><td>a</td><td>b</td><td>c</td><td>d</td></tr></table>'
    read = html.html_rows(spark.createDataFrame([(1, page)], "page_id long, html string"), ["page_id"], "html")
    assert rows(html.move_rows(read, ["page_id"]), "direction", "player_name", "other_club_name") == [("in", "d", "c")]


@pytest.mark.parametrize("header,direction", [
    ("From", "in"), ("Transfer from", "in"), ("Transferred to", "out"), ("Moving to", "out"), ("Loaned from", "in"), ("Returning to", "out"), ("Until", None),
])
def test_move_rows_by_header(spark, header, direction):
    pages = spark.createDataFrame([(5, PAGE.format(h=header))], "page_id long, html string")
    got = html.move_rows(html.html_rows(pages, ["page_id"], "html"), ["page_id"])
    if direction is None:
        assert got.count() == 0
        return
    first, second = got.where("row_no < 3").orderBy("row_no").collect()
    assert (first["direction"], first["player_wiki_title"], first["transfer_type"], first["fee_text"]) == (direction, "João", "Transfer", "€70M")
    assert (second["date"], second["player_name"], second["other_club_name"], second["transfer_type"], second["fee_text"]) == ("1 July 2026", "Rui", "Braga", "Loan", None)
    # 'wide' spans date and player, so row 3 has no player.
    assert {r["row_no"] for r in got.collect()} == {1, 2, 4}


def test_prose_lookup_goes_to_the_destination(spark):
    moves = spark.createDataFrame(
        [("Own", "in", "Other", "Transfer", None, "T1"), ("Own", "out", "Other", "Transfer", None, "T2"), ("Own", "in", "Other", "Loan", None, "T3"),
         ("Own", "in", "Other", "Transfer", "€1m", "T4"), ("Own", "in", "Other", "", None, None)],
        "club_name string, direction string, other_club_name string, transfer_type string, fee_text string, player_wiki_title string",
    )
    assert rows(html.needs_prose_fee(moves, "club_name"), "player_wiki_title", "destination_club") == [("T1", "Own"), ("T2", "Other")]


def test_staged_moves_keep_undated_twin(spark):
    raw = spark.createDataFrame(
        [(1, "Own", "26/27", "out", "15 June 2026[c]", "Travis[a]", "T", "Aarau[b]", "", None, "p"),
         (1, "Own", "26/27", "out", "15 June 2026", "Travis", "T", "Aarau", "Loan", "€1m", "p"),
         (1, "Own", "26/27", "out", "", "Travis", "T", "Aarau", "Loan", None, "p")],
        "club_id int, club_name string, season string, direction string, date string, player_name string, player_wiki_title string, "
        "other_club_name string, transfer_type string, fee_text string, source_page string",
    )
    assert rows(stage_recent_moves(raw), "player_name", "other_club_name", "transfer_date", "transfer_type", "fee_amount") == [
        ("Travis", "Aarau", None, "Loan", None), ("Travis", "Aarau", dt.date(2026, 6, 15), "Loan", Decimal("1000000.00"))]
    assert stage_recent_moves(raw, drop_undated=True).count() == 1


def test_html_rows_keep_keys_as_they_are(spark):
    page = '<table class="wikitable"><tr><th>Player</th></tr>' + "<tr><td>P</td></tr>" * 6000 + "</table>"
    pages = spark.createDataFrame([(None, page), (2**53 + 1, page), (3, None)], "page_id long, html string").coalesce(1)
    found = html.html_rows(pages, ["page_id"], "html").groupBy("page_id").agg(F.count_distinct("row_no").alias("n"), F.sum(F.size("cells")).alias("cells"))
    assert {tuple(r) for r in found.collect()} == {(None, 6000, 6000), (2**53 + 1, 6000, 6000)}


def test_mentions_hold_one_text_at_a_time():
    import re
    import tracemalloc

    import pyarrow as pa

    from tenure.functions import mentions, text

    texts = pa.array([f"and for a fee of £{i}.5m " + "é x " * 5000 for i in range(500)] + [None])
    wanted = pa.array([["and"]] * 500 + [["and"]])
    tracemalloc.start()
    got = mentions.scanned(texts, wanted, [re.compile(text.AMOUNT, re.IGNORECASE)], 100, 400)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(x) for x in got.to_pylist()] == [1] * 500 + [0] and got[7].as_py()[0]["amount"] == "£7.5m"
    assert peak < 5_000_000, peak  # the texts take 12 MB as UTF-8
