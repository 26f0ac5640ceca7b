"""PII (operator 10): detected entities get keyed surrogates of their own type and format.

Entities are found by one pattern: e-mail addresses, card numbers, social security numbers, phone numbers,
IPv4 addresses, and names behind a title that tells the gender. The words of such names are then looked up in the rest
of the same text, where they stand without a title. Each entity has a canonical form (letters in
lower case, digits without separators, each name by itself), and each distinct canonical form gets one
surrogate, a keyed hash laid into the same kind of form: digits for digits, Latin, Greek or Cyrillic letters
for letters of that script, a given name of the same gender and script. Mentions of one entity share its
surrogate in all documents, laid into the format of each mention. Surrogates that collide with one another or
with an entity of the table are drawn again, until all are distinct.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.llm.spans import match_spans, once
from tenure.llm.tables import written

# Patterns. Repetitions are bounded or of one class and without way back, so no text makes the matcher recurse or crawl.
#: A host name has 127 labels at most, by the length that names may have.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,63}(?![A-Za-z0-9-])"
CARD = r"(?<![\d+])\d(?:[ -]?\d){12,18}(?![\d])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
#: With a country code; from a trunk zero on, but no date; in groups of 3-3-4 or in one; Spanish groups of nine digits.
PHONES = [
    r"(?<![\w+])\+\d(?:[ ./()-]{0,2}\d){7,14}(?!\d)",
    r"(?<![\w+.-])(?!\d{2}([./-])\d{2}\1(?:19|20)\d{2}(?!\d))\(?0\d(?:[ ./()-]{0,2}\d){7,10}(?!\d)",
    r"(?<![\w+])(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
    r"(?<![\w+.-])[2-9]\d{2}[2-9]\d{6}(?![\w-]|\.\d)",
    r"(?<![\w+.-])[6-9]\d{2}(?:[ .-]\d{3}[ .-]\d{3}|[ .-]\d{2}[ .-]\d{2}[ .-]\d{2}|\d{6})(?![\w-]|[ .]\d)",
]
PHONE = "|".join(PHONES)
#: Country codes of the languages that write numbers with or without them.
CODES = r"^\+(?:1|33|34|44|49)"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"
MALE_TITLES = ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Señorita", "Госпожа", "Κυρία"]
TITLES = MALE_TITLES + FEMALE_TITLES
MALE, FEMALE = (f"(?:{'|'.join(t)})" for t in (MALE_TITLES, FEMALE_TITLES))
#: A possessive ending is no part of a name.
WORD = r"\p{Lu}(?:[\p{L}-]++|'(?!s(?!\p{L}))){1,12}+"
#: Names of up to MOST_WORDS words; what is capitalised beyond is taken for other text.
MOST_WORDS = 12
NAME = rf"(?<!\p{{L}})(?:{MALE}|{FEMALE})\.? {WORD}(?: {WORD}){{0,{MOST_WORDS - 1}}}"
PATTERN = "|".join([EMAIL, SSN, CARD, IP, PHONE, NAME])
KINDS = ["email", "ssn", "card", "phone", "ip", "name"]

# Given names by script and gender.
GIVEN = {
    ("latin", "m"): ["adrian", "bruno", "carlo", "dario", "emil", "felix", "georg", "hugo", "ivan", "jonas", "karl", "leon", "marco", "noel", "oskar", "paulo", "rafael", "simon", "tomas", "victor"],
    ("latin", "f"): ["agnes", "bianca", "carla", "diana", "elena", "flora", "greta", "helga", "irene", "julia", "klara", "laura", "marta", "nora", "olivia", "petra", "rosa", "sofia", "teresa", "vera"],
    ("greek", "m"): ["ανδρεασ", "γιωργοσ", "δημητρησ", "κωστασ", "νικοσ", "παυλοσ", "σπυροσ", "φιλιπποσ"],
    ("greek", "f"): ["αννα", "βασιλικη", "γεωργια", "ελενη", "ζωη", "κατερινα", "μαρια", "σοφια"],
    ("cyrillic", "m"): ["андрей", "борис", "виктор", "дмитрий", "егор", "иван", "леонид", "павел"],
    ("cyrillic", "f"): ["анна", "вера", "дарья", "елена", "ирина", "марина", "ольга", "софья"],
}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "greek": "αβγδεζηθικλμνξοπρστυφχψω", "cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя"}
SYLLABLES = {
    "latin": ["ba", "de", "fi", "go", "ha", "ke", "li", "mo", "na", "pe", "ri", "so", "tu", "va", "we", "zi"],
    "greek": ["βα", "δε", "φι", "γο", "χα", "κε", "λι", "μο", "να", "πε", "ρι", "σο", "τυ", "ξα", "θε", "ζι"],
    "cyrillic": ["ба", "де", "фи", "го", "ха", "ке", "ли", "мо", "на", "пе", "ри", "со", "ту", "ва", "же", "зи"],
}
#: Draws that keep the exact length. From then on the form grows by a sign per draw, so that a place is always found.
EXACT_DRAWS = 8
_MENTIONS = "array<struct<kind:string,canonical:string,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def kind_of(value: Column) -> Column:
    """The type of a match of PATTERN, told by its form."""
    return (
        F.when(value.contains("@"), "email").when(value.rlike(r"^\p{Lu}\p{L}"), "name").when(value.rlike(rf"^{IP}$"), "ip")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(value.rlike(r"^[\d -]+$") & (F.length(_digits(value)) >= 13), "card").otherwise("phone")
    )


def script_of(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsGreek}"), "greek").when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _mentions(value: Column, names: Column) -> Column:
    """The entities in one match: a name gives one per word behind its title, all else gives one.

    A name without a title is one of `names`, the entities of the names of the text.
    """
    kind = kind_of(value)
    words = F.split(value, " ")
    gender = F.when(value.rlike(rf"^{FEMALE}(?!\p{{L}})"), "f").otherwise("m")
    n = F.size(words)
    given = lambda w, i: (i > 0) & (i < n - 1)
    titled = F.filter(
        F.transform(words, lambda w, i: F.struct(F.when(i == 0, "title").when(given(w, i), F.concat(F.lit("given-"), gender)).otherwise("surname").alias("kind"), F.when(i == 0, w).otherwise(F.lower(w)).alias("canonical"), w.alias("value"))),
        lambda m: m["value"] != "",
    )
    bare = F.transform(F.slice(F.filter(names, lambda m: m["canonical"] == F.lower(value)), 1, 1), lambda m: F.struct(m["kind"], m["canonical"], value.alias("value")))
    # A phone number is known by its last ten digits behind the country code or trunk zero, which may be left out.
    number = F.regexp_replace(_digits(F.regexp_replace(value, CODES, "")), "^0+(?=\\d{8})", "")
    canonical = F.when(kind == "email", F.lower(value)).when(kind == "ip", value).when(kind == "phone", F.right(number, F.lit(10))).otherwise(_digits(value))
    single = F.array(F.struct(kind.alias("kind"), canonical.alias("canonical"), value.alias("value")))
    return F.when((kind == "name") & (n == 1), bare.cast(_MENTIONS)).when(kind == "name", titled.cast(_MENTIONS)).otherwise(single.cast(_MENTIONS))


def _text_names(spans: Column) -> Column:
    """The distinct entities of the names among the matches of a text."""
    titled = F.flatten(F.transform(F.filter(spans, lambda s: kind_of(s["value"]) == "name"), lambda s: _mentions(s["value"], F.array().cast(_MENTIONS))))
    return F.array_distinct(F.filter(titled, lambda m: m["kind"] != "title"))


def _with_names(names: Column) -> Column:
    """PATTERN and the words of `names`, as they stand, capitalised or in upper case, but not before an at sign."""
    forms = F.array_distinct(F.flatten(F.transform(names, lambda m: F.array(m["value"], F.initcap(m["value"]), F.upper(m["value"])))))
    # Longer ones first: of two names with one beginning the whole word is wanted.
    ordered = F.reverse(F.array_sort(F.transform(forms, lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))))
    return F.concat(F.lit(PATTERN + r"|(?<![\p{L}])(?=\p{Lu})(?:"), F.array_join(F.transform(ordered, lambda x: x["w"]), "|"), F.lit(r")(?![\p{L}]|[A-Za-z0-9._%+-]*+@)"))


def _draw(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """An array of hash values from 0 to 65535, one per character and 24 to spare."""
    blocks = F.sequence(F.lit(0), F.floor((F.length(canonical) + 24) / 16).cast("int"))
    stream = F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("|", F.lit(key), kind, canonical, attempt, b), 256)), "")
    return F.transform(F.sequence(F.lit(0), F.length(canonical) + 23), lambda i: F.conv(F.substring(stream, i * 4 + 1, F.lit(4)), 16, 10).cast("int"))


def _pick(options: list[str] | str, at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (at % len(options) + 1).cast("int"))


def surrogate(kind: Column, canonical: Column, attempt: Column, draws: Column) -> Column:
    """The surrogate of a canonical form, itself in canonical form, out of its hash values."""
    draw = lambda i: F.element_at(draws, (i + 1).cast("int"))
    extra = F.greatest(attempt - EXACT_DRAWS, F.lit(0))
    more = lambda signs: F.array_join(F.transform(F.when(extra > 0, F.sequence(F.lit(1), extra)).otherwise(F.array().cast("array<int>")), lambda i: _pick(signs, draw(F.length(canonical) + i % 20))), "")
    chars = F.split(canonical, "")
    last_label = F.length(canonical) - F.length(F.substring_index(canonical, ".", -1))
    address = F.concat(more(LETTERS["latin"]), F.array_join(F.transform(chars, lambda c, i: F.when(i >= last_label, c).when(c.rlike("[a-z]"), _pick(LETTERS["latin"], draw(i))).when(c.rlike("[0-9]"), _pick("0123456789", draw(i))).otherwise(c)), ""))
    # The first digit tells the kind of card, and stays; elsewhere it is not zero, so no number gets shorter.
    digits = F.transform(chars, lambda c, i: F.when((i == 0) & (kind == "card"), c).when(i == 0, _pick("23456789", draw(i))).otherwise(_pick("0123456789", draw(i))))
    checked = F.when((kind == "card") & _luhn(chars), _with_check_digit(digits)).otherwise(digits)
    number = F.concat(more("0123456789"), F.array_join(checked, ""))
    octet = lambda c, i: F.when(attempt > EXACT_DRAWS, draw(i) % 256).when(F.length(c) == 1, draw(i) % 9 + 1).when(F.length(c) == 2, draw(i) % 90 + 10).otherwise(draw(i) % 156 + 100)
    ip = F.array_join(F.transform(F.split(canonical, r"\."), lambda c, i: octet(c, i).cast("string")), ".")
    script = script_of(canonical)
    by_script = lambda make: F.when(script == "greek", make("greek")).when(script == "cyrillic", make("cyrillic")).otherwise(make("latin"))
    syllables = lambda s: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2) + extra), lambda i: _pick(SYLLABLES[s], draw(i % 20))), "")
    # From the second draw on, a given name gets a second one behind a hyphen, then more syllables.
    name = lambda g: by_script(lambda s: F.concat(_pick(GIVEN[s, g], draw(F.lit(0))), F.when(attempt == 0, "").otherwise(F.concat(F.lit("-"), _pick(GIVEN[s, g], draw(F.lit(1))), F.when(attempt > 2, F.concat(F.lit("-"), syllables(s))).otherwise("")))))
    return (
        F.when(kind == "title", canonical).when(kind == "email", address).when(kind == "ip", ip)
        .when(kind == "given-m", name("m")).when(kind == "given-f", name("f")).when(kind == "surname", by_script(syllables)).otherwise(number)
    )


def _luhn_sum(digits: Column, skip: int) -> Column:
    """The Luhn sum of an array of digits; `skip` 1 if the check digit is not among them."""
    ordered = F.reverse(digits)
    values = F.transform(ordered, lambda d, i: F.when((i + skip) % 2 == 1, (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(values, F.lit(0), lambda x, y: x + y)


def _luhn(digits: Column) -> Column:
    return _luhn_sum(digits, 0) % 10 == 0


def _with_check_digit(digits: Column) -> Column:
    body = F.slice(digits, 1, F.greatest(F.size(digits) - 1, F.lit(1)))
    return F.concat(body, F.array(((10 - _luhn_sum(body, 1) % 10) % 10).cast("string")))


def lay(kind: Column, value: Column, replacement: Column) -> Column:
    """`replacement` in the format of `value`: separators of numbers, upper case of letters."""
    chars = F.split(value, "")
    count = F.length(_digits(value))
    spare = F.length(replacement)
    # Digits are laid from the right; leading ones without a counterpart (a country code) stay.
    rank = lambda i: F.length(_digits(F.substring(value, i + 1, F.length(value))))
    numbered = F.transform(chars, lambda c, i: F.when(c.rlike(r"\d") & (rank(i) <= spare), F.substring(replacement, spare - rank(i) + 1, F.lit(1))).otherwise(c))
    longer = F.when(spare > count, F.substring(replacement, F.lit(1), spare - count)).otherwise("")
    cased = F.when((F.upper(value) == value) & (F.length(value) > 1) & (F.lower(value) != value), F.upper(replacement)).when(kind == "email", replacement).otherwise(F.initcap(F.replace(replacement, F.lit("-"), F.lit(" "))))
    return (
        F.when(kind.isin("card", "ssn", "phone"), F.concat(longer, F.array_join(numbered, "")))
        .when(kind.isin("ip", "title"), replacement).when(kind == "email", cased).otherwise(F.replace(cased, F.lit(" "), F.lit("-")))
    )


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) for distinct (kind, canonical), all surrogates of a kind distinct.

    Each round draws for the entities still without one. A draw counts if no entity of the table has that form,
    no settled entity has it as its surrogate, and no entity with a smaller canonical form drew it in this round.
    Titles stay as they are.
    """
    entities = written(entities)
    taken = entities.select("kind", F.col("canonical").alias("surrogate"))
    pending = entities.filter("kind <> 'title'")
    settled = entities.filter("kind = 'title'").withColumn("surrogate", F.col("canonical"))
    attempt = 0
    while True:
        form = F.col("kind"), F.col("canonical"), F.lit(attempt)
        drawn = pending.select("*", once(_draw(*form, key)).alias("_draws")).select("kind", "canonical", surrogate(*form, F.col("_draws")).alias("surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        good = written(first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "canonical", "surrogate"))
        settled = settled.unionByName(good)
        taken = taken.unionByName(good.select("kind", "surrogate"))
        pending = written(pending.join(good, ["kind", "canonical"], "left_anti"))
        if pending.isEmpty():
            return settled
        attempt += 1


def _count(kinds: Column, kind: str) -> Column:
    return F.size(F.filter(kinds, lambda k: k == kind)).cast("long")


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """`docs` with all entities of the text replaced, and `pii_counts`, a map of kind to mentions.

    A null text stays null and an empty one empty, with an empty map. Repeated rows get the same surrogates.
    Ids are not used, so they may be null or repeated. A clashing pii_counts column is replaced. Whatever holds
    a third of all rows, an entity is one row of the surrogate table, and rows meet it through a join that
    adaptive execution splits.
    """
    columns = [c for c in docs.columns if c != "pii_counts"]
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("text").alias("text"))  # so that no name of the caller's can clash
    text = F.coalesce("text", F.lit(""))
    # Every entity has a digit, an at sign or a title, which is quickly told.
    cue = reduce(or_, [text.contains(t) for t in TITLES], text.rlike("[0-9@]"))
    has = cue & text.rlike(PATTERN)
    counts = "map<string,long>"
    clean = rows.filter(~has).withColumn("pii_counts", F.create_map().cast(counts))
    found = rows.filter(has).withColumn("_row", F.monotonically_increasing_id()).withColumn("_spans", once(match_spans(text, PATTERN))).withColumn("_names", once(_text_names(F.col("_spans"))))
    spans = F.when(F.size("_names") == 0, F.col("_spans")).otherwise(match_spans(text, _with_names(F.col("_names"))))
    # The numbers of the rows must not change once they are given out, hence the written copy.
    marked = written(found.withColumn("_spans", spans))
    mentions = marked.select("_row", "_names", F.posexplode("_spans").alias("_at", "_span")).select("_row", "_at", F.posexplode(_mentions(F.col("_span.value"), F.col("_names"))).alias("_part", "_m")).select("_row", "_at", "_part", "_m.*")
    table = written(surrogate_table(mentions.select("kind", "canonical").distinct(), key))
    laid = mentions.join(table, ["kind", "canonical"]).select("_row", "_at", "_part", "kind", lay(F.col("kind"), F.col("value"), F.col("surrogate")).alias("_new"))
    # A match of several entities (title, given name, surname) is put together with spaces again.
    of_row = laid.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_at", "_part", "kind", "_new"))).alias("_all"))
    joined = F.transform("_spans", lambda s, i: F.array_join(F.transform(F.filter("_all", lambda m: m["_at"] == i), lambda m: m["_new"]), " "))
    ends = F.concat(F.array(F.lit(0)), F.transform("_spans", lambda s: s["end"]))
    gaps = F.zip_with(F.slice(ends, 1, F.size("_spans")), "_spans", lambda a, s: F.substring("text", a + 1, s["start"] - a))
    tail = F.substring("text", F.element_at(ends, -1) + 1, F.length("text"))
    whole = F.concat(F.array_join(F.zip_with(gaps, joined, lambda g, n: F.concat(g, n)), ""), tail)
    kinds = F.transform("_spans", lambda s: kind_of(s["value"]))
    counted = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*(_count(kinds, kind) for kind in KINDS)))
    replaced = marked.join(of_row, "_row").withColumn("pii_counts", F.map_filter(counted, lambda _, n: n > 0)).withColumn("text", whole)
    done = clean.unionByName(replaced.select(*clean.columns))
    return done.select(*[F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in columns], "pii_counts")


def op10_surrogates(docs: DataFrame, key: str = "surrogate key") -> DataFrame:
    """doc_id, mentions in all and per kind, the digest of the new text and the new text of every document."""
    done = replace_pii(docs.select("doc_id", "text"), key)
    per_kind = [F.coalesce(F.col("pii_counts")[k], F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    total = F.aggregate(F.map_values("pii_counts"), F.lit(0).cast("long"), lambda x, y: x + y).alias("n_pii")
    return done.select("doc_id", total, *per_kind, F.sha2("text", 256).alias("text_sha256"), "text")
