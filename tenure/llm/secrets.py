"""Secret scans (operator 3): fixed patterns, and a likelihood ratio of two character Markov models.

The patterns find assignments, access keys and long hexadecimal strings. They also label the training
samples: what they find are random strings, the words of documents without a find are ordinary identifiers.
Two first-order Markov models over characters are counted on bounded samples of both. A long run of key
characters that no pattern covers is a secret if the mean log-likelihood ratio of its transitions, random
against ordinary, exceeds a threshold, which grows for short strings. A run that is none is cut at its separators,
and neighbouring pieces that look more random than ordinary are judged together, so that a key is also found in a
path, a URL or a chain of assignments. Everything is column expressions; the models travel as one literal.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.llm.spans import fixed_array, match_spans
from tenure.llm.tables import in_sample

# Fixed patterns of the base rules, letters of the key names in either case.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8
#: Runs of key characters that the models judge; the lookbehind keeps the scan linear in long runs.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
#: Pieces of a run; separators stand at the head of the piece behind them.
PIECE = r"[/_=-]+[A-Za-z0-9+]*|[A-Za-z0-9+]+"
#: Words that the model of ordinary strings learns from: shorter than those that are judged.
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9_-]{6,15}(?![A-Za-z0-9+/_=-])"

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=.-"
STATES = len(ALPHABET) + 1
#: Documents of each label that the models are fitted on at most, drawn by a hash of id and text.
SAMPLE_MOST = 2000
THRESHOLD = 0.5
#: Shortest string that is judged; under SURE characters each missing one raises the threshold by STEEP.
LEAST, SURE, STEEP = 16, 20, 0.1
SMOOTHING = 10
_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _as_spans(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"))).cast(_SPANS)


def _none() -> Column:
    return F.array().cast(_SPANS)


def _only_if(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(_none())


def base_spans(text: Column) -> Column:
    """Spans of the base rules by start, then kind.

    Runs of hexadecimal digits and access keys are matched with their least length at once: a shorter run
    never holds a match, so the result equals matching all runs and dropping the short ones. Assignments are
    matched first and dropped after, because a short one uses up its text.
    """
    assigned = F.zip_with(match_spans(text, ASSIGN), F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))
    assigned = F.filter(assigned, lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    parts = [
        _only_if((text.contains(":") | text.contains("=")) & text.rlike(ASSIGN), _as_spans(assigned, "assign", 0)),
        _only_if(text.contains("AKIA") & text.rlike(ACCESS), _as_spans(match_spans(text, ACCESS), "access", 1)),
        _only_if(text.rlike(HEX), _as_spans(match_spans(text, HEX), "hex", 2)),
    ]
    return F.sort_array(F.concat(*parts))


def _transitions(values: DataFrame) -> DataFrame:
    """(a, b, n): how often state b follows state a in the strings of `value`."""
    chars = F.transform(F.split("value", ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.zip_with(F.slice(chars, 1, F.size(chars) - 1), F.slice(chars, 2, F.size(chars) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return values.filter(F.length("value") > 1).select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def train(docs: DataFrame, most: int = SAMPLE_MOST) -> list[float] | None:
    """Log-likelihood ratios of all transitions, row by row; None without an example of either label.

    The collected counts are bounded by the square of the alphabet.
    """
    text = F.coalesce("text", F.lit(""))
    spotted = docs.select("doc_id", text.alias("text")).withColumn("spans", base_spans(F.col("text")))
    counts = {r["found"]: r["n"] for r in spotted.groupBy((F.size("spans") > 0).alias("found")).agg(F.count("*").alias("n")).collect()}

    def sample(found: bool) -> DataFrame:
        # Twice as many as wanted by the hash alone, so that only these are put in order.
        share = min(1.0, 2 * most / counts.get(found, 1))
        some = spotted.filter(in_sample(F.lit(share), "doc_id", "text")).filter((F.size("spans") > 0) == found)
        return some.orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(most)

    cut = F.transform("spans", lambda s: F.substring("text", s["start"] + 1, s["end"] - s["start"]))
    # Of an assignment, the name in front is no part of the random string.
    values = F.transform(cut, lambda v: F.regexp_replace(v, r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?""", ""))
    random = sample(True).select(F.explode(values).alias("value"))
    plain = sample(False).select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("value"))
    logs = []
    for strings in (random, plain):
        rows = _transitions(strings).collect()
        if not rows:
            return None
        pairs = [[0] * STATES for _ in range(STATES)]
        for row in rows:
            pairs[row["a"]][row["b"]] += row["n"]
        # What follows a rare character is smoothed with how often characters follow at all.
        single = [sum(line[b] for line in pairs) + 0.5 for b in range(STATES)]
        share = [n / sum(single) for n in single]
        logs.append([[math.log((n + SMOOTHING * p) / (sum(line) + SMOOTHING)) for n, p in zip(line, share)] for line in pairs])
    return [round(r - p, 4) for random_line, plain_line in zip(*logs) for r, p in zip(random_line, plain_line)]


def _total_ratio(value: Column, ratios: list[float]) -> Column:
    """Sum of the log-likelihood ratios of the transitions of a string."""
    table = fixed_array(ratios, "double")
    states = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    steps = F.zip_with(F.slice(states, 1, F.size(states) - 1), F.slice(states, 2, F.size(states) - 1), lambda a, b: F.element_at(table, a * STATES + b + 1))
    return F.aggregate(steps, F.lit(0.0), lambda x, y: x + y)


def mean_ratio(value: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of the transitions of a string."""
    return _total_ratio(value, ratios) / F.greatest(F.length(value) - 1, F.lit(1))


def _is_secret(value: Column, mean: Column, threshold: float) -> Column:
    """Whether a string of this mean ratio is a secret. A short number is none."""
    short = F.greatest(F.lit(SURE) - F.length(value), F.lit(0))
    return (F.length(value) >= LEAST) & (mean > threshold + STEEP * short) & ((short == 0) | value.rlike("[A-Za-z]"))


def piece_spans(run: Column, ratios: list[float], threshold: float, is_free: Callable[[Column, Column], Column]) -> Column:
    """array<struct<start, end, value>>: the secrets between the separators of a run, in its own positions.

    Neighbouring free pieces of positive ratio make a chain, which is judged without the separators at its head.
    """

    def piece(m: Column) -> Column:
        word = F.regexp_replace(m["value"], "^[/_=-]+", "")
        head = F.length(m["value"]) - F.length(word)
        before = F.when(m["start"] > 0, F.substring(run, m["start"], head + 2)).otherwise(F.substring(run, F.lit(1), head + 1))
        return F.struct((m["start"] + head).alias("start"), m["end"].alias("end"), _total_ratio(before, ratios).alias("link"), _total_ratio(word, ratios).alias("inner"))

    # A last piece of no weight closes the last chain.
    closing = F.array(F.struct(F.length(run).alias("start"), F.length(run).alias("end"), F.lit(-1.0).alias("link"), F.lit(0.0).alias("inner")))
    pieces = F.concat(F.transform(match_spans(run, PIECE), piece), closing)
    empty = F.array().cast("array<struct<start:int,end:int,total:double>>")
    chain = lambda start, end, total: F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), total.cast("double").alias("total"))

    def add(done: Column, p: Column) -> Column:
        now = done["now"]
        random, begun = (p["link"] + p["inner"] > 0) & is_free(p["start"], p["end"]), now["start"] >= 0
        after = F.when(~random, chain(F.lit(-1), F.lit(-1), F.lit(0.0))).when(begun, chain(now["start"], p["end"], now["total"] + p["link"] + p["inner"])).otherwise(chain(p["start"], p["end"], p["inner"]))
        return F.struct(after.alias("now"), F.when(begun & ~random, F.concat(done["chains"], F.array(now))).otherwise(done["chains"]).alias("chains"))

    start = F.struct(chain(F.lit(-1), F.lit(-1), F.lit(0.0)).alias("now"), empty.alias("chains"))
    chains = F.aggregate(pieces, start, add, lambda done: done["chains"])
    valued = F.transform(chains, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.substring(run, c["start"] + 1, c["end"] - c["start"]).alias("value"), c["total"].alias("total")))
    judged = F.filter(valued, lambda c: _is_secret(c["value"], c["total"] / F.greatest(c["end"] - c["start"] - 1, F.lit(1)), threshold))
    return F.transform(judged, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value")))


def secret_scan(docs: DataFrame, ratios: list[float] | None, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with `secret_spans`: array of (start, rank, kind, end) in code points, end exclusive.

    Kinds are assign, access, hex and markov; a markov span never overlaps one of the others. A null or empty
    text has no spans. Without models there are no markov spans. Every row is scanned by itself, so ties and
    repeated rows need no rule; a clashing column is replaced. A text with very many matches costs the square
    of their number in array copies.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.withColumn("secret_spans", base_spans(text))
    if ratios is None:
        return found
    is_free = lambda start, end: ~F.exists("secret_spans", lambda b: (b["start"] < end) & (start < b["end"]))

    def judged(s: Column) -> Column:
        whole = is_free(s["start"], s["end"]) & _is_secret(s["value"], mean_ratio(s["value"], ratios), threshold)
        inner = F.transform(piece_spans(s["value"], ratios, threshold, lambda a, b: is_free(s["start"] + a, s["start"] + b)), lambda p: F.struct((s["start"] + p["start"]).alias("start"), (s["start"] + p["end"]).alias("end"), p["value"].alias("value")))
        return F.when(whole, F.array(s)).when(s["value"].rlike("[/_=-]"), inner).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))

    free = _as_spans(F.flatten(F.transform(match_spans(text, CANDIDATE), judged)), "markov", 3)
    return found.withColumn("secret_spans", F.sort_array(F.concat("secret_spans", _only_if(text.rlike(CANDIDATE), free))))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """`docs` with the spans of `secret_spans` replaced in the text; overlapping spans become one mask."""
    text = F.col("text")
    piece = lambda a, b: F.substring(text, a + 1, b - a)

    def add(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        out = F.when(fresh, F.concat(done["out"], piece(done["at"], s["start"]), F.lit(mask))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate("secret_spans", start, add, lambda done: F.concat(done["out"], piece(done["at"], F.length(text))))
    return docs.withColumn("text", F.when(F.size("secret_spans") > 0, whole).otherwise(text))


def op3_markov_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts per base kind, digest of the base spans and all spans of every document."""
    docs = docs.select("doc_id", "text")
    found = secret_scan(docs, train(docs))
    base = F.filter("secret_spans", lambda s: s["rank"] < 3)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"))
