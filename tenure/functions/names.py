"""Name normalisation to comparable tokens."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that carry no identity, reserve-team markers, and spelling aliases.
GENERIC_WORDS = [
    "fc", "cf", "ac", "sc", "sk", "afc", "cfc", "ss", "ssd", "asd", "spa", "sad",
    "as", "cd", "ud", "rc", "nk", "hnk", "gnk", "if", "bk", "fk", "vv", "sv",
    "club", "football", "futbol", "futebol", "calcio", "clube", "klub",
    "sportowy", "sportivo", "sportiva", "spolka", "akcyjna", "association",
    "societa", "spzoo", "the",
    "sportsklubb", "idrettslag", "fotballklubb", "idrettsforening",
    "allmanna", "idrottsklubb", "idrottsforening", "boldklub", "fotbollforening",
]
RESERVE_MARKERS = ["b", "ii", "2", "u23", "u21", "u19", "reserves", "reserve", "youth", "young"]
WORD_ALIASES = {"manchester": "man", "monchengladbach": "gladbach"}
TITLE_GENERIC_WORDS = ["fc", "cf", "afc", "sc", "the", "club", "ac", "as"]


@F.pandas_udf(StringType())
def ascii_fold(names: pd.Series) -> pd.Series:
    """Accents off and other non-ASCII characters dropped ('Málaga' -> 'Malaga')."""
    return names.map(
        lambda n: unicodedata.normalize("NFKD", n).encode("ascii", "ignore").decode(), na_action="ignore"
    )


def split_words(text: Column) -> Column:
    """The non-empty words of a text, split at white space."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def name_tokens(
    name: Column,
    stopwords: list[str] = GENERIC_WORDS,
    aliases: dict[str, str] = WORD_ALIASES,
) -> Column:
    """Parentheses dropped, folded to ASCII, lower-cased, split into words, stopwords out, aliases applied.

    Folding runs Python; call this on distinct names.
    """
    plain = F.lower(ascii_fold(F.regexp_replace(name, r"\(.*?\)", " ")))
    words = split_words(F.regexp_replace(plain, r"[^a-z0-9\s]", " "))
    kept = F.filter(words, lambda w: ~w.isin(stopwords))

    def aliased(w: Column) -> Column:
        out = w
        for word, alias in aliases.items():
            out = F.when(w == word, F.lit(alias)).otherwise(out)
        return out

    return F.transform(kept, aliased)


def has_reserve_marker(tokens: Column, markers: list[str] = RESERVE_MARKERS) -> Column:
    return F.exists(tokens, lambda t: t.isin(markers))


def title_accepts(title: Column, season: Column, name: Column, generic: list[str] = TITLE_GENERIC_WORDS) -> Column:
    """True if the title holds the season and at least one distinguishing word of the name."""
    words = F.filter(split_words(F.lower(name)), lambda w: ~w.isin(generic))
    return F.contains(title, season) & F.exists(words, lambda w: F.contains(F.lower(title), w))
