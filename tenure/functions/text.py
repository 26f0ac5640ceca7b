"""Text clean-up and extraction, as column expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, prefixes and labels the results depend on.
FOOTNOTE = r"\[.*?\]"
TEXT_DATE_FORMAT = "d MMMM yyyy"
NOT_AMOUNT = "[^0-9.]"
CURRENCY_PREFIXES = {"€": "EUR", "£": "GBP", "$": "USD"}
AMOUNT = r"([€£$]\s?\d[\d,.]*\s?(?:million|m\b))"
AMOUNT_IN_CONTEXT = (
    r"(?:fee|signing|deal|transfer|clause)[^.]{0,80}?"
    r"(?:reported to be|of|worth|around|approximately|for|understood to be)?"
    r"[^.\d]{0,25}?" + AMOUNT
)
NO_FEE_TYPES = [
    "free transfer", "loan", "end of loan", "end of contract", "mutual agreement",
    "released", "promotion", "return from loan",
]
WINDOW_BEFORE, WINDOW_AFTER = 100, 400
HREF_PREFIX = "^/wiki/"

# Case-insensitive, with Unicode classes: a non-breaking space counts as a space.
_FLAGS = "(?iU)"
# A code point that is no character and so does not occur in text.
_FILLER = "\uffff"


def strip_markers(text: Column) -> Column:
    """Remove bracketed footnote markers: 'Monaco[a]' -> 'Monaco'."""
    return F.regexp_replace(text, FOOTNOTE, "")


def parse_text_date(text: Column) -> Column:
    """'15 June 2026[c]' -> date; NULL if it does not parse."""
    return F.try_to_date(strip_markers(text), TEXT_DATE_FORMAT)


def fee_amount(fee_text: Column) -> Column:
    """'€70.5m' -> 70500000.00: the digits as a number of millions; NULL if they form no number."""
    digits = F.regexp_replace(fee_text, NOT_AMOUNT, "")
    return (digits.try_cast("decimal(10,2)") * F.lit(1000000)).cast("decimal(18,2)")


def fee_currency(fee_text: Column) -> Column:
    """Currency code by leading sign; NULL for any other start. No conversion."""
    out = F.lit(None).cast("string")
    for sign, code in CURRENCY_PREFIXES.items():
        out = F.when(F.startswith(fee_text, F.lit(sign)), F.lit(code)).otherwise(out)
    return out


def surrogate_key(*columns: Column) -> Column:
    """md5 over the columns as text, joined by '-', with a marker for NULL."""
    parts = [F.coalesce(c.cast("string"), F.lit("_dbt_utils_surrogate_key_null_")) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def leading_int(label: Column) -> Column:
    """'38. Matchday' -> 38; NULL without leading digits."""
    return F.regexp_substr(label, F.lit("^[0-9]+")).try_cast("int")


def url_from_key(prefix: str, key: Column, suffix: str) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"), F.lit(suffix))


def first_amount(text: Column, pattern: str = AMOUNT) -> Column:
    """The first amount the pattern captures, trimmed; NULL without one."""
    return F.trim(F.nullif(F.regexp_extract(text, _FLAGS + pattern, 1), F.lit("")))


def infer_type(type_text: Column, fee_cell: Column) -> Column:
    """The stated type, or one read off the fee cell where the type is empty."""
    lowered = F.lower(fee_cell)
    no_fee = F.contains(lowered, F.lit("free")) | F.contains(lowered, F.lit("none")) | F.trim(lowered).isin("-", "")
    guessed = (
        F.when(F.contains(lowered, F.lit("loan")), "Loan")
        .when(no_fee, F.when(F.contains(lowered, F.lit("free")), "Free transfer").otherwise(""))
        .when(first_amount(fee_cell).isNotNull(), "Transfer")
        .otherwise(type_text)
    )
    stated = F.coalesce(type_text, F.lit("")) != ""
    return F.when(stated | (F.coalesce(fee_cell, F.lit("")) == ""), type_text).otherwise(guessed)


def may_have_fee(type_text: Column) -> Column:
    """False for the move types that never carry a fee."""
    return ~F.lower(F.trim(type_text)).isin(NO_FEE_TYPES)


def href_title(href: Column) -> Column:
    """'/wiki/Jo%C3%A3o_F%C3%A9lix' -> 'João_Félix'. A plus sign stays a plus sign."""
    title = F.regexp_replace(href, HREF_PREFIX, "")
    # A percent sign that starts no escape stands for itself.
    escaped = F.regexp_replace(F.replace(title, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(escaped), title)


def mention_windows(text: Column, term: Column, before: int = WINDOW_BEFORE, after: int = WINDOW_AFTER) -> Column:
    """The text around every mention of `term`, in order; overlapping mentions count.

    Each zero-width match captures the `before` characters ahead of the mention and up to `after`
    characters from its start. A filler in front of the text lets the part ahead have one fixed
    length, which the regex engine finds without trying all shorter ones; it is cut off again.
    An empty or NULL term has no mention.
    """
    quoted = F.concat(F.lit(r"\Q"), F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    pattern = F.concat(F.lit("(?s)(?="), quoted, F.lit(f")(?<=(.{{{before}}}))(?=(.{{0,{after}}}))"))
    padded = F.concat(F.lit(_FILLER * before), text)
    heads = F.regexp_extract_all(padded, pattern, F.lit(1))
    tails = F.regexp_extract_all(padded, pattern, F.lit(2))
    found = F.zip_with(heads, tails, lambda h, t: F.concat(F.ltrim(h, F.lit(_FILLER)), t))
    return F.when(F.length(term) > 0, found)


def mention_amount(
    text: Column,
    term: Column,
    patterns: tuple[str, ...] = (AMOUNT_IN_CONTEXT, AMOUNT),
    before: int = WINDOW_BEFORE,
    after: int = WINDOW_AFTER,
) -> Column:
    """The first amount near a mention of `term`: per mention the patterns are tried in order.

    A range keeps its lower bound. NULL means "not found in the text".
    """
    # The fold stops looking once a mention has given an amount.
    return F.aggregate(
        mention_windows(text, term, before, after),
        F.lit(None).cast("string"),
        lambda found, w: F.coalesce(found, *[first_amount(w, p) for p in patterns]),
    )
