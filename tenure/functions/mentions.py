"""The first amount near the mentions of many terms, in one pass over each text."""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tenure.functions.text import AMOUNT, AMOUNT_IN_CONTEXT, WINDOW_AFTER, WINDOW_BEFORE

FOUND = ArrayType(StructType([StructField("term", StringType()), StructField("amount", StringType())]))
FOUND_ARROW = pa.list_(pa.struct([("term", pa.string()), ("amount", pa.string())]))


def prefix_pattern(terms: Iterable[str]) -> str:
    """A pattern for the longest of the terms at a place: terms share their prefixes, so a place is left at the first letter that none has."""
    tree: dict = {}
    for term in terms:
        node = tree
        for ch in term:
            node = node.setdefault(ch, {})
        node[""] = {}

    def spell(node: dict) -> str:
        # A chain of letters without a branch or an end is written as it is; the depth of the tree does not nest.
        out = []
        while len(node) == 1 and "" not in node:
            ((ch, node),) = node.items()
            out.append(re.escape(ch))
        branches = [re.escape(ch) + spell(below) for ch, below in sorted(node.items()) if ch]
        if branches:
            out.append(f"(?:{'|'.join(branches)}){'?' if '' in node else ''}")
        return "".join(out)

    return spell(tree)


def amounts_near(text: str, terms: Iterable[str], patterns: list[re.Pattern], before: int, after: int) -> dict[str, str]:
    """The first amount of each term that has one: per mention in order the patterns are tried in order.

    A mention of a term is also one of the terms that begin it. The pass ends when all terms have an amount.
    """
    open_, found = {t for t in terms if t}, {}
    if not open_ or not text:
        return found
    for mention in re.compile(f"(?=({prefix_pattern(open_)}))").finditer(text):
        here = [t for t in open_ if mention.group(1).startswith(t)]
        if not here:
            continue
        at = mention.start()
        window = text[max(0, at - before) : at + after]
        hit = next((h for p in patterns if (m := p.search(window)) and (h := m.group(1).strip(" "))), None)
        if hit is not None:
            for term in here:
                found[term] = hit
                open_.discard(term)
            if not open_:
                break
    return found


def scanned(texts: pa.Array, wanted: pa.Array, patterns: list[re.Pattern], before: int, after: int) -> pa.Array:
    """`amounts_near` of each text and its terms, by term. Only one text at a time is a Python text."""
    found = (amounts_near(body.as_py() or "", asked.as_py() or [], patterns, before, after) for body, asked in zip(texts, wanted))
    return pa.array([[{"term": t, "amount": a} for t, a in sorted(each.items())] for each in found], FOUND_ARROW)


def mention_amounts(text: Column, terms: Column, patterns: tuple[str, ...] = (AMOUNT_IN_CONTEXT, AMOUNT), before: int = WINDOW_BEFORE, after: int = WINDOW_AFTER) -> Column:
    """array<struct<term, amount>> of the terms of an array that have an amount within `before` and `after` characters of a mention.

    Equal to `text.mention_amount` of each term; the text is gone through once for all of them. A NULL text or array gives an
    empty array, as do empty and NULL terms.
    """
    compiled = [re.compile(p, re.IGNORECASE) for p in patterns]

    @F.arrow_udf(FOUND)
    def scan(texts: pa.Array, wanted: pa.Array) -> pa.Array:
        return scanned(texts, wanted, compiled, before, after)

    return scan(text, terms)
