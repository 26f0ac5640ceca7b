"""Token-set similarity of two names, 0 to 1: of one pair, and of the best partner of each of many names."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

#: Candidates per name that are scored first, best bound first, before the rest is ruled out by the best of them.
FIRST_LOOK = 3
#: Cells of the bound matrices that are held at a time.
CELLS = 1_000_000


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of `a`."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        match = row & places.get(ch, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def _ratio(distance: int, total: int) -> float:
    return 1.0 - distance / total if total else 1.0


def token_set_ratio(left: list[str], right: list[str]) -> float:
    """The best insert/delete ratio among (common), (common + left rest) and (common + right rest).

    1.0 where one token set contains the other; 0.0 if either is empty.
    """
    a, b = set(left), set(right)
    if not a or not b:
        return 0.0
    common = " ".join(sorted(a & b))
    rest_a, rest_b = " ".join(sorted(a - b)), " ".join(sorted(b - a))
    if common and (not rest_a or not rest_b):
        return 1.0
    joint = 1 if common else 0
    len_a, len_b = len(common) + joint + len(rest_a), len(common) + joint + len(rest_b)
    edits = len(rest_a) + len(rest_b) - 2 * lcs_length(rest_a, rest_b)
    scores = [_ratio(edits, len_a + len_b)]
    if common:
        scores += [_ratio(n - len(common), len(common) + n) for n in (len_a, len_b)]
    return max(scores)


class Names:
    """Token sets as numbers: character counts, adjacent pairs, lengths and the tokens of a shared vocabulary."""

    def __init__(self, sets: list[list[str]], letters: dict[str, int], tokens: dict[str, int]) -> None:
        self.sets = [sorted(set(s)) for s in sets]
        self.text = [" ".join(s) for s in self.sets]
        self.size = np.array([len(t) for t in self.text], np.int64)
        self.n_tokens = np.array([len(s) for s in self.sets], np.int64)
        self.letters = np.zeros((len(sets), len(letters)), np.uint8)
        for i, text in enumerate(self.text):
            for ch in text:
                self.letters[i, letters[ch]] += self.letters[i, letters[ch]] < 255
        self.has = np.zeros((len(sets), len(tokens)), np.float32)
        for i, s in enumerate(self.sets):
            self.has[i, [tokens[t] for t in s if t in tokens]] = 1


def _meeting(left: list[list[str]], right: list[list[str]]) -> tuple[Names, Names, np.ndarray]:
    """Both sides over one alphabet and over the tokens that both have, and the lengths of those tokens."""
    letters = {ch: i for i, ch in enumerate(sorted({ch for side in (left, right) for s in side for t in s for ch in t} | {" "}))}
    shared = sorted({t for s in left for t in s} & {t for s in right for t in s})
    tokens = {t: i for i, t in enumerate(shared)}
    return Names(left, letters, tokens), Names(right, letters, tokens), np.array([len(t) for t in shared], np.float32)


def common_lengths(pairs: list[tuple[str, str]]) -> np.ndarray:
    """The longest common subsequence of each pair, all pairs of up to 64 characters side by side, a bit per character."""
    out = np.zeros(len(pairs), np.int64)
    short = [i for i, (a, b) in enumerate(pairs) if len(a) <= 64]
    for i, (a, b) in enumerate(pairs):
        if len(a) > 64:
            out[i] = lcs_length(a, b)
    if not short:
        return out
    letters = {ch: i for i, ch in enumerate(sorted({ch for i in short for ch in pairs[i][0]}))}
    lefts: dict[str, int] = {}
    own = np.array([lefts.setdefault(pairs[i][0], len(lefts)) for i in short])
    rights: dict[str, int] = {}
    other = np.array([rights.setdefault(pairs[i][1], len(rights)) for i in short])
    places = np.zeros((len(lefts), len(letters) + 1), np.uint64)
    for text, i in lefts.items():
        for at, ch in enumerate(text):
            places[i, letters[ch]] |= np.uint64(1 << at)
    longest = max(map(len, rights), default=0)
    codes = np.full((len(rights), longest), len(letters), np.int64)  # beyond the end, a letter that is nowhere
    for text, i in rights.items():
        codes[i, : len(text)] = [letters.get(ch, len(letters)) for ch in text]
    row = np.full(len(short), np.uint64((1 << 64) - 1))
    for at in range(longest):
        match = row & places[own, codes[other, at]]
        row = (row + match) | (row - match)
    sizes = np.array([len(pairs[i][0]) for i in short], np.uint64)
    # Bits beyond the length of the text stay set; only those inside count.
    inside = np.where(sizes == 64, np.uint64((1 << 64) - 1), (np.uint64(1) << (sizes % np.uint64(64))) - np.uint64(1))
    out[short] = np.bitwise_count(~row & inside)
    return out


def best_partners(left: list[list[str]], right: list[list[str]]) -> tuple[np.ndarray, np.ndarray, int]:
    """For each left token set the highest `token_set_ratio` with any right one, the first right one that has it, and the number of pairs scored.

    A pair needs its subsequence only if a bound leaves it a chance: the two names cannot agree in more characters than
    their character counts have in common. Scores by shared tokens alone are exact at once. Each name
    scores the few pairs with the highest bounds; whatever stays below the best of these is ruled out, the rest is scored.
    """
    best, partner = np.full(len(left), -1.0), np.zeros(len(left), np.int64)
    if not left or not right:
        return best, partner, 0
    a, b, widths = _meeting(left, right)
    scored = 0
    height = max(1, CELLS // len(right))
    for lo in range(0, len(left), height):
        rows = slice(lo, lo + height)
        best[rows], partner[rows], n = _best_rows(a, b, widths, np.arange(lo, min(lo + height, len(left))))
        scored += n
    return best, partner, scored


def _best_rows(a: Names, b: Names, widths: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    shared = a.has[rows] @ b.has.T
    common = (a.has[rows] * widths) @ b.has.T
    common += np.maximum(shared - 1, 0)
    size_a, size_b = a.size[rows][:, None], b.size[None, :]
    total = size_a + size_b
    score = np.zeros(total.shape)  # exact without the subsequence, and a lower bound with it
    with np.errstate(invalid="ignore", divide="ignore"):
        for n in (size_a, size_b):
            np.maximum(score, np.where(shared > 0, 1.0 - (n - common) / (common + n), 0.0), out=score)
        contained = (shared > 0) & ((shared == a.n_tokens[rows][:, None]) | (shared == b.n_tokens[None, :]))
        score[contained] = 1.0
        alike = np.zeros(total.shape, np.int32)
        for letter in range(a.letters.shape[1]):
            alike += np.minimum(a.letters[rows, letter][:, None], b.letters[:, letter][None, :])
        bound = np.where((size_a > 0) & (size_b > 0) & ~contained, 1.0 - (total - 2 * alike) / total, 0.0)
    bound[bound <= score] = -1.0  # the subsequence adds nothing
    done = 0

    def settle(pairs: np.ndarray) -> int:
        """Score the pairs (flat positions); their bounds are used up."""
        at, to = np.divmod(pairs, len(b.text))
        rests, extra = [], np.zeros(len(pairs), np.int64)
        for k, (i, j, met) in enumerate(zip(rows[at].tolist(), to.tolist(), shared.ravel()[pairs].tolist())):
            if met:
                both = set(a.sets[i]) & set(b.sets[j])
                extra[k] = len(" ".join(sorted(both))) + 1
                rests.append((" ".join(t for t in a.sets[i] if t not in both), " ".join(t for t in b.sets[j] if t not in both)))
            else:
                rests.append((a.text[i], b.text[j]))
        lengths = common_lengths(rests)
        edits = np.array([len(x) + len(y) for x, y in rests], np.int64) - 2 * lengths
        exact = 1.0 - edits / (extra * 2 + np.array([len(x) + len(y) for x, y in rests], np.int64))
        flat = score.reshape(-1)
        flat[pairs] = np.maximum(flat[pairs], exact)
        bound.reshape(-1)[pairs] = -1.0
        return len(pairs)

    width = len(b.text)
    first = np.argpartition(-bound, min(FIRST_LOOK, width) - 1, axis=1)[:, : min(FIRST_LOOK, width)]
    flat = (np.arange(len(rows))[:, None] * width + first).reshape(-1)
    done += settle(flat[bound.reshape(-1)[flat] >= 0])
    # A hair of tolerance: bound and score come from different sums.
    done += settle(np.flatnonzero((bound >= score.max(axis=1, keepdims=True) - 1e-9) & (bound >= 0)))
    return score.max(axis=1), score.argmax(axis=1), done


@F.pandas_udf(ArrayType(StructType([StructField("score", DoubleType()), StructField("at", IntegerType())])))
def best_in_chunk(left: pd.Series, right: pd.Series) -> pd.Series:
    """`best_partners` over two columns of arrays of token sets, each set joined by spaces."""

    def best(names: list[str], others: list[str]) -> list[dict]:
        scores, at, _ = best_partners([n.split(" ") for n in names], [o.split(" ") for o in others])
        return [{"score": s, "at": i} for s, i in zip(scores.tolist(), at.tolist())]

    return pd.Series([best(list(a), list(b)) for a, b in zip(left, right)])
