"""Token counts (operator 4): the exact token count at every prefix of every text.

Prefix dynamic programming. White space always ends a token, so the count of a prefix is the count up to its
last word plus the count of the cut word; inside a word the same holds per pre-token. A pre-token has a table of
the counts at all of its prefixes. Tables of short pre-tokens grow out of the table of their longest known prefix,
so a prefix that many words share is worked out once. In a long pre-token the encoding of a prefix is the encoding
of a shorter prefix plus one token: of all tokens that end there, exactly one fits behind the last token of the
shorter prefix. One pass over the positions gives the count at each of them, open (the word goes on) and closed
(the text is cut here).

A word that Unicode normalisation or lower-casing changes in length, or that holds a special token, is encoded by the
library prefix by prefix up to SHORT characters. A longer one is taken apart at its special tokens and at the characters
that normalisation never joins to those before them. What stands before such a character is normalised for good, so
the counts of the normalised word are those of the prefixes that end there. A prefix that ends between two characters that
normalisation joins goes on from the counts before them. The count of each of its prefixes is stored, but the table that budgets
are fitted to (`prefix_table`) does not cut it inside: its inner prefixes carry the count at its end there.
"""

from __future__ import annotations

import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from struct import pack, unpack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tenure.llm.blocks import Recent, Words, blocks, text_bytes, worker_cache
from tenure.llm.wordbpe import VOCABULARY, WordBpe

#: Bytes of text at a time: each distinct word of a block is looked up once.
BLOCK = 2_000_000
#: New words, prefixes and token pairs of a worker after which it forgets those that it no longer meets.
WORDS_KEPT = 120_000
PREFIXES_KEPT = 200_000
PAIRS_KEPT = 100_000
#: Pre-tokens up to this many bytes share the tables of their prefixes; words on the whole-library path up to this many
#: characters are encoded prefix by prefix.
SHORT = 40
_PACKED = {n: pack("<i", n) for n in range(-SHORT, SHORT + 1)}
FIELDS = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("steps", BinaryType())]


class PrefixCounter(WordBpe):
    """Counts at every prefix of a word for a BPE vocabulary with an end-of-word suffix."""

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import models

        super().__init__(vocabulary)
        model = self.spec["model"]
        self.suffix = model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.open_model = models.BPE(vocab=model["vocab"], merges=merges)
        self.open_ids = {k: v for k, v in model["vocab"].items() if not k.endswith(self.suffix)}
        self.closed_ids = {k[: -len(self.suffix)]: v for k, v in model["vocab"].items() if k.endswith(self.suffix)}
        self.longest = max(map(len, [*self.open_ids, *self.closed_ids]))
        plain = not any(t[flag] for t in self.spec["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized"))
        self.apart = plain and not any(_overlap(a, b) for a in self.special for b in self.special)
        self.specials = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.spec = None  # the vocabulary as text is not needed any more
        self.forms: dict[str, str] = {}
        self.second: frozenset[str] | None = None
        self.fits = Recent(PAIRS_KEPT)
        self.words = Recent(WORDS_KEPT)
        self.prefixes = Recent(PREFIXES_KEPT)
        self.accented = Recent(WORDS_KEPT)

    def _fits(self, left: str, left_id: int, right: str, right_id: int, closed: bool) -> bool:
        """Whether encoding left + right gives these two tokens."""
        key = (left_id, right_id)
        known = self.fits.get(key)
        if known is None:
            model = self.model if closed else self.open_model
            known = [t.id for t in model.tokenize(left + right)] == [left_id, right_id]
            self.fits.put(key, known)
        return known

    def piece(self, piece: str) -> bytes:
        """Packed increments of the closed count at each byte of one pre-token, given in the byte alphabet."""
        young = self.prefixes.young
        table = young.get(piece) or self.prefixes.get(piece)
        if table is not None:
            return table[1]
        if len(piece) > SHORT:
            counts = self.long_piece(piece)
            return pack("<%di" % len(counts), *[b - a for a, b in zip([0, *counts], counts)])
        known = len(piece) - 1
        while (table := self.prefixes.get(piece[:known]) if known else (0, b"")) is None:
            known -= 1
        count, packed = table
        tokenize, put = self.model.tokenize, self.prefixes.put
        for end in range(known + 1, len(piece) + 1):
            prefix = piece[:end]
            n = len(tokenize(prefix))
            packed += _PACKED[n - count]
            count = n
            put(prefix, (count, packed))
        return packed

    def long_piece(self, piece: str) -> list[int]:
        """The same for a pre-token of any length, in one pass."""
        return self._grown(piece, [-1], [""], [0])

    def _grown(self, piece: str, ids: list[int], last: list[str], counts: list[int]) -> list[int]:
        """The closed counts behind the positions that the open ones are known for; these go on to the end of the piece."""
        closed: list[int] = []
        open_ids, closed_ids, longest = self.open_ids, self.closed_ids, self.longest
        for end in range(len(ids), len(piece) + 1):
            found = done = None
            for start in range(end - 1, max(-1, end - 1 - longest), -1):
                token = piece[start:end]
                if found is None and (i := open_ids.get(token)) is not None and (not start or self._fits(last[start], ids[start], token, i, False)):
                    found = (i, token, counts[start] + 1)
                if done is None and (i := closed_ids.get(token)) is not None and (not start or self._fits(last[start], ids[start], token, i, True)):
                    done = counts[start] + 1
                if found and done:
                    break
            if found is None or done is None:
                raise ValueError(f"the vocabulary does not cover {piece!r}")
            ids.append(found[0])
            last.append(found[1])
            counts.append(found[2])
            closed.append(done)
        return closed

    def whole(self, word: str) -> int:
        return len(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def word(self, word: str) -> list[int]:
        """The count at each code point of a word without white space at its ends."""
        return np.cumsum(np.frombuffer(self.steps(word.encode()), "<i4").astype(np.int64)).tolist()

    def _steps(self, word: str) -> bytes:
        low = self.lowered(word)
        if low is None:
            counts = self.inside(word) if len(word) > SHORT else [self.whole(word[:k]) for k in range(1, len(word) + 1)]
            return pack("<%di" % len(counts), *[b - a for a, b in zip([0, *counts], counts)])
        return self._low_steps(low)

    def _low_steps(self, low: str) -> bytes:
        """The same for a word as the library normalises it."""
        pieces = self.pieces.findall(low)
        if low.isascii() and "'" not in low and sum(map(len, pieces)) == len(low):
            return b"".join([self.piece(self.spelled(p)) for p in pieces])
        out = []
        at = 0
        for found in self.pieces.finditer(low):
            piece = found.group()
            out.append(bytes(4 * (found.start() - at)))  # white space inside the word has no token
            at = found.end()
            if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():
                counts = [self.whole(piece[:k]) for k in range(1, len(piece) + 1)]
                out.append(pack("<%di" % len(counts), *[b - a for a, b in zip([0, *counts], counts)]))
            elif piece.isascii():
                out.append(self.piece(self.spelled(piece)))
            else:
                out.append(self.characters(piece))
        out.append(bytes(4 * (len(low) - at)))
        return b"".join(out)

    def inside(self, word: str) -> list[int]:
        """The count at each prefix of a word of any length that normalisation changes or that holds special tokens."""
        if self.apart:
            counts: list[int] = []
            base = at = 0
            for found in [*self.specials.finditer(word), None]:
                end = found.start() if found else len(word)
                # A special token counts as plain text up to its last character.
                shown = word[at:end] + (found.group()[:-1] if found else "")
                inner = self.normalised(shown)
                counts += [base + n for n in inner]
                if found:
                    base += (inner[end - at - 1] if end > at else 0) + 1
                    counts.append(base)
                    at = found.end()
            if counts[-1] == self.whole(word):
                return counts
        # The library knows other characters or special tokens that overlap.
        return [self.whole(word[:k]) for k in range(1, len(word) + 1)]

    def normalised(self, text: str) -> list[int]:
        """The count at each prefix of a text without special tokens."""
        if not text:
            return []
        if len(text) <= SHORT and (known := self.accented.get((text,))) is not None:
            return known
        low = self.lowered(text)
        if low is not None:
            counts = np.cumsum(np.frombuffer(self._low_steps(low), "<i4").astype(np.int64)).tolist()
        else:
            counts = self._unstable(text)
        if len(text) <= SHORT:
            self.accented.put((text,), counts)
        return counts

    def _unstable(self, text: str) -> list[int]:
        cuts = [i for i, c in enumerate(text) if not i or self._begins(c)]
        forms = [self._form(text[a:b]) for a, b in zip(cuts, [*cuts[1:], len(text)])]
        low = "".join(forms)
        tails = Tails(self, low)
        at, counts = 0, []
        for a, b, form in zip(cuts, [*cuts[1:], len(text)], forms):
            joined = ""
            for end in range(a + 1, b):
                mark = text[end - 1]
                if joined and unicodedata.combining(mark) and unicodedata.combining(joined[-1]) == unicodedata.combining(mark) and unicodedata.normalize("NFD", mark) == mark:
                    joined += mark  # a mark behind one of its class stays where it is
                else:
                    joined = unicodedata.normalize("NFC", text[a:end])
                start = joined.lower() if "Σ" not in joined else self._form(joined)
                counts.append(tails.counts[at + len(start)] if form.startswith(start) else tails.count(at, start))
            at += len(form)
            counts.append(tails.counts[at])
        return counts

    def _form(self, text: str) -> str:
        """Normalised and in lower case, character by character."""
        form = self.forms.get(text)
        if form is None:
            form = "".join([c.lower() for c in unicodedata.normalize("NFC", text)])
            if len(text) == 1:
                self.forms[text] = form
        return form

    def _begins(self, c: str) -> bool:
        """Whether normalisation never joins or moves a character to those before it."""
        if c < "\u0300":
            return True
        if self.second is None:
            pairs = (unicodedata.decomposition(chr(i)).split() for i in range(sys.maxunicode + 1))
            self.second = frozenset([chr(int(p[1], 16)) for p in pairs if len(p) == 2 and p[0][0] != "<"] + [chr(i) for i in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))])
        first = unicodedata.normalize("NFD", c)[0]
        return not unicodedata.combining(first) and first not in self.second

    def characters(self, piece: str) -> bytes:
        """Increments of a pre-token of any characters; each takes the increments of its bytes together."""
        known = self.accented.get(piece)
        if known is None:
            raw = piece.encode()
            steps = unpack("<%di" % len(raw), self.piece(self.spelled(piece)))
            sums, total = [], 0
            for byte, step in zip(raw, steps):
                if byte & 0xC0 != 0x80:
                    sums.append(total)
                    total = 0
                total += step
            sums.append(total)
            known = pack("<%di" % len(piece), *sums[1:])
            self.accented.put(piece, known)
        return known

    def uncut(self, word: bytes) -> bool:
        """Whether budgets are not to end inside a word."""
        text = word.decode()
        return len(text) > SHORT and self.lowered(text) is None

    def steps(self, word: bytes) -> bytes:
        """Packed 32-bit increments of the count at each code point."""
        known = self.words.get(word)
        if known is None:
            known = self._steps(word.decode())
            self.words.put(word, known)
        return known


def _overlap(a: str, b: str) -> bool:
    """Whether the end of one is the beginning of the other, or one holds the other."""
    return (a != b and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b))))


class Tails:
    """Counts of the prefixes of a normalised text, also with other characters behind them."""

    def __init__(self, counter: PrefixCounter, low: str) -> None:
        self.counter, self.low = counter, low
        self.counts = [0, *np.cumsum(np.frombuffer(counter._low_steps(low), "<i4").astype(np.int64)).tolist()]
        self.starts, self.ends = [], []
        self.bytes: np.ndarray | None = None
        self.open: dict[int, tuple] = {}

    def count(self, at: int, tail: str) -> int:
        """The count of the first `at` characters and the tail."""
        counter, low = self.counter, self.low
        if self.bytes is None:
            spans = [m.span() for m in counter.pieces.finditer(low)]
            self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]
            self.bytes = np.cumsum([0, *[len(c.encode()) for c in low]])
        i = bisect_right(self.starts, at - 1) - 1
        if i < 0 or self.ends[i] < at:
            return self.counts[at] + self._tokens(counter.pieces.findall(tail))
        # What follows an apostrophe tells whether it is one of a short form of up to three characters.
        while i and self.starts[i] > at - 3 and self.ends[i - 1] == self.starts[i]:
            i -= 1
        start, end = self.starts[i], min(self.ends[i], at)
        # A long piece is a run of one kind of characters; its ends stand for it.
        head = low[start:end] if end - start <= SHORT else low[start : start + 3] + low[end - 3 : end]
        first, *others = counter.pieces.findall(head + low[end:at] + tail)
        return self.counts[start] + self._closed(start, end, first[len(head) :] if len(first) >= len(head) else None, first) + self._tokens(others)

    def _closed(self, start: int, end: int, more: str | None, first: str) -> int:
        """The count of the piece that starts there, of the characters up to `end` and more; of a short one as it is."""
        if end - start <= SHORT or more is None:
            return self._tokens([first])
        if not more:
            return self.counts[end] - self.counts[start]
        counter = self.counter
        if start not in self.open:
            spelled = counter.spelled(self.low[start : self.ends[bisect_right(self.starts, start) - 1]])
            state = ([-1], [""], [0])
            counter._grown(spelled, *state)
            self.open[start] = (spelled, *state)
        spelled, *state = self.open[start]
        place = int(self.bytes[end] - self.bytes[start])
        begin = max(0, place - counter.longest)
        return counter._grown(spelled[begin:place] + counter.spelled(more), *[x[begin : place + 1] for x in state])[-1]

    def _tokens(self, pieces: list[str]) -> int:
        return sum(len(self.counter.model.tokenize(self.counter.spelled(p))) for p in pieces)


def _counted(batches: Iterator[pa.RecordBatch], vocabulary: str, column: str) -> Iterator[pa.RecordBatch]:
    counter: PrefixCounter = worker_cache("prefix counter", vocabulary, lambda: PrefixCounter(vocabulary))
    for block in blocks(batches, column, BLOCK):
        data, offsets = text_bytes(block.column(column))
        words = Words(data, offsets)
        distinct, which = words.distinct()
        tables = [counter.steps(w) for w in distinct]
        lengths = np.asarray([len(t) // 4 for t in tables], np.int64)
        # Each code point gets its step: white space 0, a word the steps of its table.
        heads = (data & 0xC0) != 0x80
        place = np.zeros(len(data) + 1, np.int64)
        np.cumsum(heads, out=place[1:])
        steps = np.zeros(int(place[-1]), np.int32)
        if len(which):
            flat = np.frombuffer(b"".join(tables), "<i4")
            base = np.cumsum(lengths) - lengths
            own = lengths[which]
            run = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            steps[np.repeat(place[words.start], own) + run] = flat[np.repeat(base[which], own) + run]
        bounds = place[offsets]
        stored = [steps[a:b].astype("<i4").tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        uncut = np.array([len(w) > SHORT and counter.uncut(w) for w in distinct], bool)
        if uncut.any():
            for i in np.flatnonzero(uncut[which]).tolist():
                t = words.text[i]
                stored[t] += pack("<2i", place[words.start[i]] - bounds[t], place[words.end[i]] - bounds[t])
        totals = np.zeros(len(steps) + 1, np.int64)
        np.cumsum(steps, out=totals[1:])
        fields = [
            pa.array(np.diff(offsets), pa.int64()),
            pa.array(totals[bounds[1:]] - totals[bounds[:-1]], pa.int64()),
            pa.array(stored, pa.binary()),
        ]
        kept = block.schema
        yield pa.RecordBatch.from_arrays([*block.columns, *fields], names=[*kept.names, "n_bytes", "n_tokens", "steps"])


def prefix_counts(docs: DataFrame, vocabulary: str = VOCABULARY, column: str = "text") -> DataFrame:
    """`docs` with n_bytes, n_tokens and `steps`, the stored table of counts at every prefix.

    `steps` holds one little-endian 32-bit increment per code point: their running sum is the token count at
    each prefix. Behind them stand the first and the last place of each word that a budget should not end in. Columns of `docs` that clash with the
    three new ones are replaced. A null or empty text has no tokens and an empty table; ties, repeated rows
    and empty tables need no rule, as every row is worked out by itself.
    """
    kept = docs.drop("n_bytes", "n_tokens", "steps")
    schema = StructType([*kept.schema.fields, *FIELDS])
    return kept.mapInArrow(lambda batches: _counted(batches, vocabulary, column), schema)


def exact_table(steps: bytes, n_chars: int) -> np.ndarray:
    """The token count at each prefix length from 0 to n_chars, out of the stored steps."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, "<i4", n_chars).astype(np.int64))])


def prefix_table(steps: bytes, n_chars: int) -> np.ndarray:
    """The same for budgets: inside a word that these should not end in, the count at its end."""
    table = exact_table(steps, n_chars)
    for a, b in np.frombuffer(steps, "<i4")[n_chars:].reshape(-1, 2).tolist():
        table[a + 1 : b] = table[b]
    return table


def fit_budget(table: np.ndarray, budget: int) -> int:
    """The longest prefix, in code points, with at most `budget` tokens."""
    return int(np.flatnonzero(table <= budget)[-1]) if budget >= 0 else 0


def op4_token_counts(docs: DataFrame, limit: int = 2048, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    counted = prefix_counts(docs.select("doc_id", "text"), vocabulary)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
