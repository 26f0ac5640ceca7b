"""A BPE tokenizer with white-space words: its library object, and fast exact encoding of single words."""

from __future__ import annotations

import json
import os
import unicodedata

import regex

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str) -> str:
    """A path as it is; a bare name is looked up among the public tokenizers of the worker."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = (b for b in range(256) if b not in set(plain))
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class WordBpe:
    """The tokenizer of a vocabulary file, and its parts for words without white space."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = vocabulary_path(vocabulary)
        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.pieces = regex.compile(next(p["pattern"]["Regex"] for p in self.spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.special = [t["content"] for t in self.spec["added_tokens"]]
        self.alphabet = byte_alphabet()

    def lowered(self, word: str) -> str | None:
        """The normalised word if each of its characters stays one character in its place, else None."""
        if any(s in word for s in self.special):
            return None
        low = "".join(c.lower() for c in word) if "Σ" in word else word.lower()
        if word.isascii() or len(low) == len(word) and unicodedata.is_normalized("NFC", word) and unicodedata.is_normalized("NFC", low):
            return low
        return None

    def spelled(self, piece: str) -> str:
        """A pre-token in the byte alphabet."""
        return piece if piece.isascii() and piece.isprintable() else "".join([self.alphabet[b] for b in piece.encode()])

    def encode(self, word: str) -> list[int]:
        """The ids of a text, by the library's model piece by piece, or by the whole library if the text needs it."""
        low = self.lowered(word)
        if low is None:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        return [t.id for piece in self.pieces.findall(low) for t in self.model.tokenize(self.spelled(piece))]
