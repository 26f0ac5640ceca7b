import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

SYLLABLES = ["ba", "to", "ren", "lis", "mo", "ka", "shen", "dur", "ti", "wol", "é", "gra"]


def prose(rng, n_words):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n_words))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, lang="en", ids=None):
        rows = [(ids[i] if ids else i, t, lang, "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture()
def rng():
    return random.Random(7)


#: Texts every operator must take: nulls, empty, white space, one word, repeated, odd characters, a long word.
ODD = [None, "", " \t\n ", "word", "word", "a b c d e f", "İstanbul Σίσυφος é́  x", "<|endoftext|>a're 日本語テキスト", "x" * 20_000, "one two three four five six " * 900]
