"""The corpus pipeline: documents through five stages, in the order of STAGES.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is
written as Parquet and read again for the next one. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm import chunkbpe, decontaminate, minhash, ppm, secrets
from tenure.llm.tables import shared_folder, table
from tenure.sources.published import Folder

#: A language is believed from this share of 2 ** -bits on; less is a text that no tree fits better than another.
LEAST_SCORE = 0.5
#: A text whose best code takes more bits a byte is in none of the languages: its bytes as they are take 8. Texts of
#: the learnt languages stay below 8 on the test tables (half of them below 2.3), other languages and random letters above 10.
MOST_BITS = 9.0
#: Bytes under which a text with a letter stays, as no measure can judge it.
JUDGED_BYTES = 40


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the languages, learnt from the labelled ones; `lang` is filled in where it is null.

    Null and empty texts and texts without a letter go, as do texts that the best tree codes in more than MOST_BITS a byte.
    Without labelled documents nothing is known and all go. Rows are judged one by one, so repeated rows and ids need no rule.
    """
    found = ppm.identify(docs, ppm.training_sample(docs))
    size = F.octet_length("text")
    fits = (F.col("score") >= LEAST_SCORE) & (F.array_min("code_bits") <= MOST_BITS * size)
    kept = found.filter((F.col("lang_pred") != ppm.UNKNOWN) & ((size < JUDGED_BYTES) | fits))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group linked at similarity 0.8 or more.

    Texts without a word and rows with a null id are linked with nothing and stay; rows that share an id are one document.
    """
    return minhash.keep_one(docs, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no benchmark item. A null or empty text holds none; equal rows stay or go together."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, secrets in their texts masked; n_chars follows the text. A null text stays null."""
    masked = secrets.redact(secrets.secret_scan(docs, secrets.train(docs)))
    changed = F.size("secret_spans") > 0
    return masked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add n_tokens, token_ids and the digest of the text that the ids decode to; a null text has no ids and decodes to the empty text."""
    both = chunkbpe.encode(docs, decoded=True)
    return both.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", mask_secrets),
    ("BPE encoding and decoding", encode_tokens),
]
#: No stage can be said in SQL (trained trees, sketches, models, a tokenizer): the tests run brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what each keeps is written to the shared folder, and goes when the next has read it."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        at = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        if number:
            Folder(spark, folder).delete(str(number - 1))
    return docs
