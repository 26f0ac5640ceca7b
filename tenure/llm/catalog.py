"""The registered queries of the pipeline operators: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenure.llm import chunkbpe, decontaminate, linededup, minhash, ppm, prefixcounts, quality, resampling, secrets, sharding, suffixes, surrogates, turns
from tenure.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chunk_bpe": lambda spark, folder: chunkbpe.op1_chunk_bpe(table(spark, folder, "documents")),
    "op2_hyperminhash": lambda spark, folder: minhash.op2_hyperminhash(table(spark, folder, "documents")),
    "op3_markov_secrets": lambda spark, folder: secrets.op3_markov_secrets(table(spark, folder, "documents")),
    "op4_token_counts": lambda spark, folder: prefixcounts.op4_token_counts(table(spark, folder, "documents")),
    "op5_simhash_decontamination": lambda spark, folder: decontaminate.op5_simhash_decontamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")),
    "op6_shuffle_shards": lambda spark, folder: sharding.op6_shuffle_shards(table(spark, folder, "documents")),
    "op7_suffix_dedup": lambda spark, folder: suffixes.op7_suffix_dedup(table(spark, folder, "documents")),
    "op8_ppm_language": lambda spark, folder: ppm.op8_ppm_language(table(spark, folder, "documents")),
    "op9_quality_llr": lambda spark, folder: quality.op9_quality_llr(table(spark, folder, "documents"), table(spark, folder, "labels")),
    "op10_surrogates": lambda spark, folder: surrogates.op10_surrogates(table(spark, folder, "documents")),
    "op11_importance_draw": lambda spark, folder: resampling.op11_importance_draw(table(spark, folder, "documents"), table(spark, folder, "benchmark")),
    "op12_turn_repair": lambda spark, folder: turns.op12_turn_repair(table(spark, folder, "conversations")),
    "op13_line_bitmaps": lambda spark, folder: linededup.op13_line_bitmaps(table(spark, folder, "documents")),
}
#: DuckDB SQL of those queries that SQL can express.
ORACLES: dict[str, str] = {"op13_line_bitmaps": linededup.SQL}
