"""The registered queries of the operators here: each over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrowfile, convfix, crosstok, decontam, exactdup, langid, linededup, maxent, packing, rabitq, simhash, toxicity, warc
from .common import crc_of_id

#: Tokenizer file of the packing and binary-output queries.
TOKENIZER = "word_bpe_49k.json"
#: The two tokenizers that are aligned.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: The chain's categories: columns of the table labels, the earlier ones first. A document is rejected for the last.
CATEGORIES = ["quality", "toxic"]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    chain = toxicity.train(docs, _read(spark, sf_dir, "labels"), CATEGORIES)
    found = toxicity.score(docs, chain)
    return found.select("doc_id", "quality_score", "toxic_score", F.col("toxic_flag").alias("toxic"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    net = langid.train(docs, modulus=5)
    found = langid.predict(docs, net)
    return found.select("doc_id", F.coalesce(crc_of_id("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(_read(spark, sf_dir, "documents"), modulus=7, remainder=2)


def op5_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = arrowfile.tokens_path(spark)
    shards = arrowfile.write_tokens(_read(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), end_id=1)
    return arrowfile.read_tokens(spark, shards)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=2, capacity=4096)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.derivatives(warc.page_responses(_read(spark, sf_dir, "pages")))
    return warc.digests(made).withColumnRenamed("key", "page_id")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.nearest(_read(spark, sf_dir, "embeddings"), k=5, every=50)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(_read(spark, sf_dir, "documents")).select("doc_id", "text", "lines_removed")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.link_statistics(_read(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_groups(_read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convfix.repair(convfix.damaged(_read(spark, sf_dir, "conversations")), present_col="present")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_language_id, op3_simhash_near_dedup, op4_lm_scoring, op5_token_binary, op6_packing, op7_warc_derivatives, op8_nearest_neighbours, op9_benchmark_decontamination, op10_line_dedup, op11_token_alignment, op12_exact_dedup, op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    return {"op8_nearest_neighbours": rabitq.SQL, "op9_benchmark_decontamination": decontam.SQL, "op10_line_dedup": linededup.SQL}
