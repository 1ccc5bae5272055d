"""The registered queries of the subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opsloom.llm import decontamination, dialogues, jaccard, languages, licences, mixing, quality, secret_scan, substrings, variants
from opsloom.llm.archives import page_records, read_archives, write_archives
from opsloom.llm.fingerprints import fingerprint_neighbours
from opsloom.llm.shared import shared_folder
from opsloom.llm.tokens import read_token_files, write_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixture(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0, shards=64)
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(_table(spark, sf_dir, "documents"))


def op3_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(_table(spark, sf_dir, "pages"), shared_folder(spark, "warc"), least_bytes=0)
    return page_records(read_archives(archives, payloads=False))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                              shared_folder(spark, "tokens"))
    return read_token_files(files, whole=False)


def op10_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"), most_documents=5000)
    return quality.score(docs, model, threshold=0.3)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.shingle_components(_table(spark, sf_dir, "documents"), percent=90, size=3)
    return found.select("doc_id", "n_shingles", "component_id")


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "distance", "n_words", "end_word")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_bytes(_table(spark, sf_dir, "documents")).drop("spans")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.damage_and_repair(_table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variant_groups(_table(spark, sf_dir, "documents"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(_table(spark, sf_dir, "documents"))


for _query in (op11_conversation_repair, op12_spelling_variants, op13_secret_scan, op2_suffix_dedup, op5_benchmark_leaks, op8_jaccard_join, op4_language_id, op10_quality_scores, op1_source_mix, op6_licence_scan, op3_warc_archives, op7_document_fingerprints, op9_token_files):
    QUERIES[_query.__name__] = _query

SQL["op1_source_mix"] = mixing.CHECK_SQL
SQL["op6_licence_scan"] = licences.check_sql()
