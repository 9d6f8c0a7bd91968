"""Registered queries of the training-data operators: each applies its
operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import bestfit, htmltext, infill, language, maxscore, merkle, mixing, packing, perspectives, quality, search, simhash, substrings
from shelfline.llm.common import read_table


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("mix")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"),
                                   m["target"].alias("target"), m["taken"].alias("taken"),
                                   m["copies"].alias("copies"))


def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(read_table(spark, sf_dir, "pages"))


def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(read_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(read_table(spark, sf_dir, "documents"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.report(read_table(spark, sf_dir, "documents"))


def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.report(read_table(spark, sf_dir, "pages"))


def op8_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(read_table(spark, sf_dir, "conversations"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(read_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.report(read_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.report(read_table(spark, sf_dir, "documents"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_source_mixing": mixing.MIXING_SQL, "op2_merkle_fixity": merkle.MERKLE_SQL,
            "op8_perspective_rotation": perspectives.PERSPECTIVES_SQL, "op4_substring_dedup": substrings.SUBSTRINGS_SQL,
            "op9_quality_rules": quality.QUALITY_SQL, "op11_fill_in_middle": infill.INFILL_SQL,
            "op12_ranked_search": maxscore.MAXSCORE_SQL}
