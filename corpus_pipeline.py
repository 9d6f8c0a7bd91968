"""Training corpus from raw documents: quality rules, near-duplicates, repeated
passages, source mixture, packing. Every stage takes (spark, docs, sf_dir) and
returns a DataFrame; it is written and the next stage reads the files. All but
the last return the columns of documents.

Null, empty and very long texts, repeated rows and empty tables are treated as
the operators' docstrings say; a document that lost words has its n_chars
brought up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import mixing, packing, quality, simhash, substrings
from shelfline.llm.common import fresh, read_table, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the default policy keeps."""
    return quality.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere too."""
    rows = substrings.without_repeats(docs)
    return rows.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    name, = fresh(docs, "mix")
    return mixing.repeat_rows(mixing.mix(docs, out_col=name), docs.columns, name)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of the mixture."""
    return packing.report(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_duplicates", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("source_mixing", source_mixture),
    ("mixture_packing", packed_sequences),
]

#: The tokenizer cannot be expressed in SQL; tests/llm/test_pipeline.py holds the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the rows of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
