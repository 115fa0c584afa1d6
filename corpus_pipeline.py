"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
it kept, written as Parquet and read again: quality rules, line deduplication, one
document of each near-duplicate class, the mix of sources, best-fit packing.  All
stages but the last return the columns of ``documents``.

Edge cases: nulls in any column are kept (a null text counts as empty: the quality
rules reject it); repeated rows are documents of one class, of which one stays; an
empty table packs nothing; further columns, whatever their names, go through all
stages but the last.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm.common import own_columns, read_table, stage
from crease.llm.line_dedup import drop_frequent_lines
from crease.llm.mixing import mixed_documents
from crease.llm.near_dup import one_per_class
from crease.llm.packing import pack_documents
from crease.llm.quality import keep_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines go; ``n_chars`` follows the text."""
    cleaned = drop_frequent_lines(docs).select(*own_columns(docs))
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("mix_sources", mix_sources), ("best_fit_packing", pack)]

# shingle signatures, seeded blocks and the packing search have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
