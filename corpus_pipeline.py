"""The corpus pipeline: quality, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared folder and reads it
again as the next stage's docs. All stages but the last return the columns of documents.

Defined cases are those of the operators: see their modules in flowgraph/llm.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowgraph.llm import jaccard, line_dedup, mixing, packing, quality  # noqa: E402
from flowgraph.llm.common import stored, table  # noqa: E402


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document holds are deleted; documents that lose all their words go."""
    return line_dedup.without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that agree in 80 % of their five-word shingles the smallest doc_id stays."""
    return jaccard.one_per_group(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in batches of equal padded length."""
    return packing.pack(docs, with_text=True)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

# The classifier's noise, alignment and bucket boundaries have no plain SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
