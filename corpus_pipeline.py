"""Corpus pipeline: quality rules, near-dedup, substring dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and, but for the last, returns the columns of
documents.  The last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.llm import minmax_dedup, mixing, packing, quality_rules, substring_dedup
from cyclonespark.llm.common import checkpoint, table
from cyclonespark.llm.queries import TOKENIZER

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the base rule and every threshold."""
    return quality_rules.keep(docs).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five words, similarity 0.8)."""
    return minmax_dedup.dedup(docs).select(*COLUMNS)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of the texts; every document stays."""
    cut = substring_dedup.dedup(docs)
    return cut.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents by their cell's calibrated probability, so that the sample meets the targets."""
    return mixing.mix(docs, bounded=True).filter("_kept").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all that is left into sequences of up to 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), remember=False)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring),
    ("mixing", mix),
    ("packing", pack),
]

#: components, window hashes and tokens are not SQL; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each but the last is written to the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
