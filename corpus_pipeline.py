"""The corpus pipeline: toxicity, exact dedup, n-gram Jaccard join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pacekit.llm.common import read_table, stored
from pacekit.llm.exact_dedup import drop_exact_copies
from pacekit.llm.mixing import mix_documents
from pacekit.llm.ngram_join import one_per_component
from pacekit.llm.packing import pack_documents
from pacekit.llm.queries import PIECE_COLUMNS, word_tokenizer
from pacekit.llm.toxicity import drop_toxic

SHINGLE_WORDS = 5
NEAR_PERCENT = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go (operator 9)."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays (operator 3)."""
    return drop_exact_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at five-word similarity 0.8 one document stays (operator 4)."""
    return one_per_component(docs, width=SHINGLE_WORDS, percent=NEAR_PERCENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (operator 7)."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048 tokens (operator 8)."""
    return pack_documents(docs, word_tokenizer(), with_ids=True).select(*PIECE_COLUMNS)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("n-gram Jaccard join", ngram_join),
          ("mixing sources", mixing), ("packing", packing)]

# None of the stages but exact dedup and mixing can be said in SQL (learned scores, differencing):
# tests/llm holds the run against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
