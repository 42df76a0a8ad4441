"""A training corpus from raw documents: five stages of the llm operators, each one written and read again.

The stages before the last return the columns of `documents`: rejected documents go, boilerplate lines go from texts
(n_chars follows), one document of each near-duplicate group stays, and documents with benchmark passages go.  The last
one packs what is left into training sequences, one row per piece.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from demandspark.llm import decontaminate, lines, packing, quality, simhash
from demandspark.llm.common import bound_batches, materialise, table
from demandspark.llm.tokenization import SharedTokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SEQUENCE_TOKENS = 2048
CACHE_PIECES = 450_000  # a worker of the last stage has the memory of the stages before it


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the current policy keep."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate of their source."""
    return lines.clean_documents(docs, "source")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, two differing bits at most."""
    bound_batches(spark)
    return simhash.keep_one_of_each(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    bound_batches(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    bound_batches(spark)
    tokenizer = SharedTokenizer(spark, TOKENIZER, cache_pieces=CACHE_PIECES)
    return packing.pack_documents(docs, tokenizer, packing.Capacity(tokens=SEQUENCE_TOKENS))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Seeded 64-bit hashes and tokenizer ids are beyond DuckDB's SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
