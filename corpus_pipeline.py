"""The training-text pipeline: language, lines, near copies, benchmark items, packing.

Each stage is a function of (spark, docs, sf_dir) on all that the one before it kept. All but the last return documents, with
the columns of the ``documents`` table; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from earshot.llm import decontaminate, language, line_dedup, ngram_join, packing
from earshot.llm.common import Scratch, free_workers, table
from earshot.llm.encoding import vocabulary_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or with too low a score go."""
    return language.keep_known(docs)


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that occur earlier; those that are nothing else go."""
    return line_dedup.keep_first(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies."""
    return ngram_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences."""
    return packing.pack(docs, vocabulary_path())




def _freed(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage in Python workers that have given back what the stage before left in them."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        free_workers(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", _freed(known_language)),
    ("lines", _freed(first_lines)),
    ("near_copies", _freed(one_of_near_copies)),
    ("benchmark", _freed(without_benchmark)),
    ("packing", _freed(packed)),
]

# The language network and the tokenizer are beyond SQL; tests hold the stages against plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the ``documents`` table, each written as Parquet and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = scratch.store(stage(spark, docs, sf_dir), name)
        scratch.tidy()
    return STAGES[-1][1](spark, docs, sf_dir)
