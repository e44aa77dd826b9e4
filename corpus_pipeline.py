"""The corpus pipeline: five stages over ``documents``, each a call of one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
``run`` writes each stage's rows to the shared scratch folder and reads them again for the next, so that no stage
is computed twice and a lost executor costs a task, not the pipeline.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from topicflow.llm.common import free_name, table
from topicflow.session import scratch_dir

ORACLE_SQL = None  # tokenizers and fitted rules are outside SQL; tests/llm compares with plain Python


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learnt from ``labels`` score 0.7 or more."""
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    into = free_name(docs.columns, "score")
    return quality_rules.score(docs, model, into=into).where(F.col(into) >= quality_rules.THRESHOLD).drop(into)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of repeated three-line windows, ``n_chars`` to match; a document of which
    nothing but repeated lines was left goes."""
    counts = free_name(docs.columns, "n_lines"), free_name(docs.columns, "n_removed")
    found = line_dedup.dedup_lines(docs, counts=counts)
    found = found.where((F.col(counts[1]) == 0) | (F.col(counts[1]) < F.col(counts[0]))).drop(*counts)
    return found.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else found


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id of each group of near-duplicates."""
    return simhash.one_of_each_group(docs, shingle=3, max_bits=3)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten benchmark words occurs."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 2048."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), special_tokens=True))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", one_of_near_duplicates),
    ("benchmark_decontamination", remove_contaminated),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
