"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next stage's ``docs``; all but the last keep
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, exact, mix, simhash, toxicity
from strata.llm.common import remove, table
from strata.llm.queries import BPE_FILE, MIX_WEIGHTS
from strata.session import scratch_folder


ROWS_PER_BATCH = 1_000  # rows that go to a Python worker at once


def _short_batches(spark: SparkSession) -> None:
    """Texts are long: Spark's default of 10,000 rows a batch holds hundreds of MB outside an executor's heap, for
    each task once on the way out and once on the way back, and keeps them for the stages after. Holds for the session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= ROWS_PER_BATCH:
        spark.conf.set(name, str(ROWS_PER_BATCH))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer rejects go; it learns from ``docs`` and the training folds of ``labels``."""
    _short_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (three-word shingles, two bits)."""
    _short_batches(spark)
    return simhash.near_dedup(docs, shingle=3, bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights, in random order."""
    return mix.mix(docs, MIX_WEIGHTS, copy_col=None)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the token ids of each row."""
    _short_batches(spark)
    return bpe.round_trip(docs, BPE_FILE, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("byte_bpe", tokenize),
]

# Viterbi restoration, BK-tree search and BPE have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back.

    A stage's table goes once the next one is written; the one that the
    returned DataFrame reads goes when the driver ends.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    folder = scratch_folder(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
