"""A training corpus from raw documents, in five stages.

Each stage reads the Parquet that the one before it wrote, works on all of its
rows, and its decisions take effect: the rows it drops are gone, the rows it
repeats are there as often. All stages but the last return the columns they
got.

1. language: documents without a determined language, or that fit none of the
   learned ones, go (``lang_viterbi``)
2. exact_dedup: of equal texts the row with the smallest id stays (``digest_tree``)
3. near_dedup: of each group of texts linked by a word-5-gram Jaccard similarity
   of 0.8 or more the row with the smallest id stays (``signature_tree``)
4. mix: sources are brought to their target weights; rows are dropped or
   repeated, three times at most (``pareto_mix``)
5. encode: the token ids of every text and their decoding (``forced_bpe``)

Tables that a stage stores on the way go when its result no longer scans them;
those that the result does scan go when the next stage starts, since the result
has been written by then (they stay if the documents given to that stage still
scan them). So the disk holds the tables of one stage, not of all.
"""

from __future__ import annotations

import functools
import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelkit.llm import digest_tree, forced_bpe, lang_viterbi, pareto_mix, signature_tree  # noqa: E402
from panelkit.llm._tables import table  # noqa: E402
from panelkit.llm.queries import vocabulary_path  # noqa: E402
from panelkit.stages import StageLedger, releasing  # noqa: E402


_LAST: list[StageLedger] = []


def _owned(stage):
    """``stage`` with a ledger for its tables; see above."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ledger = StageLedger(spark)
        if _LAST and _LAST[0].spark is spark:
            _LAST[0].release(docs)
            ledger.adopt(_LAST[0])
        _LAST[:] = [ledger]
        with ledger.recording(), releasing(spark) as step:
            return step.keep(stage(spark, docs, sf_dir))
    return run_stage


@_owned
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lang_viterbi.drop_rejected(docs)


@_owned
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest_tree.drop_copies(docs, keep="min")


@_owned
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return signature_tree.drop_near_copies(docs, shingle=5, percent=80)


@_owned
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pareto_mix.repeat_rows(docs)


@_owned
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``id``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``."""
    vocabulary = forced_bpe.read_vocabulary(vocabulary_path())
    return forced_bpe.round_trip(docs, vocabulary).withColumnRenamed("id", "doc_id")


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]

#: Language identification learns its model, so SQL can't express the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs, written = table(spark, sf_dir, "documents"), StageLedger(spark)
    for name, stage in STAGES[:-1]:
        docs = written.store(stage(spark, docs, sf_dir), f"stage-{name}")
        written.release(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
