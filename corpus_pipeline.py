"""The corpus pipeline: quality classifier, exact dedup, MinHash near-dedup,
benchmark decontamination, BPE round trip.

Each stage takes what the one before it kept and is judged on that input; all
but the last return rows of ``documents`` unchanged. Stages read what they
need besides (labels, benchmark) from the same folder as ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from audival.llm.bpe import round_trip
from audival.llm.decontaminate import drop_contaminated
from audival.llm.exact_dedup import drop_copies
from audival.llm.near_dedup import drop_near_duplicates
from audival.llm.quality import drop_rejected
from audival.llm.shared import stages
from audival.sources.tables import Tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return drop_rejected(docs, Tables(spark, sf_dir).labels)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return drop_contaminated(docs, Tables(spark, sf_dir).benchmark)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("near dedup", near),
          ("decontamination", decontaminate), ("bpe", encode)]

#: The classifier is trained, so SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    store = stages(spark)
    docs = Tables(spark, sf_dir).documents
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = store.write(stage(spark, docs, sf_dir), f"stage{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
