"""A corpus from documents: language, exact copies, near copies, personal data, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written and read again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnflow.llm import exact_dedup, language, minhash_dedup, packing, pii
from firnflow.llm.common import stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier tells; those without letters or with a narrow margin go."""
    learned = language.fitted(docs.where(~language.held_out()))
    columns = [docs[f"`{c}`"] for c in docs.columns]
    return language.predicted(docs, learned, *columns).where(~F.col("rejected")).select(*(f"`{c}`" for c in docs.columns))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


NEAR_PERCENT = 80  # of two documents' shingles that make them near copies; the stage has no contract of its own


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.deduplicated(docs, NEAR_PERCENT)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.without(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences with their ids."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("personal_data", without_personal_data),
    ("packing", sequences),
]

# The language stage is a trained classifier, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
