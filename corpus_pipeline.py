"""From raw documents to packed sequences; each stage applies one operator.

Every stage reads all that its predecessor kept, written as Parquet, and but
for the last returns the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packhorse.functions.columns import unused
from packhorse.llm import language_id
from packhorse.llm.common import stored, table
from packhorse.llm.jaccard_join import first_of_each
from packhorse.llm.packing import pack
from packhorse.llm.packing import production as packing_settings
from packhorse.llm.quality_rules import quality_rules
from packhorse.llm.secrets import find_secrets, redact


# Target shares of sources are their numbers of tokens to this power.
MIXTURE = 0.7


def _all(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`") for name in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    verdict = unused("verdict", docs.columns)
    judged = quality_rules(docs, out=verdict)
    return judged.filter(F.col(verdict).kept).select(*_all(docs))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear margin."""
    settings = language_id.Settings()
    dictionaries = language_id.fit_documents(docs, settings)
    told = unused("language", docs.columns)
    judged = language_id.language_id(docs, dictionaries, settings, out=told)
    return judged.filter(F.col(told).accepted).select(*_all(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links join, the one with the smallest id."""
    return first_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark, also one that many have."""
    spans = unused("secrets", docs.columns)
    clean = redact(find_secrets(docs, out=spans, copied_too=True), spans=spans)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*_all(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences that hold the documents, smaller sources being sent sooner than their sizes say."""
    return pack(docs, packing_settings(), temperature=MIXTURE)


STAGES = [
    ("quality rules", keep_quality),
    ("language id", keep_known_languages),
    ("n-gram Jaccard join", keep_one_of_each),
    ("secret scans", without_secrets),
    ("packing", packed),
]

# Compression cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"stage-{number}")
    return docs
