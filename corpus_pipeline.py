"""A training corpus from the documents table: identified, deduplicated, decontaminated, redacted, and packed.

Each stage takes what its predecessor kept, written as Parquet and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from changefold.llm.common import stored, table
from changefold.llm.decontamination import drop_contaminated
from changefold.llm.language import keep_identified
from changefold.llm.ngram_join import keep_one
from changefold.llm.packing import pack_documents
from changefold.llm.pii import redact

#: Near duplicates share this part of their shingles of so many words; op2 has values of its own.
NEAR_PERCENT, NEAR_SHINGLE = 80, 5


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return keep_one(docs, NEAR_PERCENT, NEAR_SHINGLE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]
#: SQL can express neither the language models, the span classifier nor the packing search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
