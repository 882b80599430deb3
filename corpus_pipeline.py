"""Corpus pipeline: quality rules, SimHash near-dedup, personal data, packing.

Null texts are empty and leave with the quality rules; rows without a key, with
a repeated key or with further columns go through every stage as they are. Of
linked texts the one with the least key stays (those without a key last), of
rows with one key and one text one. Without a column ``n_chars`` none is made.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost.llm import packing, pii, quality, simhash
from waypost.llm.common import table, text_of
from waypost.session import materialize


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by SimHash fingerprints: three-word shingles, at most 3 of 64 bits."""
    return simhash.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked by its kind; n_chars follows the text."""
    masked = pii.redact(docs, pii.fit(pii.labelled_windows(docs)))
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in length buckets and batches."""
    return packing.pack(docs, F.octet_length(text_of("text")) + 1)


STAGES = [("quality rules", rules), ("near-duplicates", near_duplicates), ("personal data", personal_data), ("packing", pack)]

#: Near-duplicate groups and the model's spans are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
