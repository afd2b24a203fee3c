"""A cleaning pipeline over `documents`, made of the operators in skerry.llm.

Toxic documents go, one document of each near-duplicate class stays, benchmark
passages are cut out (documents that consist mostly of them go), personal
numbers and addresses get pseudonyms, and the rest is encoded. Every stage reads
all that its predecessor wrote.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from skerry.llm import byte_bpe, decontaminate, jaccard_forest, pii, toxicity
from skerry.llm.queries import PSEUDONYM_KEY
from skerry.llm.shared import read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows under the threshold of their language; the classifier is fitted on labelled rows of `docs`."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_forest.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contamination(docs, read_table(spark, sf_dir, "benchmark"), length_col="n_chars")


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms may be longer or shorter than the values (addresses, dates), so the length is taken anew."""
    masked = pii.pseudonymise_column(docs, PSEUDONYM_KEY)
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.withColumn("n_chars", size).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("PII", pseudonymise),
    ("byte-level BPE", encode),
]

# The classifier and the forest have no SQL form; tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each result written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
