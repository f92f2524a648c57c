"""The corpus pipeline: language ID, near-duplicate removal, surrogates for personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return the
columns of documents. run() writes each stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import jaccard, langid, mixing, packing, surrogates
from framewright.llm.common import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier accepts; it learns from a bounded sample of their own labels."""
    return langid.keep_identified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least doc_id."""
    return jaccard.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data."""
    done = surrogates.replace_entities(docs, surrogates.QUERY_KEY)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out as their sources' targets ask."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: where each piece of a document stands in which sequence."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixing", mix), ("packing", pack)]

#: Classifiers, minhash forests and tokenizers are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
