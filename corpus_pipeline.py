"""From raw documents to packed sequences: language, near-duplicates, personal data, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import langid, mixing, neardup, packing, pii
from orderflow.llm.common import table, written
from orderflow.llm.queries import tokenizer_file


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; texts without letters and those in no language go."""
    return langid.identified(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id."""
    return neardup.survivors(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.masked(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    taken = mixing.mix(docs).filter("copies > 0")
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], copies.alias("__copy")).drop("__copy")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_file()).withColumn("ids_crc32", F.crc32("ids").cast("long")).drop("ids")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packed", packed),
]

#: No stage's model or sample can be told in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
