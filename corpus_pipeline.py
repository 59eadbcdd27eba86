"""A corpus pipeline over ``documents``: each stage reads what its predecessor kept.

All stages take null texts as empty ones (PII leaves them null), keep rows with a null doc_id, give an empty table for an empty one, and
return the columns they were given, in order and however named; packing returns pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.llm import exact_dedup, packing, pii, quality, simhash
from lexiforge.storage import materialize, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Without labels of both classes nothing is learned: all stay if all labels are 1."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, that with the smallest doc_id; of rows that repeat it, one."""
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest doc_id: five-word shingles, a similarity of 0.8 or more."""
    return simhash.keep_one_of_each_group(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms in the text; n_chars follows."""
    done = pii.pseudonyms(docs)
    return done.withColumn("n_chars", F.when(F.size("pii_kinds") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens, in an order that does not depend on the files before: shards by doc_id, sorted by doc_id and text.

    The number of shards is that of shuffle partitions; the same rows and number give the same pieces.
    """
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartition(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    return packing.packed(ordered, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("PII", pii_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the classifier nor the fingerprints; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's documents are written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
