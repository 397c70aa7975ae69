"""The corpus pipeline: operators of ``provdata.llm`` applied to ``documents`` one after the other.

Each stage takes what its predecessor kept, whole, and its decisions take effect: all but the last
return the columns of ``documents``, the last one row per packed piece.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from provdata.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from provdata.session import ensure_checkpoint_dir


def clean_of_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's toxicity threshold, by a classifier of the labelled ones."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle similarity of 0.75 or more, the one with the smallest doc_id, if any has one."""
    return jaccard_join.drop_near_duplicates(docs, spare_unnamed=False)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix to source weights 1, 2, 3 takes them."""
    return mixing.repeat_to_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, placed in sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", clean_of_toxic), ("exact dedup", without_copies), ("near duplicates", without_near_copies),
          ("source mix", source_mix), ("packing", packed)]

#: None: stages run a trained model, a similarity join and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written as Parquet and read again by the next."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
