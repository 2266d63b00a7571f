"""The corpus pipeline: stages over ``documents``, each one of the operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import bpe
from hearth.llm.common import documents, shared_folder, table
from hearth.llm.exact_dedup import drop_exact_copies
from hearth.llm.mixing import draw_copies, mix
from hearth.llm.near_dup import drop_near_copies
from hearth.llm.toxicity import toxicity

#: shares of the token budget that the mixing stage aims at: no toxic documents,
#: and one in ten tokens from documents of low quality
WEIGHTS = {"good": 0.9, "poor": 0.1, "toxic": 0.0}


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or model calls toxic go."""
    return toxicity(docs, table(spark, sf_dir, "labels")).filter("predicted = 0").select("row.*")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return drop_exact_copies(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group connected by n-gram similarity one document stays."""
    return drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out by the rates fitted to the weights."""
    mixed, _ = mix(docs, table(spark, sf_dir, "labels"), weights=WEIGHTS, keep_text=True)
    return draw_copies(mixed)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to."""
    out = bpe.encode(docs, decoded=True)
    return out.select("row.*", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity_stage), ("exact dedup", exact_dedup_stage),
          ("near duplicates", near_dup_stage), ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: SQL can't express the classifiers, the similarity groups or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
