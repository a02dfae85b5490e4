"""A corpus pipeline over ``documents``: toxicity filter, near-dedup, secret redaction, source mixing, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auctionflow.llm import minhash, mixing, packing, secrets, toxicity
from auctionflow.llm.queries import TOKENIZER
from auctionflow.llm.shared import staged


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the CRF, trained on the labelled ones among ``docs``, scores 0.3 or more."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked at a similarity of 0.8 of five-word shingles."""
    return minhash.one_of_each(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in the texts; all documents stay."""
    return secrets.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the curriculum takes, in training order."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 1024."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [("toxicity", toxicity_stage), ("MinHash near-dedup", near_dedup_stage), ("secret scans", secret_stage),
          ("mixing sources", mixing_stage), ("best-fit packing", packing_stage)]

#: The toxicity model is fitted and tokens come from a vocabulary file, neither of which SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is staged in the session's shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, name.replace(" ", "-"))
    return docs
