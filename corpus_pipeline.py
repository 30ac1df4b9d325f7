"""The corpus pipeline: each stage reads what the one before kept, as documents.

toxicity    documents that the model scores at 0.5 or more go
quality     documents over their language's cross-entropy threshold go
near_dedup  one document of each group of near-duplicates stays, that with the smallest doc_id
mixing      nine tenths of all words, dealt to domains, languages and sources by weight
packing     pieces of the documents that are left, placed in sequences
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arborpay.llm.common import Workspace, without_ids
from arborpay.llm.minhash_forest import near_duplicates
from arborpay.llm.mixing import mix
from arborpay.llm.packing import pack_documents, piece_digests
from arborpay.llm.quality_lm import classify
from arborpay.llm.queries import WEIGHTS
from arborpay.llm.toxicity_pu import drop_toxic


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, _labels(spark, sf_dir))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rejected = classify(docs, _labels(spark, sf_dir)).where("not kept").select("doc_id")
    return without_ids(Workspace(spark, "pipeline-quality"), docs, rejected).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = near_duplicates(docs).where("not kept").select("doc_id")
    return without_ids(Workspace(spark, "pipeline-dedup"), docs, copies).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, WEIGHTS, share=0.9, epochs=1, seed=9).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digests(pack_documents(docs))


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]
#: Two stages are learned models and one tokenises, so SQL cannot state the rows; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = ws.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
