"""Corpus preparation in five stages over ``documents``: toxic documents go,
of equal texts one stays, of near copies one stays, personal data is masked,
and what is left is packed into token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the docs of the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import exact_dedup, near_dedup, packing, pii, toxicity
from pitwall.llm.queries import WORD_BPE, piece_digests
from pitwall.llm.shared import documents, fresh, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score, rejected = fresh(docs, "score"), fresh(docs, "rejected")
    scored = toxicity.score(docs, model, docs.columns, added=(score, rejected))
    return scored.where(F.col(rejected) == 0).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digests(packing.pack(docs, WORD_BPE))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: The classifier, the sampling of near copies and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
