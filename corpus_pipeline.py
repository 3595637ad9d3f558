"""A corpus pipeline: toxicity, line dedup, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontaminate, line_dedup, near_copies, pieces, toxicity
from cadenza.llm.common import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; null and empty texts stay."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_texts(docs, model, score_col="__score")
    return scored.where("__score < 0.5").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that are near-duplicates of earlier ones; n_chars follows."""
    out = line_dedup.dedup_lines(docs)
    return out.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts with a similarity of 0.8 or more, found by SimHash and
    Golay keys: the one with the smallest doc_id."""
    return near_copies.keep_one(docs).select(*docs.columns)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are not a twentieth or more."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, with ids, n_tokens and whether decoding gave the text back."""
    both = pieces.encode(docs, pieces.default_model(), check_col="round_trip")
    return both.select(*docs.columns, "ids", "n_tokens", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_copies),
    ("SentencePiece encoding", encode_texts),
]

#: Model scores, fuzzy lines and piece ids are beyond SQL; tests hold line dedup and near-dedup against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
