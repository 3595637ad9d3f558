"""The retry loop: generate, analyse, evaluate, select, until every segment has a candidate
that passes or the retries are used up. Generator and recognizer are functions that return
DataFrames; each round is written, so a lost executor costs no model call."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators import selection
from cadenza.operators.evaluate import RESIDUAL_SILENCE, Quality, evaluate, speech_rate, timestamp_pairs, with_score
from cadenza.operators.silence import residual
from cadenza.sources.worker import seed_of_round, split_reference

Worker = Callable[[DataFrame, int], DataFrame]


def round_table(df: DataFrame, tag: str) -> DataFrame:
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(tempfile.gettempdir(), "checkpoints")
    path = f"{root.rstrip('/')}/cadenza-runs/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run(spark: SparkSession, segments: DataFrame, worker: Worker, q: Quality = Quality(), retries: int = 2, base_seed: int = 20235791, stride: int = 104729) -> tuple[DataFrame, DataFrame, DataFrame]:  # noqa: B008
    """(history, selected, unresolved). worker(segments with a seed, round) returns worker
    results, in round 0 with the reference's row if there is one.

    A reference that could not be analysed turns its rules off.
    """
    history, waiting, rate, reference = None, segments, 0.0, {}
    selected = None
    for i in range(retries + 1):
        asked = waiting.withColumn("seed", seed_of_round(i, base_seed, stride))
        found = round_table(worker(asked, i), f"results-{i}")
        found, ref = split_reference(found)
        if i == 0:
            row = ref.where(F.coalesce("error", F.lit("")) == "").select(speech_rate(timestamp_pairs(F.col("timestamps_ms"))).alias("rate"), "acoustic").first()
            if row is not None:
                rate, reference = row["rate"], row["acoustic"].asDict(recursive=True) if row["acoustic"] else {}
        judged = selection.muffle_warnings(evaluate(selection.with_results(asked, found, "seed"), q, i, rate), reference)
        judged = judged.withColumn("boundary_issue", F.lit(None).cast("struct<left_segment_id:string,right_segment_id:string,gap_ms:double,minimum_ms:double,maximum_ms:double>"))
        history = judged if history is None else history.unionByName(judged)
        changed, _ = selection.apply_boundary(history.drop("boundary_issue"), segments, q)
        kept = history.select("segment_id", "round_index", F.col("boundary_issue").alias("__old"))
        history = changed.join(kept, ["segment_id", "round_index"]).withColumn("boundary_issue", F.coalesce("__old", "boundary_issue")).drop("__old")
        history = round_table(history, f"history-{i}")
        selected = round_table(selection.select_best(history), f"selected-{i}")
        waiting = selection.pending(segments, selected)
        if waiting.isEmpty():
            break
    return history, selected, waiting


def final_check(result: DataFrame, silences: DataFrame, history: DataFrame, q: Quality = Quality()) -> DataFrame:  # noqa: B008
    """The whole recording's candidate: rules on pauses and speed are off, and silences that
    are still too long are a failure."""
    last = history.agg(F.max("round_index")).first()[0]
    c = evaluate(result, q, (last or 0) + 1, 0.0, prosody=False)
    if not residual(silences).isEmpty():
        c = c.withColumn("hard_failures", F.concat("hard_failures", F.array(F.lit(RESIDUAL_SILENCE))))
    return with_score(c)
