"""Putting selected clips together: timelines, hashes, verification, edits and review rows.

A clip is one row with its samples as array<float>. A recording is the clips of one key in
the order of seq; only join_clips() holds a whole recording in a row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators import selection
from cadenza.operators.silence import RATE, remove_ranges


def sample_sha256(samples: Column | str) -> Column:
    """SHA-256 of the samples as little-endian 32-bit floats; null for null."""

    @F.pandas_udf("string")
    def digest(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None else hashlib.sha256(np.asarray(v, "<f4").tobytes()).hexdigest())

    return digest(samples)


def format_error(rate: Column, channels: Column, kind: Column) -> Column:
    """What keeps a clip from being joined as it is, or null: 48 kHz, one channel, 32-bit floats."""
    fits = (rate == RATE) & (channels == 1) & (kind == "float32")
    return F.when(~F.coalesce(fits, F.lit(False)), F.concat_ws(" ", F.lit("not 48 kHz mono float32:"), rate.cast("string"), channels.cast("string"), kind))


def matched(segments: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Segments with exactly one row each; a segment without one, or with several, raises.

    Both sides meet on keys; the check is an expression of the joined rows, so it costs no pass
    of its own.
    """
    found = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.any_value(F.struct(*[c for c in rows.columns if c not in keys])).alias("__r"))
    both = segments.join(found, keys, "left")
    bad = F.raise_error(F.concat(F.lit("no single row for segment "), F.concat_ws("/", *(F.col(k).cast("string") for k in keys))))
    ok = F.when(F.col("__n") == 1, F.col("__r")).otherwise(bad.cast(both.schema["__r"].dataType))
    return both.withColumn("__r", ok).select(*segments.columns, "__r.*")


def assemble(clips: DataFrame, keys: list[str]) -> DataFrame:
    """clips (keys, seq, segment_id, samples, ...) with frames, start_frame, end_frame, seconds and
    sample_sha256, laid end to end in the order of seq."""
    return selection.timeline(clips.withColumn("frames", F.size("samples").cast("long")), keys).withColumn("sample_sha256", sample_sha256("samples"))


def join_clips(clips: DataFrame, keys: list[str]) -> DataFrame:
    """keys, samples of the whole recording, sample_sha256, frames."""
    whole = clips.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("seq", "samples"))).alias("c"))  # one recording's clips
    joined = whole.select(*keys, F.flatten(F.transform("c", lambda x: x["samples"])).alias("samples"))
    return joined.select("*", sample_sha256("samples").alias("sample_sha256"), F.size("samples").cast("long").alias("frames"))


def verify_assembly(line: DataFrame, whole: DataFrame, keys: list[str]) -> DataFrame:
    """Every clip of a timeline with ``kept``: whether the whole recording holds its samples at
    its place, one by one."""
    w = whole.select(*keys, F.col("samples").alias("__all"))
    both = line.join(w, keys, "left")
    part = F.slice("__all", F.col("start_frame").cast("int") + 1, F.size("samples"))
    return both.withColumn("kept", F.coalesce(part == F.col("samples"), F.lit(False))).drop("__all")


def after_edits(line: DataFrame, deletions: DataFrame, key: str) -> DataFrame:
    """The timeline after deletions (key, start, end in frames of the recording): clips without the
    deleted samples, laid end to end again; where they were is kept as original_start_frame and
    original_end_frame."""
    cuts = deletions.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cuts"))  # one recording's edits
    both = line.join(cuts, key, "left")
    a, b = F.col("start_frame"), F.col("end_frame")
    here = F.filter(F.coalesce("__cuts", F.array().cast("array<struct<start:bigint,end:bigint>>")), lambda d: (d["start"] < b) & (d["end"] > a))
    local = F.transform(here, lambda d: F.struct(F.greatest(F.lit(0), d["start"] - a).cast("long").alias("start"), (F.least(b, d["end"]) - a).cast("long").alias("end")))
    left = both.select("*", a.alias("original_start_frame"), b.alias("original_end_frame"), remove_ranges(F.col("samples"), local).alias("__left"))
    again = left.drop("__cuts", "samples", "frames", "start_frame", "end_frame", "start_seconds", "end_seconds", "duration_seconds", "sample_sha256")
    return assemble(again.withColumnRenamed("__left", "samples"), [key])


def review_rows(segments: DataFrame, selected: DataFrame, line: DataFrame, overrides: DataFrame | None = None, keys: tuple[str, ...] = ("segment_id",)) -> DataFrame:
    """The review list, a row for each segment: which clip to listen to, and where it went.

    overrides: keys, audio_path of clips that were edited after they were selected. A segment
    without a selected clip or a place in the timeline raises.
    """
    k = list(keys)
    s = matched(segments.select(*k, "seq", "text"), selected.select(*k, "audio_path", F.coalesce("seed", F.lit(0)).alias("seed"), F.coalesce("round_index", F.lit(0)).alias("round_index")), k)
    s = matched(s, line.select(*k, "duration_seconds", F.col("start_seconds").alias("final_start_seconds"), F.col("end_seconds").alias("final_end_seconds"), "sample_sha256"), k)
    if overrides is None:
        return s.withColumn("postprocessed", F.lit(False))
    s = s.join(overrides.select(*k, F.col("audio_path").alias("__edited")), k, "left")
    return s.withColumn("audio_path", F.coalesce("__edited", "audio_path")).drop("__edited").withColumn("postprocessed", F.lit(True))
