"""Silence in sample arrays: islands, compression, deletions by segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values: -50 dB as an amplitude, and the shortest silence that is reported.
LEVEL, MIN_SECONDS, RATE = 10 ** (-50 / 20), 0.05, 48000
THRESHOLD_MS, TARGET_MS = 200, 200


def islands(samples: DataFrame, key: str, pos: str, value: str, level: float = LEVEL, least: int = int(MIN_SECONDS * RATE)) -> DataFrame:
    """key, start, end (half-open): maximal runs of at least ``least`` samples below level.

    One row for each sample: for short arrays; array_islands() does whole clips in a row.
    """
    quiet = samples.where(F.abs(F.col(value)) < level)
    group = F.col(pos) - F.row_number().over(Window.partitionBy(key).orderBy(pos))
    runs = quiet.select(key, pos, group.alias("g")).groupBy(key, "g").agg(F.min(pos).cast("long").alias("start"), (F.max(pos) + 1).cast("long").alias("end"))
    return runs.where(F.col("end") - F.col("start") >= least).select(key, "start", "end")


def array_islands(array, level: float = LEVEL, least: int = int(MIN_SECONDS * RATE)):
    """The same for an array column: array<struct<start, end>>, without a shuffle."""
    loud = F.filter(F.transform(array, lambda x, i: F.when(F.abs(x) >= level, i)), lambda i: i.isNotNull())
    edge = F.concat(F.array(F.lit(-1)), loud, F.array(F.size(array)))
    gaps = F.transform(F.sequence(F.lit(1), F.size(edge) - 1), lambda i: F.struct((F.get(edge, i - 1) + 1).cast("long").alias("start"), F.get(edge, i).cast("long").alias("end")))
    return F.filter(gaps, lambda g: g["end"] - g["start"] >= max(1, least))


def silence_edits(intervals: DataFrame, key: str, frames: str = "n_frames", rate: int = RATE, threshold_ms: float = THRESHOLD_MS, target_ms: float = TARGET_MS) -> DataFrame:
    """The edit of each interval longer than the threshold: what follows its first target_ms goes.

    Intervals are clamped to the clip; the deleted range is [start + target, end).
    """
    if not 0 < target_ms <= threshold_ms:
        raise ValueError("target must be above zero and at most the threshold")
    keep, limit = round(rate * target_ms / 1000), round(rate * threshold_ms / 1000)
    s, e = F.greatest(F.lit(0), F.col("start")), F.least(F.col(frames), F.col("end"))
    i = intervals.select(key, frames, s.cast("long").alias("start_frame"), e.cast("long").alias("end_frame")).where(F.col("end_frame") - F.col("start_frame") > limit)
    return i.select(
        key, frames, "start_frame", "end_frame", (F.col("start_frame") / rate).alias("start_seconds"), (F.col("end_frame") / rate).alias("end_seconds"),
        ((F.col("end_frame") - F.col("start_frame")) * 1000.0 / rate).alias("duration_ms_before"), F.lit(float(target_ms)).alias("target_duration_ms"),
        (F.col("start_frame") + keep).alias("delete_start_frame"), F.col("end_frame").alias("delete_end_frame"), (F.col("end_frame") - F.col("start_frame") - keep).alias("deleted_frames"),
    )


def coalesce_intervals(intervals: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """key, start, end of unions of overlapping or touching intervals."""
    w = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col(start) > before), 1).otherwise(0)
    g = intervals.select(key, F.col(start).alias("start"), F.col(end).alias("end"), new.alias("new"))
    g = g.withColumn("g", F.sum("new").over(Window.partitionBy(key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)))
    return g.groupBy(key, "g").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("g")


def segment_deletions(segments: DataFrame, deletions: DataFrame, key: str) -> DataFrame:
    """Overlaps of deletions with segments, in each segment's own frames.

    An interval join within a key; the equality on key deals both sides out, so no side is
    broadcast or multiplied.
    """
    s, d = segments.alias("s"), deletions.alias("d")
    both = s.join(d, (F.col(f"s.{key}") == F.col(f"d.{key}")) & (F.col("d.start") < F.col("s.end_frame")) & (F.col("d.end") > F.col("s.start_frame")))
    lo = F.greatest(F.lit(0), F.col("d.start") - F.col("s.start_frame"))
    hi = F.least(F.col("s.end_frame"), F.col("d.end")) - F.col("s.start_frame")
    return both.select(f"s.{key}", "s.seq", lo.cast("long").alias("local_start"), hi.cast("long").alias("local_end"))


def kept_ranges(ranges, size):
    """array<struct<start, end>> (half-open) of what is left of 0 .. size without the ranges, which
    may overlap; one pass over them in the order of their starts."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    state = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("kept"))

    def step(s, r):
        more = F.when(r["start"] > s["at"], F.concat(s["kept"], F.array(F.struct(s["at"].alias("start"), F.least(r["start"], size.cast("long")).cast("long").alias("end"))))).otherwise(s["kept"])
        return F.struct(F.greatest(s["at"], r["end"].cast("long")).alias("at"), more.alias("kept"))

    last = F.struct(size.cast("long").alias("start"), size.cast("long").alias("end"))
    plain = F.transform(F.coalesce(ranges, empty), lambda r: F.struct(r["start"].cast("long").alias("start"), r["end"].cast("long").alias("end")))
    return F.filter(F.aggregate(F.concat(F.sort_array(plain), F.array(last)), state, step)["kept"], lambda r: r["end"] > r["start"])


def remove_ranges(array, ranges):
    """The array without the positions (from 0) in array<struct<start, end>>: what lies between
    the ranges, put together."""
    return F.flatten(F.transform(kept_ranges(ranges, F.size(array)), lambda r: F.slice(array, r["start"].cast("int") + 1, (r["end"] - r["start"]).cast("int"))))


def refuse_loud(edits: DataFrame, clips: DataFrame, key: str, samples: str = "samples", level: float = LEVEL) -> DataFrame:
    """The edits, held against the clips' samples: one that would delete a sample at or above
    level raises, as what the scan took for silence is not."""
    both = edits.join(clips.select(key, F.col(samples).alias("__x")), key)
    loud = F.exists(F.slice("__x", (F.col("delete_start_frame") + 1).cast("int"), F.col("deleted_frames").cast("int")), lambda x: F.abs(x.cast("double")) >= level)
    told = F.format_string("a silence holds audible samples, nothing is cut: %.3f-%.3f seconds", "start_seconds", "end_seconds")
    held = F.when(F.coalesce(loud, F.lit(False)), F.raise_error(told).cast("long")).otherwise(F.col("deleted_frames"))
    return both.withColumn("deleted_frames", held).drop("__x")


def residual(intervals: DataFrame, rate: int = RATE, limit_ms: float = 200.0) -> DataFrame:
    """Silences that are still too long."""
    return intervals.where((F.col("end") - F.col("start")) * 1000.0 / rate > limit_ms)
