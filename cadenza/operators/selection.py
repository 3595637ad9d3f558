"""Choosing candidates, pauses between segments, timelines, metric and report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions import text as X
from cadenza.operators.evaluate import BOUNDARY, MUFFLED, Quality, failure_details, with_score


def select_best(candidates: DataFrame, keys: list[str] | None = None, order: str = "round_index") -> DataFrame:
    """The passing candidate with the least score of each segment; of equals the earliest."""
    keys = keys or ["segment_id"]
    best = candidates.where("passed").groupBy(*keys).agg(F.min_by(F.struct(*candidates.columns), F.struct("score", order)).alias("best"))
    return best.select("best.*")


def pending(segments: DataFrame, selected: DataFrame) -> DataFrame:
    """Segments without a selected candidate."""
    return segments.join(selected.select("segment_id"), "segment_id", "left_anti")


def with_results(segments: DataFrame, results: DataFrame, order: str | None = None) -> DataFrame:
    """Every segment with its worker result; a missing one is an error row, of several the
    last one (by ``order``) counts."""
    rest = [c for c in results.columns if c != "segment_id"]
    last = results.groupBy("segment_id").agg((F.max_by(F.struct(*rest), F.struct(order)) if order else F.last(F.struct(*rest))).alias("r"))
    joined = segments.select("segment_id", F.col("text").alias("segment_text")).join(last, "segment_id", "left")
    cols = [F.coalesce("r.error", F.when(F.col("r").isNull(), "ASR worker did not return this segment")).alias("error") if c == "error" else F.coalesce("r.target_text", "segment_text").alias(c) if c == "target_text" else F.col(f"r.{c}").alias(c) for c in rest]
    return joined.select("segment_id", *cols)


def muffle_warnings(candidates: DataFrame, reference: dict, group: list[str] | None = None) -> DataFrame:
    """Adds a warning, and muffle figures, where a candidate is darker than the reference and
    the median of its group (default: its round). Rows without acoustics are left as they are.

    If neither the group nor the reference has a positive centroid there is no baseline: no
    warning, and no centroid ratio.
    """
    group = group or ["round_index"]
    ref_c, ref_h = float(reference.get("spectral_centroid_hz") or 0), float(reference.get("high_frequency_ratio_4khz") or 0)
    num = lambda c: F.coalesce(F.col(f"acoustic.{c}"), F.lit(0.0))
    medians = candidates.where("acoustic IS NOT NULL").groupBy(*group).agg(F.median(F.when(num("spectral_centroid_hz") > 0, num("spectral_centroid_hz"))).alias("__median"))
    c = candidates.join(F.broadcast(medians), group, "left") if group == ["round_index"] else candidates.join(medians, group, "left")  # a row for each round
    middle = F.coalesce("__median", F.lit(ref_c))
    base = F.when((F.lit(ref_c) > 0) & (middle > 0), (ref_c + middle) / 2).when(F.lit(ref_c) > 0, ref_c).when(middle > 0, middle)
    dark = F.coalesce((num("spectral_centroid_hz") < base * 0.75) & (num("high_frequency_ratio_4khz") < ref_h * 0.65) & F.lit(ref_h > 0), F.lit(False))
    known = F.col("acoustic").isNotNull() & F.lit(bool(reference))
    figures = F.struct(F.lit(ref_c).alias("reference_centroid_hz"), middle.alias("batch_centroid_median_hz"), (num("spectral_centroid_hz") / base).alias("centroid_ratio"), (num("high_frequency_ratio_4khz") / F.lit(ref_h if ref_h > 0 else None).cast("double")).alias("high_frequency_ratio_vs_reference"))
    out = c.withColumns({"warnings": F.when(known & dark, F.concat("warnings", F.array(F.lit(MUFFLED)))).otherwise(F.col("warnings")), "muffle": F.when(known, figures)})
    return with_score(out.drop("__median"))


def neighbours(ordered: Window, leading: Column, trailing: Column) -> Column:
    """Silence between a row and the next one."""
    return trailing + F.lead(leading).over(ordered)


def boundary_issues(selected: DataFrame, keys: list[str], q: Quality = Quality()) -> DataFrame:  # noqa: B008
    """Victims of bad pauses between neighbouring segments: keys, segment_id, gap figures.

    selected: keys, seq, segment_id, leading_ms, trailing_ms. The right segment is the victim
    of a short pause, or if its own silence is the larger part; a segment is a victim once,
    of its first bad pause. Everything is judged on the selection as it was.
    """
    w = Window.partitionBy(*keys).orderBy("seq") if keys else Window.orderBy("seq")
    nxt = lambda c: F.lead(c).over(w)
    pairs = selected.select(*keys, "seq", F.col("segment_id").alias("left_segment_id"), nxt("segment_id").alias("right_segment_id"), (F.coalesce("trailing_ms", F.lit(0.0)) + F.coalesce(nxt("leading_ms"), F.lit(0.0))).alias("gap_ms"), F.coalesce("trailing_ms", F.lit(0.0)).alias("t"), F.coalesce(nxt("leading_ms"), F.lit(0.0)).alias("l"))
    bad = pairs.where(F.col("right_segment_id").isNotNull() & ~F.col("gap_ms").between(q.cross_segment_gap_min_ms, q.cross_segment_gap_max_ms))
    right = (F.col("gap_ms") < q.cross_segment_gap_min_ms) | (F.col("l") >= F.col("t"))
    issue = F.struct("left_segment_id", "right_segment_id", "gap_ms", F.lit(float(q.cross_segment_gap_min_ms)).alias("minimum_ms"), F.lit(float(q.cross_segment_gap_max_ms)).alias("maximum_ms"))
    victims = bad.select(*keys, "seq", F.when(right, F.col("right_segment_id")).otherwise(F.col("left_segment_id")).alias("segment_id"), issue.alias("boundary_issue"))
    return victims.groupBy(*keys, "segment_id").agg(F.min("seq").alias("pair_seq"), F.min_by("boundary_issue", "seq").alias("boundary_issue"))


def apply_boundary(candidates: DataFrame, segments: DataFrame, q: Quality = Quality()) -> tuple[DataFrame, DataFrame]:  # noqa: B008
    """(candidates with the rule applied to the selected ones, victims). Runs only if every
    segment has a passing candidate; else nothing changes."""
    chosen = select_best(candidates)
    whole = pending(segments, chosen).isEmpty()
    rows = chosen.join(segments.select("segment_id", "seq"), "segment_id").select("seq", "segment_id", "round_index", F.col("acoustic.leading_silence_ms").alias("leading_ms"), F.col("acoustic.trailing_silence_ms").alias("trailing_ms"))
    victims = boundary_issues(rows, [], q).join(chosen.select("segment_id", "round_index"), "segment_id")
    if not whole:
        victims = victims.limit(0)
    hit = victims.select("segment_id", "round_index", F.col("boundary_issue").alias("__issue"))
    out = candidates.drop("boundary_issue").join(hit, ["segment_id", "round_index"], "left")
    out = out.withColumns({"hard_failures": F.when(F.col("__issue").isNotNull(), F.concat("hard_failures", F.array(F.lit(BOUNDARY)))).otherwise(F.col("hard_failures")), "boundary_issue": F.col("__issue")}).drop("__issue")
    return with_score(out), victims


def timeline(clips: DataFrame, keys: list[str], frames: str = "frames", rate: int = 48000) -> DataFrame:
    """start_frame, end_frame and seconds of clips laid end to end in the order of seq."""
    w = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(frames).over(w), F.lit(0))
    c = clips.withColumn("start_frame", start.cast("long")).withColumn("end_frame", (F.col("start_frame") + F.col(frames)).cast("long"))
    return c.withColumns({"start_seconds": F.col("start_frame") / rate, "end_seconds": F.col("end_frame") / rate, "duration_seconds": F.col(frames) / rate})


def metric_records(candidates: DataFrame, selected: DataFrame, line: DataFrame | None = None, final: DataFrame | None = None) -> DataFrame:
    """Candidate, selection and final check records in one table, told apart by record_type."""
    sel = selected.select("segment_id", "round_index", "audio_path", "seed", "passed")
    if line is not None:
        extra = [c for c in ("start_seconds", "end_seconds", "duration_seconds", "review_audio_path") if c in line.columns]
        sel = sel.join(line.select("segment_id", *extra), "segment_id", "left")
    out = candidates.withColumn("record_type", F.lit("candidate")).unionByName(sel.withColumn("record_type", F.lit("selection")), allowMissingColumns=True)
    return out if final is None else out.unionByName(final.withColumn("record_type", F.lit("final_qc")), allowMissingColumns=True)


def attempts(candidates: DataFrame, keys: list[str], order: str = "round_index") -> DataFrame:
    """regenerations, initially_failed and finally_failed of each segment."""
    return candidates.groupBy(*keys).agg((F.count("*") - 1).alias("regenerations"), F.min_by(~F.col("passed"), order).alias("initially_failed"), (~F.max("passed")).alias("finally_failed"))


def report_totals(per_segment: DataFrame) -> DataFrame:
    one = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    return per_segment.agg(F.count("*").alias("segments"), one("initially_failed").alias("initially_failed"), one("finally_failed").alias("finally_failed"), one("regenerations").alias("regenerations"))


def report_lines(segments: DataFrame, candidates: DataFrame, line: DataFrame | None = None) -> DataFrame:
    """seq, lines: the report's text on each segment. The wording."""
    issue = F.col("boundary_issue") if "boundary_issue" in candidates.columns else F.lit(None).cast("struct<left_segment_id:string,right_segment_id:string,gap_ms:double>")
    said = F.when(F.col("passed"), "通过（检测问题0项）").otherwise(F.concat(F.lit("未通过（检测问题"), F.size("hard_failures"), F.lit("项）："), F.array_join(failure_details(F.col("hard_failures"), F.col("metrics"), issue), "、")))
    tries = candidates.select("segment_id", "round_index", "passed", "seed", said.alias("said")).groupBy("segment_id").agg(F.sort_array(F.collect_list(F.struct("round_index", "seed", "said", "passed"))).alias("a"))  # as many as retries allow
    s = segments.select("seq", "segment_id", "text").join(tries, "segment_id")
    s = s.join(line.select("segment_id", "start_seconds", "end_seconds"), "segment_id", "left") if line is not None else s.withColumns({"start_seconds": F.lit(None).cast("double"), "end_seconds": F.lit(None).cast("double")})
    sec = lambda c: F.format_string("%.3f", F.col(c))
    place = F.concat(F.lit("成品位置："), X.audio_time(F.col("start_seconds")), F.lit(" - "), X.audio_time(F.col("end_seconds")), F.lit("（"), sec("start_seconds"), F.lit("秒 - "), sec("end_seconds"), F.lit("秒）"))
    name = lambda i: F.when(i == 0, "首次生成").otherwise(F.concat(F.lit("第"), i, F.lit("次重新生成")))
    told = F.transform("a", lambda x, i: F.concat(name(i), F.lit("（seed="), x["seed"], F.lit("）："), x["said"]))
    head = F.filter(F.array(F.concat(F.lit("对应文字："), F.col("text")), F.when(F.col("start_seconds").isNotNull(), place), F.concat(F.lit("重新生成："), F.size("a") - 1, F.lit("次"))), lambda x: x.isNotNull())
    last = F.concat(F.lit("最终状态："), F.when(F.exists("a", lambda x: x["passed"]), "通过").otherwise("仍未通过"))
    return s.select("seq", F.concat(head, told, F.array(last, F.lit(""))).alias("lines"))
