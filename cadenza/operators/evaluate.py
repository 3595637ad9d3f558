"""Candidate evaluation: sixteen quality rules over one row for each candidate.

All measures of a candidate are array expressions over its own row, so evaluation adds no
shuffle; the only Python is the alignment.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import text as X
from cadenza.operators.alignment import alignment, changed_span, substitute


@dataclass(frozen=True)
class Quality:
    """Thresholds; the defaults are fixed values."""

    internal_gap_floor_ms: float = 280
    internal_gap_mad_multiplier: float = 4.0
    comma_pause_min_ms: float = 40
    comma_pause_max_ms: float = 900
    sentence_pause_min_ms: float = 100
    sentence_pause_max_ms: float = 1600
    punctuation_boundary_min_ms: float = 240
    known_asr_substitutions: dict = field(default_factory=dict)
    speed_window_chars: int = 6
    speed_ratio_limit: float = 1.45
    speed_consecutive_windows: int = 2
    cer_limit: float = 0.12
    missing_or_extra_span_limit: int = 2
    clipping_fraction_limit: float = 0.001
    minimum_audio_seconds: float = 0.35
    overall_speed_min_chars_per_second: float = 2.0
    overall_speed_max_chars_per_second: float = 7.0
    overall_speed_ratio_max: float = 1.5
    tail_analysis_min_seconds: float = 4.0
    tail_centroid_ratio_limit: float = 0.65
    tail_high_frequency_ratio_limit: float = 0.5
    tail_rms_drop_db_limit: float = 10.0
    cross_segment_gap_min_ms: float = 60
    cross_segment_gap_max_ms: float = 1200


# The rules' names, in the order in which they are reported.
ANALYSIS_FAILED, EMPTY_TARGET, BOUNDARY = "音频分析失败", "目标文本为空", "跨段停顿异常"
RESIDUAL_SILENCE, MUFFLED, SUBSTITUTED = "后期仍存在超过200毫秒的连续无声区", "频谱偏暗（仅提示）", "ASR已知近音替换："

HALF = "rms_db double, clipping_fraction double, spectral_centroid_hz double, spectral_rolloff_85_hz double, high_frequency_ratio_4khz double"
ACOUSTIC = (
    "struct<sample_rate:int,channels:int,duration_seconds:double,peak:double,clipping_fraction:double,rms_db:double,leading_silence_ms:double,"
    "trailing_silence_ms:double,spectral_centroid_hz:double,spectral_rolloff_85_hz:double,high_frequency_ratio_4khz:double,"
    f"first_half:struct<{HALF.replace(' double', ':double')}>,second_half:struct<{HALF.replace(' double', ':double')}>>"
).replace(", ", ",")
WORKER_RESULTS = f"segment_id string, target_text string, audio_path string, seed bigint, recognized_text string, timestamps_ms array<array<int>>, acoustic {ACOUSTIC}, raw string, error string, traceback string"


def ratio(a: Column, b: Column, default) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(default))


def speech_rate(ts: Column) -> Column:
    """Units per second from the first start to the last end, in array order; 0 if undefined."""
    seconds = (F.element_at(ts, -1)["end_ms"] - ts[0]["start_ms"]) / 1000
    return F.when((F.size(ts) >= 2) & (F.try_element_at(ts, F.lit(-1))["end_ms"] > F.get(ts, F.lit(0))["start_ms"]), F.size(ts) / seconds).otherwise(F.lit(0.0))


def timestamp_pairs(raw: Column) -> Column:
    """array<struct<start_ms, end_ms>> of the entries that have at least two numbers."""
    return F.transform(F.filter(F.coalesce(raw, F.array().cast("array<array<int>>")), lambda p: F.size(p) >= 2), lambda p: F.struct(p[0].alias("start_ms"), p[1].alias("end_ms")))


def boundaries(units: Column, separators: Column, mapping: Column, ts: Column) -> Column:
    """Pauses between neighbouring units whose recognized units are neighbours too."""
    n = F.size(units)
    at = F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))

    def pair(i: Column) -> Column:
        a, b = F.get(mapping, i), F.get(mapping, i + 1)
        left, right = F.get(ts, a), F.get(ts, b)
        gap = F.greatest(F.lit(0), right["start_ms"] - left["end_ms"])
        held = F.greatest(F.lit(0), left["end_ms"] - left["start_ms"])
        return F.struct(
            X.punctuation_kind(F.get(separators, i)).alias("kind"), F.get(units, i).alias("left"), F.get(units, i + 1).alias("right"), gap.alias("gap_ms"),
            held.alias("left_duration_ms"), (held + gap).alias("boundary_duration_ms"), (b == a + 1).alias("joined"),
        )

    return F.filter(F.transform(at, pair), lambda p: F.coalesce(p["joined"], F.lit(False)))


def window_rates(mapping: Column, ts: Column, k: int) -> Column:
    """Units per second of each run of k target units; 0 for a run that is not recognized as one."""
    n = F.size(mapping)
    at = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))

    def rate(i: Column) -> Column:
        m = F.slice(mapping, i + 1, F.lit(k))
        first = F.get(m, F.lit(0))
        whole = F.forall(F.transform(m, lambda j, x: j == first + x), lambda ok: F.coalesce(ok, F.lit(False)))
        ms = F.get(ts, F.get(m, F.lit(k - 1)))["end_ms"] - F.get(ts, first)["start_ms"]
        return F.when(whole & (ms > 0), k / (ms / 1000)).otherwise(F.lit(0.0))

    return F.transform(at, rate)


def consecutive(flags: Column, n: int) -> Column:
    """Whether any n flags in a row are true."""
    run = F.aggregate(flags, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), lambda s, f: X.let(F.when(f, s["now"] + 1).otherwise(0), lambda x: F.struct(x.alias("now"), F.greatest(s["most"], x).alias("most"))))
    return (F.size(flags) > 0) & (run["most"] >= n)


def evaluate(results: DataFrame, q: Quality = Quality(), round_index: Column | int = 0, reference_rate: Column | float = 0.0, prosody: bool = True) -> DataFrame:  # noqa: B008
    """Candidates of worker result rows: failures, warnings, metrics, passed and score.

    A worker error or an empty target stops at its one failure, with empty metrics after it.
    Null fields count as absent (0, "" or no entries; a level of 0 dB as -120).
    """
    ref = F.lit(float(reference_rate)) if isinstance(reference_rate, (int, float)) else reference_rate
    ac = lambda name: F.coalesce(F.col(f"acoustic.{name}"), F.lit(0))
    c = results.select(
        F.coalesce("segment_id", F.lit("")).alias("segment_id"), F.coalesce("target_text", F.lit("")).alias("text"),
        (F.lit(round_index) if isinstance(round_index, int) else round_index).alias("round_index"), F.coalesce("audio_path", F.lit("")).alias("audio_path"),
        F.coalesce("seed", F.lit(0)).alias("seed"), F.coalesce("recognized_text", F.lit("")).alias("recognized_text"),
        timestamp_pairs(F.col("timestamps_ms")).alias("ts"), "acoustic", "error", ref.alias("ref"),
    )
    c = c.select("*", X.normalized_text(F.col("text")).alias("target"), X.normalized_text(F.col("recognized_text")).alias("raw"), X.timestamp_units(F.col("text")).alias("units"), X.unit_separators(F.col("text")).alias("seps"))
    c = c.select("*", alignment(X.lexical_units(F.col("text")), X.lexical_units(F.col("recognized_text"))).alias("al"), alignment(F.col("units"), X.timestamp_units(F.col("recognized_text"))).alias("am"))
    c = c.select("*", substitute(F.col("target"), F.col("raw"), F.col("al.opcodes"), q.known_asr_substitutions).alias("sub"), F.transform("am.mapping", lambda j: F.when(j < F.size("ts"), j)).alias("mapping"))
    # the corrected text is aligned again only where a substitution changed it
    c = c.select("*", F.when(F.size("sub.applied") > 0, alignment(X.lexical_units(F.col("target")), X.lexical_units(F.col("sub.text")))["opcodes"]).otherwise(F.col("al.opcodes")).alias("opcodes") if q.known_asr_substitutions else F.col("al.opcodes").alias("opcodes"))
    c = c.select("*", boundaries(F.col("units"), F.col("seps"), F.col("mapping"), F.col("ts")).alias("b"), window_rates(F.col("mapping"), F.col("ts"), q.speed_window_chars).alias("rates"), speech_rate(F.col("ts")).alias("rate"))
    c = c.select("*", F.filter("b", lambda p: p["kind"].isNull()).alias("inner"), F.filter("b", lambda p: p["kind"].isNotNull()).alias("marked"), X.array_median(F.filter("rates", lambda r: r > 0)).alias("median_rate"))
    c = c.select("*", F.transform("inner", lambda p: p["gap_ms"].cast("double")).alias("gaps"))
    c = c.select("*", X.array_median(F.col("gaps")).alias("gap_median"))
    c = c.select("*", X.array_median(F.transform("gaps", lambda g: F.abs(g - F.col("gap_median")))).alias("gap_mad"))
    c = c.select("*", F.greatest(F.lit(float(q.internal_gap_floor_ms)), F.col("gap_median") + q.internal_gap_mad_multiplier * F.col("gap_mad")).alias("gap_limit"), F.transform("rates", lambda r: F.when((r > 0) & (F.col("median_rate") > 0), r / F.col("median_rate")).otherwise(F.lit(0.0))).alias("ratios"))
    low = lambda p: F.when(p["kind"] == "sentence", q.sentence_pause_min_ms).otherwise(q.comma_pause_min_ms)
    high = lambda p: F.when(p["kind"] == "sentence", q.sentence_pause_max_ms).otherwise(q.comma_pause_max_ms)
    short = lambda p: (p["gap_ms"] < low(p)) & (p["boundary_duration_ms"] < q.punctuation_boundary_min_ms)
    half = lambda h, n: F.coalesce(F.col(f"acoustic.{h}.{n}"), F.lit(0.0))
    level = lambda h: X.nonzero_or(F.col(f"acoustic.{h}.rms_db"), -120.0)
    metrics = F.struct(
        F.col("target").alias("target_normalized"), F.col("raw").alias("recognized_normalized_raw"), F.col("sub.text").alias("recognized_normalized"), F.col("sub.applied").alias("known_asr_substitutions"),
        X.error_rate(F.col("target"), F.col("sub.text")).alias("cer"), F.levenshtein("target", "sub.text").alias("edit_distance"), changed_span(F.col("opcodes")).alias("maximum_changed_span"),
        (F.size(F.filter("mapping", lambda j: j.isNotNull())) / F.greatest(F.size("units"), F.lit(1))).alias("timestamp_coverage"),
        F.col("gap_median").alias("internal_gap_median_ms"), F.col("gap_mad").alias("internal_gap_mad_ms"), F.col("gap_limit").alias("internal_gap_threshold_ms"),
        F.coalesce(F.array_max("gaps"), F.lit(0.0)).alias("maximum_internal_gap_ms"), F.filter("inner", lambda p: p["gap_ms"] > F.col("gap_limit")).alias("abnormal_gaps"),
        F.col("marked").alias("punctuation_gaps"), F.filter("marked", short).alias("short_punctuation_gaps"), F.filter("marked", lambda p: ~short(p) & (p["gap_ms"] > high(p))).alias("long_punctuation_gaps"),
        F.col("rates").alias("window_rates"), F.transform("rates", lambda r, i: F.array_join(F.slice("units", i + 1, F.lit(q.speed_window_chars)), "")).alias("speed_window_texts"),
        F.col("median_rate").alias("median_window_rate"), F.coalesce(F.array_max("ratios"), F.lit(0.0)).alias("maximum_speed_ratio"), F.lit(prosody).alias("internal_prosody_enforced"),
        F.col("rate").alias("overall_speech_rate"), F.col("ref").alias("reference_speech_rate"), F.when((F.col("rate") > 0) & (F.col("ref") > 0), F.col("rate") / F.col("ref")).otherwise(F.lit(0.0)).alias("overall_speed_ratio_to_reference"),
        ratio(half("second_half", "spectral_centroid_hz"), half("first_half", "spectral_centroid_hz"), 1.0).alias("tail_centroid_ratio"),
        ratio(half("second_half", "high_frequency_ratio_4khz"), half("first_half", "high_frequency_ratio_4khz"), 1.0).alias("tail_high_frequency_ratio"), (level("first_half") - level("second_half")).alias("tail_rms_drop_db"),
    )
    c = c.select("*", metrics.alias("m"))
    m, seconds = (lambda n: F.col(f"m.{n}")), ac("duration_seconds")
    tail = seconds >= q.tail_analysis_min_seconds
    # Rule names.
    rules = [
        ("逐字时间戳覆盖不足", m("timestamp_coverage") < 0.70),
        ("句内异常停顿", F.lit(prosody) & (F.size(m("abnormal_gaps")) > 0)),
        ("标点停顿过短", F.lit(prosody) & (F.size(m("short_punctuation_gaps")) > 0)),
        ("标点停顿过长", F.lit(prosody) & (F.size(m("long_punctuation_gaps")) > 0)),
        ("局部语速异常", F.lit(prosody) & consecutive(F.transform("ratios", lambda r: r > q.speed_ratio_limit), q.speed_consecutive_windows)),
        ("转写差异过大", m("cer") > q.cer_limit),
        ("存在连续漏字、错字或重复", F.lit(prosody) & (m("maximum_changed_span") >= q.missing_or_extra_span_limit)),
        ("音频为空或过短", seconds < q.minimum_audio_seconds),
        ("音频格式异常", (ac("sample_rate") != 48000) | (ac("channels") != 1)),
        ("音频削波", ac("clipping_fraction") > q.clipping_fraction_limit),
        ("整体语速异常", (F.col("rate") > 0) & ((F.col("rate") < q.overall_speed_min_chars_per_second) | (F.col("rate") > q.overall_speed_max_chars_per_second))),
        ("整体语速明显快于参考", (F.col("ref") > 0) & (m("overall_speed_ratio_to_reference") > q.overall_speed_ratio_max)),
        ("后半段频谱明显变暗", tail & (m("tail_centroid_ratio") < q.tail_centroid_ratio_limit) & (m("tail_high_frequency_ratio") < q.tail_high_frequency_ratio_limit)),
        ("后半段响度异常下降", tail & (m("tail_rms_drop_db") > q.tail_rms_drop_db_limit)),
    ]
    broken, empty = F.coalesce(F.col("error") != "", F.lit(False)), F.col("target") == ""
    found = F.filter(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules)), lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    out = c.select(
        "segment_id", "round_index", "text", "audio_path", "seed", "recognized_text", F.col("ts").alias("timestamps_ms"), "acoustic",
        F.when(broken, F.array(F.lit(ANALYSIS_FAILED))).when(empty, F.array(F.lit(EMPTY_TARGET))).otherwise(found).alias("hard_failures"),
        F.when(broken, none).otherwise(F.transform("sub.applied", lambda s: F.concat(F.lit(SUBSTITUTED), s))).alias("warnings"),
        F.when(~broken & ~empty, F.col("m")).alias("metrics"), F.when(broken, F.col("error")).alias("worker_error"),
    )
    return with_score(out)


def with_score(candidates: DataFrame) -> DataFrame:
    """passed, and score: failures, warnings, then error rate, speed ratio and longest pause (infinite if unknown)."""
    far = F.lit(float("inf"))
    parts = [F.size("hard_failures").cast("double"), F.size("warnings").cast("double"), *(F.coalesce(F.col(f"metrics.{n}"), far) for n in ("cer", "maximum_speed_ratio", "maximum_internal_gap_ms"))]
    return candidates.withColumns({"passed": F.size("hard_failures") == 0, "score": F.array(*parts)})


def failure_details(failures: Column, m: Column, boundary: Column) -> Column:
    """One text for each failure, with its figures. The wording."""
    num = lambda fmt, x: F.format_string(fmt, F.coalesce(x.cast("double"), F.lit(0.0)))
    whole = lambda x: F.rint(F.coalesce(x.cast("double"), F.lit(0.0))).cast("long").cast("string")
    between = lambda g: F.concat(F.lit("“"), g["left"], F.lit("”到“"), g["right"], F.lit("”"))
    listed = lambda gaps, tail: F.array_join(F.transform(gaps, lambda g: F.concat(between(g), tail(g))), "、")
    pauses = lambda g: F.concat(F.lit("静音"), whole(g["gap_ms"]), F.lit("毫秒，含前字拉长共"), whole(g["boundary_duration_ms"]), F.lit("毫秒"))
    wrap = lambda name, inner: F.concat(name, F.lit("（"), inner, F.lit("）"))
    fastest = F.get(m["speed_window_texts"], (F.array_position(m["window_rates"], F.array_max(m["window_rates"])) - 1).cast("int"))

    def one(f: Column) -> Column:
        place = F.when(F.coalesce(fastest, F.lit("")) != "", F.concat(F.lit("“"), fastest, F.lit("”，"))).otherwise("")
        marks = lambda gaps: F.when(F.size(gaps) > 0, wrap(f, listed(gaps, pauses))).otherwise(f)
        return (
            F.when(f == "逐字时间戳覆盖不足", wrap(f, F.concat(num("%.1f", m["timestamp_coverage"] * 100), F.lit("%"))))
            .when(f == "句内异常停顿", F.when(F.size(m["abnormal_gaps"]) > 0, wrap(f, listed(m["abnormal_gaps"], lambda g: F.concat(whole(g["gap_ms"]), F.lit("毫秒"))))).otherwise(f))
            .when(f == "局部语速异常", wrap(f, F.concat(place, F.lit("最高比值"), num("%.3f", m["maximum_speed_ratio"]))))
            .when(f == "标点停顿过短", marks(m["short_punctuation_gaps"]))
            .when(f == "标点停顿过长", marks(m["long_punctuation_gaps"]))
            .when(f.startswith("整体语速"), wrap(f, F.concat(num("%.2f", m["overall_speech_rate"]), F.lit("字/秒，参考比值"), num("%.3f", m["overall_speed_ratio_to_reference"]))))
            .when(f == "后半段频谱明显变暗", wrap(f, F.concat(F.lit("频谱质心比"), num("%.3f", m["tail_centroid_ratio"]), F.lit("，高频占比比"), num("%.3f", m["tail_high_frequency_ratio"]))))
            .when(f == "后半段响度异常下降", wrap(f, F.concat(F.lit("下降"), num("%.2f", m["tail_rms_drop_db"]), F.lit("dB"))))
            .when(f == BOUNDARY, wrap(f, F.concat(F.coalesce(boundary["left_segment_id"], F.lit("")), F.lit("到"), F.coalesce(boundary["right_segment_id"], F.lit("")), F.lit("，"), whole(boundary["gap_ms"]), F.lit("毫秒"))))
            .when(f == "转写差异过大", wrap(f, F.concat(F.lit("CER "), num("%.3f", m["cer"]))))
            .otherwise(f)
        )

    return F.transform(failures, one)
