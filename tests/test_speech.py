import difflib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.functions import text as X
from cadenza.operators import acoustic, alignment, selection, silence
from cadenza.operators.evaluate import BOUNDARY, WORKER_RESULTS, Quality, evaluate, failure_details
from cadenza.plans import run as loop
from cadenza.sources import config, segments, worker

Q = Quality(known_asr_substitutions={"情分": "勤奋"})


def steps(n, a, b):
    return [[i * a, i * a + b] for i in range(n)]


def judge(spark, target, recognized=None, ts=None, q=Q, prosody=True, rate=0.0, error=None, round_index=0, acoustic_extra=None, sid="S001"):
    ac = {"duration_seconds": 2.0, "sample_rate": 48000, "channels": 1, "clipping_fraction": 0.0, "rms_db": -22.0} | (acoustic_extra or {})
    row = {"segment_id": sid, "target_text": target, "recognized_text": target if recognized is None else recognized, "timestamps_ms": ts, "acoustic": ac, "error": error, "seed": 0, "audio_path": ""}
    df = spark.read.schema(WORKER_RESULTS).json(spark.createDataFrame([(json.dumps(row),)], "value string").rdd.map(lambda r: r[0]))
    return evaluate(df, q, round_index, rate, prosody)


def one(*a, **k):
    return judge(*a, **k).first()


def test_pauses(spark):
    t = "语速不会突然加快"
    ts, at = [], 0
    for i in range(8):
        at += 350 if i == 4 else 0
        ts.append([at, at + 120])
        at += 130
    r = one(spark, t, ts=ts)
    assert "句内异常停顿" in r.hard_failures
    m = r.metrics
    assert (m.internal_gap_median_ms, m.internal_gap_mad_ms, m.internal_gap_threshold_ms, m.maximum_internal_gap_ms) == (10, 0, 280, 360)
    assert "句内异常停顿" not in one(spark, "语速不会，突然加快", "语速不会突然加快", ts).hard_failures
    d = judge(spark, t, ts=ts).select(failure_details(F.col("hard_failures"), F.col("metrics"), F.lit(None).cast("struct<left_segment_id:string,right_segment_id:string,gap_ms:double>")).alias("d")).first().d
    assert "句内异常停顿（“会”到“突”360毫秒）" in d
    assert "标点停顿过短" in one(spark, "前面，后面", ts=steps(4, 120, 120)).hard_failures
    assert "标点停顿过短" not in one(spark, "前面，后面", ts=[[0, 120], [120, 360], [360, 480], [480, 600]]).hard_failures
    assert "标点停顿过长" in one(spark, "前面。后面", ts=[[0, 120], [120, 240], [2000, 2120], [2120, 2240]]).hard_failures
    r = one(spark, "前面，后面", ts=steps(4, 120, 120), prosody=False)
    assert "标点停顿过短" not in r.hard_failures and r.metrics.internal_prosody_enforced is False


def test_transcripts(spark):
    t = "语速不会突然加快"
    r = one(spark, t, "语速不会加快", steps(6, 130, 120))
    assert "存在连续漏字、错字或重复" in r.hard_failures and (r.metrics.maximum_changed_span, r.metrics.cer) == (2, 0.25)
    assert one(spark, "好好gap或者AI健身", ts=steps(8, 130, 120)).metrics.timestamp_coverage == 1.0
    r = one(spark, "这个过程叫情分清零", "这个过程叫勤奋清零", steps(9, 130, 120))
    assert "存在连续漏字、错字或重复" not in r.hard_failures and r.warnings == ["ASR已知近音替换：情分→勤奋"]
    assert r.metrics.timestamp_coverage == pytest.approx(7 / 9) and r.metrics.cer == 0
    assert "存在连续漏字、错字或重复" in one(spark, "这个过程叫情分清零", "这个过程叫天气清零", steps(9, 130, 120)).hard_failures


def test_other_rules(spark):
    assert one(spark, "前面", error="boom").hard_failures == ["音频分析失败"]
    assert one(spark, "，。").hard_failures == ["目标文本为空"]
    t, ts = "语速不会突然加快", steps(8, 200, 150)
    bad = one(spark, t, ts=ts, acoustic_extra={"duration_seconds": 0.2, "sample_rate": 44100, "clipping_fraction": 0.5}).hard_failures
    assert {"音频为空或过短", "音频格式异常", "音频削波"} <= set(bad)
    assert "整体语速异常" in one(spark, t, ts=steps(8, 100, 90)).hard_failures
    assert "整体语速明显快于参考" in one(spark, t, ts=ts, rate=1.0).hard_failures
    half = lambda c, h, db: {"spectral_centroid_hz": c, "high_frequency_ratio_4khz": h, "rms_db": db}
    tail = one(spark, t, ts=ts, acoustic_extra={"duration_seconds": 5.0, "first_half": half(1000.0, 0.5, -20.0), "second_half": half(500.0, 0.1, -40.0)}).hard_failures
    assert {"后半段频谱明显变暗", "后半段响度异常下降"} <= set(tail)
    zero = one(spark, t, ts=ts, acoustic_extra={"duration_seconds": 5.0, "first_half": half(1.0, 1.0, 0.0), "second_half": half(1.0, 1.0, -100.0)})
    assert zero.metrics.tail_rms_drop_db == -20  # a level of exactly 0 counts as -120
    fast = [[i * 300, i * 300 + 250] for i in range(12)] + [[3600 + i * 60, 3600 + i * 60 + 50] for i in range(8)]
    assert "局部语速异常" in one(spark, "一二三四五六七八九十甲乙丙丁戊己庚辛壬癸", ts=fast).hard_failures


def test_alignment_is_the_standard_one():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ["".join(rng.choices("abc", k=rng.randrange(12))) for _ in range(2)]
        codes, mapping = alignment.align(a, b)
        sm = difflib.SequenceMatcher(a=a, b=b, autojunk=False)
        assert codes == sm.get_opcodes()
        assert {i: j for i, j in enumerate(mapping) if j is not None} == {x.a + k: x.b + k for x in sm.get_matching_blocks() for k in range(x.size)}


def test_text_functions(spark):
    df = spark.createDataFrame([(65.432, "a　 b c\x1c"), (3661.0005, None), (-1.0, "")], "s double, t string")
    rows = df.select(X.audio_time(F.col("s")).alias("a"), X.strip_space(F.col("t")).alias("b")).collect()
    assert [r.a for r in rows] == ["01:05.432", "01:01:01.000", "00:00.000"] and [r.b for r in rows] == ["abc", "", ""]
    e = spark.createDataFrame([("RuntimeError: os error 1455",), ("CUDA out of memory",), ("x\ny",)], "m string")
    got = [r[0] for r in e.select(X.error_summary(F.col("m"))).collect()]
    assert "错误1455" in got[0] and "显存不足" in got[1] and got[2] == "x"
    assert spark.sql("SELECT 1").select(X.array_median(F.array(F.lit(3.0), F.lit(1.0), F.lit(2.0), F.lit(10.0)))).first()[0] == 2.5


def test_segments(spark, tmp_path):
    s = segments.load(spark, "第一行内容完整生成。\n\n第二行是另一次生成。").orderBy("seq").collect()
    assert [(r.segment_id, r.paragraph_after) for r in s] == [("S001", True), ("S002", True)]
    assert segments.load(spark, "长" * 200).count() == 1
    p = segments.payload_segments(spark, json.dumps({"segments": ["甲乙", {"text": "丙丁"}]}), "甲乙\n丙丁").collect()
    assert [r.segment_id for r in p] == ["S001", "S002"] and p[1].paragraph_after
    with pytest.raises(ValueError, match="修改了原文"):
        segments.payload_segments(spark, '["甲"]', "乙")
    df = spark.createDataFrame([("a", "x" * 240), ("b", "x" * 241)], "segment_id string, text string")
    assert [r.segment_id for r in segments.oversized(df).collect()] == ["b"]
    with pytest.raises(ValueError, match="mode"):
        segments.load(spark, "x", "other")


def test_silence(spark):
    df = spark.createDataFrame([(1, [1.0, 1.0] + [0.0] * 24000 + [1.0, 1.0]), (2, [0.0] * 9600)], "k int, x array<double>")
    iv = df.select("k", F.size("x").alias("n_frames"), F.explode(silence.array_islands(F.col("x"))).alias("s")).select("k", "n_frames", "s.start", "s.end")
    assert sorted(map(tuple, iv.collect())) == [(1, 24004, 2, 24002), (2, 9600, 0, 9600)]
    e = silence.silence_edits(iv, "k").collect()
    assert [(r.k, r.delete_start_frame, r.delete_end_frame) for r in e] == [(1, 9602, 24002)]
    cut = df.where("k = 1").select(silence.remove_ranges(F.col("x"), F.array(F.struct(F.lit(9602).alias("start"), F.lit(24002).alias("end")))).alias("y")).first().y
    assert len(cut) == 9604 and cut[:2] == [1.0, 1.0] == cut[-2:]
    segs = spark.createDataFrame([(1, 0, 0, 10), (1, 1, 10, 20)], "k int, seq int, start_frame int, end_frame int")
    dele = spark.createDataFrame([(1, 8, 12)], "k int, start int, end int")
    assert sorted(map(tuple, silence.segment_deletions(segs, dele, "k").collect())) == [(1, 0, 8, 10), (1, 1, 0, 2)]
    with pytest.raises(ValueError):
        silence.silence_edits(iv, "k", target_ms=300)


def test_boundary(spark):
    rows = lambda *x: spark.createDataFrame([(i, f"S{i:03d}", float(a), float(b)) for i, (a, b) in enumerate(x, 1)], "seq int, segment_id string, leading_ms double, trailing_ms double")
    found = lambda df: sorted((r.segment_id, r.pair_seq) for r in selection.boundary_issues(df, [], Q).collect())
    assert found(rows((0, 10), (10, 0))) == [("S002", 1)]
    assert found(rows((5, 5), (5, 5), (5, 5))) == [("S002", 1), ("S003", 2)]
    assert found(rows((0, 1500), (10, 0))) == [("S001", 1)]
    assert found(rows((0, 10), (10, 2000), (5, 0))) == [("S002", 1)]  # hit twice, first issue stays


def test_acoustics(spark):
    t = np.arange(48000) / 48000
    s = acoustic.spectral_summary(np.sin(2 * np.pi * 1000 * t), 48000)
    assert abs(s["spectral_centroid_hz"] - 1000) < 30 and s["high_frequency_ratio_4khz"] < 1e-3 and abs(s["rms_db"] + 3.01) < 0.1
    assert acoustic.spectral_summary(np.sin(2 * np.pi * 8000 * t), 48000)["high_frequency_ratio_4khz"] > 0.99
    assert acoustic.spectral_summary(np.zeros(0), 48000)["rms_db"] == -240
    df = spark.createDataFrame([([0.0, 0.5, -1.0, 0.0],), ([0.0],), ([],)], "x array<float>")
    r = [x.s for x in df.select(acoustic.sample_stats(F.col("x"), 1000).alias("s")).collect()]
    assert (r[0].peak, r[0].clipping_fraction, r[0].leading_silence_ms, r[0].trailing_silence_ms) == (1.0, 0.25, 1.0, 1.0)
    assert r[1].leading_silence_ms == 1.0 and r[2].rms == 0


def test_best_and_report(spark):
    a = judge(spark, "语速不会突然加快", "语速不会加快", steps(6, 200, 150))
    b = judge(spark, "语速不会突然加快", ts=steps(8, 200, 150), round_index=1)
    both = a.unionByName(b)
    assert selection.select_best(both).first().round_index == 1
    segs = spark.createDataFrame([(1, "S001", "语速不会突然加快")], "seq int, segment_id string, text string")
    line = spark.createDataFrame([("S001", 12.345, 17.89)], "segment_id string, start_seconds double, end_seconds double")
    text = selection.report_lines(segs, both, line).first().lines
    assert "成品位置：00:12.345 - 00:17.890（12.345秒 - 17.890秒）" in text and "重新生成：1次" in text and "S001" not in "".join(text)
    assert text[-2] == "最终状态：通过"
    tie = spark.createDataFrame([("S001", 0, True, [0.0, float("inf")]), ("S001", 1, True, [0.0, float("inf")]), ("S001", 2, True, [0.0, 0.5])], "segment_id string, round_index int, passed boolean, score array<double>")
    assert selection.select_best(tie.where("round_index < 2")).first().round_index == 0 and selection.select_best(tie).first().round_index == 2


def test_muffle(spark):
    c = judge(spark, "前面后面", ts=steps(4, 200, 150), acoustic_extra={"spectral_centroid_hz": 100.0, "high_frequency_ratio_4khz": 0.01})
    out = selection.muffle_warnings(c, {"spectral_centroid_hz": 1000.0, "high_frequency_ratio_4khz": 0.5}).first()
    assert out.warnings == ["频谱偏暗（仅提示）"] and out.muffle.batch_centroid_median_hz == 100


def test_retry_loop(spark):
    segs = spark.createDataFrame([(1, "S001", "前面后面"), (2, "S002", "左边右边")], "seq int, segment_id string, text string")

    def results(asked, i):
        ok = F.when((F.col("segment_id") == "S002") & (F.lit(i) == 0), "broken")
        stamps = F.array(*(F.array(F.lit(k * 200), F.lit(k * 200 + 150)) for k in range(4)))
        ac = F.from_json(F.lit('{"duration_seconds":2,"sample_rate":48000,"channels":1,"leading_silence_ms":100,"trailing_silence_ms":100}'), "sample_rate int, channels int, duration_seconds double, leading_silence_ms double, trailing_silence_ms double")
        full = spark.createDataFrame([], WORKER_RESULTS).schema["acoustic"].dataType
        cols = {"target_text": F.col("text"), "audio_path": F.lit(""), "recognized_text": F.col("text"), "timestamps_ms": stamps, "acoustic": F.from_json(F.to_json(ac), full), "raw": F.lit(""), "error": ok, "traceback": F.lit("")}
        return asked.select("segment_id", *(v.alias(k) for k, v in cols.items()), "seed")

    history, selected, left = loop.run(spark, segs, results, Q)
    assert left.isEmpty() and selected.count() == 2
    assert sorted((r.segment_id, r.round_index, r.seed) for r in history.collect()) == [("S001", 0, 20235791), ("S002", 0, 20235791), ("S002", 1, 20340520)]
    assert BOUNDARY not in sum((r.hard_failures for r in history.collect()), [])


def test_worker_sources(spark, tmp_path):
    body = {"worker": {}, "results": [{"segment_id": "S001", "timestamps_ms": [[0, 1]], "acoustic": {"first_half": {"rms_db": -1.5}}}, {"segment_id": worker.REFERENCE_ID}]}
    (tmp_path / "r.json").write_text(json.dumps(body))
    rows, ref = worker.split_reference(worker.read_results(spark, str(tmp_path / "r.json")))
    assert rows.first().acoustic.first_half.rms_db == -1.5 and ref.count() == 1
    segs = spark.createDataFrame([("S001", "a"), ("S002", "b")], "segment_id string, text string")
    joined = {r.segment_id: r.error for r in selection.with_results(segs, rows, "seed").collect()}
    assert joined == {"S001": None, "S002": "ASR worker did not return this segment"}
    x = np.array([0.1, -0.5, 1.0], np.float32)
    worker.write_verified_wav(str(tmp_path / "a.wav"), x)
    (tmp_path / "b.wav").write_bytes(b"nothing")
    got = {r.path[-5:]: r for r in worker.read_audio(spark, str(tmp_path / "*.wav")).collect()}
    assert np.array_equal(np.array(got["a.wav"].samples, np.float32), x) and got["b.wav"].error
    worker.write_csv_with_bom(str(tmp_path / "c.csv"), ["a", "b"], [])
    assert (tmp_path / "c.csv").read_bytes() == b"\xef\xbb\xbfa,b\r\n"
    ts = spark.sql("SELECT array(array(0.5D, 1.5D), array(-1D, 3D), array(5D, 4D), array(2D)) AS p").select(worker.normalize_timestamps(F.col("p")).alias("t")).first().t
    assert ts == [[0, 2]]


def test_config(tmp_path):
    good = {"paths": {"input_text": "in.txt"}, "generation": {"cfg": 2.0, "steps": 20, "reference_mode": "combined", "base_seed": 1, "retry_seed_stride": 1, "max_quality_retries": 0}, "quality": {}}
    (tmp_path / "c.json").write_text(json.dumps(good))
    c = config.load_config(str(tmp_path / "c.json"))
    config.check_config(c)
    assert c["paths"]["input_text"] == str((tmp_path / "in.txt").resolve()) and config.missing_paths(c) == ["input_text"]
    for key, value in {"cfg": 4, "steps": 3, "base_seed": -1, "retry_seed_stride": 0, "max_quality_retries": -1, "max_parallel": 2, "reference_mode": "x"}.items():
        with pytest.raises(ValueError):
            config.check_config(c | {"generation": c["generation"] | {key: value}})
    with config.single_run(str(tmp_path)), pytest.raises(RuntimeError), config.single_run(str(tmp_path)):
        pass
    (tmp_path / ".run.lock").write_text("999999999")
    with config.single_run(str(tmp_path)):
        pass


def test_stream(spark, tmp_path):
    from cadenza.streaming.results import evaluate_stream, read_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps({"segment_id": "S001", "target_text": "前面", "error": "x"}) + "\n")
    evaluate_stream(read_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).first().hard_failures == ["音频分析失败"]
