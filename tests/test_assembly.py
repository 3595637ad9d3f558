import csv
import hashlib
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import assembly, silence
from cadenza.sources import run_files, worker
from cadenza.sources.worker import decode_wav, encode_wav, read_results


def clips(spark):
    rows = [("r", 1, "S001", [0.1, 0.0, 0.0, 0.2]), ("r", 2, "S002", []), ("r", 3, "S003", [0.3, 0.4]), ("q", 1, "S001", [0.5])]
    return spark.createDataFrame(rows, "k string, seq int, segment_id string, samples array<float>")


def test_assembly_is_exact_and_verified(spark):
    line = assembly.assemble(clips(spark), ["k"])
    whole = assembly.join_clips(clips(spark), ["k"])
    got = {(r.k, r.seq): r for r in assembly.verify_assembly(line, whole, ["k"]).collect()}
    assert [(got["r", i].start_frame, got["r", i].end_frame) for i in (1, 2, 3)] == [(0, 4), (4, 4), (4, 6)]
    assert all(r.kept for r in got.values())
    assert got["r", 3].sample_sha256 == hashlib.sha256(np.array([0.3, 0.4], "<f4").tobytes()).hexdigest()
    w = {r.k: r for r in whole.collect()}
    assert np.allclose(w["r"].samples, [0.1, 0, 0, 0.2, 0.3, 0.4]) and w["r"].frames == 6
    changed = whole.withColumn("samples", F.transform("samples", lambda x, i: F.when(i == 5, F.lit(0.0).cast("float")).otherwise(x)))
    assert [r.seq for r in assembly.verify_assembly(line, changed, ["k"]).where("NOT kept").collect()] == [3]
    assert not assembly.verify_assembly(line, whole.limit(0), ["k"]).where("kept").count()


def test_edits_move_later_clips(spark):
    line = assembly.assemble(clips(spark).where("k = 'r'"), ["k"])
    cuts = spark.createDataFrame([("r", 1, 3), ("r", 2, 5)], "k string, start long, end long")
    got = {r.seq: r for r in assembly.after_edits(line, cuts, "k").collect()}
    assert [(got[i].start_frame, got[i].end_frame, got[i].original_start_frame) for i in (1, 2, 3)] == [(0, 1, 0), (1, 1, 4), (1, 2, 4)]
    assert np.allclose(got[3].samples, [0.4])


def test_loud_silence_is_refused(spark):
    c = spark.createDataFrame([("a", [0.0] * 400, 400), ("b", [0.0] * 300 + [0.5] + [0.0] * 99, 400)], "k string, samples array<float>, n_frames int")
    i = c.select("k", "n_frames", F.lit(0).alias("start"), F.lit(400).alias("end"))
    edits = silence.silence_edits(i, "k", rate=1000)
    assert silence.refuse_loud(edits.where("k = 'a'"), c, "k").first().deleted_frames == 200
    with pytest.raises(Exception, match="audible"):
        silence.refuse_loud(edits, c, "k").collect()


def test_kept_ranges(spark):
    d = spark.createDataFrame([([(5, 8), (2, 6), (9, 12)],), ([],), (None,), ([(0, 10)],), ([(0, 99)],)], "d array<struct<start:int,end:int>>")
    got = [[tuple(x) for x in r.k] for r in d.select(silence.kept_ranges(F.col("d"), F.lit(10)).alias("k")).collect()]
    assert got == [[(0, 2), (8, 9)], [(0, 10)], [(0, 10)], [], []]


def test_every_segment_needs_one_row(spark):
    s = spark.createDataFrame([("a",), ("b",)], "segment_id string")
    r = spark.createDataFrame([("a", 1), ("b", 2)], "segment_id string, x int")
    assert {tuple(x) for x in assembly.matched(s, r, ["segment_id"]).collect()} == {("a", 1), ("b", 2)}
    for bad in (r.where("x = 1"), r.union(r)):
        with pytest.raises(Exception, match="no single row"):
            assembly.matched(s, bad, ["segment_id"]).collect()
    e = spark.createDataFrame([(48000, 1, "float32"), (44100, 1, "float32"), (48000, 2, "float32"), (48000, 1, "int16"), (None, 1, "float32")], "r int, c int, k string")
    assert [x[0] is None for x in e.select(assembly.format_error(F.col("r"), F.col("c"), F.col("k"))).collect()] == [True, False, False, False, False]


def test_integers_are_not_read_as_floats():
    import struct

    raw = np.array([1 << 30, -(1 << 31)], "<i4").tobytes()
    data = b"RIFF" + struct.pack("<I", 36 + len(raw)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 48000, 192000, 4, 32) + b"data" + struct.pack("<I", len(raw)) + raw
    assert decode_wav(data)[1][:, 0].tolist() == [0.5, -1.0]
    with pytest.raises(ValueError):
        decode_wav(data.replace(struct.pack("<IHH", 16, 1, 1), struct.pack("<IHH", 16, 7, 1)))


def test_review_clips_are_copied_and_listed(tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.wav").write_bytes(encode_wav(np.full(5, 0.25, np.float32)))
    rows = [{"segment_id": f"S00{i}", "audio_path": str(tmp_path / f"{n}.wav"), "text": "x", "extra": 1} for i, n in enumerate("ab", 1)]
    out = run_files.export_review(str(tmp_path), rows)
    listed = list(csv.DictReader(open(out["manifest_path"], encoding="utf-8-sig")))
    assert list(listed[0]) == list(run_files.REVIEW_COLUMNS) and [r["segment_id"] for r in listed] == ["S001", "S002"]
    assert all(r["file_sha256"] == r["source_file_sha256"] and open(r["audio_file"], "rb").read() == (tmp_path / "a.wav").read_bytes() for r in listed)
    run_files.write_list(str(tmp_path / "e.csv"), run_files.EDIT_COLUMNS, [])
    assert (tmp_path / "e.csv").read_text(encoding="utf-8-sig").strip() == ",".join(run_files.EDIT_COLUMNS)
    worker.write_report(str(tmp_path / "r.txt"), 2, ["x"], {"initially_failed": 1, "finally_failed": 0, "regenerations": 1}, "f.wav", [], out)
    assert "最终整条质检：通过" in (tmp_path / "r.txt").read_text() and out["review_dir"] in (tmp_path / "r.txt").read_text()


def test_generator_contract_and_logs(tmp_path):
    make = "import sys, pathlib; t, s, o = map(pathlib.Path, sys.argv[1:4]); o.mkdir(); n = int(sys.argv[4]); [(o / f'{i:02d}.wav').write_text(x) for i, x in enumerate(t.read_text().splitlines()[:n], 1)]"
    command = lambda n: lambda t, s, o: [sys.executable, "-c", make, t, s, o, str(n)]
    got = run_files.generate([("S001", "a\nb"), ("S002", "c")], 7, str(tmp_path / "r0"), command(2))
    assert got["S001"][1] == 7 and open(got["S001"][0]).read() == "a b" and (tmp_path / "r0/seeds.txt").read_text() == "7\n7\n"
    assert "COMMAND" in (tmp_path / "r0/generation.log").read_text()
    with pytest.raises(FileNotFoundError):
        run_files.generate([("S001", "a"), ("S002", "c")], 7, str(tmp_path / "r1"), command(1))
    with pytest.raises(RuntimeError, match="exit=3"):
        run_files.run_command([sys.executable, "-c", "import sys; sys.exit(3)"], str(tmp_path / "l.txt"))


def test_preflight_delivery_and_failure_report(tmp_path):
    (tmp_path / "t.txt").write_text(" \n")
    config = {"paths": {"reference_text_file": str(tmp_path / "t.txt"), "gone": str(tmp_path / "no")}, "generation": {"reference_mode": "combined"}}
    with pytest.raises(FileNotFoundError, match="gone"):
        run_files.preflight(config, ["gone"])
    with pytest.raises(ValueError, match="参考文字"):
        run_files.preflight(config, ["reference_text_file"])
    with pytest.raises(ValueError) as e:
        run_files.check_lengths([(f"S{i:03d}", 241) for i in range(20)] + [("ok", 240)], 240)
    assert str(e.value).count("=241字") == 8
    assert run_files.free_memory_mb("4096.0\n1\n") == 4096
    before = {str(p) for p in tmp_path.iterdir()}
    run = tmp_path / "20260101-000000"
    run.mkdir()
    (run / "c.wav").write_text("x")
    assert run_files.deliver(str(run / "c.wav"), str(run / "final.wav"), False) is None and not (run / "final.wav").exists()
    assert run_files.deliver(str(run / "c.wav"), str(run / "final.wav"), True) and (run / "final.wav").exists()
    path = run_files.report_failure(str(tmp_path), before, ValueError("boom"), "x" * 2000)
    assert path and "x" * 1000 in open(path).read() and "x" * 1001 not in open(path).read() and "boom" in (run / "technical_error.txt").read_text()
    assert run_files.report_failure(str(tmp_path), before, ValueError("again"), "") is None
    run_files.write_effective(str(run), config, "t", [{"segment_id": "S001"}])
    assert (run / "validated_segments.json").exists() and len(run_files.run_id()) == 15


def test_worker_envelope_round_trip(spark, tmp_path):
    rows = [{"segment_id": "S001", "target_text": "a", "seed": 3, "recognized_text": "a", "timestamps_ms": np.array([[0, 5]]), "acoustic": {"sample_rate": 48000}}, {"segment_id": "S002", "error": "E: x"}]
    run_files.write_envelope(str(tmp_path / "w.json"), {"device": "cpu", "versions": (1, 2)}, rows)
    got = {r.segment_id: r for r in read_results(spark, str(tmp_path / "w.json")).collect()}
    assert got["S001"].timestamps_ms == [[0, 5]] and got["S001"].acoustic.sample_rate == 48000 and got["S002"].error == "E: x"
    assert run_files.first_object([{"a": 1}]) == {"a": 1}
    with pytest.raises(RuntimeError):
        run_files.first_object(["x"])
