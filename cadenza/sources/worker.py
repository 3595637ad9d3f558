"""Worker results, audio files, seeds, and the sinks of a run."""

from __future__ import annotations

import csv
import io
import json
import os
import struct
from collections.abc import Iterable
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.evaluate import WORKER_RESULTS

REFERENCE_ID, FINAL_ID = "__REFERENCE__", "__FINAL__"


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``{worker, results: [...]}`` files, with an explicit schema."""
    kind = WORKER_RESULTS.replace(", ", ",").replace(" ", ":")
    return spark.read.schema(f"results array<struct<{kind}>>").option("multiLine", True).json(path).select(F.explode("results").alias("r")).select("r.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Items of ``{items: [...]}``; raises if there are none."""
    out = spark.read.schema("items array<struct<segment_id:string,text:string,audio_path:string,seed:bigint>>").option("multiLine", True).json(path).select(F.explode("items").alias("i")).select("i.*")
    if out.isEmpty():
        raise ValueError("manifest has no items")
    return out


def split_reference(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results without the reference's row, that row)."""
    return results.where(F.col("segment_id") != REFERENCE_ID), results.where(F.col("segment_id") == REFERENCE_ID).limit(1)


def with_reference(items: DataFrame, text: str, audio_path: str) -> DataFrame:
    ref = items.sparkSession.createDataFrame([(REFERENCE_ID, text, audio_path)], "segment_id string, text string, audio_path string")
    return items.unionByName(ref, allowMissingColumns=True)


def seed_of_round(round_index: Column | int, base: int = 20235791, stride: int = 104729) -> Column:
    r = F.lit(round_index) if isinstance(round_index, int) else round_index
    return (F.lit(base) + r * stride).cast("long")


def normalize_timestamps(pairs: Column) -> Column:
    """[start, end] as whole milliseconds (half-even), without negative or reversed ones."""
    whole = F.transform(F.filter(pairs, lambda p: F.size(p) >= 2), lambda p: F.array(F.rint(p[0]).cast("int"), F.rint(p[1]).cast("int")))
    return F.filter(whole, lambda p: (p[0] >= 0) & (p[1] >= p[0]))


def decode_wav(data: bytes) -> tuple[int, np.ndarray]:
    """(rate, frames x channels float32) of a RIFF file of 32-bit floats, or of 16- or 32-bit integers."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a RIFF WAVE file")
    at, rate, channels, kind, bits = 12, 0, 0, 0, 0
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, at + 8)
        elif name == b"data":
            raw = data[at + 8 : at + 8 + size]
            if bits == 32 and kind == 3:
                return rate, np.frombuffer(raw, "<f4").reshape(-1, channels)
            if bits == 16 and kind == 1:
                return rate, (np.frombuffer(raw, "<i2") / np.float32(32768)).astype(np.float32).reshape(-1, channels)
            if bits == 32 and kind == 1:
                return rate, (np.frombuffer(raw, "<i4") / np.float64(1 << 31)).astype(np.float32).reshape(-1, channels)
            raise ValueError(f"{bits}-bit samples of format {kind} are not supported")
        at += 8 + size + size % 2
    raise ValueError("no samples")


def encode_wav(samples: np.ndarray, rate: int = 48000) -> bytes:
    raw = np.asarray(samples, "<f4").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(raw)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 3, 1, rate, rate * 4, 4, 32) + b"data" + struct.pack("<I", len(raw)) + raw


def read_audio(spark: SparkSession, path: str) -> DataFrame:
    """path, rate, channels, samples (mean of the channels), error: a bad file is a row with
    an error, not a failed job."""
    import pandas as pd

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, data in zip(b["path"], b["content"], strict=True):
                try:
                    rate, x = decode_wav(data)
                    rows.append((p, rate, x.shape[1], x.mean(axis=1, dtype=np.float32), None))
                except (ValueError, struct.error) as e:
                    rows.append((p, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "rate", "channels", "samples", "error"]).astype({"rate": "Int64", "channels": "Int64"})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, rate int, channels int, samples array<float>, error string")


def write_verified_wav(path: str, samples: np.ndarray, rate: int = 48000) -> None:
    """Write, read again and compare sample by sample; the name appears only when all is there."""
    part = f"{path}.part"
    Path(part).write_bytes(encode_wav(samples, rate))
    if not np.array_equal(decode_wav(Path(part).read_bytes())[1][:, 0], np.asarray(samples, np.float32)):
        raise OSError("the file does not hold what was written")
    os.replace(part, path)


def write_csv_with_bom(path: str, columns: list[str], rows: Iterable[dict]) -> None:
    """A single small file for people: byte order mark, header even without rows."""
    out = io.StringIO(newline="")
    writer = csv.DictWriter(out, columns)
    writer.writeheader()
    writer.writerows(rows)
    Path(path).write_text(out.getvalue(), encoding="utf-8-sig", newline="")


def write_report(path: str, count: int, lines: Iterable[str], totals: dict, final: str | None = None, check: list[str] | None = None, review: dict[str, str] | None = None) -> None:
    """check: details of what the whole recording failed (empty: it passed; None: not checked);
    review: what export_review() returned. Fixed values: the wording."""
    told = [] if check is None else [f"最终整条质检：{'未通过：' + '、'.join(check) if check else '通过'}", ""]
    head = ["音频质量报告", "", f"本次生成块数：{count}段", ""]
    tail = [f"首次检测未达标：{totals['initially_failed']}段", f"未达标音频：{totals['finally_failed']}段", f"总重新生成次数：{totals['regenerations']}次", f"最终音频：{final or '未交付'}", f"逐段审听目录：{review['review_dir'] if review else '未交付'}", f"逐段审听清单：{review['manifest_path'] if review else '未交付'}"]
    Path(path).write_text("\n".join([*head, *lines, *told, *tail]) + "\n", encoding="utf-8")


def manifest_json(items: Iterable[dict]) -> str:
    return json.dumps({"items": list(items)}, ensure_ascii=False)
