"""Segments from reviewed text or from a segmenter's JSON."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions import text as X


def reviewed_segments(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """keys, seq, segment_id, text, paragraph_after: every line that is not blank.

    A segment ends a paragraph if the next line is blank or there is none. A text without
    any such line gives no rows; read_reviewed() raises for it.
    """
    lines = texts.select(*keys, F.posexplode(F.split(F.col(text_col), X.LINE_BREAK)).alias("no", "line")).select(*keys, "no", X.trim_space(F.col("line")).alias("text")).where("text <> ''")
    w = Window.partitionBy(*keys).orderBy("no")
    after = F.lead("no").over(w)
    seq = F.row_number().over(w)
    return lines.select(*keys, seq.alias("seq"), X.segment_id(seq).alias("segment_id"), "text", (after.isNull() | (after > F.col("no") + 1)).alias("paragraph_after"))


def read_reviewed(spark: SparkSession, path: str) -> DataFrame:
    out = reviewed_segments(spark.read.text(path, wholetext=True).withColumnRenamed("value", "text").withColumn("source", F.input_file_name()), ["source"])
    if out.isEmpty():
        raise ValueError("输入文本为空")
    return out


def payload_segments(spark: SparkSession, payload: str, source_text: str) -> DataFrame:
    """Segments of a JSON list, or of an object's ``segments``; items are texts or objects.

    Raises on other items, empty texts, or if more than white space differs from the source.
    """
    found = json.loads(payload)
    items = found.get("segments") if isinstance(found, dict) else found
    if not isinstance(items, list) or not items:
        raise ValueError("语义分段器必须返回非空segments数组")
    rows = []
    for i, x in enumerate(items, 1):
        if not isinstance(x, (str, dict)):
            raise ValueError(f"语义分段器返回了无效片段：第{i}项")
        text = (x if isinstance(x, str) else str(x.get("text") or "")).strip()
        if not text:
            raise ValueError(f"语义分段器返回了空片段：第{i}项")
        rows.append((i, f"S{i:03d}", text, i == len(items) or bool(isinstance(x, dict) and x.get("paragraph_after"))))
    if "".join("".join(r[2].split()) for r in rows) != "".join(source_text.split()):
        raise ValueError("语义分段器修改了原文；只允许改变边界，不允许增删或改写文字")
    return spark.createDataFrame(rows, "seq int, segment_id string, text string, paragraph_after boolean")


def joined_text(seq: Column, text: Column) -> Column:
    """Aggregate: the texts of a group without white space, in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(seq.alias("s"), text.alias("t")))), lambda x: X.strip_space(x["t"])), "")


def oversized(segments: DataFrame, hard_max: int = 240) -> DataFrame:
    return segments.where(F.length("text") > hard_max)


def load(spark: SparkSession, text: str, mode: str = "reviewed", payload: str | None = None) -> DataFrame:
    """By mode: reviewed or manual text, or ai_command with the command's output as payload."""
    mode = mode.strip().lower()
    if mode in ("reviewed", "manual"):
        return reviewed_segments(spark.createDataFrame([(0, text)], "k int, text string"), ["k"]).drop("k")
    if mode != "ai_command":
        raise ValueError("segmentation.mode必须是reviewed或ai_command")
    if payload is None:
        raise ValueError("ai_command模式必须配置非空的segmentation.command数组")
    return payload_segments(spark, payload, text)
