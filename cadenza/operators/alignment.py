"""Alignment of target and recognized text: the one place that needs Python.

The matching follows the standard library's longest-matching-block rule, which no SQL
function expresses; rows go through Arrow in batches.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEMA = "opcodes array<struct<tag:string,i1:int,i2:int,j1:int,j2:int>>, mapping array<int>"


def align(target, recognized) -> tuple[list[tuple], list[int | None]]:
    """Opcodes, and for each target item its recognized index or None."""
    matcher = difflib.SequenceMatcher(None, target, recognized, autojunk=False)
    codes, mapping = matcher.get_opcodes(), [None] * len(target)
    for tag, i1, i2, j1, _ in codes:
        if tag == "equal":
            mapping[i1:i2] = range(j1, j1 + i2 - i1)
    return codes, mapping


def alignment(target: Column, recognized: Column) -> Column:
    """struct(opcodes, mapping) of two arrays of strings; nulls count as empty."""

    @F.pandas_udf(SCHEMA)
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        out = [align(list(x) if x is not None else [], list(y) if y is not None else []) for x, y in zip(a, b, strict=True)]
        return pd.DataFrame({"opcodes": [[dict(zip(("tag", "i1", "i2", "j1", "j2"), c, strict=True)) for c in codes] for codes, _ in out], "mapping": [m for _, m in out]})

    return run(target, recognized)


def changed_span(opcodes: Column) -> Column:
    """Longest side of a block that is not equal."""
    other = F.filter(opcodes, lambda c: c["tag"] != "equal")
    return F.coalesce(F.array_max(F.transform(other, lambda c: F.greatest(c["i2"] - c["i1"], c["j2"] - c["j1"]))), F.lit(0))


def substitute(target: Column, recognized: Column, opcodes: Column, known: dict[str, str]) -> Column:
    """struct(text, applied): recognized with known misrecognitions of whole replaced spans
    put right, and target→recognized for each."""
    table = F.create_map(*(F.lit(x) for kv in known.items() for x in kv)) if known else F.lit(None).cast("map<string,string>")
    part = lambda t, a, b: F.substring(t, a + 1, b - a)

    def step(c: Column) -> Column:
        want, got = part(target, c["i1"], c["i2"]), part(recognized, c["j1"], c["j2"])
        hit = F.coalesce((c["tag"] == "replace") & (F.element_at(table, want) == got), F.lit(False)) if known else F.lit(False)
        return F.struct(F.when(hit, want).otherwise(got).alias("text"), F.when(hit, F.concat(want, F.lit("→"), got)).alias("note"))

    steps = F.transform(opcodes, step)
    return F.struct(F.array_join(F.transform(steps, lambda s: s["text"]), "").alias("text"), F.filter(F.transform(steps, lambda s: s["note"]), lambda n: n.isNotNull()).alias("applied"))
