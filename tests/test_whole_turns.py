"""Queries on adjacent turns against brute force, with turns far over 240 characters."""

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from cadenza.plans import speech_queries as q


def normal(text):
    return re.sub("[^A-Za-z0-9㐀-鿿]", "", text or "").lower()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(11)
    words = "the a on in speech, turn. word same; voice next? rate 12 语 速 mark".split()
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = say(130)
    texts = [long, long + " and then on", say(20), say(90) + " the end of it", "", None, "Short one", "short 1"]
    texts += [long + " the x", long + " and x", long + " " + say(60), long[:245] + say(80)]
    return [(1, i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, pairs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("turns"))
    spark.createDataFrame(pairs, "conv_id long, turn int, text string").withColumn("role", F.lit("user")).write.parquet(f"{path}/conversations.parquet")
    return path


def adjacent(pairs):
    return {i: (a, b) for (_, i, a), (_, _, b) in zip(pairs, pairs[1:], strict=False) if b is not None}


def test_every_pair_has_its_error_rate(spark, pairs, folder):
    want = {}
    for i, (a, b) in adjacent(pairs).items():
        d = distance(normal(a), normal(b))
        want[i] = (d, round(d / max(len(normal(a)), 1), 6))
    assert any(len(normal(a)) > 240 and len(normal(b)) > 240 for a, b in adjacent(pairs).values())
    assert {r.turn: (r.distance, r.cer) for r in q.QUERIES["cer_all_adjacent_turns"](spark, folder).collect()} == want


def test_entry_has_every_pair(spark, pairs, folder, monkeypatch):
    import __spark_entry__ as e

    monkeypatch.setattr(e, "SMOKE_DIR", folder)
    assert {r.turn for r in e.entry(spark).collect()} == set(adjacent(pairs))


def units(text):
    return [u.lower() for u in re.findall("[A-Za-z]+|[0-9]+|[㐀-鿿]", text or "")]


def median(x):
    s = sorted(x)
    return (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2 if s else 0.0


def judged(turn, a, b, known):
    """Failures, warnings, corrected recognition, score and details of one pair, rule by rule."""
    if turn % 11 == 3:
        return ["音频分析失败"], [], None, [1.0, 0.0, *[float("inf")] * 3], ["音频分析失败"]
    target, raw = normal(a), normal(b)
    got, notes = "", []
    for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, list(target), list(raw), autojunk=False).get_opcodes():
        hit = tag == "replace" and known.get(target[i1:i2]) == raw[j1:j2]
        got += target[i1:i2] if hit else raw[j1:j2]
        notes += ["ASR已知近音替换：" + target[i1:i2] + "→" + raw[j1:j2]] if hit else []
    if not target:
        return ["目标文本为空"], notes, None, [1.0, float(len(notes)), *[float("inf")] * 3], ["目标文本为空"]
    span = max([max(i2 - i1, j2 - j1) for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, list(target), list(got), autojunk=False).get_opcodes() if tag != "equal"], default=0)
    u, v = units(a), units(b)
    seps = re.findall("(?:[A-Za-z]+|[0-9]+|[㐀-鿿])([^A-Za-z0-9㐀-鿿]*)", a)
    ts = [(i * 200, i * 200 + 150 + i % 7 * 10) for i in range(len(v) + 1)]
    to = [None] * len(u)
    for i, j, n in difflib.SequenceMatcher(None, u, v, autojunk=False).get_matching_blocks():
        to[i : i + n] = range(j, j + n)
    inner, short, long = [], [], []
    for i in range(len(u) - 1):
        if to[i] is None or to[i + 1] != to[i] + 1:
            continue
        (s, e), (nxt, _) = ts[to[i]], ts[to[i + 1]]
        gap = max(0, nxt - e)
        whole = e - s + gap
        mark = "s" if re.search("[。！？!?；;\n]", seps[i]) else "c" if re.search("[，,、：:]", seps[i]) else ""
        if not mark:
            inner.append((gap, u[i], u[i + 1]))
        elif gap < (100 if mark == "s" else 40) and whole < 240:
            short.append((gap, whole, u[i], u[i + 1]))
        elif gap > (1600 if mark == "s" else 900):
            long.append((gap, whole, u[i], u[i + 1]))
    gaps = [g for g, _, _ in inner]
    limit = max(280.0, median(gaps) + 4 * median([abs(g - median(gaps)) for g in gaps]))
    odd = [g for g in inner if g[0] > limit]
    rates = []
    for i in range(len(u) - 5):
        m = to[i : i + 6]
        run = m[0] is not None and m == list(range(m[0], m[0] + 6))
        rates.append(6 / ((ts[m[5]][1] - ts[m[0]][0]) / 1000) if run else 0.0)
    middle = median([r for r in rates if r > 0])
    ratios = [r / middle if r > 0 and middle > 0 else 0.0 for r in rates]
    speed = len(ts) / ((ts[-1][1] - ts[0][0]) / 1000) if len(ts) >= 2 else 0.0
    cer, coverage = distance(target, got) / max(len(target), 1), sum(j is not None for j in to) / max(len(u), 1)
    pauses = lambda name, x: name + "（" + "、".join(f"“{p}”到“{r}”静音{g}毫秒，含前字拉长共{w}毫秒" for g, w, p, r in x) + "）"
    fastest = "".join(u[rates.index(max(rates)) :][:6]) if rates else ""
    place = f"“{fastest}”，" if fastest else ""
    rules = [
        (coverage < 0.7, "逐字时间戳覆盖不足", f"逐字时间戳覆盖不足（{coverage * 100:.1f}%）"),
        (odd, "句内异常停顿", "句内异常停顿（" + "、".join(f"“{p}”到“{r}”{g}毫秒" for g, p, r in odd) + "）"),
        (short, "标点停顿过短", pauses("标点停顿过短", short)),
        (long, "标点停顿过长", pauses("标点停顿过长", long)),
        (any(x > 1.45 and y > 1.45 for x, y in zip(ratios, ratios[1:], strict=False)), "局部语速异常", f"局部语速异常（{place}最高比值{max(ratios, default=0):.3f}）"),
        (cer > 0.12, "转写差异过大", f"转写差异过大（CER {cer:.3f}）"),
        (span >= 2, "存在连续漏字、错字或重复", "存在连续漏字、错字或重复"),
        (turn < 0.35, "音频为空或过短", "音频为空或过短"),
        (speed > 0 and not 2 <= speed <= 7, "整体语速异常", f"整体语速异常（{speed:.2f}字/秒，参考比值0.000）"),
    ]
    failed = [name for bad, name, _ in rules if bad]
    score = [float(len(failed)), float(len(notes)), cer, max(ratios, default=0.0), float(max(gaps, default=0))]
    return failed, notes, got, score, [told for bad, _, told in rules if bad]


def test_rules_see_whole_turns(spark, pairs, folder):
    for name, known in (("rules_vector", {}), ("failure_details", {}), ("known_substitution", {"the": "and", "on": "in"})):
        want = {f"1-{i}": judged(i, a, b, known) for i, (a, b) in adjacent(pairs).items()}
        rows = {r.segment_id: r for r in q.QUERIES[name](spark, folder).collect()}
        assert set(rows) == set(want)
        for key, (failed, notes, got, score, told) in want.items():
            r = rows[key]
            if name == "rules_vector":
                assert (r.hard_failures, r.warnings, r.passed) == (failed, notes, not failed), key
                assert r.score == pytest.approx(score), key
            elif name == "failure_details":
                assert r.details == told, key
            else:
                assert (r.warnings, r.recognized) == (notes, got), key
