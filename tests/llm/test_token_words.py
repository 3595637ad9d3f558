"""op8: words as they are remembered, and the rolling hash by doubling."""

import numpy as np
import pytest

from cadenza.llm import token_store as ts

TEXTS = [
    "so and, then. so\nand", "a,", "a.\nB, c.", "a,, b", "a), b.", "3, 4.\nc", "it's, we'll.", "a,\n\nb", "a,  b", "a. \nb", ".", ", a", "", " ", "\n",
    "x,\u00a0y", "x,\n\u3000y", "é.\né,\r\nz", "x,\n", "a,\n, b", "a, , b,\n.c", "a   b, c", "日本, 語.\n語", "a <|endoftext|>, b", "\ufdd1a, b",
]


@pytest.fixture(scope="module")
def spec():
    with open(ts.default_tokenizer(), "rb") as f:
        return f.read()


def test_words_are_known_with_all_that_may_follow(spec):
    c = ts.Coder(spec)
    assert c.encode(TEXTS) == c.pack(TEXTS)
    assert "and" in c.words and "and," not in c.words and "then." not in c.words  # before, each such pair was a word of its own


def test_words_in_use_outlast_a_full_memory(spec, monkeypatch):
    monkeypatch.setattr(ts, "MEMORY", 8)
    c = ts.Coder(spec)
    for i in range(9):
        text = f"x often w{chr(97 + i)} v{chr(97 + i)}"
        assert c.encode([text]) == c.pack([text])
        assert "often" in c.words or "often" in c.words.older  # before, a full memory was emptied
        assert len(c.words) <= 8 and len(c.words.older) <= 8


@pytest.mark.parametrize("n", [0, 1, 7, 8, 15, 16, 17, 900])
def test_places_are_those_of_the_sum(n):
    ids = np.random.default_rng(n).integers(0, 50_000, n).astype("<u2")
    m, want = (1 << 64) - 1, []
    for i in range(n):
        h = 0
        for k in range(min(ts.REACH, i + 1)):
            x = (int(ids[i - k]) + 1) * int(ts._MIX) & m
            h += (x ^ x >> 29) * pow(ts._BASE, k, 1 << 64)
        want += [i + 1] if (h & m) >> 61 == 0 else []
    assert ts.places(ids, 3).tolist() == want


def test_different_words_are_looked_up_once_for_all_texts(spec):
    c, seen = ts.Coder(spec), []
    c.words.__class__ = type("Seen", (ts._Words,), {"get": lambda self, w: seen.append(w) or dict.get(self, w)})
    texts = ["same so same. same", "so so same", "", "été\nsame, été"] * 3
    assert c.encode(texts) == c.pack(texts)
    assert seen.count("same") == 1 and seen.count("so") == 1  # before, each time they occurred


def test_new_words_are_met_together(spec):
    c = ts.Coder(spec)
    words = ["plain", "ÀÉï", "x1", "", "日本", "ɏ", "a-b", ts.LINE_MARK + "line", "tail$$$", "ǅ", "µ", "×", "ªº"]
    c.words.meet(words)
    assert sorted(c.words) == sorted(["plain", "ÀÉï", "ɏ", "ǅ"])
    assert [c.words[w] for w in ("plain", "ÀÉï", "ɏ", "ǅ")] == c.pack([" plain", " ÀÉï", " ɏ", " ǅ"])


def test_gathered_batches_hold_the_same_rows():
    import pyarrow as pa

    rows = [pa.RecordBatch.from_pydict({"a": [f"{i}-{k}" for k in range(i % 4)]}, pa.schema([("a", pa.string())])) for i in range(9)]
    for size in (1, 40, 1 << 20):
        got = list(ts.gathered(iter(rows), size))
        assert sum((b.column(0).to_pylist() for b in got), []) == sum((b.column(0).to_pylist() for b in rows), []) and len(got) <= len(rows)
    assert len(got) == 1 and list(ts.gathered(iter([]))) == []


def test_the_sum_of_a_first_part_needs_no_shift():
    from zlib import crc32

    shift = ts.Shift()
    assert ts.join_crcs([(crc32(b"whole"), 5)], shift) == crc32(b"whole") and list(shift.known) == [0]  # before, 5 was made known
    assert ts.join_crcs([(crc32(b""), 0), (crc32(b"a"), 1), (crc32(b"bc"), 2)], shift) == crc32(b"abc")
