"""Substring dedup: words inside passages of 50 words or more that an earlier document holds.

Suffix automata of reference shards give matching statistics: the longest run of words up
to each place that the references hold. One automaton of all references would not fit and a
broadcast of every shard would read the corpus once for each, so shards are made by content:
every window of 50 words names an anchor (the least hash among its 8-word grams), equal
windows name equal anchors, and a shard holds the passages around one anchor only. Documents
are streamed against a shard in the order of their ids, each before it becomes a reference.
Passages that are equal as a whole are settled by their 128-bit hash and never compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, process_memory, release, small_batches, stash, unstash

WINDOW, GRAM = 50, 8
#: Windows in one run at most, and different passages of one anchor up to which an automaton is built.
RUN, SHARD = 64, 256
MEMORY = 1 << 19
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 1)
        return h


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = process_memory("words").setdefault("hashes", _WordHashes())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Hashes of any word range of one document, in constant time each."""

    def __init__(self, hashes: np.ndarray, base: int):
        n = len(hashes)
        self.back, power = powers(pow(base, -1, 1 << 64), n), powers(base, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * power[:n], dtype=np.uint64, out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def runs(words: list[bytes], window: int = WINDOW, gram: int = GRAM, longest: int = RUN) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: start, windows, anchor, and two hashes of the run's words."""
    n = len(words) - window + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    h = word_hashes(words)
    one, two = Rolling(h, _BASES[0]), Rolling(mix(h), _BASES[1])
    at = np.arange(len(words) - gram + 1)
    least, size, need = one(at, at + gram), 1, window - gram + 1
    while 2 * size <= need:
        least, size = np.minimum(least[: len(least) - size], least[size:]), 2 * size
    if size < need:
        least = np.minimum(least[:n], least[need - size : need - size + n])
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.append(first[1:], n)
    if (ends - first).max() > longest:
        first = np.concatenate([np.arange(a, b, longest) for a, b in zip(first, ends, strict=True)])
        ends = np.append(first[1:], n)
    stop = ends + window - 1
    return first, ends - first, least[first].view(np.int64), one(first, stop).view(np.int64), two(first, stop).view(np.int64)


class SuffixAutomaton:
    """Of several word sequences; add() them one by one, match() another against all so far."""

    def __init__(self):
        self.length, self.link, self.next = [0], [-1], [{}]

    def add(self, words: list) -> None:
        last = 0
        length, link, nxt = self.length, self.link, self.next
        for c in words:
            q = nxt[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
                continue
            if q is None:
                new = len(length)
                length.append(length[last] + 1)
                link.append(0)
                nxt.append({})
                p = last
                while p != -1 and c not in nxt[p]:
                    nxt[p][c] = new
                    p = link[p]
                if p == -1:
                    last = new
                    continue
                q = nxt[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    link[new] = self._clone(p, c, q)
                last = new
            else:
                last = self._clone(last, c, q)

    def _clone(self, p: int, c, q: int) -> int:
        length, link, nxt = self.length, self.link, self.next
        copy = len(length)
        length.append(length[p] + 1)
        link.append(link[q])
        nxt.append(dict(nxt[q]))
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        link[q] = copy
        return copy

    def match(self, words: list) -> Iterator[int]:
        """Matching statistics: for each place the words up to it that a sequence holds."""
        v = n = 0
        length, link, nxt = self.length, self.link, self.next
        for c in words:
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            yield n


def shard_hits(group: list[tuple], window: int) -> list[tuple]:
    """Rows (doc, digest, start, words) of one anchor, in the order of doc: the (doc, digest,
    first window, windows) ranges that a smaller doc's rows hold."""
    automaton, out, waiting, doc = SuffixAutomaton(), [], [], None
    for d, digest, start, words in group:
        if d != doc:
            for w in waiting:
                automaton.add(w)
            waiting, doc = [], d
        begin = None
        for i, n in enumerate(automaton.match(words)):
            if n >= window:
                begin = i if begin is None else begin
            elif begin is not None:
                out.append((d, digest, start + begin - window + 1, i - begin))
                begin = None
        if begin is not None:
            out.append((d, digest, start + begin - window + 1, len(words) - begin))
        waiting.append(words)
    return out


def _digest(text: str) -> int:
    return int(np.array(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 9), np.uint64).view(np.int64))


def repeated_windows(docs: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """(doc_id, digest, start, n): windows start .. start + n - 1 of the text with this digest
    also occur in a document with a smaller doc_id."""
    spark = docs.sparkSession

    def find(cols: dict) -> dict:
        ids, digests, parts = [], [], []
        for d, t in zip(cols["doc_id"].to_pylist(), cols["text"].to_pylist(), strict=True):
            if d is None or not t:
                continue
            r = runs(t.encode("utf-8", "surrogatepass").split(), window)
            parts.append(r)
            ids.append(np.full(len(r[0]), d, np.int64))
            digests.append(np.full(len(r[0]), _digest(t), np.int64))
        cat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
        return {"doc_id": cat(ids), "digest": cat(digests)} | {c: cat([p[i] for p in parts]) for i, c in enumerate(("start", "n", "anchor", "c1", "c2"))}

    all_runs = stash(map_rows(docs, "doc_id long, digest long, start int, n int, anchor long, c1 long, c2 long", find), "runs")
    shared = all_runs.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")
    some = stash(all_runs.join(shared, "anchor", "left_semi"), "shared-runs")
    unstash(all_runs)
    release(spark)
    passages = stash(some.groupBy("anchor", "c1", "c2").agg(F.min("doc_id").alias("first")), "passages")
    sizes = passages.groupBy("anchor").agg(F.count("*").alias("size")).where("size > 1")
    known = some.join(passages, ["anchor", "c1", "c2"])
    copies = stash(known.where("doc_id > first").select("doc_id", "digest", "start", "n"), "copied-runs")
    firsts = known.where("doc_id = first").join(sizes, "anchor")
    places = firsts.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "n", "anchor", "size")).alias("places"))  # as many as a text has runs
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")

    def cut(cols: dict) -> dict:
        out: dict[str, list] = {c: [] for c in ("doc_id", "digest", "start", "anchor", "passage", "w1", "w2")}
        for d, t, digest, places in zip(*(cols[c].to_pylist() for c in ("doc_id", "text", "digest", "places")), strict=True):
            if _digest(t) != digest:
                continue
            words = t.encode("utf-8", "surrogatepass").split()
            one = two = None
            for p in places:
                lo, n = p["start"], p["n"]
                if p["size"] <= shard:
                    rows = [(d, digest, lo, p["anchor"], b" ".join(words[lo : lo + n + window - 1]), None, None)]
                else:
                    if one is None:
                        h = word_hashes(words)
                        one, two = Rolling(h, _BASES[0]), Rolling(mix(h), _BASES[1])
                    at = np.arange(lo, lo + n)
                    rows = [(d, digest, i, None, None, a, b) for i, a, b in zip(at.tolist(), one(at, at + window).view(np.int64).tolist(), two(at, at + window).view(np.int64).tolist(), strict=True)]
                for row in rows:
                    for c, x in zip(out, row, strict=True):
                        out[c].append(x)
        return out

    schema = "doc_id long, digest long, start int, anchor long, passage binary, w1 long, w2 long"
    cuts = stash(map_rows(texts.join(places, "doc_id").select("doc_id", "text", "digest", "places"), schema, cut), "passage-words")
    unstash(some, passages)
    release(spark)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        now, found = None, []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*found, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["doc_id", "digest", "start", "n"])

        for b in batches:
            for anchor, d, digest, start, passage in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if anchor != now:
                    found += shard_hits(group, window)
                    group, now = [], anchor
                group.append((d, digest, start, passage.split()))
            if len(found) > 4096:
                yield batch()
                found = []
        found += shard_hits(group, window)
        yield batch()

    small_batches(spark)
    shards = cuts.where("passage IS NOT NULL").select("anchor", "doc_id", "digest", "start", "passage").repartition("anchor").sortWithinPartitions("anchor", "doc_id", "digest", "start")
    matched = shards.mapInArrow(search, "doc_id long, digest long, start int, n int")
    windows = cuts.where("passage IS NULL")
    least = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("w1", "w2", "first")
    hot = windows.join(least, ["w1", "w2"]).where("doc_id > first").select("doc_id", "digest", "start", F.lit(1).alias("n"))
    return copies.union(matched).union(hot)


def remove_repeats(docs: DataFrame, window: int = WINDOW, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text of every row.

    Words are runs of other characters than space and U+0009-U+000D. A word is removed if a
    window of ``window`` words that covers it also starts in a document with a smaller
    doc_id; windows are judged on the input. Null and short texts lose nothing (a null
    one keeps the empty text). Rows whose doc_id is null lose nothing and take nothing.
    Rows that repeat a doc_id are not compared with each other. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranges = repeated_windows(docs, window, shard)
    lists = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("digest", "start", "n")).alias("ranges"))  # as many as a text has runs or windows

    def strip(cols: dict) -> dict:
        n_words, n_removed, kept = [], [], []
        for t, ranges in zip(cols["text"].to_pylist(), cols["ranges"].to_pylist(), strict=True):
            words = (t or "").encode("utf-8", "surrogatepass").split()
            keep = np.ones(len(words), bool)
            if ranges:
                digest = _digest(t or "")
                for r in ranges:
                    if r["digest"] == digest:
                        keep[r["start"] : r["start"] + r["n"] + window - 1] = False
            n_words.append(len(words))
            n_removed.append(int(len(words) - keep.sum()))
            kept.append(b" ".join(words if keep.all() else [w for w, k in zip(words, keep.tolist(), strict=True) if k]).decode("utf-8", "surrogatepass"))
        return {"doc_id": cols["doc_id"], "n_words": n_words, "n_removed": n_removed, "kept_text": kept}

    return map_rows(docs.join(lists, "doc_id", "left"), "doc_id long, n_words long, n_removed long, kept_text string", strip)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, unnest(range(1, greatest(len(words) - 48, 1))) AS i, words FROM w),
g AS (SELECT doc_id, i, sha256(array_to_string(words[i:i + 49], ' ')) AS h FROM s),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM g),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM m WHERE first < doc_id),
d AS (SELECT doc_id, count(*) AS n_removed, list(p) AS gone FROM r GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN words ELSE [x FOR x, j IN words IF NOT list_contains(gone, j)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN d USING (doc_id)
"""
