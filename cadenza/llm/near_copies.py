"""Near-dedup of whole documents: SimHash, Golay keys, exact Jaccard.

Documents with equal sets of five-word shingles are one node. A node's SimHash counts, for each
of 828 bits, how many shingles set it and how many do not. At similarity 0.8 some 15 of 100
bits differ, far more than op3's two of 64, so a fingerprint is cut into 36 words of 23 bits and
each word is decoded softly: its keys are the Golay codewords nearest to the counts, not to the
bits alone, so bits that were nearly even weigh little. A table joins three words; a node has
the 24 likeliest triples of codewords as keys in each of the twelve tables. Nodes that meet in a
key are compared bit by bit (128 bits of the fingerprint), what is left is verified by the exact
Jaccard similarity of the sets, and verified links form components by distributed union-find.

A pair of similarity 0.8 is missed once in some 6,000 times, one of 0.9 practically never
(simulated). As in line dedup, each node of a bucket is compared with the bucket's least, and after
that only nodes of one bucket that are still in different components, all of them. A key has 36
bits, so unlike nodes hardly meet by chance: one of ten million pairs. Keys are made on the way into
their shuffle and shingles once more for the nodes that meet: neither is stored for every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, connected_components, map_rows, process_memory, release, stash, unstash
from .line_dedup import WORDS as SKETCH_WORDS
from .line_dedup import across, jaccard
from .simhash import codewords

SHINGLE, THRESHOLD = 5, 0.8
#: Tables, Golay words in a table's key, codewords taken for a word, and keys of a node in a table.
TABLES, WORDS, LIST, KEYS = 12, 3, 8, 24
#: Bits of a Golay word, and of its codeword's index.
LENGTH, INDEX = 23, 12
#: Differing bits of 128 beyond which nodes are not compared. At similarity 0.8 19 are expected,
#: with a standard deviation of 4; between unlike nodes 64, of 6.
FAR = 48
#: Whether a key is the least that two nodes share.
FIRST_SHARED = "array_min(array_intersect(ba, bb)) = element_at(ba, nr + 1)"
SEED = 42
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LANES = np.uint64(0x0101010101010101)


def shingles(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of a text's different word shingles, sorted: the XXH64 of their words, mixed
    in order. Fewer words than a shingle has: the whole sequence is one; no words: the one value 0."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return np.zeros(1, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    k = min(words, len(found))
    n = len(found) - k + 1
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = (out ^ out >> np.uint64(32)) * _MIX + h[j : j + n]
    out = (out ^ out >> np.uint64(32)) * _MIX
    return np.unique(out ^ out >> np.uint64(29))


def counts(values: np.ndarray, starts: np.ndarray, n: np.ndarray, bits: int) -> np.ndarray:
    """SimHash counts of sets laid end to end: for each set and bit the values that set it less
    those that do not. The bits are those of the values hashed anew for every 64.

    Eight bits are counted at once, in the bytes of a number, over at most 255 values.
    """
    parts = -(-n // 255)
    first = np.cumsum(parts) - parts
    blocks = np.repeat(starts, parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    out = np.empty((len(n), -(-bits // 64) * 64), np.int32)
    for t, (a, b, c) in enumerate(np.random.default_rng(SEED).integers(0, 1 << 64, (out.shape[1] // 64, 3), np.uint64)):
        h = (values ^ a) * (b | np.uint64(1))
        h = (h ^ h >> np.uint64(32)) * (c | np.uint64(1))
        h ^= h >> np.uint64(32)
        sums = np.empty((len(blocks), 8, 8), np.uint8)
        for j in range(8):
            sums[:, :, j] = np.add.reduceat(h >> np.uint64(j) & _LANES, blocks).astype("<u8").view(np.uint8).reshape(-1, 8)
        out[:, 64 * t : 64 * t + 64] = np.add.reduceat(sums.reshape(-1, 64).astype(np.int32), first, axis=0)
    return 2 * out[:, :bits] - n[:, None].astype(np.int32)


def _halves() -> tuple[np.ndarray, np.ndarray]:
    """Indices of one codeword of each pair of opposite ones, and their bits as -1 and 1."""
    words = codewords()
    index = np.flatnonzero(words >> 22 == 0)
    return index, (2 * (words[index, None] >> np.arange(LENGTH) & 1) - 1).astype(np.float32)


def nearest_codewords(c: np.ndarray, k: int = LIST) -> tuple[np.ndarray, np.ndarray]:
    """(indices, nearness) of the k codewords that agree most with each row of 23 counts, in
    no order. Ties go the same way for every row."""
    memory = process_memory("near")
    if "codewords" not in memory:
        index, signs = _halves()
        opposite = np.searchsorted(codewords(), codewords()[index] ^ (1 << LENGTH) - 1)
        memory["codewords"] = index, opposite, signs.T.copy(), np.random.default_rng(SEED).random(len(index), np.float32) / 2
    index, opposite, signs, ties = memory["codewords"]
    agree = c.astype(np.float32) @ signs
    near = np.abs(agree) + ties
    # the k best lie in the k of 128 groups whose best are greatest
    groups = near.reshape(len(c), -1, 128).max(axis=1)
    some = np.argpartition(groups, 128 - k, axis=1)[:, -k:]
    some = (some[:, None, :] + np.arange(0, len(index), 128)[:, None]).reshape(len(c), -1)
    at = np.take_along_axis(some, _best(np.take_along_axis(near, some, 1), k), 1)
    negative = np.take_along_axis(agree, at, 1) < 0
    return np.where(negative, opposite[at], index[at]), np.take_along_axis(near, at, 1)


def _best(near: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest of each row, in no order."""
    return np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]


def golay_keys(c: np.ndarray) -> np.ndarray:
    """Keys of each row of counts, with the number of the table in their upper bits."""
    out = []
    for t in range(TABLES):
        keys, near = np.zeros((len(c), 1), np.int64), np.zeros((len(c), 1), np.float32)
        for w in range(WORDS * t, WORDS * t + WORDS):
            index, more = nearest_codewords(c[:, LENGTH * w : LENGTH * w + LENGTH])
            near = (near[:, :, None] + more[:, None, :]).reshape(len(c), -1)
            keys = (keys[:, :, None] << INDEX | index[:, None, :]).reshape(len(c), -1)
            if near.shape[1] > KEYS:  # what is best with the next word is best without it
                best = _best(near, KEYS)
                keys, near = np.take_along_axis(keys, best, 1), np.take_along_axis(near, best, 1)
        out.append(keys | t << INDEX * WORDS)
    return np.concatenate(out, axis=1)


def _sets(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Shingles, their number and the node of each text."""
    sets = [shingles(t) for t in texts.to_pylist()]
    node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64)
    return sets, np.array([len(s) for s in sets]), node.view(np.int64)


def _counts(sets: list[np.ndarray], n: np.ndarray, bits: int = TABLES * WORDS * LENGTH) -> np.ndarray:
    return counts(np.concatenate(sets), np.cumsum(n) - n, n, bits)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hash of the text, node, n, f1 and f2: 128 bits of the fingerprint) of every row."""

    def run(cols: dict) -> dict:
        sets, n, node = _sets(cols["text"])
        f = np.packbits(_counts(sets, n, 128) > 0, axis=1).view("<i8")
        return {"doc_id": cols["doc_id"], "hash": cols["hash"], "node": node, "n": n.astype(np.int32), "f1": f[:, 0], "f2": f[:, 1]}

    kind = dict(docs.dtypes)[id_col]
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text")), f"doc_id {kind}, hash long, node long, n int, f1 long, f2 long", run)


def node_keys(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(band, node): the keys of every row, repeated for equal nodes."""

    def run(cols: dict) -> dict:
        sets, n, node = _sets(cols["text"])
        keys = golay_keys(_counts(sets, n))
        return {"band": keys.ravel(), "node": np.repeat(node, keys.shape[1])}

    return map_rows(docs.select(F.col(text_col).alias("text")), "band long, node long", run)


def node_sets(docs: DataFrame, text_col: str = "text", keys: bool = True) -> DataFrame:
    """(node, n, s: the shingles, bands: the keys if asked for), one row for each node."""

    def run(cols: dict) -> dict:
        sets, n, node = _sets(cols["text"])
        bands = list(golay_keys(_counts(sets, n))) if keys else [None] * len(n)
        return {"node": node, "n": n.astype(np.int32), "s": [s.view(np.int64) for s in sets], "bands": bands}

    return map_rows(docs.select(F.col(text_col).alias("text")), "node long, n int, s array<long>, bands array<long>", run).dropDuplicates(["node"])


def verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) of nodes that are similar enough."""
    a = pairs.join(sets.select(F.col("node").alias("u"), F.col("s").alias("a")), "u")
    both = a.join(sets.select(F.col("node").alias("v"), F.col("s").alias("b")), "v")
    return both.where(jaccard(F.col("a"), F.col("b")) >= threshold).select("u", "v")


def sketches(sets: DataFrame, words: int = SKETCH_WORDS) -> DataFrame:
    """As in line dedup, of the sets given: (line_id, n, bands, w0, w1, ...)."""
    s = sets.select(F.col("node").alias("line_id"), "n", "bands", F.explode("s").alias("h"))
    at, bit = F.expr(f"cast(shiftright(h, 6) & {words - 1} AS int)"), F.expr("shiftleft(1L, cast(h & 63 AS int))")
    w = [F.bit_or(F.when(at == j, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{j}") for j in range(words)]
    return s.groupBy("line_id").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), *w)


def alike(a: str, b: str, threshold: float) -> str:
    """SQL: whether two nodes' fingerprints and sizes allow a link."""
    bits = f"bit_count({a}.f1 ^ {b}.f1) + bit_count({a}.f2 ^ {b}.f2) <= {FAR}"
    return f"{bits} AND least({a}.n, {b}.n) >= {threshold}D * greatest({a}.n, {b}.n) - 0.000001D"


def components(marks: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(node, root): nodes of a component with another one. marks: the features of docs."""
    spark = marks.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sets(wanted: DataFrame, tag: str, keys: bool) -> DataFrame:
        first = first_rows(marks.join(wanted.distinct(), "node", "left_semi"), "node")
        return stash(node_sets(rows_at(docs, first, id_col, text_col), text_col, keys), tag)

    # one exchange for both uses, as both ask for the same columns
    keys = node_keys(docs, text_col).repartition(parts, "band")
    stats = keys.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").drop("last")
    live = stash(keys.join(stats.hint("shuffle_hash"), "band").select("band", "node", "hub").distinct(), "near-buckets")
    release(spark)
    nodes = stash(marks.select("node", F.struct("n", "f1", "f2").alias("f")).join(live.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "near-nodes")
    met = live.where("node <> hub").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    met = met.join(nodes.select(F.col("node").alias("u"), F.col("f").alias("a")), "u").join(nodes.select(F.col("node").alias("v"), F.col("f").alias("b")), "v")
    stars = stash(met.where(alike("a", "b", threshold)).select("u", "v"), "near-met")
    ends = sets(stars.select(F.explode(F.array("u", "v")).alias("node")), "near-ends", False)
    links = stash(verify(stars, ends, threshold), "near-stars")
    unstash(stars, ends)
    release(spark)
    roots = connected_components(links, "near-cc").select("node", "root")
    rest = live.where("node <> hub").join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    split = rest.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("band")
    open_ = stash(rest.join(split, "band").join(nodes, "node").select("band", "node", "root", "f"), "near-open")
    unstash(live)
    release(spark)
    a, b = open_.alias("x"), open_.alias("y")
    near = a.join(b, F.expr(f"x.band = y.band AND x.root <> y.root AND {alike('x.f', 'y.f', threshold)}"))
    busy = stash(near.select("x.band", "x.node", "x.root").distinct(), "near-busy")
    some = sets(busy.select("node"), "near-sets", True)
    place = some.select("node", F.posexplode("bands").alias("nr", "band"))
    members = busy.join(place, ["node", "band"]).select("nr", "band", F.col("node").alias("line_id"), "root")
    maybe = across(members, sketches(some), threshold, first_shared=FIRST_SHARED)
    more = stash(verify(maybe, some, threshold), "near-cross")
    unstash(maybe, open_, busy, some, nodes)
    release(spark)
    if more.isEmpty():
        return roots
    return connected_components(links.union(more), "near-cc-2").select("node", "root")


def first_rows(named: DataFrame, by: str) -> DataFrame:
    """(__id, __hash): for each value of ``by`` its row with the smallest doc_id, nulls last, of
    equal ids the one with the least hash."""
    first = named.groupBy(by).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("k"))
    return first.select(_id(F.col("k.doc_id")), F.col("k.hash").alias("__hash"))


def rows_at(docs: DataFrame, places: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose ids and texts are asked for, with __id and __hash."""
    rows = docs.select("*", _id(F.col(id_col)), F.xxhash64(text_col).alias("__hash"))
    return rows.join(places, ["__id", "__hash"], "left_semi")


def _id(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("\x00")).alias("__id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of each component of documents whose sets of five-word shingles have a Jaccard
    similarity of ``threshold`` or more: the one with the smallest doc_id, nulls last, of
    equal ids the one with the least hash of the text. Null and blank texts are one component."""
    marks = stash(features(docs, id_col, text_col), "near-marks")
    roots = components(marks, docs, id_col, text_col, threshold)
    named = marks.select("doc_id", "hash", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rows_at(docs, first_rows(named, "root"), id_col, text_col).dropDuplicates(["__id", "__hash"]).select(*docs.columns)
