"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of at most 23 bits. With two differing bits
or fewer, one segment is clean (pigeonhole) and every other has two errors at most. The
23-bit Golay code is perfect: every word lies within three bits of exactly one codeword, and
the codewords nearest to a word and to its one-bit neighbours (one, or six) share an
index with those of any word two bits away. So a fingerprint gives a key for each segment
taken as it is, with each codeword index of the next segment; fingerprints meet in equal
keys and are verified bit by bit. Linked fingerprints form components by distributed
union-find.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, connected_components, map_rows, process_memory, small_batches, stash, unstash

SEED = 42
#: First bit and length of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: The Golay code's generator polynomial.
GENERATOR = 0b101011100011
#: Fingerprints with one key up to which all pairs of the key are compared.
PAIRED = 48
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: str | None, words: int = 3, seed: int = SEED) -> int:
    """SimHash of a text's word shingles (repeats count), as an unsigned number.

    Bits are 1 if set in over half of the shingles' XXH64. Fewer words than a shingle has:
    the whole sequence is one; no words: zero.
    """
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = len(found)
    if not n:
        return 0
    joined = b" ".join(found)
    if n <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, found), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: n - words + 1].tolist(), ends[words - 1 :].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for lo in range(0, len(starts), 1 << 14):
        raw = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[lo : lo + (1 << 14)], ends[lo : lo + (1 << 14)], strict=True)])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = SEED) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long) of every row."""

    def run(cols: dict) -> dict:
        fps = [fingerprint(t, words, seed) for t in cols["text"].to_pylist()]
        return {"doc_id": cols["doc_id"], "fp": np.array(fps, np.uint64).view(np.int64)}

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), f"doc_id {dict(docs.dtypes)[id_col]}, fp long", run)


def _leaders() -> np.ndarray:
    """Error pattern of up to three bits for each of the 2048 syndromes."""
    bits = [1 << i for i in range(23)]
    words = [0, *bits, *(a | b for i, a in enumerate(bits) for b in bits[:i])]
    words += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    words = np.array(words, np.int64)
    out = np.zeros(2048, np.int64)
    out[_syndrome(words)] = words
    return out


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator polynomial."""
    rest = words.copy()
    for i in range(22, 10, -1):
        rest ^= (rest >> i & 1) * (GENERATOR << (i - 11))
    return rest


def codewords() -> np.ndarray:
    """The 4096 codewords by index, as numbers of 23 bits."""
    high = np.arange(4096, dtype=np.int64) << 11
    return high | _syndrome(high)


def codeword_indices(words: np.ndarray, length: int = 23) -> np.ndarray:
    """For each word the indices (upper 12 bits) of the codewords nearest to it and to each
    word one bit away among its lower ``length`` bits: an array of shape (n, length + 1)."""
    flips = np.concatenate([[0], 1 << np.arange(length)]).astype(np.int64)
    all_words = words.astype(np.int64)[:, None] ^ flips
    memory = process_memory("golay")
    if "leaders" not in memory:
        memory["leaders"] = _leaders()
    return (all_words ^ memory["leaders"][_syndrome(all_words)]) >> 11


def _keys(df: DataFrame) -> DataFrame:
    """(fp) -> (key, fp): 3 to 18 keys for a fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            part = [((fp >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64) for lo, n in SEGMENTS]
            for s, (_, n) in enumerate(SEGMENTS):
                index = np.sort(codeword_indices(part[s], n), axis=1)
                new = np.concatenate([np.ones((len(fp), 1), bool), index[:, 1:] != index[:, :-1]], axis=1)
                row, col = np.nonzero(new)
                key = (np.int64(s) << 48) | (part[s - 1][row] << 12) | index[row, col]
                yield pa.RecordBatch.from_pydict({"key": key, "fp": fp.view(np.int64)[row]})

    return df.mapInArrow(run, "key long, fp long")


def link_fingerprints(fps: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Links (u, v) that connect exactly the distinct fingerprints two bits apart or fewer.

    A key that more than ``paired`` fingerprints have is not compared in pairs: its
    fingerprints go to the words one bit away from them (65 each), where two of them meet
    if and only if they differ in two bits at most, and are linked to the smallest there.
    """
    keys = stash(_keys(fps), "simhash-keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    a = keys.join(sizes.where(F.col("n") <= paired).select("key"), "key")
    pairs = a.select("key", F.col("fp").alias("u")).join(keys.select("key", F.col("fp").alias("v")), "key")
    pairs = pairs.where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 2)).select("u", "v")
    hot = keys.join(sizes.where(F.col("n") > paired).select("key"), "key", "left_semi").select("fp").distinct()
    near = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    spread = hot.select("fp", F.explode(near).alias("bit")).select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("word"))
    least = spread.groupBy("word").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1").select("word", "v")
    stars = spread.join(least, "word").where("fp <> v").select(F.col("fp").alias("u"), "v")
    links = stash(pairs.union(stars).distinct(), "simhash-links")
    unstash(keys)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = SEED, paired: int = PAIRED) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every row.

    component_id is the smallest doc_id of the documents reachable by links of two or fewer
    differing bits, the row's own included. Null and empty texts have fingerprint zero and
    link like others. Repeated rows stay; rows whose doc_id is null get the component's
    smallest id (null if it has none). Other columns are not read.

    Equal fingerprints are one node, with its smallest doc_id, so a group of copies is never
    compared with itself.
    """
    fps = stash(fingerprints(docs, id_col, text_col, words, seed), "simhash-fps")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = link_fingerprints(nodes.select("fp"), paired)
    roots = connected_components(links, "simhash-cc").select(F.col("node").alias("fp"), "root")
    both = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = both.groupBy("root").agg(F.min("least").alias("component_id"))
    named = both.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
