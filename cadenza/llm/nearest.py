"""Nearest neighbours by a block matrix join.

Vectors are held in blocks; int8 product tiles give inner products with a bound on their
quantisation error; pairs whose upper bound reaches the query's k-th best lower bound are
recomputed in double precision, and the tiles' lists are merged by heaps. Every vector is
covered and the bounds are safe, so recall is 1 against brute force.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, stash

QUERY_BLOCK, DATA_BLOCK = 2048, 8192


def _pack(df: DataFrame, block: int, spread: str) -> DataFrame:
    """Blocks of up to ``block`` vectors as one row: ids (int64) and matrix (float64) bytes.

    A block never holds more than a partition's rows, so no shuffle is needed to form it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        rows: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            m = np.stack(rows)
            b = pa.RecordBatch.from_pydict({"ids": [np.array(ids, "<i8").tobytes()], "matrix": [m.tobytes()], "dims": pa.array([m.shape[1]], pa.int32())})
            ids.clear()
            rows.clear()
            return b

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if i is None or v is None or None in v:
                    continue
                x = np.array(v, np.float64)
                if not len(x) or not np.isfinite(x).all() or not x.any():
                    continue
                if rows and (len(rows) == block or len(x) != len(rows[0])):
                    yield out()
                ids.append(i)
                rows.append(x)
        if rows:
            yield out()

    return df.mapInArrow(run, "ids binary, matrix binary, dims int")


def _quantise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes as float32, scale, norm of the quantisation error, norm of the decoded row."""
    scale = np.abs(m).max(axis=1, keepdims=True) / 127
    scale[scale == 0] = 1  # denormal rows
    code = np.rint(m / scale).astype(np.int8)
    back = code * scale
    # sums of products stay below 2**24, so they are exact in float32, up to 1040 dimensions
    return code.astype(np.float32 if m.shape[1] <= 1040 else np.float64), scale[:, 0], np.linalg.norm(m - back, axis=1), np.linalg.norm(back, axis=1)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of row pairs, summed in double precision from the first component on."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def tile(q_ids: np.ndarray, q: np.ndarray, d_ids: np.ndarray, d: np.ndarray, k: int, step: int = 128) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of d for each query: (query_id, vec_id, score) arrays, exact."""
    dc, ds, de, dn = _quantise(d)
    outs = []
    for lo in range(0, len(q), step):
        qs, ids = q[lo : lo + step], q_ids[lo : lo + step]
        qc, qsc, qe, qn = _quantise(qs)
        near = (qc @ dc.T).astype(np.float64) * qsc[:, None] * ds  # whole numbers, exact
        room = qn[:, None] * de + qe[:, None] * (dn + de)
        room += 1e-12 * (1 + np.abs(near)) + 1e-12 * (qn + qe)[:, None] * (dn + de)
        own = ids[:, None] == d_ids[None, :]
        low = np.where(own, -np.inf, near - room)
        if len(d) > k:
            bar = np.partition(low, len(d) - k, axis=1)[:, len(d) - k]
        else:
            bar = np.full(len(qs), -np.inf)
        r, c = np.nonzero((near + room >= bar[:, None]) & ~own)
        score = _exact(qs[r], d[c])
        order = np.lexsort((d_ids[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        first = np.searchsorted(r, np.arange(len(qs)))
        keep = np.arange(len(r)) - first[r] < k
        outs.append((ids[r[keep]], d_ids[c[keep]], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*outs, strict=True))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k nearest other vectors.

    Nearness is the inner product of the original vectors in double precision; ties go to
    the smaller id. Null vectors, ones that are empty, zero or hold null or non-finite
    components, and null ids take no part. Vectors of another length than the query's are
    never its neighbours. Repeated query rows give one list (of the least vector); a vector repeated
    under one id counts as often as it occurs.

    Plan: both sides are packed into blocks without a shuffle. Each pair of a query block
    and a data block is one row of the block join, made by repeating the (packed) query
    blocks' numbers on the data side, and is dealt to its own task; each gives at most k rows
    for a query, and these lists are merged by a heap for each query.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    q = stash(_pack(pick(queries).groupBy("id").agg(F.min("v").alias("v")), query_block, "q").withColumn("qb", F.monotonically_increasing_id()), "ann-queries")
    d = stash(_pack(pick(vectors), data_block, "d").withColumn("db", F.monotonically_increasing_id()), "ann-data")
    # block numbers only: one for thousands of vectors
    tiles = q.select("qb", "dims").join(d.select("db", "dims"), "dims")
    pairs = (
        tiles.join(q.select("qb", F.col("ids").alias("q_ids"), F.col("matrix").alias("q")), "qb")
        .join(d.select("db", F.col("ids").alias("d_ids"), F.col("matrix").alias("d")), "db")
        .select("qb", "db", "dims", "q_ids", "q", "d_ids", "d")
        .repartition("qb", "db")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, qi, qm, di, dm in zip(*(b.column(x).to_pylist() for x in ("dims", "q_ids", "q", "d_ids", "d")), strict=True):
                a, v, s = tile(np.frombuffer(qi, "<i8"), np.frombuffer(qm).reshape(-1, n), np.frombuffer(di, "<i8"), np.frombuffer(dm).reshape(-1, n), k)
                yield pa.RecordBatch.from_pydict({"query_id": a, "vec_id": v, "score": s})

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score double")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One heap of k for the query at hand; rows come query by query."""
        now, heap, rows = None, [], []

        def done() -> None:
            rows.extend((now, i, -v, s) for i, (s, v) in enumerate(sorted(heap, key=lambda x: (-x[0], -x[1])), start=1))

        for b in batches:
            for query, v, s in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if query != now:
                    done()
                    now, heap = query, []
                if len(heap) < k:
                    heapq.heappush(heap, (s, -v))
                else:
                    heapq.heappushpop(heap, (s, -v))
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows.clear()
        done()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names, kinds = ["query_id", "rank", "vec_id", "score"], [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(merge, "query_id long, rank int, vec_id long, score double")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score of the 20 nearest others of every vector whose id is divisible
    by 20, among all rows of embeddings; see nearest() for vectors that take no part."""
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(v, v.where(F.col("vec_id") % 20 == 0))


OP6_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, list_inner_product(q.e, d.e) AS score
      FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
