"""Helpers shared by the corpus operators: the shared scratch folder, written
intermediate tables, Arrow batch mapping and distributed connected components."""

from __future__ import annotations

import gc
import os
import sys
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch handed to Python; long texts make larger batches a memory risk.
BATCH_ROWS = 256
#: The six ASCII white space characters that separate words in several contracts.
WORD_SPLIT = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver share: ``spark.checkpoint.dir``.

    Only where that is unset (tests on one machine) a folder of the machine is used.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    return (found or os.path.join(tempfile.gettempdir(), "checkpoints")).rstrip("/") + "/cadenza"


def stash(df: DataFrame, tag: str, compression: str = "snappy", dictionary: bool = True) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: this cuts the
    lineage, and the rows survive the loss of any executor. Many columns of hashes are read
    faster without dictionaries, which hold each value once and are looked up out of order."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).option("parquet.enable.dictionary", str(dictionary).lower()).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stash_path = path
    return out


def unstash(*frames: DataFrame) -> None:
    """Delete tables made by stash() that nothing lazy reads any more."""
    for df in frames:
        path = getattr(df, "stash_path", None)
        if path:
            jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner see that finished shuffles are no longer used, so their files go.

    py4j detaches what Python has dropped from a thread of its own, up to a second later;
    until then the JVM's collector finds the frames and their shuffles in use.
    """
    gc.collect()
    waiting, until = getattr(spark._jvm._gateway_client, "finalizer_deque", None), time.monotonic() + 5
    while waiting and time.monotonic() < until:
        time.sleep(0.05)
    time.sleep(0.05)  # for the one last taken from the queue
    spark.range(1).count()  # the scheduler was seen to hold the last query's shuffles until another one ran
    spark._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def one_file_shuffles(spark: SparkSession) -> None:
    """Let every task of a shuffle write one file, which Spark does only for more partitions than
    this threshold: up to it a task opens a file and a compressor for each partition, and for the
    rows of one task that costs more than the rows. Small numbers of partitions stay as they are."""
    most = int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    if most // 2 < int(spark.conf.get("spark.sql.shuffle.partitions")) <= most:
        spark.conf.set("spark.sql.shuffle.partitions", str(most + 1))


def map_rows(df: DataFrame, schema: str, fn: Callable[[dict[str, list]], dict[str, object]]) -> DataFrame:
    """mapInArrow over column lists: fn gets and returns a dict of columns of one batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    small_batches(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn({n: b.column(i) for i, n in enumerate(b.schema.names)})
                yield pa.RecordBatch.from_arrays([_array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def process_memory(name: str) -> dict:
    """A dict that lives as long as the Python worker, which serves many tasks: code is sent
    to workers by value, so globals of these modules begin anew with every task. What another
    name has kept is dropped: a worker runs one operator's tasks at a time."""
    held = vars(sys.modules["pyspark"]).setdefault("_cadenza_memory", {})
    if name not in held:
        held.clear()
    return held.setdefault(name, {})


def bit_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit for the lowest bits (``bits`` a power of two) of each key (a column ``key``), as
    numbers of 64 bits: a fixed size, whatever the number of keys."""
    place = F.col("key").bitwiseAND(F.lit(bits - 1))
    marks = keys.groupBy(F.shiftright(place, 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 AS int))")).alias("m")).toArrow()  # at most bits / 64 rows
    out = np.zeros(bits // 64, np.uint64)
    out[marks.column("i").to_numpy()] = marks.column("m").to_numpy().view(np.uint64)
    return out


def may_hold(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the keys; False is certain."""
    place = keys & np.uint64(64 * len(known) - 1)
    return known[(place >> np.uint64(6)).view(np.int64)] >> (place & np.uint64(63)) & np.uint64(1) == 1


def lower_ascii(col):
    """A-Z only, as the contracts ask; lower() would change other letters too."""
    return F.translate(col, UPPER, LOWER)


def connected_components(edges: DataFrame, tag: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Distributed union-find over edges (u, v: long): (node, root) for every node that has
    an edge to another one, root the smallest node of its component.

    Alternates large-star and small-star rounds until the edge set is a forest of stars.
    Each round is a written table; only a count and a checksum come to the driver. Nulls
    and loops are ignored. An empty edge table gives an empty result.
    """
    u, v = F.col("u"), F.col("v")

    def tidy(df: DataFrame) -> DataFrame:
        return df.where(u != v).distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())

    now = stash(tidy(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), f"{tag}-0")
    seen = mark(now)
    for i in range(1, max_rounds):
        if not seen[0]:
            break
        both = now.select("u", "v").union(now.select(v, u))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = tidy(both.join(least, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        then = stash(tidy(small.union(low.select("u", F.col("m").alias("v")))), f"{tag}-{i}")
        was, seen = seen, mark(then)
        unstash(now)
        now = then
        if was == seen:
            break
    else:
        raise RuntimeError("connected components did not settle")
    stars = now.select(u.alias("node"), v.alias("root"))
    return stars.union(now.select(v.alias("node"), v.alias("root")).distinct())
