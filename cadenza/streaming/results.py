"""Worker results that arrive as files, evaluated in batches as they come (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cadenza.operators.evaluate import WORKER_RESULTS, Quality, evaluate


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines files of worker result rows."""
    return spark.readStream.schema(WORKER_RESULTS).json(folder)


def evaluate_stream(results: DataFrame, out: str, checkpoint: str, q: Quality = Quality()) -> StreamingQuery:  # noqa: B008
    """Candidates of each batch, in a folder of the batch's number: a repeated batch replaces itself."""
    return results.writeStream.foreachBatch(lambda df, n: evaluate(df, q).write.mode("overwrite").parquet(f"{out}/batch={n}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
