"""Incremental rewriting: new shard files are picked up, generated and trimmed as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def follow_shards(spark: SparkSession, path: str, schema: StructType, job: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 64) -> StreamingQuery:
    """Run `job` over shard files that the checkpoint hasn't seen, once each, then stop.

    The checkpoint stands in for claims and completion markers: a batch is committed after
    its output, and one that failed is run again over the same files, replacing what it wrote.
    """

    def batch(df: DataFrame, number: int) -> None:
        job(df).write.mode("overwrite").option("compression", "zstd").parquet(f"{out.rstrip('/')}/batch={number}")

    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(path)
    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
