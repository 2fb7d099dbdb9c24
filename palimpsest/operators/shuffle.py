"""Reproducible document shuffles: a native one, and one that follows numpy's streams exactly."""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.order import dense_rank_from_zero
from palimpsest.runtime import ship

GIB = 1 << 30


def choose_buckets(disk_bytes: int, mem_bytes: int | None = None, inflate: float = 4.0, cap: int = 256 * GIB) -> int:
    """Buckets such that two of them in memory take about half of it; 16 at least."""
    return max(16, math.ceil(2.0 * disk_bytes * inflate / (0.55 * min(mem_bytes or cap, cap))))


def bucket_count(disk_bytes: Column, inflate: float = 4.0, cap: int = 256 * GIB) -> Column:
    """`choose_buckets` for a column of sizes."""
    return F.greatest(F.lit(16), F.ceil(F.lit(2.0) * disk_bytes * F.lit(inflate) / F.lit(0.55 * cap))).cast("long")


def shuffle_native(rows: DataFrame, rows_per_file: int, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Add pos, file_no and row_in_file: rows in the order of a keyed digest of their id.

    The order is a function of ids and seed alone, whatever the partitioning; every file but
    the last has `rows_per_file` rows.
    """
    keyed = rows.withColumn("_key", F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))))
    placed = dense_rank_from_zero(keyed, [F.col("_key"), F.col(id_col)], "pos").drop("_key")
    return placed.withColumn("file_no", F.floor(F.col("pos") / rows_per_file).cast("int")).withColumn("row_in_file", F.col("pos") % rows_per_file)


def scatter(order: DataFrame, buckets: int, seed: int = 42) -> DataFrame:
    """Add `bucket` to rows with shard_index and row_in_shard, as one stream over all shards draws it.

    The stream is sequential, so the driver steps it through the shards' row counts (one
    small row a shard) and keeps its state before each; tasks then draw their own shards.
    """
    ship(order.sparkSession)
    rng, states = np.random.default_rng(seed), []
    for r in order.groupBy("shard_index").agg(F.count(F.lit(1)).alias("n")).orderBy("shard_index").toLocalIterator():
        states.append((r["shard_index"], pickle.dumps(rng.bit_generator.state)))
        rng.integers(0, buckets, size=r["n"])
    known = order.sparkSession.createDataFrame(states, "shard_index int, state binary")

    def draw(part: pd.DataFrame) -> pd.DataFrame:
        own = np.random.default_rng()
        own.bit_generator.state = pickle.loads(part["state"].iloc[0])
        drawn = own.integers(0, buckets, size=len(part))
        return part.assign(bucket=drawn[part["row_in_shard"].to_numpy()].astype("int32"))[["doc_id", "shard_index", "row_in_shard", "bucket"]]

    narrow = order.select("doc_id", "shard_index", "row_in_shard").join(known, "shard_index")
    return narrow.groupBy("shard_index").applyInPandas(draw, "doc_id long, shard_index int, row_in_shard long, bucket int")


def shuffle_parity(order: DataFrame, buckets: int, rows_per_file: int, seed: int = 42) -> DataFrame:
    """doc_id, bucket, pos, file_no, row_in_file in exactly the order of numpy's two passes.

    Rows are scattered, permuted inside their bucket by default_rng([seed, bucket]), and
    buckets follow one another; cutting that sequence at `rows_per_file` is what carrying
    a rest from bucket to bucket amounts to. Buckets are sized to fit a task's memory.
    """
    scattered = scatter(order, buckets, seed)

    def permute(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["shard_index", "row_in_shard"])
        taken = part.iloc[np.random.default_rng([seed, int(part["bucket"].iloc[0])]).permutation(len(part))]
        return taken.assign(place=np.arange(len(part)))[["doc_id", "bucket", "place"]]

    placed = scattered.groupBy("bucket").applyInPandas(permute, "doc_id long, bucket int, place long")
    before = Window.partitionBy(F.lit(1)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select(F.col("bucket").alias("_b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    out = placed.join(starts, F.col("bucket") == F.col("_b")).withColumn("pos", F.col("_start") + F.col("place"))
    return out.select("doc_id", "bucket", "pos", F.floor(F.col("pos") / rows_per_file).cast("int").alias("file_no"), (F.col("pos") % rows_per_file).alias("row_in_file"))


def check_permutation(before: DataFrame, after: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row: rows before and after, and whether the ids are the same ones as often."""
    both = before.select(F.lit(1).alias("_side"), id_col).unionByName(after.select(F.lit(-1).alias("_side"), id_col))
    digest = F.coalesce(F.sum(F.col("_side") * F.xxhash64(id_col).cast("decimal(38,0)")), F.lit(0))
    out = both.agg(F.count_if(F.col("_side") == 1).alias("n_before"), F.count_if(F.col("_side") == -1).alias("n_after"), digest.alias("_digest"))
    return out.select("n_before", "n_after", ((F.col("n_before") == F.col("n_after")) & (F.col("_digest") == 0)).alias("conserved"))
