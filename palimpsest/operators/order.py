"""Global order without a single task: dense ranks and running sums over range partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.runtime import discard, materialize

#: Rows a range partition holds on average.
ROWS_PER_RANGE = 1 << 20


def _ranged(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """`df` in ranges of (keys, order), each row with its range's number, written once.

    `df` itself is written first, by as many tasks as it has, so that neither counting nor
    drawing the ranges works it out again. The second table fixes the ranges, which sampling
    would draw anew on recomputation; rows of a single range need none.
    """
    rows = materialize(df, "rows")
    n = max(1, -(-rows.count() // ROWS_PER_RANGE))
    if n == 1:
        return rows.withColumn("_range", F.lit(0))
    held = materialize(rows.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()), "ranged")
    discard(rows)
    return held


def dense_rank_from_zero(df: DataFrame, order: list[Column], out: str = "ord", keys: list[str] | None = None) -> DataFrame:
    """Number rows from 0 in `order` within `keys`; ties must not matter.

    Rows are numbered inside a range and shifted by the ranges before it; only one row for
    each key and range is joined to them.
    """
    return _running(df, F.lit(1), order, out, keys or [], own=False)


def running_sum(df: DataFrame, value: Column, order: list[Column], out: str, keys: list[str] | None = None, own: bool = False) -> DataFrame:
    """The sum of `value` over the rows before each in `order` (with its own too if `own`)."""
    return _running(df, value, order, out, keys or [], own)


def _running(df: DataFrame, value: Column, order: list[Column], out: str, keys: list[str], own: bool) -> DataFrame:
    held = _ranged(df.withColumn("_value", value), keys, order)
    totals = held.groupBy(*keys, "_range").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_range").alias("_r"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    upto = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    match = F.col("_range") == F.col("_r")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = held.withColumn("_within", F.coalesce(F.sum("_value").over(upto), F.lit(0))).join(starts, match)
    return joined.withColumn(out, F.col("_start") + F.col("_within")).drop("_value", "_range", "_r", "_start", "_within", *(f"_k_{k}" for k in keys))
