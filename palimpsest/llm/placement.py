"""Gapless ranks without a single large window, shared by sharding and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.runtime import materialize

#: Rows one window partition holds on average.
ROWS_PER_BLOCK = 1 << 10


def gapless_rank(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Number the rows of each key (none null) from 0 without gaps.

    A key's rows are salted by a hash of `order` over as many blocks as their number asks
    for, numbered within a block, and shifted by the rows of the blocks before it. So a key
    with a third of all rows takes as many tasks as it has blocks, and the offsets have a
    row for each key and each further ROWS_PER_BLOCK rows. `order` must tell all rows apart,
    else repeats of one row share a block. `df` is read three times: pass a materialized table.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    blocks = materialize(counts.select(*keys, F.ceil(F.col("_rows") / ROWS_PER_BLOCK).alias("_blocks")), "rank-blocks")
    salted = df.join(blocks, keys).withColumn("_block", F.pmod(F.xxhash64(*order), F.col("_blocks"))).drop("_blocks")
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = salted.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows")).select(*keys, "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, "_block").orderBy(*order)
    ranked = salted.withColumn("_in_block", F.row_number().over(within) - 1).join(materialize(starts, "rank-starts"), [*keys, "_block"])
    return ranked.withColumn(out, (F.col("_start") + F.col("_in_block")).cast("long")).drop("_block", "_start", "_in_block")
