"""Op 10: shards of near-equal bytes, equal texts kept together, by best-fit-decreasing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.bestfit import near_equal
from palimpsest.llm.placement import gapless_rank
from palimpsest.runtime import discard, materialize


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Place every row in one of `n_shards` shards of near-equal bytes.

    A row's size is its text's UTF-8 bytes plus 1. Rows of equal text (64-bit hash) are one
    indivisible group. Best-fit-decreasing asks for the groups' sizes alone, so the driver
    packs their histogram: groups of one size are alike, and which of them goes where follows
    from their gapless rank. Of T bytes there are at most sqrt(2 T) distinct sizes, as they
    add up to no more than T. Only sizes that more than one shard took are ranked. Only
    sizes, hashes and ids are shuffled; a group with a third of all rows is a plain side of
    its join, which Spark splits.

    Null texts count as empty; rows with a null or repeated id are placed like any other;
    an empty table gives an empty result; further columns are not read.
    Returns id, size, text_crc32, law, shard, slot (gapless from 0), grown_shard (null).
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_group"), F.monotonically_increasing_id().alias("_row")
        ),
        "op10-sized",
    )
    groups = materialize(sized.groupBy("_group").agg(F.sum("size").alias("bytes")), "op10-groups")
    histogram = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).toArrow()
    plan = near_equal(zip(histogram.column("bytes").to_pylist(), histogram.column("n").to_pylist()), n_shards)
    rows = []
    for size, runs in plan:
        upto, edges = 0, []
        for _, n in runs:
            upto += n
            edges.append(upto)
        rows.append((size, edges, [b for b, _ in runs]))
    planned = materialize(spark.createDataFrame(rows, "bytes long, edges array<long>, shards array<int>"), "op10-plan")
    whole = groups.join(planned.filter(F.size("shards") == 1), "bytes").select("_group", F.col("shards")[0].alias("shard"))
    divided = materialize(groups.join(planned.filter(F.size("shards") > 1), "bytes"), "op10-divided")
    ranked = gapless_rank(divided, ["bytes"], ["_group"], "_rank")
    parted = ranked.select("_group", F.get("shards", F.size(F.filter("edges", lambda e: e <= F.col("_rank")))).alias("shard"))
    where = materialize(whole.union(parted), "op10-where")
    placed = materialize(sized.join(where, "_group").select("doc_id", "size", "text_crc32", "_row", "shard"), "op10-placed")
    discard(sized, groups, planned, divided, where)
    slotted = gapless_rank(placed, ["shard"], ["doc_id", "text_crc32", "size", "_row"], "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
