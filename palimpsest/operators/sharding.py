"""Cutting an ordered corpus into row- and byte-capped shards, manifests and identity hashes."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.text import text_bytes, text_sha1
from palimpsest.operators.order import dense_rank_from_zero
from palimpsest.runtime import materialize, ship

#: Rows of a block of the parallel fold; never fewer than a shard may have.
BLOCK_ROWS = 1 << 20
#: Ids are the dataset's own or a running row index; recorded in every fingerprint.
DOC_ID_POLICY = "dataset_doc_id_or_row_index"


def ordered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, source_text_sha1, text_bytes and the 0-based order `ord`; the text itself stays behind.

    Documents that have an `ord` of their own, as `corpus.scan_order` gives it, keep it; others
    are ordered by id and digest. Without an id column the order is the id.
    """
    given = "ord" in docs.columns
    if id_col not in docs.columns and not given:
        raise ValueError(f"no column {id_col!r}, and no scan order to take its place")
    id_ = F.col(id_col if id_col in docs.columns else "ord").cast("long").alias("doc_id")
    narrow = docs.select(id_, text_sha1(F.col(text_col)).alias("source_text_sha1"), text_bytes(F.col(text_col)).alias("text_bytes"), *(["ord"] if given else []))
    return narrow if given else dense_rank_from_zero(narrow, [F.col("doc_id"), F.col("source_text_sha1")])


def _next(total: np.ndarray, rows: int, size: int) -> np.ndarray:
    """For each position, where the next shard begins if one begins there.

    `total` holds the bytes before each position and after the last. A shard closes at its
    `rows`-th row or at the first row that brings it to `size` bytes; beyond the end of
    what is known, the answer is past it.
    """
    n = len(total) - 1
    return np.minimum(np.arange(n) + rows, np.searchsorted(total[1:], total[:-1] + size) + 1)


def _arrive(nxt: np.ndarray) -> np.ndarray:
    """For each position, the last shard start reached from it, by pointer doubling."""
    n = len(nxt)
    at = np.where(nxt < n, nxt, np.arange(n))
    while True:
        further = at[at]
        if (further == at).all():
            return at
        at = further


def _block_map(rows: int, size: int, block_rows: int):
    """A block as a function of the open shard's start: where the shard open at its end began.

    Beside each possible start stand the bytes from it to the block.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("ord")
        block = int(part["block"].iloc[0])
        start = int(part["ord"].iloc[0])
        halo = block * block_rows - start
        total = np.concatenate(([0], np.cumsum(part["text_bytes"].to_numpy())))
        nxt = _next(total, rows, size)
        last = _arrive(nxt)
        # A shard that would begin exactly behind the block begins there.
        ends = np.where(nxt[last] == len(nxt), len(nxt), last)
        return pd.DataFrame({"block": [block], "start": [start], "table": [(start + ends[: halo + 1]).tolist()], "held": [(total[halo] - total[: halo + 1]).tolist()]})

    return run


def _span_map(part: pd.DataFrame) -> pd.DataFrame:
    """A span of blocks as one function, of the same kind as a block's: its tables, one after another."""
    part = part.sort_values("block")
    reached = np.arange(len(part["table"].iloc[0])) + int(part["start"].iloc[0])
    for start, table in zip(part["start"], part["table"]):
        reached = np.asarray(table)[reached - int(start)]
    return pd.DataFrame({"span": [int(part["span"].iloc[0])], "start": [int(part["start"].iloc[0])], "table": [reached.tolist()]})


def _compose(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Follow the one path that begins at 0 through the spans' tables, in order."""
    at = 0
    for part in parts:
        entries = []
        for start, table in zip(part["start"], part["table"]):
            entries.append(at)
            at = int(table[at - start])
        yield pd.DataFrame({"span": part["span"], "entry": entries})


def _follow(part: pd.DataFrame) -> pd.DataFrame:
    """Follow a span's own path from where it is entered through its blocks."""
    part = part.sort_values("block")
    at, entries, held = int(part["entry"].iloc[0]), [], []
    for start, table, before in zip(part["start"], part["table"], part["held"]):
        entries.append(at)
        held.append(int(before[at - start]))
        at = int(table[at - start])
    return pd.DataFrame({"block": part["block"], "entry": entries, "held": held})


def _assign(rows: int, size: int):
    """Rows of a block with the number, within it, of their shard and their place in that."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("ord")
        n, first = len(part), int(part["ord"].iloc[0])
        entry, held = int(part["entry"].iloc[0]), int(part["held"].iloc[0])
        total = np.concatenate(([0], np.cumsum(part["text_bytes"].to_numpy())))
        starts = [entry]
        if entry < first:
            at = min(entry + rows - first, int(np.searchsorted(total[1:], size - held)) + 1)
        else:
            starts, at = [], 0
        nxt = _next(total, rows, size)
        while at < n:
            starts.append(first + at)
            at = int(nxt[at])
        starts = np.array(starts)
        local = np.searchsorted(starts, part["ord"].to_numpy(), side="right") - 1
        return part.assign(local=local.astype("int32"), row_in_shard=part["ord"].to_numpy() - starts[local]).drop(columns=["entry", "held"])

    return run


def cut(order: DataFrame, target_rows: int, target_bytes: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add shard_index and row_in_shard to rows with `ord` and `text_bytes`.

    Rows go in order into the open shard, which closes once it has `target_rows` rows or
    `target_bytes` bytes, checked after adding. Without a byte cap that is a division. With
    one it is a fold whose state resets, run in parallel: a shard has at most `target_rows`
    rows, so a block of rows is a function on the at most `target_rows` places where the
    shard open at its beginning can have begun. Blocks work out that table; such functions
    compose, so spans of blocks, as many as a span has blocks, become one function each; one
    task follows the path through the spans, spans follow it through their blocks, and blocks
    then number their shards. Of n blocks no task sees more than the tables of sqrt(n). A
    corpus of one block needs no tables.
    """
    if target_bytes is None:
        return order.withColumn("shard_index", F.floor(F.col("ord") / target_rows).cast("int")).withColumn("row_in_shard", F.col("ord") % target_rows)
    spark = order.sparkSession
    ship(spark)
    columns = order.columns
    block_rows = max(block_rows, target_rows)
    order = materialize(order.withColumn("block", F.floor(F.col("ord") / block_rows).cast("long")), "order")
    if order.count() <= block_rows:
        entered = order.withColumn("entry", F.lit(0).cast("long")).withColumn("held", F.lit(0).cast("long"))
    else:
        sizes = order.select("ord", "text_bytes", "block")
        ahead = sizes.filter(F.col("ord") % block_rows >= block_rows - target_rows).withColumn("block", F.col("block") + 1)
        halves = sizes.unionByName(ahead.join(sizes.select("block").distinct(), "block", "left_semi"))
        tables = halves.groupBy("block").applyInPandas(_block_map(target_rows, target_bytes, block_rows), "block long, start long, table array<long>, held array<long>")
        n_blocks = -(-order.count() // block_rows)
        tables = materialize(tables.withColumn("span", F.floor(F.col("block") / math.isqrt(n_blocks)).cast("long")), "tables")
        spans = tables.groupBy("span").applyInPandas(_span_map, "span long, start long, table array<long>")
        first = spans.repartition(1).sortWithinPartitions("span").mapInPandas(_compose, "span long, entry long")
        entries = tables.join(materialize(first, "spans"), "span").groupBy("span").applyInPandas(_follow, "block long, entry long, held long")
        entered = order.join(materialize(entries, "entries"), "block")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in order.schema)
    numbered = materialize(entered.groupBy("block").applyInPandas(_assign(target_rows, target_bytes), f"{schema}, local int, row_in_shard long"), "numbered")
    # Shards that begin in the blocks before, less the one that was already open.
    per = numbered.groupBy("block").agg(F.count_if(F.col("row_in_shard") == 0).alias("begun"), F.max_by("row_in_shard", -F.col("ord")).alias("first"))
    before = Window.partitionBy(F.lit(1)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(F.col("block").alias("_b"), (F.coalesce(F.sum("begun").over(before), F.lit(0)) - F.when(F.col("first") > 0, 1).otherwise(0)).alias("_base"))
    placed = numbered.join(base, F.col("block") == F.col("_b"))
    return placed.select(*columns, (F.col("_base") + F.col("local")).cast("int").alias("shard_index"), "row_in_shard")


def shard_path(shard: Column) -> Column:
    """Where `corpus.write_shards` puts a shard, under its root."""
    return F.format_string("shard_index=%d", shard)


def shard_manifest(sharded: DataFrame) -> DataFrame:
    """shard_index, n_rows, text_bytes, first_doc_id, last_doc_id, path."""
    return (
        sharded.groupBy("shard_index")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("text_bytes").alias("text_bytes"), F.min_by("doc_id", "ord").alias("first_doc_id"), F.max_by("doc_id", "ord").alias("last_doc_id"))
        .withColumn("path", shard_path(F.col("shard_index")))
    )


#: Digests joined inside one group before their hash goes on: bounds any one string to 40 MB.
DIGESTS_PER_STEP = 1_000_000


def content_sha1(order: DataFrame) -> str:
    """SHA-1 over all hex digests in scan order, streamed through the driver in bounded steps.

    A running SHA-1 is sequential by definition; executors join a step's digests into one
    string, and the driver holds one step at a time.
    """
    steps = (
        order.groupBy(F.floor(F.col("ord") / DIGESTS_PER_STEP).alias("step"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "source_text_sha1"))), lambda x: x["source_text_sha1"]), "").alias("digests"))
        .orderBy("step")
    )
    running = hashlib.sha1()
    for row in steps.toLocalIterator():
        running.update(row["digests"].encode())
    return running.hexdigest()


def fingerprint(content: str, target_rows: int, target_bytes: int, doc_id_source: str, keys: list[str]) -> str:
    """Identity of a sharding: content, caps, id policy and output columns in order."""
    return hashlib.sha1("|".join([content, str(target_rows), str(target_bytes), DOC_ID_POLICY, doc_id_source, ",".join(keys)]).encode()).hexdigest()


def manifest(sharded: DataFrame, arm: str, target_rows: int, target_bytes: int, keys: list[str], doc_id_source: str = "dataset") -> DataFrame:
    """One row: totals, identity hashes and the array of shards."""
    shards = shard_manifest(sharded)
    content = content_sha1(sharded)
    listed = F.array_sort(F.collect_list(F.struct(F.col("shard_index").alias("index"), "path", "n_rows", "text_bytes")))
    return shards.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"), F.coalesce(F.sum("text_bytes"), F.lit(0)).alias("total_text_bytes"), F.count(F.lit(1)).alias("n_shards"), listed.alias("shards")).select(
        F.lit(arm).alias("arm"), "total_rows", "total_text_bytes", F.lit(content).alias("content_sha1"), F.lit(fingerprint(content, target_rows, target_bytes, doc_id_source, keys)).alias("fingerprint"), "n_shards", "shards", F.lit(DOC_ID_POLICY).alias("doc_id_policy"), F.lit(doc_id_source).alias("doc_id_source")
    )


def check_shard_count(n_shards: int, total_rows: int, gpus: int, min_ratio: int = 20) -> int | None:
    """None if there are at least `min_ratio` shards for each GPU, else the rows a shard should have."""
    need = min_ratio * gpus
    return None if n_shards >= need else max(200, total_rows // need // 100 * 100)
