"""Op 3: packing token pieces into fixed-length sequences by a distributed grouping genetic algorithm."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.batches import slices, texts
from palimpsest.llm.bpe import SLICE, encoder
from palimpsest.llm.grouping import Solution, best_fit, bins, dump, evolve, fitness, load, lower_bound
from palimpsest.llm.placement import gapless_rank
from palimpsest.runtime import materialize, ship

CAPACITY = 2048
#: Islands, epochs between which elites move on, and generations of an epoch.
ISLANDS, EPOCHS, GENERATIONS = 4, 3, 12


def token_pieces(docs: DataFrame, json_path: str, ranks_path: str | None = None, pattern: str | None = None, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids and the end id, cut into pieces: doc_id, piece, start, length, ids_crc32.

    Only a document above `capacity` is cut; all its pieces but the first have that length.
    """
    ship(docs.sparkSession)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(json_path, ranks_path, pattern)
        for b in slices(batches, limit=SLICE):
            counts, ids = enc.encode(texts(b))
            ends = np.cumsum(counts)
            closed = np.insert(ids.astype("<u4"), ends, np.uint32(end_id))
            data, total = closed.tobytes(), counts + 1
            begin = np.cumsum(total) - total
            head = (total - 1) % capacity + 1
            pieces = (total - head) // capacity + 1
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[row], capacity)
            first = (begin[row] + start) * 4
            crc = [zlib.crc32(data[f : f + 4 * n]) for f, n in zip(first.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return read.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _epoch(shared, counts: dict[int, int], capacity: int, bound: int, generations: int, epoch: int):
    """One epoch of the island that a task's one row names: its population comes out as rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for island in rows["id"].tolist():
                started = [load(s) for s in shared.value[island]]
                out = evolve(counts, capacity, started, generations, seed=epoch * 1009 + island, bound=bound)
                yield pd.DataFrame({"island": [island] * len(out), "rank": range(len(out)), "solution": [dump(s) for s in out]})

    return run


def pack_histogram(spark: SparkSession, counts: dict[int, int], capacity: int = CAPACITY, islands: int = ISLANDS, epochs: int = EPOCHS, generations: int = GENERATIONS) -> Solution:
    """The best packing of a histogram of sizes (at most `capacity` entries).

    Each island is a task of its own with its own population; after an epoch every island's
    elite moves to the next one. All islands live through one epoch at least; then a solution
    at the lower bound ends the search. What passes through the driver is a few populations,
    whose size depends on `capacity` alone.
    """
    if not counts:
        return {}
    ship(spark)
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    people = [[dump(best)] for _ in range(islands)]
    for epoch in range(epochs):
        shared = spark.sparkContext.broadcast(people)
        found = spark.range(0, islands, 1, islands).mapInPandas(_epoch(shared, counts, capacity, bound, generations, epoch), "island int, rank int, solution string").collect()
        shared.destroy()
        elite = {r["island"]: load(r["solution"]) for r in found if r["rank"] == 0}
        best = max([best, *elite.values()], key=lambda s: fitness(s, capacity))
        if bins(best) <= bound:
            break
        people = [[r["solution"] for r in found if r["island"] == i] + [dump(elite[(i - 1) % islands])] for i in range(islands)]
    return best


def _slots(solution: Solution) -> tuple[np.ndarray, ...]:
    """Where the k-th item of a size goes: runs (key, first bin, copies in a bin, first offset)."""
    used: dict[int, int] = {}
    rows, bin_ = [], 0
    for pattern, n in sorted(solution.items()):
        at = 0
        for size, copies in pattern:
            rows.append(((size << 40) + used.get(size, 0), bin_, copies, at))
            used[size] = used.get(size, 0) + copies * n
            at += size * copies
        bin_ += n
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(4))


def pack(pieces: DataFrame, capacity: int = CAPACITY, **search: int) -> DataFrame:
    """Add sequence_id and offset to pieces of at most `capacity` tokens, as few sequences as found.

    A full piece is a sequence of its own; the others go where the packing of their
    histogram puts the k-th piece of a length, k being its gapless rank. `pieces` is read
    more than once: pass a materialized table with a unique number `_row` for each row.
    """
    spark = pieces.sparkSession
    ship(spark)
    sizes = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    solution = pack_histogram(spark, {s: n for s, n in sizes.items() if s < capacity}, capacity, **search)
    shared = spark.sparkContext.broadcast((_slots(solution), bins(solution)))
    ranked = gapless_rank(pieces, ["length"], ["doc_id", "piece", "ids_crc32", "_row"], "_rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (key, first, copies, at), used = shared.value
        for b in batches:
            size = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("_rank").to_numpy(zero_copy_only=False)
            where, offset = used + rank, np.zeros(len(size), np.int64)
            part = size < capacity
            if part.any():
                want = (size[part] << 40) + rank[part]
                run_ = np.searchsorted(key, want, side="right") - 1
                into = want - key[run_]
                where[part] = first[run_] + into // copies[run_]
                offset[part] = at[run_] + into % copies[run_] * size[part]
            names = [n for n in b.schema.names if n not in ("_rank", "_row")]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(where, pa.int64()), pa.array(offset, pa.int64())], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name not in ("_rank", "_row"))
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str | None = None, pattern: str | None = None, capacity: int = CAPACITY, **search: int) -> DataFrame:
    """Tokenize, cut and pack all documents; one row for each piece.

    Null and empty texts are one piece of the end id alone; repeated rows and ids are packed
    like others; an empty table gives an empty result; other columns are not read.
    """
    pieces = token_pieces(docs, json_path, ranks_path, pattern, capacity)
    pieces = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()), "op3-pieces")
    return pack(pieces, capacity, **search)
