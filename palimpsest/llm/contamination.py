"""Op 7: benchmark decontamination by Wu-Manber multi-pattern search."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.batches import lut, slices, texts
from palimpsest.runtime import discard, materialize, ship

#: Consecutive words of an item that count as a passage of it.
WINDOW = 13
#: Benchmark text searched for in one pass; a larger benchmark takes several passes.
PASS_BYTES = 2 << 20
#: Windows of a long item that travel in one row.
CHUNK_WINDOWS = 4096
#: Slots of a shift table, bytes of a block, positions a lane of the scan covers.
SLOTS, BLOCK, LANE = 1 << 20, 8, 2048

#: Word bytes after lower-casing: 0-9, a-z and all of a character beyond ASCII.
WORD = lut(*range(48, 58), *range(97, 123), *range(128, 256))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def normalize(array: pa.Array) -> np.ndarray:
    """All texts as lower-case words, a space after each, and byte 1 after each text."""
    if not len(array):
        return np.zeros(0, np.uint8)
    ended = pc.binary_join_element_wise(array.cast(pa.large_string()), pa.scalar("\x01\x01", pa.large_string()), pa.scalar("", pa.large_string()))
    offsets = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset : ended.offset + len(ended) + 1]
    data = LOWER[np.frombuffer(ended.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    word = WORD[data]
    keep = word.copy()
    keep[1:] |= word[:-1]
    ends = offsets[1:] - offsets[0] - 1
    keep[ends] = True
    out = np.where(word, data, np.uint8(32))
    out[ends] = 1
    return out[keep]


def _blocks(data: np.ndarray, width: int) -> tuple[np.ndarray, np.uint64]:
    """A view that reads 8 bytes at any position of `data` (padded by 8), and a mask of `width`."""
    return np.ndarray(len(data) - 7, np.dtype("<u8"), data.data, 0, (1,)), np.uint64((1 << (8 * width)) - 1)


def _slot(block: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((block * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def passages(items: list[tuple[object, str | None]]) -> dict[bytes, tuple[int, set[str]]]:
    """Each distinct passage as normal bytes: its words and the items that hold it."""
    out: dict[bytes, tuple[int, set[str]]] = {}
    for key, text in items:
        words = bytes(normalize(pa.array([text or ""]))[:-1]).split()
        for i in range(max(1, len(words) - WINDOW + 1) if words else 0):
            own = words[i : i + WINDOW]
            _, held = out.setdefault(b" ".join(own) + b" ", (len(own), set()))
            if key is not None:
                held.add(str(key))
    return out


class Tier:
    """Shift and suffix-hash tables for passages of similar length."""

    def __init__(self, found: list[tuple[bytes, int, tuple[str, ...]]]) -> None:
        self.m = min(len(p) for p, _, _ in found)
        self.width = min(BLOCK, max(1, self.m // 2)) if self.m < 2 * BLOCK else BLOCK
        self.text = np.frombuffer(b"".join(p for p, _, _ in found) + b"\x01" * 8, np.uint8).copy()
        self.length = np.array([len(p) for p, _, _ in found])
        self.start = np.concatenate(([0], np.cumsum(self.length)[:-1]))
        self.words = np.array([w for _, w, _ in found])
        self.items = [i for _, _, i in found]
        read, mask = _blocks(self.text, self.width)
        far = self.m - self.width
        self.shift = np.full(SLOTS, far + 1, np.int32)
        for j in range(far + 1):  # later positions ask for smaller shifts
            self.shift[_slot(read[self.start + j] & mask)] = far - j
        last = _slot(read[self.start + far] & mask)
        self.order = np.argsort(last, kind="stable")
        self.last = last[self.order]

    def search(self, data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and passage of every occurrence in `data` (n bytes, then padding).

        Lanes of LANE start positions advance together, each by the shift of the block that
        ends its window; a shift of 0 nominates the passages of the block's bucket.
        """
        read, mask = _blocks(data, self.width)
        far = self.m - self.width
        at = np.arange(0, n, LANE)
        end = np.minimum(at + LANE, n - self.m + 1)
        hits = []
        at, end = at[at < end], end[at < end]
        while len(at):
            slot = _slot(read[at + far] & mask)
            shift = self.shift[slot]
            hits.append(np.stack([at[shift == 0], slot[shift == 0]]))
            at = at + np.maximum(shift, 1)
            on = at < end
            at, end = at[on], end[on]
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start, slot = np.concatenate(hits, axis=1)
        start, slot = self._at_word(data, start, slot)
        lo, hi = np.searchsorted(self.last, slot), np.searchsorted(self.last, slot, side="right")
        many = hi - lo
        first = np.cumsum(many) - many
        which = self.order[np.repeat(lo - first, many) + np.arange(many.sum())]
        start = np.repeat(start, many)
        # Whole 8-byte pieces first, then the bytes themselves.
        own, _ = _blocks(self.text, BLOCK)
        there, _ = _blocks(data, BLOCK)
        fits = start + self.length[which] <= n
        start, which = start[fits], which[fits]
        if self.m >= BLOCK:
            fits = there[start] == own[self.start[which]]
            start, which = start[fits], which[fits]
        depth = BLOCK
        while len(start) and depth + BLOCK <= self.m:
            fits = there[start + depth] == own[self.start[which] + depth]
            start, which, depth = start[fits], which[fits], depth + BLOCK
        text, body = self.text.tobytes(), data.tobytes() if len(start) else b""
        same = [body[s : s + k] == text[p : p + k] for s, p, k in zip(start.tolist(), self.start[which].tolist(), self.length[which].tolist())]
        same = np.array(same, bool)
        return start[same], which[same]

    @staticmethod
    def _at_word(data: np.ndarray, start: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        good = (start == 0) | ~WORD[data[start - 1]]
        return start[good], slot[good]


def build(found: dict[bytes, tuple[int, set[str]]]) -> list[Tier]:
    """Tables by length, so that one short passage doesn't shorten every shift."""
    tiers: dict[int, list[tuple[bytes, int, tuple[str, ...]]]] = {}
    for p, (n, items) in sorted(found.items()):
        tiers.setdefault(0 if len(p) >= 40 else 1 if len(p) >= 16 else 2 if len(p) >= 6 else 3, []).append((p, n, tuple(sorted(items))))
    return [Tier(tiers[k]) for k in sorted(tiers)]


def scan(array: pa.Array, tiers: list[Tier]) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Per text: words; per word of all texts: hit or not; per text: items that occur."""
    n = len(array)
    data = normalize(array)
    size = len(data)
    data = np.concatenate((data, np.ones(64, np.uint8)))
    word = WORD[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    index = np.cumsum(begins) - 1  # of the word that starts or holds each byte
    ends = np.flatnonzero(data[:size] == 1)
    upto = index[ends] + 1 if n else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate(([0], upto)))
    total = int(upto[-1]) if n else 0
    edge, items = np.zeros(total + 1, np.int64), [set() for _ in range(n)]
    for tier in tiers:
        start, which = tier.search(data, size)
        first = index[start]
        np.add.at(edge, first, 1)
        np.add.at(edge, first + tier.words[which], -1)
        doc = np.searchsorted(ends, start)
        for d, p in set(zip(doc.tolist(), which.tolist())):
            items[d].update(tier.items[p])
    return counts, np.cumsum(edge[:total]) > 0, items


def item_chunks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words): the items as normal words, long ones in chunks that share no window.

    Every window of an item is whole in exactly one chunk; a chunk has CHUNK_WINDOWS windows at
    most, so no row outgrows what one pass may hold.
    """
    ship(benchmark.sparkSession)
    read = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            item, out = [], []
            for key, body in zip(b.column("item").to_pylist(), bytes(normalize(texts(b))).split(b"\x01")):
                words = body.split()
                for i in range(0, max(1, len(words) - WINDOW + 1) if words else 0, CHUNK_WINDOWS):
                    item.append(key)
                    out.append(b" ".join(words[i : i + CHUNK_WINDOWS + WINDOW - 1]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(out, pa.string())], ["item", "words"])

    return read.mapInArrow(run, "item string, words string")


def benchmark_passes(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", limit: int = PASS_BYTES) -> Iterator[list[tuple[str | None, str]]]:
    """The benchmark's chunks in groups of about `limit` bytes, by a hash; one group at a time is on the driver."""
    chunks = item_chunks(benchmark, item_col, text_col)
    total = chunks.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    groups = max(1, -(-total // limit))
    at = F.pmod(F.xxhash64("words"), F.lit(groups))
    for g in range(groups):
        yield [(r[0], r[1]) for r in chunks.filter(at == g).collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, columns: list[str], text_col: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """`columns` of `docs`, n_words, n_hit, n_items, items_sha256, contaminated, longest_hit, item_ids for every row.

    `longest_hit` is the longest run of hit words. A benchmark of up to `pass_bytes` is
    searched for in one narrow pass, its tables broadcast; a larger one takes a pass for each
    such part, with a written table in between that carries a bit for each word, so neither
    tables nor what the driver holds outgrow their bound. Null and empty texts have no words
    and are clean; items without words hold no passage; an item with a null id marks words
    but is not named; repeated rows are judged alike; an empty table gives an empty result;
    columns that aren't asked for are not read.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    read = docs.select(*columns, F.col(text_col).alias("_text_read"))
    kept = [f for f in read.schema if f.name != "_text_read"]
    middle = T.StructType(list(read.schema) + [T.StructField("_hits", T.BinaryType()), T.StructField("_found", T.ArrayType(T.StringType()))])
    final = T.StructType(kept + [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()), T.StructField("longest_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType()))])
    passes, resumed = benchmark_passes(benchmark, limit=pass_bytes), False
    items, after = next(passes), next(passes, None)
    while True:
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, passages(items)))
        last = after is None
        found = read.mapInArrow(_pass(shared, [f.name for f in kept], resumed, last), final if last else middle)
        if last:
            return found
        before, read, resumed = read if resumed else None, materialize(found, "op7-pass"), True
        if before is not None:
            discard(before)
        items, after = after, next(passes, None)


def longest_runs(hit: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The longest run of set flags inside each of the parts that `edges` delimits."""
    out = np.zeros(len(edges) - 1, np.int64)
    on = np.flatnonzero(hit)
    if not len(on):
        return out
    part = np.searchsorted(edges, on, side="right") - 1
    fresh = np.concatenate(([True], (on[1:] != on[:-1] + 1) | (part[1:] != part[:-1])))
    start = np.flatnonzero(fresh)
    np.maximum.at(out, part[start], np.diff(np.concatenate((start, [len(on)]))))
    return out


#: The tables a worker built last, by the name of their broadcast, which no other pass has.
_tables: dict[str, list[Tier]] = {}


def _pass(shared, columns: list[str], resumed: bool, last: bool):
    """One pass over batches: search, merge with earlier passes, and sum up after the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, found_in = shared.value
        if name not in _tables:
            _tables.clear()
            _tables[name] = build(found_in)
        tiers = _tables[name]
        for b in slices(batches, "_text_read"):
            counts, hit, items = scan(texts(b, "_text_read"), tiers)
            edges = np.concatenate(([0], np.cumsum(counts)))
            parts = [hit[i:j] for i, j in zip(edges[:-1], edges[1:])] if resumed or not last else None
            if resumed:
                before = zip(b.column("_hits").to_pylist(), b.column("_found").to_pylist())
                for k, (bits, found) in enumerate(before):
                    parts[k] = parts[k] | np.unpackbits(np.frombuffer(bits, np.uint8), count=len(parts[k])).astype(bool)
                    items[k].update(found)
                hit = np.concatenate(parts) if parts else hit
            if not last:
                packed = pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), b.column("_text_read"), packed, pa.array([sorted(s) for s in items], pa.list_(pa.string()))], [*columns, "_text_read", "_hits", "_found"])
                continue
            upto = np.concatenate(([0], np.cumsum(hit, dtype=np.int64)))
            hits = upto[edges[1:]] - upto[edges[:-1]]
            names = [sorted(s) for s in items]
            digest = [hashlib.sha256(",".join(s).encode()).hexdigest() for s in names]
            dirty = (hits > 0) & (20 * hits >= counts)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in columns), pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array([len(s) for s in names], pa.int64()), pa.array(digest, pa.string()), pa.array(dirty), pa.array(longest_runs(hit, edges)), pa.array(names, pa.list_(pa.string()))],
                [*columns, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_hit", "item_ids"],
            )

    return run
