"""Op 5: language-model scores by context-tree weighting, and a unigram base to hold them against."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.batches import slices, texts, words
from palimpsest.llm.ctw import DEPTH, Level, code_length, index, stream, subtree
from palimpsest.runtime import discard, materialize, ship

#: Text bytes of a block, whose distinct keys are looked up together; of these, those worked on at once.
BLOCK_BYTES, SLICE = 24 << 20, 2 << 20
#: Keys that blocks ask for in a tree part on average, and the most parts there are.
PART_KEYS, MOST_PARTS = 400_000, 8192
#: Contexts of up to so many bytes are shared by all tree parts: 256 at most, and the root.
SHARED_DEPTH = 1
#: Kinds of keys: contexts with the byte that follows, and words.
GRAM, WORD = 0, 1
#: Sums that are held beside the merged ones before they are merged in.
PENDING = 4_000_000


def held_out(id_: Column) -> Column:
    """Documents the model doesn't learn from."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % 10 == 0


def _word_hash(flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words' 64-bit hashes and each word's number among them."""
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    coded = flat.dictionary_encode()
    known = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    return known.view(np.int64), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, byte by byte of all, compressed: two or three bytes a key."""
    return _squeeze(np.diff(keys.view(np.uint64), prepend=np.uint64(0)))


def unpack_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_expand(data, n, np.uint64), dtype=np.uint64)


def _squeeze(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _expand(data: bytes, n: int, kind: type) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Even buckets of keys, whatever their first bytes."""
    with np.errstate(over="ignore"):
        mixed = (keys.view(np.uint64) ^ (keys.view(np.uint64) >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def part_of(keys: np.ndarray, parts: int, depth: int) -> np.ndarray:
    """Tree parts of gram keys: a context of two bytes is all in one."""
    return bucket_of((keys >> np.uint64(8 * (depth - SHARED_DEPTH))).astype(np.uint64), parts)


class _Sums:
    """Sums by 64-bit key, merged whenever enough have come together; memory follows the distinct keys."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Distinct keys, each with its count."""
        self.parts.append((keys.view(np.uint64), counts.astype(np.int64)))
        self.pending += len(keys)
        if self.pending > PENDING + len(self.parts[0][0]):
            self._merge()

    def _merge(self) -> None:
        keys = np.concatenate([k for k, _ in self.parts])
        keys.sort()
        keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
        sums = np.zeros(len(keys), np.int64)
        while self.parts:
            own, counts = self.parts.pop()
            sums[np.searchsorted(keys, own)] += counts
        self.parts, self.pending = [(keys, sums)], len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._merge()
        return self.parts[0]


def _text_slices(table: pa.Table):
    return slices(iter(table.to_batches()), limit=SLICE)


def _scored(ends: np.ndarray, size: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Which positions count (not the further end bytes), and the first position of each text."""
    counted = np.ones(size, bool)
    starts = np.concatenate(([0], ends[:-1]))
    for i in range(1, depth):
        counted[ends - i] = False
    return counted, starts


def _by_group(group: np.ndarray, keys: np.ndarray, values: np.ndarray):
    """(group, its keys, its values) of keys that are sorted, and stay so."""
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    for own in np.split(order, cuts) if len(order) else ():
        yield int(group[own[0]]), keys[own], values[own]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


_KEYS = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("block", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_TOTALS = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("part", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("values", pa.binary()), ("total", pa.int64()), ("positive", pa.int64())])
_ASKED = pa.schema([("block", pa.int32()), ("kind", pa.int8()), ("n", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])
_WORTH = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("n", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])


def _sql(schema: pa.Schema) -> str:
    names = {pa.int8(): "byte", pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _gather(depth: int, buckets: int):
    """A block's distinct contexts and words with their training counts, a row for each bucket of them."""

    def run(table: pa.Table) -> pa.Table:
        sums = {GRAM: _Sums(), WORD: _Sums()}
        for b in _text_slices(table):
            array = texts(b)
            train = ~b.column("held_out").to_numpy(zero_copy_only=False)
            data, ends = stream(array, depth)
            number, keys = index(data, depth)
            counted, starts = _scored(ends, len(number), depth)
            learn = counted & np.repeat(train, ends - starts)
            used = np.zeros(len(keys), bool)
            used[number[counted]] = True
            sums[GRAM].add(keys[used], np.bincount(number[learn], minlength=len(keys))[used])
            flat, text = words(pc.ascii_lower(array))
            hashes, code = _word_hash(flat)
            sums[WORD].add(hashes, np.bincount(code[train[text]], minlength=len(hashes)))
        block = table.column("block")[0].as_py()
        rows = []
        for kind, held in sums.items():
            keys, counts = held.merged()
            rows += [(bucket, kind, block, len(k), pack_keys(k), _squeeze(c)) for bucket, k, c in _by_group(bucket_of(keys, buckets), keys, counts)]
        return _table(rows, _KEYS)

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[dict]]]:
    """Rows sorted by (bucket, kind), a run at a time, one row in memory."""
    rows = ({n: b.column(n)[k].as_py() for n in b.schema.names} for b in batches for k in range(b.num_rows))
    return itertools.groupby(rows, key=lambda r: (r["bucket"], r["kind"]))


def _total(depth: int, parts: int):
    """Sums of a bucket's keys over all blocks, contexts dealt to tree parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, kind), rows in _runs(batches):
            sums = _Sums()
            for r in rows:
                sums.add(unpack_keys(r["keys"], r["n"]), _expand(r["counts"], r["n"], np.int64))
            keys, counts = sums.merged()
            group = part_of(keys, parts, depth) if kind == GRAM else np.full(len(keys), -1)
            out = [(bucket, kind, part, len(k), pack_keys(k), _squeeze(c if kind == GRAM else c.astype(float)), int(c.sum()), int((c > 0).sum())) for part, k, c in _by_group(group, keys, counts)]
            yield from _table(out, _TOTALS).to_batches()

    return run


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's values, which come first, given to each block that asked for its keys."""
    for (_, kind), rows in _runs(batches):
        held, out = [], []
        known = values = None
        for r in rows:
            keys = unpack_keys(r["keys"], r["n"])
            if r["block"] < 0:
                held.append((keys, _expand(r["values"], r["n"], np.float64)))
                continue
            if known is None:
                known, values = (np.concatenate(c) for c in zip(*held))
                order = np.argsort(known)
                known, values = known[order], values[order]
            out.append((r["block"], kind, r["n"], r["keys"], _squeeze(values[np.searchsorted(known, keys)])))
            if len(out) == 64:
                yield from _table(out, _ASKED).to_batches()
                out = []
        yield from _table(out, _ASKED).to_batches()


def _part_keys(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray]:
    """A tree part's keys and counts, and how many each of its rows has."""
    sizes = table.column("n").to_pylist()
    keys = np.concatenate([unpack_keys(x, n) for x, n in zip(table.column("keys").to_pylist(), sizes)])
    counts = np.concatenate([_expand(x, n, np.int64) for x, n in zip(table.column("values").to_pylist(), sizes)])
    return sizes, keys.view(np.int64), counts


def _shared_nodes(depth: int):
    """A tree part's depth-2 nodes, summed up to their depth-1 contexts."""

    def run(table: pa.Table) -> pa.Table:
        _, keys, counts = _part_keys(table)
        levels = subtree(keys, counts, SHARED_DEPTH + 1, depth)
        low = levels[SHARED_DEPTH + 1]
        up, back = np.unique(((low.node >> 16) << 8) | (low.node & 255), return_inverse=True)
        return pa.table({"node": up, "zeros": np.bincount(back, low.zeros, len(up)), "ones": np.bincount(back, low.ones, len(up)), "below": np.bincount(back, low.weighted, len(up))})

    return run


def _root(rows: list, depth: int) -> dict[int, Level]:
    """Levels 1 and 0 from the summed depth-1 nodes (65,280 at most)."""
    rows = sorted(rows, key=lambda r: r["node"])
    one = Level(np.array([r["node"] for r in rows], np.int64), np.array([r["zeros"] for r in rows]), np.array([r["ones"] for r in rows]), None)
    if rows:
        one.mix(np.array([r["below"] for r in rows]))
    node, back = np.unique(one.node & 255, return_inverse=True)
    zero = Level(node, np.bincount(back, one.zeros, len(node)), np.bincount(back, one.ones, len(node)), one)
    return {1: one, 0: zero}


def _lengths(shared, depth: int):
    """The log10 probability of each of a tree part's keys, row by row."""

    def run(table: pa.Table) -> pa.Table:
        sizes, keys, counts = _part_keys(table)
        found = code_length(keys, subtree(keys, counts, SHARED_DEPTH + 1, depth) | shared.value, depth)
        values = [_squeeze(v) for v in np.split(found, np.cumsum(sizes)[:-1])]
        return pa.table([table.column("bucket"), table.column("kind"), table.column("n"), table.column("keys"), pa.array(values, pa.binary())], schema=_WORTH)

    return run


def _values_of(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's keys of one kind, sorted, with their values."""
    own = table.filter(pc.equal(table.column("kind"), kind))
    sizes = own.column("n").to_pylist()
    if not sizes:
        return np.zeros(0, np.uint64), np.zeros(0)
    keys = np.concatenate([unpack_keys(x, n) for x, n in zip(own.column("keys").to_pylist(), sizes)])
    values = np.concatenate([_expand(x, n, np.float64) for x, n in zip(own.column("values").to_pylist(), sizes)])
    order = np.argsort(keys)
    return keys[order], values[order]


def _score(depth: int, total: float, distinct: float, ends_known: float):
    """Scores of a block's texts from its keys' values: code lengths, and words' counts."""
    base = total + 0.1 * (distinct + 1)

    def word(count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / base)

    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        gram_key, gram_value = _values_of(asked, GRAM)
        word_key, word_count = _values_of(asked, WORD)
        parts = []
        for b in _text_slices(docs) if docs.num_rows else ():
            array = texts(b)
            data, ends = stream(array, depth)
            number, keys = index(data, depth)
            counted, starts = _scored(ends, len(number), depth)
            own = np.minimum(np.searchsorted(gram_key, keys.view(np.uint64)), max(0, len(gram_key) - 1))
            each = gram_value[own][number]
            each[~counted] = 0
            flat, text = words(pc.ascii_lower(array))
            hashes, code = _word_hash(flat)
            n = b.num_rows
            mine = word_count[np.searchsorted(word_key, hashes.view(np.uint64))]
            worth = word(mine)[code] if len(code) else np.zeros(0)
            parts.append(
                pa.table(
                    {
                        "doc_id": b.column("doc_id"),
                        "held_out": b.column("held_out"),
                        "n_tokens": pa.array(np.bincount(text, minlength=n) + 1),
                        "n_known": pa.array(np.bincount(text, (mine > 0)[code] if len(code) else None, n).astype(np.int64) + int(ends_known > 0)),
                        "train_tokens": pa.array(np.full(n, int(total))),
                        "base_score": pa.array(np.bincount(text, worth, n) + float(word(np.array(ends_known)))),
                        "score": pa.array(np.add.reduceat(each, starts)),
                    }
                )
            )
        return pa.concat_tables(parts) if parts else _EMPTY.empty_table()

    return run


_EMPTY = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _spread(df: DataFrame, n: int, column: str) -> DataFrame:
    """Rows by the number in `column`, evenly over as many tasks as there are numbers, or as a shuffle has partitions."""
    return df.repartitionById(min(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), F.col(column))


def score_documents(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text by a model learned from all documents that aren't held out.

    Documents are dealt by hash into blocks. A block gives its distinct contexts and words
    with their counts, packed, a row for each bucket of keys; a bucket's rows are summed one
    after another, the context tree is worked out in parts that hold all of a two-byte
    context each, and each key's value goes back through its bucket to the blocks that asked
    for it. So what is gathered grows with the corpus, at a few bytes for each distinct key
    of a block; a bucket's memory follows its distinct keys, and buckets grow as the root of
    the blocks, so that their rows keep a useful size. Nothing is broadcast but the root's
    two levels, at most 65,535 nodes. Words are told apart by a 64-bit hash.

    Null texts are empty: one end token. Repeated rows and null ids are scored (and learned
    from) like others; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), held_out(F.col(id_col)).alias("held_out"))
    size = read.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(~F.col("held_out"))).first()
    blocks, ends = max(1, -(-size[0] // block_bytes)), size[1] or 0
    buckets = math.ceil(8 * math.sqrt(blocks))
    dealt = read.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    dealt = _spread(dealt, blocks, "block")
    gathered = materialize(dealt.groupBy("block").applyInArrow(_gather(depth, buckets), _sql(_KEYS)), "op5-keys")
    asked = gathered.filter(F.col("kind") == GRAM).agg(F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0))).first()[0]
    parts = min(MOST_PARTS, max(1, -(-asked // PART_KEYS)))

    held = _spread(gathered, buckets, "bucket").sortWithinPartitions("bucket", "kind")
    totals = materialize(held.mapInArrow(_total(depth, parts), _sql(_TOTALS)), "op5-totals")
    grams, known = totals.filter(F.col("kind") == GRAM), totals.filter(F.col("kind") == WORD)
    n, v = known.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("positive"), F.lit(0))).first()
    parted = grams.groupBy("part")
    nodes = parted.applyInArrow(_shared_nodes(depth), "node long, zeros double, ones double, below double")
    summed = nodes.groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")).collect()
    shared = spark.sparkContext.broadcast(_root(summed, depth))
    worth = parted.applyInArrow(_lengths(shared, depth), _sql(_WORTH)).union(known.select("bucket", "kind", "n", "keys", "values"))

    both = worth.withColumn("block", F.lit(-1)).unionByName(gathered.select("bucket", "kind", "n", "keys", F.lit(None).cast("binary").alias("values"), "block"))
    found = _spread(both, buckets, "bucket").sortWithinPartitions("bucket", "kind", "block").mapInArrow(_look_up, _sql(_ASKED))
    found = materialize(found, "op5-found")
    discard(gathered, totals)
    return dealt.groupBy("block").cogroup(_spread(found, blocks, "block").groupBy("block")).applyInArrow(
        _score(depth, n + ends, v + (ends > 0), ends), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
