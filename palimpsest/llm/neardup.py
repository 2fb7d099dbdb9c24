"""Op 9: near-duplicate classes by ProbMinHash, banding, verification and components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.batches import slices, texts, words
from palimpsest.llm.components import components
from palimpsest.runtime import discard, materialize, ship

#: Words of a shingle and the probability Jaccard from which two texts are near copies.
SHINGLE, SIMILARITY = 5, 0.8
#: A pair at the threshold shares no band with a probability of (1 - 0.8^5)^32 = 3e-6.
BANDS, ROWS = 32, 5
#: Pairs whose signatures agree in a smaller share are not near copies: 4.7 deviations below 0.8.
LEAST_ESTIMATE = 0.65
#: Text bytes and texts one kernel call works on.
SLICE, SLICE_ROWS = 3 << 20, 2048
#: Members of a bucket that one task compares with so many that are still apart in it.
BLOCK_MEMBERS, TURN_MEMBERS = 1024, 512
#: Pairs of one member that are worked out together, before components are looked at again.
AT_ONCE = 64
#: Hashes of one matrix product, and what an entry of it and a search for one hash cost, in nanoseconds.
MATRIX_COLUMNS, PRODUCT_COST, SEARCH_COST = 2048, 0.1, 150
#: Fingerprints of texts to verify that are broadcast at most; more are joined by shuffling.
BROADCAST_IDS = 1 << 19


def fingerprint(text: Column) -> Column:
    """What tells texts apart: the MD5 as 16 bytes."""
    return F.unhex(F.md5(text))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct weighted shingles: the text, a 48-bit hash, how often the text has it.

    Words are separated by white space, A-Z lower-cased; a text of fewer than SHINGLE words,
    but not none, is one shingle. Sorted by text, then hash.
    """
    flat, text = words(pc.ascii_lower(array))
    n = len(array)
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    coded = flat.dictionary_encode()
    with np.errstate(over="ignore"):
        h = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)[coded.indices.to_numpy(zero_copy_only=False)]
        count = np.bincount(text, minlength=n)
        step = np.uint64(0x9E3779B97F4A7C15)
        w = max(0, len(h) - SHINGLE + 1)
        key = np.zeros(w, np.uint64)
        for i in range(SHINGLE):
            key = key * step + h[i : w + i]
        own = np.flatnonzero(text[:w] == text[SHINGLE - 1 :]) if w else np.zeros(0, np.int64)
        key, doc = _mix(key[own] + np.uint64(SHINGLE)), text[own]
        short = np.flatnonzero((count > 0) & (count < SHINGLE))
        if len(short):
            begin = (np.cumsum(count) - count)[short]
            rest = np.zeros(len(short), np.uint64)
            for i in range(SHINGLE - 1):
                on = count[short] > i
                rest[on] = rest[on] * step + h[begin[on] + i]
            key, doc = np.concatenate((key, _mix(rest + count[short].astype(np.uint64)))), np.concatenate((doc, short))
    both = np.sort((doc.astype(np.uint64) << np.uint64(48)) | (key >> np.uint64(16)))
    first = np.ones(len(both), bool)
    first[1:] = both[1:] != both[:-1]
    at = np.flatnonzero(first)
    kept = both[at]
    return (kept >> np.uint64(48)).astype(np.int64), kept & np.uint64((1 << 48) - 1), np.diff(np.concatenate((at, [len(both)])))


def prob_min_hash(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, k: int = BANDS * ROWS) -> np.ndarray:
    """n x k registers; two texts agree in one with the probability Jaccard of their shingles.

    Each shingle is a Poisson process of rate `weight` whose arrivals fall into random
    registers; a register keeps the shingle that came first. A shingle stops at the first
    arrival later than all its text's registers, as no later one can matter. Everything
    follows from hash and weight alone, so equal shingles behave alike in every text.
    """
    times, keeper = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
    t, rate, i = np.zeros(len(h)), weight.astype(float), 0
    with np.errstate(over="ignore"):
        seed = _mix(h + np.uint64(0x632BE59BD9B4E019))
        while len(h):
            i += 1
            x = _mix(seed + np.uint64((i * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
            t = t - np.log(((x >> np.uint64(20)).astype(float) + 1) * 2.0**-44) / rate
            slot = doc * k + (((x & np.uint64(0xFFFFF)) * np.uint64(k)) >> np.uint64(20)).astype(np.int64)
            better = t < times[slot]
            s, tt, hh = slot[better], t[better], h[better]
            np.minimum.at(times, s, tt)
            won = times[s] == tt
            keeper[s[won]] = hh[won]
            on = t < times.reshape(n, k).max(axis=1)[doc]
            doc, h, seed, rate, t = doc[on], h[on], seed[on], rate[on], t[on]
    return keeper.reshape(n, k)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each text."""
    with np.errstate(over="ignore"):
        key = np.zeros((len(registers), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
        for i in range(ROWS):
            key = _mix(key * np.uint64(0xD6E8FEB86659FD93) + registers[:, i::ROWS])
    return key.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact: the sum over common d of 1 / sum over d' of max(a[d'] / a[d], b[d'] / b[d]).

    Hashes are sorted and distinct; if all weights are 1 this is the Jaccard of the sets.
    """
    if len(a[0]) and len(b[0]) and a[1].max() == 1 and b[1].max() == 1:
        at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
        common = int((b[0][at] == a[0]).sum())
        return common / (len(a[0]) + len(b[0]) - common)
    every = np.union1d(a[0], b[0])
    if not len(every):
        return 0.0
    wa, wb = np.zeros(len(every)), np.zeros(len(every))
    wa[np.searchsorted(every, a[0])] = a[1]
    wb[np.searchsorted(every, b[0])] = b[1]
    kinds, times = np.unique(np.stack([wa, wb]), axis=1, return_counts=True)
    out = 0.0
    for (x, y), n in zip(kinds.T, times):
        if x and y:
            out += n / float((np.maximum(kinds[0] / x, kinds[1] / y) * times).sum())
    return out


def similarities(one: tuple[np.ndarray, np.ndarray], others: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """`probability_jaccard` of one non-empty set with each of several, all without repeats at once."""
    out = np.zeros(len(others))
    plain = np.array([one[1].max() == 1 and w.max() == 1 for _, w in others], bool)
    for k in np.flatnonzero(~plain):
        out[k] = probability_jaccard(one, others[k])
    if plain.any():
        held = [others[k][0] for k in np.flatnonzero(plain)]
        sizes = np.array([len(h) for h in held])
        flat = np.concatenate(held)
        same = one[0][np.minimum(np.searchsorted(one[0], flat), len(one[0]) - 1)] == flat
        common = np.add.reduceat(same.astype(np.int64), np.cumsum(sizes) - sizes)
        out[plain] = common / (len(one[0]) + sizes - common)
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, MD5 of the text, band keys (empty without words), registers as 16 bits each."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint(text).alias("fp"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=SLICE, rows=SLICE_ROWS):
            doc, h, weight = shingles(texts(b))
            n = b.num_rows
            has = np.bincount(doc, minlength=n) > 0
            registers = prob_min_hash((np.cumsum(has) - 1)[doc], h, weight, int(has.sum()))
            keys = band_keys(registers)
            edges = np.concatenate(([0], np.cumsum(has * BANDS))).astype(np.int32)
            small = iter(registers.astype(np.uint16))
            signs = pa.array([next(small).tobytes() if x else b"" for x in has.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("fp"), pa.ListArray.from_arrays(pa.array(edges), pa.array(keys.ravel())), signs], ["doc_id", "fp", "bands", "sign"])

    return read.mapInArrow(run, "doc_id long, fp binary, bands array<long>, sign binary")


def _signs(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Signatures as rows of 16-bit registers."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BANDS * ROWS)


def likely(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough, long before any text is moved."""
    both = pairs.join(signs.select(F.col("node").alias("a"), F.col("sign").alias("sa")), "a").join(signs.select(F.col("node").alias("b"), F.col("sign").alias("sb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                close = (_signs(b.column("sa")) == _signs(b.column("sb"))).mean(axis=1) >= LEAST_ESTIMATE
                yield b.select(["a", "b"]).filter(pa.array(close))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, hashes, weights) of the texts of `wanted` (node, fp, first_id): 64 bits a hash, 32 a weight.

    Of equal texts only the rows of the least id are read out, and one of these counts. The
    wanted fingerprints are broadcast up to BROADCAST_IDS, beyond which Spark shuffles.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint(text).alias("_fp"), text.alias("t"))
    n, schema = wanted.count(), "node long, hashes binary, weights binary"
    if not n:
        return docs.sparkSession.createDataFrame([], schema)
    held = F.broadcast(wanted) if n <= BROADCAST_IDS else wanted
    own = read.join(held, (F.col("_fp") == F.col("fp")) & F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("node").agg(F.first("t").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t", SLICE, SLICE_ROWS):
            doc, h, w = shingles(texts(b, "t"))
            at = np.searchsorted(doc, np.arange(b.num_rows + 1))
            w = np.minimum(w, (1 << 32) - 1).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([b.column("node"), *(pa.array([x[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary()) for x in (h, w))], ["node", "hashes", "weights"])

    return own.mapInArrow(run, schema)


def _sets(hashes: pa.ChunkedArray | pa.Array, weights: pa.ChunkedArray | pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(h, np.uint64), np.frombuffer(w, np.uint32)) for h, w in zip(hashes.to_pylist(), weights.to_pylist())]


def _in_common(sets: list[tuple[np.ndarray, np.ndarray]], rows: np.ndarray, columns: np.ndarray, pairs: int) -> np.ndarray | None:
    """How many hashes each of `rows` shares with each of `columns`, by products of 0-1 matrices.

    None where that costs more than `pairs` of them one by one. Hashes that one set alone
    has play no part.
    """
    flat = np.concatenate([h for h, _ in sets])
    owner = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    wanted = times > 1
    number = np.cumsum(wanted) - 1
    kept = wanted[code]
    code, owner = number[code[kept]], owner[kept]
    n = int(wanted.sum())
    if n * len(rows) * len(columns) * PRODUCT_COST > pairs * (len(flat) / len(sets)) * SEARCH_COST:
        return None
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out = np.zeros((len(rows), len(columns)), np.float32)
    for start in range(0, n, MATRIX_COLUMNS):
        a, b = np.searchsorted(code, [start, start + MATRIX_COLUMNS])
        there = np.zeros((len(sets), MATRIX_COLUMNS), np.float32)
        there[owner[a:b], code[a:b] - start] = 1
        out += there[rows] @ there[columns].T
    return out


def _compare_block(similarity: float):
    """A block of a bucket's members against a block of its apart ones: links between two components.

    A pair is looked at only in the bucket of the least key it shares, and only while its
    components are still two, so the links found are fewer than the components. A link is
    given, and its components merged, once the whole shingle sets confirm it.
    """

    def run(part: pa.Table) -> pa.Table:
        key = part.column("key")[0].as_py()
        apart = part.column("apart").to_numpy(zero_copy_only=False)
        own = part.column("own").to_numpy(zero_copy_only=False)
        node, label, sign = part.column("node").to_numpy(), part.column("label").to_numpy().copy(), _signs(part.column("sign"))
        bands = part.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        sets = _sets(part.column("hashes"), part.column("weights"))
        members, asked = np.flatnonzero(own), np.flatnonzero(~own)
        nominated = []
        for i in asked:
            there = members[(label[members] != label[i]) & (~apart[members] | (node[members] > node[i]))]
            there = there[(sign[there] == sign[i]).mean(axis=1) >= LEAST_ESTIMATE]
            shared = np.where(bands[there] == bands[i], bands[there], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
            nominated.append(there[shared == key])
        size, plain = np.array([len(h) for h, _ in sets]), np.array([w.max(initial=1) == 1 for _, w in sets])
        common, column = _in_common(sets, asked, members, sum(map(len, nominated))), np.cumsum(own) - 1
        out: list[tuple[int, int]] = []
        for k, (i, there) in enumerate(zip(asked, nominated)):
            there = there[label[there] != label[i]]
            while len(there):
                now, there = there[:AT_ONCE], there[AT_ONCE:]
                if common is not None and plain[i] and plain[now].all():
                    both = common[k, column[now]]
                    alike = both / (size[i] + size[now] - both)
                else:
                    alike = similarities(sets[i], [sets[j] for j in now])
                for j in now[alike >= similarity - 1e-9]:
                    if label[i] != label[j]:
                        out.append((min(node[i], node[j]), max(node[i], node[j])))
                        label[label == label[j]] = label[i]
                there = there[label[there] != label[i]]
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def verify(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least the probability Jaccard `similarity`.

    Both are plain tables, so a text that a whole family is held against is split over tasks.
    """
    both = pairs
    for k in "ab":
        both = both.join(sets.select(F.col("node").alias(k), F.col("hashes").alias(f"h{k}"), F.col("weights").alias(f"w{k}")), k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "ha", SLICE, SLICE_ROWS):
            one, two = _sets(b.column("ha"), b.column("wa")), _sets(b.column("hb"), b.column("wb"))
            good = np.array([probability_jaccard(x, y) >= similarity - 1e-9 for x, y in zip(one, two)], bool)
            yield b.select(["a", "b"]).filter(pa.array(good))

    return both.select("a", "b", "ha", "wa", "hb", "wb").mapInArrow(run, "a long, b long")


def _relabel(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Bucket members with their component's label; nodes without links are their own."""
    named = buckets.join(labels.select(F.col("node").alias("_n"), "label"), F.col("node") == F.col("_n"), "left")
    return named.select("key", "node", F.coalesce("label", "node").alias("label"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, kept, text_md5 for every row; a class's id is its least doc_id.

    Two texts are linked if their five-word shingles, weighted by occurrences, have a
    probability Jaccard of at least `similarity` and they share a band; classes are the
    components. Equal texts are one node from the start. Within a bucket nobody is compared
    with everybody: each member is compared with two leaders, the member whose buckets are
    most crowded (the text that variants were made from, if there is one) and one chosen by
    a hash, another in each band. Then members still apart from their bucket's largest
    component are compared with all of the bucket, block by block inside tasks that give
    only links. Pairs are judged by their signatures first and by their shingle sets last.
    So a group of n near copies costs 2 * BANDS * n comparisons at most, and no bucket is
    skipped or cut for its size. What a join meets is a written table, never an aggregate,
    so that a key with a third of all rows is split over tasks.

    A class keeps the rows of its least doc_id and, of that id's texts, the one whose MD5 is
    least. Nodes are texts, not ids: rows that share an id but not the text are judged apart
    (their classes may then bear the same id; `text_md5` tells them apart). Null ids come
    after all others; a class of nothing else has a null id. Texts without words, null ones
    included, are classes of their own; an empty table gives an empty result; other columns
    are not read.
    """
    ship(docs.sparkSession)
    signed = materialize(signatures(docs, id_col, text_col), "op9-signatures")
    nodes = signed.filter(F.size("bands") > 0).groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.first(F.struct("bands", "sign")).alias("r"))
    nodes = materialize(nodes.select(F.monotonically_increasing_id().alias("node"), "fp", "first_id", "r.bands", "r.sign"), "op9-nodes")
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    crowded = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "op9-crowded")
    buckets = materialize(keyed.join(crowded, "key"), "op9-buckets")
    crowd = buckets.groupBy("node").agg(F.sum("n").alias("crowd"))
    signs = materialize(nodes.select("node", "sign", "bands").join(crowd, "node"), "op9-signs")
    ranked = buckets.join(signs.select("node", "crowd"), "node")
    leaders = ranked.groupBy("key").agg(
        F.max(F.struct("crowd", F.negative("node").alias("node"))).alias("c"), F.min(F.struct(F.xxhash64("key", "node").alias("h"), "node")).alias("h")
    ).select("key", (-F.col("c.node")).alias("l1"), F.col("h.node").alias("l2"))
    leaders = materialize(leaders, "op9-leaders")
    led = buckets.join(leaders, "key").select("node", F.explode(F.array("l1", "l2")).alias("leader")).filter("node != leader")
    pairs = led.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    pairs = materialize(likely(pairs, signs), "op9-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts_of = nodes.select("node", "fp", "first_id")
    sets = materialize(shingle_sets(docs, materialize(texts_of.join(wanted, "node", "left_semi"), "op9-wanted"), id_col, text_col), "op9-sets")
    labels = materialize(components(verify(pairs, sets, similarity)), "op9-labels")
    discard(crowded, leaders, pairs)

    named = _relabel(buckets, labels)
    sizes = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("members")).filter("parts > 1")
    blocks = [F.ceil(c / n).cast("int") for c, n in ((F.col("members"), BLOCK_MEMBERS), (F.col("members") - F.col("main.n"), TURN_MEMBERS))]
    split = materialize(split.select("key", F.col("main.label").alias("main"), blocks[0].alias("blocks"), blocks[1].alias("turns")), "op9-split")
    open_ = materialize(named.join(split, "key").withColumn("apart", F.col("label") != F.col("main")), "op9-open")
    more = texts_of.join(open_.select("node").distinct(), "node", "left_semi").join(sets.select("node"), "node", "left_anti")
    further = materialize(shingle_sets(docs, materialize(more, "op9-wanted"), id_col, text_col), "op9-sets")
    place = [F.pmod(F.xxhash64("node"), F.col(c)).cast("int") for c in ("blocks", "turns")]
    every = [F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("blocks", "turns")]
    members = open_.select("key", "node", "label", "apart", F.lit(True).alias("own"), place[0].alias("block"), every[1].alias("turn"))
    asked = open_.filter("apart").select("key", "node", "label", "apart", F.lit(False).alias("own"), every[0].alias("block"), place[1].alias("turn"))
    held = members.unionByName(asked).join(signs.select("node", "sign", "bands"), "node").join(sets.union(further), "node")
    rest = materialize(held.groupBy("key", "block", "turn").applyInArrow(_compare_block(similarity), "a long, b long").distinct(), "op9-rest")
    if rest.limit(1).count():
        stars = labels.filter("node != label").select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = materialize(components(stars.union(rest)), "op9-labels")
    discard(buckets, signs, split, open_, sets, further, rest)
    return _classes(signed, nodes, labels)


def _classes(signed: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row with its class, from the nodes' components."""
    linked = materialize(nodes.select("node", "fp", "first_id").join(labels, "node"), "op9-linked")
    first = linked.groupBy("label").agg(F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "fp")).alias("r"))
    first = materialize(first.select("label", F.col("r.first_id").alias("class_id"), F.col("r.fp").alias("class_fp")), "op9-first")
    of_text = linked.join(first, "label").select(F.col("fp").alias("_fp"), "class_id", "class_fp")
    alone = nodes.join(labels, "node", "left_anti").select(F.col("fp").alias("_fp"), F.col("first_id").alias("class_id"), F.col("fp").alias("class_fp"))
    worded = signed.filter(F.size("bands") > 0).select("doc_id", "fp").join(of_text.union(alone), F.col("fp") == F.col("_fp"))
    kept = (F.col("fp") == F.col("class_fp")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    rows = worded.select("doc_id", "class_id", kept.alias("kept"), F.col("fp").alias("text_md5"))
    return rows.union(signed.filter(F.size("bands") == 0).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"), F.col("fp").alias("text_md5")))
