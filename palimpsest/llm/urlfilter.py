"""Op 2: URL rules, and exact list membership by a Bloom filter cascade."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.runtime import materialize, ship

#: Bits for each encoded key at every level, and hash functions.
BITS_PER_KEY, HASHES = 8, 4
#: Universe keys one segment of the cascade is built from, and filter bytes broadcast at once.
KEYS_PER_SEGMENT, BROADCAST_BYTES = 1 << 20, 64 << 20


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first `://` (A-Z lower-cased) and path; both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its action; nulls where none fits."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == F.lit(r.host)) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, action = F.when(fits, F.lit(r.text)).otherwise(name), F.when(fits, F.lit(r.action)).otherwise(action)
    return name, action


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _positions(a: np.ndarray, b: np.ndarray, level: int, m: int) -> np.ndarray:
    """Bit positions of each key at a level, one row for each hash function."""
    with np.errstate(over="ignore"):
        base = _mix(a + np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        step = _mix(b ^ base) | np.uint64(1)
        return np.stack([((base + np.uint64(i) * step) >> np.uint64(11)) % np.uint64(m) for i in range(HASHES)]).astype(np.int64)


def _holds(bits: np.ndarray, a: np.ndarray, b: np.ndarray, level: int, m: int) -> np.ndarray:
    at = _positions(a, b, level, m)
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def build_segment(a: np.ndarray, b: np.ndarray, listed: np.ndarray) -> list[tuple[int, bytes]]:
    """The levels (bit count, bits) that separate listed from unlisted keys exactly.

    Level 0 encodes the listed keys; each further level encodes the keys of the other kind
    that the level above lets through by mistake, until there are none.
    """
    (inside, outside), levels = (np.flatnonzero(listed), np.flatnonzero(~listed)), []
    while len(inside):
        m = max(64, BITS_PER_KEY * len(inside))
        bits = np.zeros(-(-m // 8), np.uint8)
        at = _positions(a[inside], b[inside], len(levels), m).ravel()
        np.bitwise_or.at(bits, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))
        through = outside[_holds(bits, a[outside], b[outside], len(levels), m)]
        levels.append((m, bits.tobytes()))
        inside, outside = through, inside
        if len(levels) > 200:
            raise ValueError("two keys of different kinds share both 64-bit hashes")
    return levels


def member(levels: list[tuple[int, bytes]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each key of the universe is listed: the parity of the first level that lacks it."""
    out, open_ = np.zeros(len(a), bool), np.ones(len(a), bool)
    for k, (m, data) in enumerate(levels):
        open_[open_] = _holds(np.frombuffer(data, np.uint8), a[open_], b[open_], k, m)
        out[open_] = k % 2 == 0
    return out


def _segments(key: pd.DataFrame) -> pd.DataFrame:
    key = key.sort_values(["a", "b"])
    levels = build_segment(key["a"].to_numpy().view(np.uint64), key["b"].to_numpy().view(np.uint64), key["listed"].to_numpy())
    return pd.DataFrame({"segment": [int(key["segment"].iloc[0])] * len(levels), "level": range(len(levels)), "m": [x[0] for x in levels], "bits": [x[1] for x in levels]})


def _hashes(key: Column, segments: int) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b"), F.pmod(F.hash(key), F.lit(segments)).cast("int").alias("segment")]


def build_cascade(keys: DataFrame, key: str, listed: Column) -> tuple[DataFrame, int]:
    """Filter rows (segment, level, m, bits) over the distinct keys of `keys`, and the segment count.

    `listed` tells for a key whether the list holds it. The universe is split by hash into
    segments of bounded size, each built by one task.
    """
    ship(keys.sparkSession)
    distinct = materialize(keys.groupBy(F.col(key).alias("key")).agg(F.max(listed).alias("listed")), "op2-keys")
    segments = max(1, -(-distinct.count() // KEYS_PER_SEGMENT))
    hashed = distinct.select(*_hashes(F.col("key"), segments), "listed")
    rows = hashed.groupBy("segment").applyInPandas(_segments, "segment int, level int, m long, bits binary")
    return materialize(rows, "op2-cascade"), segments


def _tester(shared):
    """The function that tests keys against the broadcast segments."""

    def test(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b, segment in parts:
            u, v, s = a.to_numpy().view(np.uint64), b.to_numpy().view(np.uint64), segment.to_numpy()
            found = np.zeros(len(s), bool)
            for k in np.unique(s):
                if int(k) in shared.value:
                    own = s == k
                    found[own] = member(shared.value[int(k)], u[own], v[own])
            yield pd.Series(found)

    return test


def mark_listed(df: DataFrame, key: str, cascade: DataFrame, segments: int, out: str = "listed") -> DataFrame:
    """Add Boolean `out`: exact for every key of the universe the cascade was built over.

    Filters are broadcast while they take at most BROADCAST_BYTES; a larger cascade is read in
    groups of segments of that size, one pass over the rows for each, with a written table
    between two passes. No pass joins.
    """
    spark = df.sparkSession
    ship(spark)
    sizes = cascade.groupBy("segment").agg(F.sum(F.octet_length("bits")).alias("bytes")).orderBy("segment")
    groups, held = [[]], 0
    for r in sizes.toLocalIterator():  # one small row for each KEYS_PER_SEGMENT keys
        if held + r["bytes"] > BROADCAST_BYTES and groups[-1]:
            groups.append([])
            held = 0
        groups[-1].append(r["segment"])
        held += r["bytes"]
    df = df.withColumn(out, F.lit(False))
    for n, group in enumerate(groups):
        rows = cascade.filter(F.col("segment").isin(group)).orderBy("segment", "level").collect() if group else []
        levels: dict[int, list[tuple[int, bytes]]] = {}
        for r in rows:
            levels.setdefault(r["segment"], []).append((r["m"], bytes(r["bits"])))
        shared = spark.sparkContext.broadcast(levels)
        test = F.pandas_udf(_tester(shared), "boolean")
        df = df.withColumn(out, F.col(out) | test(*_hashes(F.col(key), segments)))
        if n + 1 < len(groups):
            df = materialize(df, "op2-pass")
    return df


def judge_urls(pages: DataFrame, rules: list[Rule], listed: Column, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every row: the longest fitting rule's action, else block iff the host is listed.

    `listed` is a Boolean column over `host`. Null urls and urls without `://` have empty
    host and path and fit no rule; repeated rows and null ids are judged like others; an
    empty table gives an empty result; further columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    cascade, segments = build_cascade(split.select("host"), "host", listed)
    rule, action = longest_rule(F.col("host"), F.col("path"), rules)
    marked = mark_listed(split.withColumn("rule", rule).withColumn("_action", action), "host", cascade, segments)
    verdict = F.coalesce("_action", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    return marked.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")
