"""Op 6: text statistics, and decision lists learned from labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.batches import SPACE, lut, per_text, raw, slices, texts, words
from palimpsest.runtime import ship

#: Words in a window whose repetition counts.
WINDOW = 8
#: Labelled rows the list is learned from at most: those whose id hashes lowest.
TRAIN_ROWS = 6000
SYMBOLS = lut(*b"#*$%&|<>")

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_pipes", "n_digits", "n_echo_words", "n_lines", "n_distinct_words"]
#: What the rules may test: name and how it follows from the counts.
FEATURES = {
    "words": lambda r: r("n_words"),
    "word_length": lambda r: r("word_chars") / r("n_words"),
    "symbols_per_word": lambda r: r("n_symbols") / r("n_words"),
    "dup_line_share": lambda r: r("n_dup_lines") / r("n_lines"),
    "repeat_share": lambda r: r("n_repeat_words") / r("n_words"),
    "upper_per_char": lambda r: r("n_upper") / r("word_chars"),
    "marks_per_word": lambda r: r("n_marks") / r("n_words"),
    "pipes_per_word": lambda r: r("n_pipes") / r("n_words"),
    "digits_per_word": lambda r: r("n_digits") / r("n_words"),
    "echo_share": lambda r: r("n_echo_words") / r("n_words"),
    "words_per_line": lambda r: r("n_words") / r("n_lines"),
    "distinct_share": lambda r: r("n_distinct_words") / r("n_words"),
}


def _repeat_words(ids: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Words covered by a window of WINDOW words that its text holds at least twice."""
    total = np.zeros(n, np.int64)
    w = len(ids) - WINDOW + 1
    if w < 1:
        return total
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        key = text[:w].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for i in range(WINDOW):
            key = key * np.uint64(0x100000001B3) + mixed[i : w + i]
    own = np.flatnonzero(text[:w] == text[WINDOW - 1 :])
    ordered = np.sort(key[own])
    doubled = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(doubled):
        return total
    at = np.minimum(np.searchsorted(doubled, key[own]), len(doubled) - 1)
    own = own[doubled[at] == key[own]]
    # The hash only nominates: the windows themselves decide.
    rows = np.column_stack([text[own], *(ids[own + i] for i in range(WINDOW))]).astype(np.int64)
    _, back, times = np.unique(np.ascontiguousarray(rows).view(f"V{rows.shape[1] * 8}").ravel(), return_inverse=True, return_counts=True)
    own = own[times[back] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, own, 1)
    np.add.at(edge, own + WINDOW, -1)
    return np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=n)


def count(array: pa.Array) -> dict[str, np.ndarray]:
    """The COUNTS of each text of a null-free array."""
    n = len(array)
    data, offsets = raw(array)
    out = {
        "word_chars": per_text(((data & 0xC0) != 0x80) & ~SPACE[data], offsets),
        "n_symbols": per_text(SYMBOLS[data], offsets),
        "n_upper": per_text((data >= 65) & (data <= 90), offsets),
        "n_marks": per_text(lut(*b"!?")[data], offsets),
        "n_pipes": per_text(data == ord("|"), offsets),
        "n_digits": per_text((data >= 48) & (data <= 57), offsets),
    }
    flat, text = words(array)
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, np.int32)
    out["n_words"] = np.bincount(text, minlength=n)
    out["n_repeat_words"] = _repeat_words(ids, text, n)
    echo = (ids[1:] == ids[:-1]) & (text[1:] == text[:-1])
    out["n_echo_words"] = np.bincount(text[1:][echo], minlength=n)
    pairs = np.sort((text.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64))
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = pairs[1:] != pairs[:-1]
    out["n_distinct_words"] = np.bincount((pairs[fresh] >> np.uint64(32)).astype(np.int64), minlength=n)
    lines = pc.split_pattern(array, "\n")
    line, owner = pc.list_flatten(lines), pc.list_parent_indices(lines)
    real = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(line)), 0)
    line, owner = line.filter(real), owner.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
    out["n_lines"] = np.bincount(owner, minlength=n)
    if len(line):
        key = np.unique((owner << 32) | line.dictionary_encode().indices.to_numpy(zero_copy_only=False))
        out["n_dup_lines"] = out["n_lines"] - np.bincount(key >> 32, minlength=n)
    else:
        out["n_dup_lines"] = np.zeros(n, np.int64)
    return out


def with_counts(docs: DataFrame, columns: list[str], text_col: str = "text", prefix: str = "_") -> DataFrame:
    """`columns` of `docs`, and the COUNTS of the whole text under `prefix`, in one narrow pass."""
    ship(docs.sparkSession)
    read = docs.select(*columns, F.col(text_col).alias("_text_read"))
    schema = T.StructType([f for f in read.schema if f.name != "_text_read"] + [T.StructField(prefix + c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text_read"):
            found = count(texts(b, "_text_read"))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), *(pa.array(found[c].astype(np.int64)) for c in COUNTS)], [*columns, *(prefix + c for c in COUNTS)])

    return read.mapInArrow(run, schema)


def base_failed(prefix: str = "_") -> Column:
    """Under 20 words, or over 30 % of them in repeated windows."""
    words_, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words_ < 20) | (repeated * 100 > words_ * 30)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float


@dataclass(frozen=True)
class Rule:
    """Reject if all conditions hold; the counts are of the held-out rows it was pruned on."""

    conditions: tuple[Condition, ...]
    hits: int
    errors: int

    def text(self) -> str:
        return " and ".join(f"{c.feature} {'>' if c.above else '<='} {c.cut:.6g}" for c in self.conditions)


def _match(x: dict[str, np.ndarray], conditions: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for c in conditions:
        out &= (x[c.feature] > c.cut) if c.above else (x[c.feature] <= c.cut)
    return out


def _best_condition(x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Condition | None]:
    """The condition of the largest information gain for the bad rows, FOIL's measure."""
    p0, n0 = bad.sum(), len(bad)
    best, found = 1e-9, None
    base = np.log2(p0 / n0)
    for name in FEATURES:
        order = np.argsort(x[name], kind="stable")
        v, b = x[name][order], np.cumsum(bad[order])
        edge = np.flatnonzero(v[1:] > v[:-1])
        if not len(edge):
            continue
        for above in (False, True):
            p = (p0 - b[edge]) if above else b[edge]
            n = (n0 - edge - 1) if above else edge + 1
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - base), 0)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, found = gain[k], Condition(name, above, float((v[edge[k]] + v[edge[k] + 1]) / 2))
    return best, found


def learn(x: dict[str, np.ndarray], bad: np.ndarray, order: np.ndarray, max_rules: int = 24, max_conditions: int = 4, least_precision: float = 0.95) -> list[Rule]:
    """Sequential covering: grow a rule, prune it, keep it while it is precise, drop what it covers.

    Two thirds of the uncovered rows (by `order`, a hash) grow a rule by the best condition
    until it is pure; the last third prunes it from the end to the prefix of the largest
    (right - wrong) / covered. Learning ends at the first rule below `least_precision` or
    with fewer than 3 right rejections among the pruning rows.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules:
        grow, prune = left & (order % 3 != 0), left & (order % 3 == 0)
        if not bad[grow].any() or bad[grow].all() or not bad[prune].any():
            break
        chosen: tuple[Condition, ...] = ()
        inside = np.flatnonzero(grow)
        while len(chosen) < max_conditions and not bad[inside].all():
            own = {k: v[inside] for k, v in x.items()}
            _, c = _best_condition(own, bad[inside])
            if c is None:
                break
            chosen += (c,)
            inside = inside[_match(own, (c,))]
        if not chosen:
            break
        held = {k: v[prune] for k, v in x.items()}

        def worth(k: int) -> tuple[float, int]:
            m = _match(held, chosen[:k])
            right, wrong = int((m & bad[prune]).sum()), int((m & ~bad[prune]).sum())
            return ((right - wrong) / max(1, right + wrong), right)

        k = max(range(1, len(chosen) + 1), key=lambda k: (*worth(k), -k))
        m = _match(held, chosen[:k])
        hits, errors = int((m & bad[prune]).sum()), int((m & ~bad[prune]).sum())
        if hits < 3 or hits < least_precision * (hits + errors):
            break
        rules.append(Rule(chosen[:k], hits, errors))
        left &= ~_match(x, chosen[:k])
    return rules


def verdict(rules: list[Rule], prefix: str = "_") -> Column:
    """The list as one ordered Spark conditional: false at the first rule that fits, else true."""

    def column(name: str) -> Column:
        return FEATURES[name](lambda c: F.greatest(F.col(prefix + c), F.lit(1)).cast("double") if c in ("n_words", "word_chars", "n_lines") else F.col(prefix + c).cast("double"))

    out = F.lit(True)
    for rule in reversed(rules):
        fits = F.lit(True)
        for c in rule.conditions:
            fits = fits & ((column(c.feature) > F.lit(c.cut)) if c.above else (column(c.feature) <= F.lit(c.cut)))
        out = F.when(fits, F.lit(False)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", label: str = "quality") -> list[Rule]:
    """Learn when to reject from at most `train_rows` labelled rows (label 0 is bad).

    The rows are those whose id hashes lowest, so the sample doesn't depend on row order. A
    document with several labels, or a repeated one, counts as often as it occurs, up to the
    bound; labels without a document and null labels don't count.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_labelled"), F.col(label).alias("_label"), F.xxhash64(F.col(id_col)).alias("_order"))
    chosen = known.orderBy("_order", "_labelled", "_label").limit(train_rows)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(chosen), F.col("_id") == F.col("_labelled"))
    found = with_counts(rows, ["_id", "_label", "_order"], "_t").orderBy("_order", "_id", "_label").limit(train_rows).collect()
    if not found:
        return []
    counts = {c: np.array([r["_" + c] for r in found], float) for c in COUNTS}
    x = {k: f(lambda c: np.maximum(counts[c], 1) if c in ("n_words", "word_chars", "n_lines") else counts[c]) for k, f in FEATURES.items()}
    bad = np.array([r["_label"] == 0 for r in found])
    return learn(x, bad, np.array([r["_order"] >> 7 for r in found]))


def judge_quality(docs: DataFrame, rules: list[Rule], columns: list[str], text_col: str = "text") -> DataFrame:
    """`columns`, the base statistics, base_failed and kept for every row.

    Null texts have no words and fail; an empty table gives an empty result; repeated rows
    are judged alike; columns of `docs` that aren't asked for are not read, so clashing
    names don't matter.
    """
    counted = with_counts(docs, columns, text_col)
    base = [F.col("_" + c).alias(c) for c in COUNTS[:5]]
    return counted.select(*columns, *base, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))
