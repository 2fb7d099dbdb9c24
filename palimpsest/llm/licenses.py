"""Op 8: licences by sparse TF-IDF cosine to templates, then by the nearest ancestor directory."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.batches import slices, texts
from palimpsest.llm.license_texts import TEMPLATES
from palimpsest.runtime import materialize, ship

#: A window of a text's words takes a template's licence from this cosine.
SIMILARITY = 0.85
#: Texts whose terms are laid out at once.
SLICE_ROWS = 4096
_WORD = re.compile(r"[0-9a-z]+")
_LICENCE_FILE = r"^(?i)(licen[cs]e|copying|notice)([^a-z].*)?$"


def tokens(text: str) -> list[str]:
    """Runs of a-z and 0-9 after lower-casing A-Z."""
    return _WORD.findall("".join(c.lower() if c.isascii() else c for c in text))


def split(array: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts, one after another, and where each text's begin and end."""
    parts = pc.split_pattern_regex(pc.ascii_lower(array), "[^0-9a-z]+")
    flat, parent = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.greater(pc.binary_length(flat), 0)
    parent = parent.filter(real).to_numpy(zero_copy_only=False)
    return flat.filter(real), np.searchsorted(parent, np.arange(len(array) + 1))


class Matcher:
    """Templates as sparse vectors; terms weigh by how few of the corpus's documents hold them.

    A term outside all templates weighs like one that no document holds, the most there is.
    """

    def __init__(self, templates: list[tuple[str, str, str]], df: dict[str, int], n: int) -> None:
        self.n, self.df = n, df
        self.names = [name for name, _, _ in templates]
        own = [tokens(text) for _, text, _ in templates]
        self.lengths = [len(w) for w in own]
        self.vocabulary = sorted({w for ws in own for w in ws} | {w for _, _, keys in templates for w in tokens(keys)})
        at = {w: k for k, w in enumerate(self.vocabulary)}
        self.weight = np.array([*map(self.idf, self.vocabulary), self.idf("")])  # the last: any other term
        self.vectors = np.zeros((len(templates), len(self.vocabulary) + 1))
        for k, ws in enumerate(own):
            for w, c in Counter(ws).items():
                self.vectors[k, at[w]] = c * self.idf(w)
        self.vectors /= np.sqrt((self.vectors**2).sum(axis=1, keepdims=True))
        self.keys = [sorted({at[w] for w in tokens(keys)}) for _, _, keys in templates]

    def idf(self, word: str) -> float:
        return math.log((1 + self.n) / (1 + self.df.get(word, 0))) + 1

    def candidates(self, code: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Which templates can reach SIMILARITY in which texts, as rows (text, template).

        No window can have a larger cosine than the root of the squared template weights of
        the terms that the text has at all; and it must have the template's keys.
        """
        n, v = len(edges) - 1, len(self.vocabulary)
        there = np.zeros((n, v), np.float32)
        known = code < v
        there[np.repeat(np.arange(n), np.diff(edges))[known], code[known]] = 1
        able = there @ (self.vectors[:, :v].T ** 2).astype(np.float32) >= SIMILARITY**2 - 1e-4
        for k, keys in enumerate(self.keys):
            if keys:
                able[:, k] &= there[:, keys].all(axis=1)
        return np.argwhere(able)

    def cosine(self, k: int, word: np.ndarray, code: np.ndarray) -> float:
        """The largest cosine of template `k` to any window of its length, or to a shorter text as a whole.

        `word` numbers the text's words, `code` is their place in the vocabulary. Dot products
        and norms of all windows follow from running sums: a word that enters a window which
        holds it c times adds 2 c + 1 times its squared weight, one that leaves takes 2 c - 1.
        """
        n = len(word)
        size = min(self.lengths[k], n)
        gain = np.concatenate(([0.0], np.cumsum(self.vectors[k, code] * self.weight[code])))
        place = word.astype(np.int64) * (2 * n) + np.arange(n)
        order = np.sort(place)
        rank = np.searchsorted(order, place)
        entering = rank - np.searchsorted(order, place - np.minimum(np.arange(n), size - 1))
        leaving = np.searchsorted(order, place + size) - rank
        square = self.weight[code] ** 2
        grown = np.concatenate(([0.0], np.cumsum(square * (2 * entering + 1))))
        lost = np.concatenate(([0.0], np.cumsum(square * (2 * leaving - 1))))
        last = np.arange(size, n + 1)
        norm = grown[last] - lost[last - size]
        found = (gain[last] - gain[last - size]) / np.sqrt(np.maximum(norm, 1e-12))
        for key in self.keys[k]:
            held = np.concatenate(([0], np.cumsum(code == key)))
            found = np.where(held[last] > held[last - size], found, 0.0)
        return float(found.max())

    def best(self, array: pa.Array) -> tuple[list[str | None], list[float]]:
        """Each text's licence by the closest window and its cosine; none and 0 below SIMILARITY, the first template on ties."""
        flat, edges = split(array)
        found = pc.fill_null(pc.index_in(flat, pa.array(self.vocabulary, flat.type)), len(self.vocabulary)).to_numpy(zero_copy_only=False)
        name, score = [None] * len(array), [0.0] * len(array)
        number: dict[int, np.ndarray] = {}
        for i, k in self.candidates(found, edges).tolist():
            a, b = int(edges[i]), int(edges[i + 1])
            if i not in number:
                number = {i: flat.slice(a, b - a).dictionary_encode().indices.to_numpy(zero_copy_only=False)}
            cosine = self.cosine(k, number[i], found[a:b])
            if cosine >= SIMILARITY and cosine > score[i] + 1e-9:
                name[i], score[i] = self.names[k], cosine
        return name, score


def document_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> tuple[dict[str, int], int]:
    """In how many of all documents each vocabulary term occurs, and how many there are."""
    ship(docs.sparkSession)
    known = pa.array(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(known), np.int64), 0
        for b in slices(batches, text_col):
            split = pc.split_pattern_regex(pc.ascii_lower(texts(b, text_col)), "[^0-9a-z]+")
            code = pc.index_in(pc.list_flatten(split), known)
            hit = code.is_valid()
            pairs = np.unique((pc.list_parent_indices(split).filter(hit).to_numpy().astype(np.int64) << 32) | code.filter(hit).to_numpy().astype(np.int64))
            total += np.bincount(pairs & 0xFFFFFFFF, minlength=len(known))
            n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([*vocabulary, ""]), pa.array([*total.tolist(), n])], ["term", "n"])

    rows = docs.select(text_col).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in rows}
    return found, found.pop("", 0)


def scan(files: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """doc_id, path, own_license and score of every file, over its whole text."""
    ship(files.sparkSession)
    df, n = document_frequencies(files, Matcher(templates, {}, 0).vocabulary, text_col)
    matcher = Matcher(templates, df, n)
    read = files.select(F.col(id_col).alias("doc_id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    schema = T.StructType([read.schema["doc_id"], read.schema["path"], T.StructField("own_license", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, rows=SLICE_ROWS):
            name, score = matcher.best(texts(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("path"), pa.array(name, pa.string()), pa.array(score, pa.float64())], ["doc_id", "path", "own_license", "score"])

    return read.mapInArrow(run, schema)


def directory(path: Column) -> Column:
    """All before the last slash; the empty root without one."""
    return F.regexp_extract(path, r"^(?s)(.*)/", 1)


def scan_licenses(files: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """doc_id, path, own_license, score, license, inherited_from for every file.

    A file's own licence is the template of the largest cosine to any window of its text that
    has the template's length (or to the whole of a shorter text), from SIMILARITY on.
    Without one it takes that of the nearest directory above it, its own included, in which
    a licence file (LICENSE, COPYING, NOTICE, with any ending) has one; of several the best
    score and then the first path counts. Only distinct directories are joined to their
    ancestors, so a directory with a third of all files is one row there.

    Null texts and empty ones have no licence of their own; a null path inherits nothing;
    repeated rows are judged alike; an empty table gives an empty result; other columns are
    not read.
    """
    found = materialize(scan(files, templates, id_col, path_col, text_col).withColumn("_dir", directory(F.col("path"))), "op8-scan")
    is_licence = F.col("own_license").isNotNull() & F.regexp_like(F.regexp_extract("path", r"([^/]*)$", 1), F.lit(_LICENCE_FILE))
    granted = found.filter(is_licence).groupBy("_dir").agg(F.min_by("own_license", F.struct(-F.col("score"), F.col("path"))).alias("license")).select(F.col("_dir").alias("above"), "license")
    dirs = found.filter("_dir is not null").select("_dir").distinct()
    parts = F.split("_dir", "/")
    steps = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.when(n == 0, F.lit("")).otherwise(F.array_join(F.slice(parts, 1, n), "/")))
    up = dirs.select("_dir", F.explode(F.array_distinct(steps)).alias("above"))
    nearest = up.join(granted, "above").groupBy("_dir").agg(F.max_by(F.struct("above", "license"), F.length("above")).alias("up")).select(F.col("_dir").alias("_d"), "up")
    joined = found.join(nearest, F.col("own_license").isNull() & (F.col("_dir") == F.col("_d")), "left")
    return joined.select("doc_id", "path", "own_license", "score", F.coalesce("own_license", "up.license").alias("license"), F.when(F.col("own_license").isNull(), F.col("up.above")).alias("inherited_from"))
