"""Op 4: token counts, huge documents by overlap resynchronisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.batches import slices, texts
from palimpsest.llm.bpe import SLICE, Encoder, encoder
from palimpsest.runtime import ship

#: A text above HUGE bytes is encoded in chunks of CHUNK bytes that overlap by OVERLAP bytes.
HUGE, CHUNK, OVERLAP = 1 << 15, 1 << 14, 256


def _byte_lengths(library) -> np.ndarray:
    """UTF-8 bytes each id stands for: one character of a byte-level token for each byte."""
    out = np.zeros(library.get_vocab_size(with_added_tokens=True), np.int64)
    for token, k in library.get_vocab(with_added_tokens=True).items():
        out[k] = len(token)
    for k, token in library.get_added_tokens_decoder().items():
        out[k] = len(token.content.encode())
    return out


def _boundary(data: bytes, at: int) -> int:
    """The first character boundary at or after `at`."""
    while at < len(data) and (data[at] & 0xC0) == 0x80:
        at += 1
    return at


class Resynchroniser:
    """Encodes a huge text chunk by chunk and splices where both sides provably agree.

    A position between a printable ASCII character and an ASCII space or line break is a
    piece boundary in every chunk that holds both: no piece runs from a non-space into a
    space, and no added token holds a space. Left of it a chunk's tokens depend on nothing
    beyond the space; right of it on nothing before. So two neighbouring chunks are spliced
    at such a position inside their overlap if both have a token edge there. Without one
    the overlap grows fourfold, at most to the end of the text.
    """

    def __init__(self, enc: Encoder, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        self.enc, self.chunk, self.overlap = enc, chunk, overlap
        self.length = _byte_lengths(enc.library)
        self.widened = 0

    def _edges(self, data: bytes, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.enc.whole(data[a:b].decode()), np.int64)
        edges = a + np.concatenate(([0], np.cumsum(self.length[ids])))
        if edges[-1] != b:
            raise ValueError("the tokens' bytes don't add up to the chunk's")
        return ids, edges

    @staticmethod
    def _stable(data: bytes, a: int, b: int) -> np.ndarray:
        """Positions p in (a, b) with a printable ASCII character before and a space at p."""
        part = np.frombuffer(data[a:b], np.uint8)
        space = (part[1:] == 32) | ((part[1:] >= 9) & (part[1:] <= 13))
        return a + 1 + np.flatnonzero(space & (part[:-1] > 32) & (part[:-1] < 127))

    def encode(self, text: str) -> np.ndarray:
        data = text.encode()
        out, begin = [], 0  # `begin`: where the tokens still needed start, inside the left chunk
        a = 0
        b = _boundary(data, min(len(data), self.chunk))
        ids, edges = self._edges(data, a, b)
        while b < len(data):
            overlap, at = self.overlap, None
            left = _boundary(data, max(a + 1, b - overlap))
            while True:
                stable = self._stable(data, max(left, begin + 1), b)
                stable = stable[np.isin(stable, edges)]
                if len(stable):
                    right_end = _boundary(data, min(len(data), left + self.chunk + (b - left)))
                    r_ids, r_edges = self._edges(data, left, right_end)
                    both = stable[np.isin(stable, r_edges)]
                    if len(both):
                        at = int(both[len(both) // 2])
                        break
                if b == len(data):
                    break
                overlap *= 4
                self.widened += 1
                b = _boundary(data, min(len(data), b + overlap))
                ids, edges = self._edges(data, a, b)
            if at is None:
                break
            out.append(ids[np.searchsorted(edges, begin) : np.searchsorted(edges, at)])
            a, b, ids, edges, begin = left, right_end, r_ids, r_edges, at
        out.append(ids[np.searchsorted(edges, begin) :])
        return np.concatenate(out)


def count_tokens(docs: DataFrame, json_path: str, ranks_path: str | None = None, pattern: str | None = None, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Token counts of every whole text, in one narrow pass.

    Null texts count as empty (0 tokens); repeated rows, null ids and ties are counted like
    any row; an empty table gives an empty result; other columns are not read.
    """
    ship(docs.sparkSession)
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([read.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(json_path, ranks_path, pattern)
        splice = Resynchroniser(enc, chunk, overlap)
        for b in slices(batches, limit=SLICE):
            array = texts(b)
            size = pc.binary_length(array).to_numpy(zero_copy_only=False).astype(np.int64)
            long = size > huge
            counts, _ = enc.encode(pc.if_else(pa.array(long), "", array), counts_only=True)
            for k in np.flatnonzero(long):
                counts[k] = len(splice.encode(array[int(k)].as_py()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size), pa.array(counts), pa.array(counts > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return read.mapInArrow(run, schema)
