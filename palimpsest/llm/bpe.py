"""Token ids of whole texts, exactly as the tokenizers library gives them, by repeated pieces.

A byte-level pre-tokenizer of the form `... | ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`
never lets a piece run from a non-space character into a space: only the first character of
a piece can be a space that other kinds follow. So a text may be cut before any space that
follows a non-space, and each part encoded alone. Natural text repeats such parts, so each
distinct part of a batch is encoded once.
"""

from __future__ import annotations

import base64
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space after any other white space: cuts before it are not safe.
DOUBLE_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
#: Parts kept from batch to batch, and characters above which a part goes to the library.
CACHE, LONG_PART = 100_000, 400
#: Text bytes encoded at once.
SLICE = 6 << 20


class Encoder:
    """Encodes with the library's file; with the same vocabulary as ranks, faster for plain parts.

    `ranks_path` must hold the same vocabulary as `json_path` in merge order; without it every
    part goes through the library.
    """

    def __init__(self, json_path: str, ranks_path: str | None = None, pattern: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(json_path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.plain = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding("parts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.kind = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.cache: dict[str, bytes] = {}

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _part(self, part: str) -> list[int]:
        if self.plain is None or len(part) > LONG_PART or any(a in part for a in self.added):
            return self.whole(part)
        return self.plain._core_bpe.encode_ordinary(part)

    def _parts(self, parts: list[str], common: list[bool]) -> list[bytes]:
        """The ids of each part; only common parts are kept for later batches."""
        cache, kind, out = self.cache, self.kind.char, []
        if len(cache) > CACHE:
            cache.clear()
        for p, again in zip(parts, common):
            ids = cache.get(p)
            if ids is None:
                ids = array(kind, self._part(p)).tobytes()
                if again:
                    cache[p] = ids
            out.append(ids)
        return out

    def encode(self, held: pa.Array, counts_only: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Tokens of each text and, unless `counts_only`, all ids one after another."""
        n = len(held)
        if not n:
            return np.zeros(0, np.int64), None if counts_only else np.zeros(0, np.uint32)
        odd = pc.match_substring_regex(held, DOUBLE_SPACE).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(odd), "", held), " ")
        flat = split.flatten()
        edges = split.offsets.to_numpy()
        edges = edges - edges[0]
        coded = flat.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        known = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        first = edges[:-1]
        often = (np.bincount(code, minlength=len(known)) > 2).tolist()
        firsts, code[first] = np.unique(code[first], return_inverse=True)
        rest = np.ones(len(code), bool)
        rest[first] = False
        code[rest] += len(firsts)
        lists = self._parts([known[k] for k in firsts], [False] * len(firsts)) + self._parts([" " + p for p in known], often)
        for k in np.flatnonzero(odd):
            code[edges[k]] = len(lists)
            lists.append(array(self.kind.char, self.whole(held[int(k)].as_py())).tobytes())
        size = np.fromiter(map(len, lists), np.int64, len(lists)) // self.kind.itemsize
        sizes = size[code]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        counts = upto[edges[1:]] - upto[edges[:-1]]
        if counts_only:
            return counts, None
        ids = np.frombuffer(b"".join(lists), self.kind).astype(np.uint32)
        begin = np.cumsum(size) - size
        return counts, ids[np.repeat(begin[code] - upto[:-1], sizes) + np.arange(upto[-1])]


_encoders: dict[tuple, Encoder] = {}


def encoder(json_path: str, ranks_path: str | None = None, pattern: str | None = None) -> Encoder:
    """One encoder for each Python worker and file."""
    key = (json_path, ranks_path, pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]
