"""Context-tree weighting over byte contexts, each byte decomposed into eight binary decisions.

A key is a context of DEPTH bytes, most recent first, and the byte that follows it. Bytes
are those of the A-Z lower-cased text and one end byte; contexts reach no further back
than the text's start, before which there are end bytes. The end byte 0xFF occurs in no
UTF-8 text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END = 0xFF
#: Bytes of context.
DEPTH = 5
#: Entries of an index table; a slice with more distinct contexts is sorted instead.
TABLE = 1 << 24


def stream(array: pa.Array, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes with `depth` end bytes before the first and after each.

    Also how many bytes each text and those before it take, end bytes included: of a text's
    end bytes only the first counts, the others keep contexts apart.
    """
    tail = pa.scalar(bytes([END]) * depth, pa.large_binary())
    joined = pc.binary_join_element_wise(pc.ascii_lower(array).cast(pa.large_binary()), tail, pa.scalar(b"", pa.large_binary()))
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return np.concatenate((np.full(depth, END, np.uint8), data)), offsets[1:] - offsets[0]


def index(data: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """For each position from `depth` on, the number of its key among the distinct keys; the keys.

    Contexts are numbered level by level: the number of the last k bytes and the next byte
    give the number of the last k + 1, through a table of those that occur.
    """
    present = np.flatnonzero(np.bincount(data, minlength=256))
    a = len(present)
    rank = np.zeros(256, np.int32)
    rank[present] = np.arange(a)
    symbol = rank[data]
    number, keys = symbol, present.astype(np.uint64)
    for _ in range(depth):
        pair = number[:-1].astype(np.int64) * a + symbol[len(symbol) - len(number) + 1 :]
        if len(keys) * a <= TABLE:
            seen = np.zeros(len(keys) * a, bool)
            seen[pair] = True
            distinct = np.flatnonzero(seen)
            table = np.zeros(len(seen), np.int32)
            table[distinct] = np.arange(len(distinct), dtype=np.int32)
            number = table[pair]
        else:
            distinct, number = np.unique(pair, return_inverse=True)
            number = number.astype(np.int32)
        keys = (keys[distinct // a] << np.uint64(8)) | present[distinct % a].astype(np.uint64)
    # Oldest byte first up to here; turn the context round.
    out = np.zeros(len(keys), np.uint64)
    for i in range(depth):
        out |= ((keys >> np.uint64(8 * (depth - i))) & np.uint64(255)) << np.uint64(8 * (i + 1))
    return number, (out | (keys & np.uint64(255))).astype(np.int64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma(x) for x > 0, by Stirling's series beyond 8."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    low = x < 8
    while low.any():
        shift[low] -= np.log(x[low])
        x = np.where(low, x + 1, x)
        low = x < 8
    y = 1 / (x * x)
    return shift + (x - 0.5) * np.log(x) - x + 0.9189385332046727 + (1 / 12 - (1 / 360 - (1 / 1260 - y / 1680) * y) * y) / x


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - 1.1447298858494002


class Level:
    """The binary nodes of all contexts of one depth: id, counts, ln of the weighted probability."""

    def __init__(self, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: Level | None) -> None:
        self.node, self.zeros, self.ones = node, zeros.astype(float), ones.astype(float)
        self.estimate = log_kt(self.zeros, self.ones)
        if below is None:
            self.weighted, self.stop = self.estimate, np.ones(len(node))
        else:
            parent = ((below.node >> 16) << 8) | (below.node & 255)
            self.mix(np.bincount(np.searchsorted(node, parent), weights=below.weighted, minlength=len(node)))

    def mix(self, children: np.ndarray) -> None:
        """Weigh stopping here against the children's product, half and half at first."""
        half = np.log(0.5)
        self.weighted = np.logaddexp(half + self.estimate, half + children)
        self.stop = np.exp(half + self.estimate - self.weighted)


def nodes_of(context: np.ndarray, byte: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node ids (context, path of bits behind a leading 1) with their zero and one counts, sorted."""
    ids, zeros, ones = [], [], []
    for k in range(8):
        ids.append((context << 8) | (1 << k) | (byte >> (8 - k)))
        bit = (byte >> (7 - k)) & 1
        zeros.append(count * (1 - bit))
        ones.append(count * bit)
    every, back = np.unique(np.concatenate(ids), return_inverse=True)
    return every, np.bincount(back, np.concatenate(zeros), len(every)), np.bincount(back, np.concatenate(ones), len(every))


def subtree(keys: np.ndarray, counts: np.ndarray, top: int, depth: int = DEPTH) -> dict[int, Level]:
    """Levels `depth` up to `top` over keys that hold all of each of their depth-`top` contexts."""
    keys, counts = keys[counts > 0], counts[counts > 0]
    levels: dict[int, Level] = {}
    below = None
    for d in range(depth, top - 1, -1):
        context, byte = keys >> (8 * (depth - d + 1)), keys & 255
        pair, back = np.unique((context << 8) | byte, return_inverse=True)
        levels[d] = below = Level(*nodes_of(pair >> 8, pair & 255, np.bincount(back, counts, len(pair))), below)
    return levels


def code_length(keys: np.ndarray, levels: dict[int, Level], depth: int = DEPTH) -> np.ndarray:
    """log10 of the model's probability of each key's byte in its context.

    At each of the eight decisions the estimates along the context path are mixed from the
    deepest up by the posterior weights. A context that training never saw at a decision
    says nothing there: the mixture begins at the deepest one it did see, and at one half
    where it saw none, so the two outcomes always sum to 1.
    """
    out = np.zeros(len(keys))
    byte = keys & 255
    for k in range(8):
        path, bit = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1
        p, begun = np.full(len(keys), 0.5), np.zeros(len(keys), bool)
        for d in range(depth, -1, -1):
            level = levels[d]
            if not len(level.node):
                continue
            want = ((keys >> (8 * (depth - d + 1))) << 8) | path
            at = np.minimum(np.searchsorted(level.node, want), len(level.node) - 1)
            seen = level.node[at] == want
            own = (np.where(bit == 1, level.ones[at], level.zeros[at]) + 0.5) / (level.zeros[at] + level.ones[at] + 1)
            stop = np.where(begun, level.stop[at], 1.0)
            p = np.where(seen, stop * own + (1 - stop) * p, p)
            begun |= seen
        out += np.log10(p)
    return out
