"""Vectorised text primitives over the UTF-8 bytes of Arrow string columns.

A block holds a few documents side by side in one byte array.  Hashes of any substring come
from one prefix sum, so a word, a line or an n-gram costs a subtraction and two products
whatever its length.  Nothing here ever spans two documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: bytes of text worked on at once; bounds memory whatever the Arrow batch holds
BLOCK_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = np.asarray(x, dtype=U)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n reproducible 64-bit values."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U) + U(seed * 1_000_003)) * U(0x9E3779B97F4A7C15))


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


#: white space of the words [^\x20\x09-\x0D]+
SPACE = _table(b" \t\n\x0b\x0c\r")
#: the same and ASCII punctuation: what stands between bare terms
BREAK = _table(bytes(i for i in range(128) if not chr(i).isalnum()))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: first bytes of code points
LEAD = np.array([(i & 0xC0) != 0x80 for i in range(256)])

BASE = U(0x9E3779B97F4A7C15) | U(1)
INVERSE = U(pow(int(BASE), -1, 1 << 64))
BYTE_VALUE = (stream(7, 256), stream(11, 256))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, kept and grown as needed."""
    if len(_powers["up"]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        for key, base in (("up", BASE), ("down", INVERSE)):
            factors = np.full(size, base, U)
            factors[0] = 1
            _powers[key] = np.multiply.accumulate(factors)
    return _powers["up"][:n], _powers["down"][:n]


class Block:
    """Some documents: their rows in the batch, bytes and offsets."""

    def __init__(self, first: int, buf: np.ndarray, offs: np.ndarray):
        self.first, self.buf, self.offs = first, buf, offs
        self.n = len(offs) - 1

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """Sum of a per-byte mask over each document."""
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[self.offs[1:]] - total[self.offs[:-1]]

    def spans(self, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of each maximal run of marked bytes in one document."""
        n = len(is_word)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = is_word[:-1], is_word[1:]
        edges = self.offs[:-1][self.offs[:-1] < self.offs[1:]]
        before[edges] = False
        after[edges[edges > 0] - 1] = False
        starts, ends = np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1
        return starts, ends, self.doc_of(starts)

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offs, pos, side="right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r"""Start, end and document of each \n-split line; an empty document has one empty line."""
        breaks = np.flatnonzero(self.buf == 10)
        doc = self.doc_of(breaks)
        starts = np.concatenate((self.offs[:-1], breaks + 1))
        docs = np.concatenate((np.arange(self.n), doc))
        order = np.lexsort((starts, docs))
        starts, docs = starts[order], docs[order]
        ends = np.empty_like(starts)
        ends[:-1] = starts[1:] - 1
        last = np.ones(len(starts), bool)
        last[:-1] = docs[1:] != docs[:-1]
        ends[last] = self.offs[1:][docs[last]]
        return starts, ends, docs


class Prefix:
    """Prefix sums that give the hash of any substring of a block."""

    def __init__(self, buf: np.ndarray, table: int = 0):
        up, self.down = powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, U)
        np.cumsum(BYTE_VALUE[table][buf] * up[:-1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def ngrams(hashes: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one document, and the index of each first word."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    value = np.zeros(count, U)
    for k in range(n):
        value = value * BASE + hashes[k : k + count]
    at = np.flatnonzero(docs[:count] == docs[n - 1 :])
    return mix(value[at] + U(n)), at


def repeats(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occurred earlier in their document, and which occur twice or more in it."""
    keyed = mix(hashes + docs.astype(U) * U(0xA0761D6478BD642F))
    order = np.argsort(keyed, kind="stable")
    same = keyed[order[1:]] == keyed[order[:-1]]
    later, many = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    later[order[1:][same]] = True
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    return later, many


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offs


def blocks(col: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column in runs of whole documents of about `size` bytes."""
    data, offs = string_buffers(col)
    first, n = 0, len(offs) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offs, offs[first] + size, side="right")) - 1)
        last = min(last, n, first + 4096)
        yield Block(first, data[offs[first] : offs[last]], offs[first : last + 1] - offs[first])
        first = last
