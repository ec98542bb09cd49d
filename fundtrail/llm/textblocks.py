"""Texts as byte arrays inside Arrow batches.

The text operators work on blocks: the UTF-8 bytes of several whole texts in
one numpy array plus the offsets of the texts. Spark partitions the rows; the
functions here only look at the bytes of one Arrow batch at a time. A text is
never cut: a block holds at least one whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
U64 = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(*ranges: tuple[int, int], inside: bool = True) -> np.ndarray:
    """256 flags: bytes in any of the closed ranges (or outside all of them)."""
    flags = np.full(256, not inside)
    for low, high in ranges:
        flags[low : high + 1] = inside
    return flags


# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ over lower-cased text; bytes from 0x80 belong to non-ASCII letters and signs.
WORD_BYTES = table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F), inside=False)
# [^\x20\x09-\x0D]+
TOKEN_BYTES = table((0x20, 0x20), (0x09, 0x0D), inside=False)


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of whole texts of about ``limit`` bytes."""
    data, offs = packed(column)
    low, n = 0, len(column)
    while low < n:
        high = max(low + 1, int(np.searchsorted(offs, offs[low] + limit, side="right")) - 1)
        high = min(high, n)
        yield low, high, data[offs[low] : offs[high]], offs[low : high + 1] - offs[low]
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes about half of the output bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def salts(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants drawn from the seed."""
    start = U64(seed * 1_000_003 % 2**64)
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + start) * U64(0x9E3779B97F4A7C15)) | U64(1)


_position_salts = salts(1 << 12, 1)


def _salts_for(length: int) -> np.ndarray:
    global _position_salts
    if length > len(_position_salts):
        _position_salts = salts(1 << int(length).bit_length(), 1)
    return _position_salts


def runs(data: np.ndarray, offs: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first run of each text) of the longest runs of bytes of one kind; runs end where texts end.

    The third array has one more entry than there are texts.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    mask = kind[data]
    start = mask.copy()
    start[1:] &= ~mask[:-1]
    end = mask.copy()
    end[:-1] &= ~mask[1:]
    edges = offs[:-1][offs[:-1] < len(data)]
    start[edges] |= mask[edges]
    last = offs[1:][offs[1:] > 0] - 1
    end[last] |= mask[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offs)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run."""
    if not len(starts):
        return np.zeros(0, U64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    within = np.arange(int(lens.sum())) - np.repeat(first, lens)
    at = within + np.repeat(starts, lens)
    terms = data[at].astype(U64)
    terms += U64(1)
    terms *= _salts_for(int(lens.max()))[within]
    sums = np.add.reduceat(terms, first)
    return mix(sums + lens.astype(U64) * U64(0xD6E8FEB86659FD93))


_order_salts = salts(64, 7)


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles and the text index of each.

    A text with fewer words, but at least one, gives its whole sequence as one
    shingle; a text without words gives none.
    """
    counts = np.diff(first)
    n = len(words)
    text = np.repeat(np.arange(len(counts)), counts)
    full = n - size + 1
    if full > 0:
        sums = np.zeros(full, U64)
        for k in range(size):
            sums += words[k : k + full] * _order_salts[k]
        keep = text[:full] == text[size - 1 :]
        out, owner = mix(sums[keep]), text[:full][keep]
    else:
        out, owner = np.zeros(0, U64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.zeros(len(short), U64)
        for k in range(size - 1):
            has = counts[short] > k
            extra[has] += words[first[short[has]] + k] * _order_salts[k]
        # the length keeps a short sequence apart from every full shingle
        extra = mix(extra + counts[short].astype(U64) * U64(0xA0761D6478BD642F))
        out, owner = np.concatenate([out, extra]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, owner


def distinct_sorted(values: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and the offsets of the texts. ``owner`` must be ascending."""
    values = values.copy()
    offs = np.searchsorted(owner, np.arange(texts + 1))
    for a, b in zip(offs[:-1], offs[1:], strict=True):
        values[a:b].sort()
    if not len(values):
        return values, offs
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    kept = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], kept[offs]
