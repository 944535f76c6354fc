"""Words, word hashes and word shingles of whole Arrow text columns, in numpy.

A word is a maximal run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
Memory is bounded by the Arrow batch: eight bytes a word, and scratch of PIECE bytes at a time (or one longer word).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
PIECE = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers, dtype=np.uint64)


INVERSE = pow(int(BASE), -1, 1 << 64)
POWERS, INVERSES = _powers(int(BASE), PIECE), _powers(INVERSE, PIECE)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each text starts in them (one entry more than texts); null is empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(texts: pa.Array, most: int = 1 << 22) -> Iterator[pa.Array]:
    """The column cut into pieces of at most so many bytes, or of one longer text; one empty piece if it is empty."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes), 0
    while at < len(texts) or at == 0:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield texts.slice(at, end - at)
        at = end


@dataclass
class Words:
    """All words of a column: byte ranges in data, the row of each, and the first word of each row (one entry more)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray


def words(texts: pa.Array) -> Words:
    data, offsets = text_bytes(texts)
    inside = ~IS_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[heads] = False  # a word ends with its text
    after[heads[1:] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(data, starts, ends, row, first)


def hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, read off running sums."""
    out, i = np.empty(len(w.starts), np.uint64), 0
    while i < len(out):
        low = w.starts[i]
        j = max(i + 1, int(np.searchsorted(w.ends, low + PIECE, "right")))
        piece = w.data[low : w.ends[j - 1]].astype(np.uint64) + np.uint64(1)
        long = len(piece) > PIECE  # one word
        powers = _powers(int(BASE), len(piece)) if long else POWERS[: len(piece)]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * powers, out=sums[1:])
        start, end = w.starts[i:j] - low, w.ends[i:j] - low
        out[i:j] = (sums[end] - sums[start]) * INVERSES[start]
        i = j
    return mixed(out)


def shingles(w: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row) of every run of width words. A row with fewer words has one shingle, all its words; without words, none."""
    h = hashes(w)
    n = len(h)
    if not n:
        return h, w.row
    run = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        run = run * BASE + h[k : k + len(run)]
    whole = w.row[: len(run)] == w.row[width - 1 :]
    row = w.row[: len(run)][whole]
    run = mixed(run[whole])
    counts = np.diff(w.first)
    few = np.flatnonzero((counts > 0) & (counts < width))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for k in range(width - 1):
            has = counts[few] > k
            short[has] = short[has] * BASE + h[w.first[few[has]] + k]
        run = np.concatenate([run, mixed(short + np.uint64(1))])
        row = np.concatenate([row, few])
        order = np.argsort(row, kind="stable")
        run, row = run[order], row[order]
    return run, row


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """One array of distinct keys, and their counts."""
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    return [key], [np.bincount(place, np.concatenate(counts), len(key)).astype(np.int64)]
