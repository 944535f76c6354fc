"""Word-piece token counts by a longest-match automaton that never goes back and never builds a piece.

Vocabulary: a piece that ends a word carries the end mark. The trie over pieces gets failure links: where no edge fits,
the longest matching piece on the way to the node is popped, then as many more as it takes until the rest is again a node
of the trie. A node keeps the node it fails to and how many pieces are popped on the way, so a word is read once, left to
right, and its pieces are only counted. The automaton runs over all distinct words of a batch in lockstep.

Defined results: null or empty text has no tokens; words are runs of characters other than space and tab to carriage
return, lower-cased; a word with a byte run that no piece covers counts as one unknown token; a word longer than LONGEST
bytes is read like any other; repeated rows get equal counts; a column named like the output is replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.words import hashes, spans, words
from granary.session import shipped

END_MARK = "</w>"  # fixed value of the vocabulary format
END = 256  # the symbol after a word's last byte
NOWHERE = -1


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the other ones from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def pieces(path: str) -> list[tuple[int, ...]]:
    """The vocabulary's entries as symbols: bytes, and END where a piece ends a word; special tokens are left out."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special, of = {x["content"] for x in content["added_tokens"]}, byte_of_char()
    out = []
    for piece in content["model"]["vocab"]:
        if piece not in special:
            body = piece.removesuffix(END_MARK)
            out.append((*map(of.__getitem__, body), *([END] if body != piece else [])))
    return out


class Automaton:
    """Trie edges as sorted keys; for each node where it fails to and how many pieces that pops."""

    def __init__(self, vocabulary: list[tuple[int, ...]]):
        edges: dict[tuple[int, int], int] = {}
        ends, parents = {}, [(NOWHERE, NOWHERE)]
        for piece in sorted(vocabulary):
            node = 0
            for symbol in piece:
                if (node, symbol) not in edges:
                    edges[node, symbol] = len(parents)
                    parents.append((node, symbol))
                node = edges[node, symbol]
            ends[node] = True
        fail, popped = [NOWHERE] * len(parents), [0] * len(parents)
        depth = [0] * len(parents)
        for node, (parent, _) in enumerate(parents[1:], 1):  # a parent comes before its children
            depth[node] = depth[parent] + 1
        for node in sorted(range(1, len(parents)), key=depth.__getitem__):
            parent, symbol = parents[node]
            if node in ends:  # the whole way is a piece
                fail[node], popped[node] = 0, 1
                continue
            at, n = fail[parent], popped[parent]
            while at != NOWHERE and (at, symbol) not in edges:
                n += popped[at]
                at = fail[at]
            if at != NOWHERE:
                fail[node], popped[node] = edges[at, symbol], n
        keys = np.array([node * 512 + symbol for node, symbol in edges], np.int64)
        order = np.argsort(keys)
        self.fail, self.popped = np.array(fail, np.int32), np.array(popped, np.int32)
        self._hash(keys[order], np.array(list(edges.values()), np.int32)[order])

    def _hash(self, keys: np.ndarray, targets: np.ndarray) -> None:
        """Edges in an open hash table, looked up for many nodes at a time."""
        self.bits = int(len(keys) * 4 - 1).bit_length()
        self.key, self.target = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NOWHERE, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):
            self.probes += 1
            free = self.key[slot[left]] < 0
            first = left[free][np.unique(slot[left[free]], return_index=True)[1]]
            self.key[slot[first]], self.target[slot[first]] = keys[first], targets[first]
            left = np.setdiff1d(left, first, assume_unique=True)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The child of each node, or NOWHERE."""
        key = node.astype(np.int64) * 512 + symbol
        slot = self._slot(key)
        out = np.where(self.key[slot] == key, self.target[slot], NOWHERE)
        open_ = np.flatnonzero((out == NOWHERE) & (self.key[slot] >= 0) & (self.key[slot] != key))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.key[slot[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.target[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word data[start:end]; 1 where the vocabulary does not cover it."""
        length = ends - starts
        order = np.argsort(-length, kind="stable")
        starts, length = starts[order], length[order]
        counts, node = np.zeros(len(order), np.int64), np.zeros(len(order), np.int32)
        longest = int(length[0]) + 1 if len(length) else 0
        for i in range(longest):
            live = int(np.searchsorted(-length, -i, "right"))  # words with a byte at i, or ending there
            at = np.minimum(starts[:live] + i, len(data) - 1)
            symbol = np.where(i < length[:live], data[at].astype(np.int64), END)
            todo = np.flatnonzero(node[:live] >= 0)
            while len(todo):
                child = self.step(node[todo], symbol[todo])
                stuck = child < 0
                node[todo[~stuck]] = child[~stuck]
                todo = todo[stuck]
                counts[todo] += self.popped[node[todo]]
                node[todo] = self.fail[node[todo]]
                todo = todo[node[todo] >= 0]
        # after the end mark only whole pieces may be left
        left = np.flatnonzero(node > 0)
        while len(left):
            counts[left] += self.popped[node[left]]
            node[left] = self.fail[node[left]]
            left = left[node[left] > 0]
        counts[node < 0] = 1
        out = np.empty_like(counts)
        out[order] = counts
        return out


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(pieces(path))


def lengths(texts: pa.Array, own: Automaton) -> np.ndarray:
    """Tokens of each text. Words are told apart by a 64-bit hash; each distinct one is read once."""
    lower = pa.array([t.lower() if t else "" for t in texts.to_pylist()], pa.string())
    w = words(lower)
    if not len(w.starts):
        return np.zeros(len(texts), np.int64)
    _, first, place = np.unique(hashes(w), return_index=True, return_inverse=True)
    of_word = own.count(w.data, w.starts[first], w.ends[first])[place]
    return np.bincount(w.row, of_word, len(texts)).astype(np.int64)


def counted(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each whole text."""
    shipped(df.sparkSession)

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = automaton(path)
        for texts in batches:
            yield pa.array(np.concatenate([lengths(piece, own) for piece in spans(texts)]), pa.int64())

    return df.withColumn(out, F.arrow_udf(count, "long")(F.col(text)))
