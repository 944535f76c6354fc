"""Byte-level BPE through a sentencepiece model that is written straight from a rank vocabulary.

No tokenizer is trained: each vocabulary entry becomes a piece of a sentencepiece BPE model. Bytes are mapped to single
characters, so that every byte string is a string of known characters; the score of a piece is its negative rank, so that
the best-scored merge is the one of lowest rank; normalisation is the identity. Pre-tokens are encoded separately.

Defined results: a null or empty text has no ids and decodes to no bytes; texts of any length are encoded whole; equal
texts have equal ids; columns named like an output are replaced, all other columns are kept.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.words import spans
from granary.session import shipped

KEPT = 200_000  # distinct pre-tokens remembered by a worker before it starts afresh
BYTE_CHARS = {b: chr(0x100 + b) for b in range(256)}
UNKNOWN_PIECE, NORMAL_PIECE, BPE_MODEL = 2, 1, 2  # fixed values of the model format


def vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(BYTE_CHARS)


def _field(number: int, value: bytes | int | float | str) -> bytes:
    """One field of a protocol buffer message."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model; the piece after the unknown one has rank 0, and so on."""
    def piece(text: str, score: float, kind: int) -> bytes:
        return _field(1, _field(1, text) + _field(2, score) + _field(3, kind))

    pieces = [piece("<unk>", 0.0, UNKNOWN_PIECE)]
    pieces += [piece(mapped(token), -float(rank), NORMAL_PIECE) for token, rank in sorted(ranks.items(), key=lambda x: x[1])]
    trainer = _field(3, BPE_MODEL) + _field(4, len(pieces))
    identity = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, identity)


class Codec:
    """Encodes and decodes with one vocabulary; lives in a worker."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = vocabulary(path)
        by_rank = sorted(self.ranks.items(), key=lambda x: x[1])
        self.tokens = dict((rank, token) for token, rank in by_rank)
        self.rank_of_piece = [0, *(rank for _, rank in by_rank)]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self.pre_tokens = regex.compile(pattern).findall
        self.packed: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, end to end."""
        parts = self.pre_tokens(text)
        if unseen := set(parts).difference(self.packed):
            if len(self.packed) + len(unseen) > KEPT:
                self.packed, unseen = {}, set(parts)
            self._learn(list(unseen))
        return b"".join(map(self.packed.__getitem__, parts))

    def _learn(self, parts: list[str]) -> None:
        coded = [part.encode() for part in parts]
        for part, token in zip(parts, coded):
            if token in self.ranks:  # a token by itself, whether or not merges lead to it
                self.packed[part] = struct.pack("<I", self.ranks[token])
        rest = [(part, mapped(token)) for part, token in zip(parts, coded) if token not in self.ranks]
        for (part, _), pieces in zip(rest, self.model.encode([text for _, text in rest], num_threads=1)):
            self.packed[part] = struct.pack(f"<{len(pieces)}I", *map(self.rank_of_piece.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _applied(df: DataFrame, kind: str, column: str, work) -> Column:
    """work(texts or ids of a small piece) on whole Arrow batches."""
    shipped(df.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([work(piece.to_pylist()) for piece in spans(batch)])

    return F.arrow_udf(run, kind)(F.col(column))


def encoded(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the packed ids of every text."""
    def encode(texts: list) -> pa.Array:
        own = codec(path, pattern)
        return pa.array([own.encode(t or "") for t in texts], pa.binary())

    return df.withColumn(ids, _applied(df, "binary", text, encode))


def decoded(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that packed ids stand for."""
    def decode(packed: list) -> pa.Array:
        own = codec(path, pattern)
        return pa.array([own.decode(x or b"") for x in packed], pa.binary())

    return df.withColumn(out, _applied(df, "binary", ids, decode))


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ids and decoded in one go, so that a task has one worker and one copy of the vocabulary."""
    def there_and_back(texts: list) -> pa.Array:
        own = codec(path, pattern)
        ids = [own.encode(t or "") for t in texts]
        columns = [pa.array(ids, pa.binary()), pa.array(map(own.decode, ids), pa.binary())]
        return pa.StructArray.from_arrays(columns, ["ids", "decoded"])

    kept = [c for c in df.columns if c.lower() not in ("ids", "decoded")]
    both = df.withColumn("_both", _applied(df, "ids binary, decoded binary", text, there_and_back))
    return both.select(*kept, "_both.ids", "_both.decoded")


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: token count, and digests of its ids and of what they decode to."""
    return round_trip(df.select("doc_id", "text"), path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
