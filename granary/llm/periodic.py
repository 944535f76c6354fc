"""Periodic runs of words within a text, found by seeds and extended along diagonals.

A run is a stretch of words with smallest period q, at least max(LEAST, REPEATS * q) words long, that no neighbouring word
extends. On diagonal q (words q apart) it is a stretch of max(LEAST, REPEATS * q) - q equal pairs or more, so an index of
k-grams no longer than that has a seed in every run. The index is made for a ladder of lengths k: 5 words for periods up to
5, then for longer periods up to k the longest overlap that the shortest of them still guarantees, k = 3 * (last k + 1).
At least q words long, a k-gram of a run occurs next exactly q words on (an earlier occurrence would make the period
shorter), so of the pairs of occurrences only neighbouring ones are looked at: their number is linear, and a longer lag than
the smallest period is never a seed. Places whose k-gram occurs once are left out of the next steps of the ladder.

Seeds are taken lag by lag. One that lies before the end of what its lag has covered is passed over, so every run is
extended once, word by word in both directions, which also confirms the seed.

Defined results: a null, empty or blank text has no words, no runs and collapses to the empty text; texts are read whole, in
time n log n of their words; runs that overlap are all reported; repeated rows get equal runs; an empty table gives an empty
result; a column named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm.quality import SPACE_RUN, let
from granary.llm.words import BASE, mixed, spans
from granary.session import shipped

LEAST, REPEATS = 6, 4
SEED = 5  # words: the overlap that a run of period 1 guarantees
RUNS = "array<struct<start:long,length:long,period:long>>"
BLOCK = 64  # words compared at once, doubled as an extension goes on


class Numbers(dict):
    """Numbers of words by order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def longer(grams: np.ndarray, size: int, wanted: int) -> np.ndarray:
    """Hashes of all wanted-grams from those of all size-grams; overlaps are allowed, so any greater length can be made."""
    while size < wanted:
        step = min(size, wanted - size)
        grams = mixed(grams[: max(len(grams) - step, 0)] * BASE + grams[step:])
        size += step
    return grams


def same(words: np.ndarray, left: int, right: int, forward: bool) -> int:
    """How many words agree from two places on, in one direction."""
    n, block = 0, BLOCK
    while True:
        room = len(words) - right - n if forward else left + 1 - n
        size = min(block, room)
        if size <= 0:
            return n
        if forward:
            differ = words[left + n : left + n + size] != words[right + n : right + n + size]
        else:
            differ = (words[left - n - size + 1 : left - n + 1] != words[right - n - size + 1 : right - n + 1])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return n + at
        n, block = n + size, block * 2


def seeds(words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, lags): neighbouring occurrences of k-grams whose lag the length k serves, by lag and place.

    Words below 0 stand between texts and are all different.
    """
    size, shorter, text = SEED, 0, np.cumsum(words < 0)
    grams = longer(mixed(words.astype(np.uint64)), 1, size)
    places = np.arange(len(grams))
    while len(places):
        order = places[np.argsort(grams[places], kind="stable")]
        equal = (grams[order[1:]] == grams[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
        first, lag = order[:-1][equal], np.diff(order)[equal]
        served = (lag > shorter) & (lag <= size)
        by_lag = np.lexsort((first[served], lag[served]))
        yield size, first[served][by_lag], lag[served][by_lag]
        again = np.zeros(len(grams), bool)
        again[first] = again[order[1:][equal]] = True
        shorter, size = size, (REPEATS - 1) * (size + 1)
        grams = longer(grams, shorter, size)
        places = np.flatnonzero(again[: len(grams)])


def runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    out = []
    for size, places, lags in seeds(words):
        covered: dict[int, int] = {}  # lag -> end of the furthest extension
        # a seed straight after another of its lag lies in what that one covers
        fresh = np.ones(len(places), bool)
        fresh[1:] = (np.diff(places) != 1) | (np.diff(lags) != 0)
        for place, lag in zip(places[fresh].tolist(), lags[fresh].tolist()):
            if place < covered.get(lag, 0):
                continue
            ahead = same(words, place, place + lag, forward=True)
            behind = same(words, place - 1, place + lag - 1, forward=False)
            covered[lag] = place + ahead
            length = behind + ahead + lag
            if length >= max(LEAST, REPEATS * lag):
                out.append((place - behind, length, lag))
    return sorted(out, key=lambda run: (run[0], run[2]))


def analysed(texts: list[bytes]) -> list[dict]:
    """Runs and collapsed form of each text. All are searched at once, with a word of no text behind each."""
    numbers, split = Numbers(), [text.split() for text in texts]  # bytes split at exactly the six white space characters
    sizes = np.array([len(words) for words in split], np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    every = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for k, (words, start) in enumerate(zip(split, starts.tolist())):
        every[start : start + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        every[start + len(words)] = -1 - k
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs(every):
        of = int(np.searchsorted(ends, start, "right"))
        found[of].append((start - int(starts[of]), length, period))
    out = []
    for words, own in zip(split, found):
        if own:
            kept = np.ones(len(words), bool)
            for start, length, period in own:
                kept[start + period : start + length] = False
            words = [words[i] for i in np.flatnonzero(kept).tolist()]
        out.append({"runs": [{"start": a, "length": n, "period": q} for a, n, q in own], "collapsed": b" ".join(words).decode()})
    return out


def detected(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default), runs by start and period, and collapsed: the words that no run repeats, joined by a space."""
    shipped(df.sparkSession)
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("runs", "collapsed")]
    found = T.StructType([*(T.StructField(c, df.schema[c].dataType) for c in kept), *T.StructType.fromDDL(f"runs {RUNS}, collapsed string")])

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            at = 0
            for piece in spans(batch.column(len(kept))):
                rows = analysed(piece.fill_null("").cast(pa.binary()).to_pylist())
                own = batch.slice(at, len(piece))
                at += len(piece)
                columns = [pa.array([r["runs"] for r in rows], kind), pa.array([r["collapsed"] for r in rows], pa.string())]
                yield pa.RecordBatch.from_arrays([*own.columns[: len(kept)], *columns], names=found.names)

    return df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`")).mapInArrow(detect, found)


def planted(text: Column, key: Column) -> Column:
    """Text in which the words from a place on repeat, for one in ten keys; place and period follow from the key's checksum.

    Null keys and texts without words stay as they are.
    """
    whole, checksum = F.coalesce(text, F.lit("")), F.crc32(key.cast("string"))
    g = F.floor(checksum / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        periodic = lambda a, p: F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p)))
        period = lambda a: (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        changed = let((g % n).cast("int"), lambda a: let(period(a), lambda p: periodic(a, p)))
        return F.when(n > 0, F.array_join(changed, " ")).otherwise(whole)

    words = F.filter(F.split(whole, SPACE_RUN, -1), lambda w: w != "")
    return F.when(F.coalesce(checksum % 10 == 0, F.lit(False)), let(words, repeated)).otherwise(whole)


def digests(df: DataFrame) -> DataFrame:
    """Per document: number of runs, the longest one, and digests of all runs and of the collapsed text."""
    found = detected(df.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text")), keep=["doc_id"])
    # greatest length first, then smallest start and period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("brief"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", "runs", "collapsed", longest.alias("longest")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.brief")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.brief")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
