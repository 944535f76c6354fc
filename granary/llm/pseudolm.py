"""Score documents by masked pseudo-likelihood: every word is predicted from its neighbours on both sides.

A word is drawn in two steps: its class given the classes of the two words before and after it, by a small network
trained here in numpy, and the word given its class and the classes of the words next to it. The most frequent words are
classes of their own, all others share classes by their hash. The second step is an even mixture of the word's share of
its class, and of its share among the words of its class that stood beside such neighbours; the latter leaves out the
word's own place. The score is the sum of the logarithms over all words of a text.

Every document takes part in training, in one of ROUNDS rounds: in a round each task makes a pass over its documents from
the same start, and the networks are averaged by the words they have seen, which is the start of the next round.

Every word has its own counts. Those of words at least one in FREQUENT, a bounded number, are sent to every task. All
other words are sent in packed form, with their neighbours, to a task for each range of words, which counts and answers
them; the ranges grow in number with the input, and no such word is more than one in FREQUENT, so none is large.

Defined results: null, empty or blank text has no words and scores 0; texts are scored whole; outside a text is a class of
its own; repeated rows get equal scores; an empty table gives an empty result; scores may differ when the input is split
otherwise, as the network is averaged over tasks; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.words import added, hashes, spans, words
from granary.session import shipped, stored, unused

OUTSIDE, OWN, SHARED_BITS = 0, 63, 6  # classes: outside a text, a word each, and 2 ** SHARED_BITS by hash
CLASSES = 1 + OWN + (1 << SHARED_BITS)
REACH = (-2, -1, 1, 2)
WIDTH, HIDDEN = 12, 24
FREQUENT = 1 << 16
BATCH, RATE, SEED, ROUNDS = 2048, 0.005, 7, 4
RANGE = 1 << 19  # words to a range
HEADS = 1 << 10  # groups in which what needs no answer is passed on
MERGED = 1 << 20  # new words that a task gathers before it adds them up
BLOCK = 1 << 12  # counts beside neighbours that are sent in one row
SAFE = 50  # scores up to here are exponentiated as they are


def counted(texts: DataFrame) -> DataFrame:
    """word (a hash), n over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in batches:
            for piece in spans(batch["text"]):
                found, n = np.unique(hashes(words(piece)), return_counts=True)
                keys.append(found)
                counts.append(n)
                if sum(map(len, keys[1:])) > len(keys[0]) + MERGED:
                    keys, counts = added(keys, counts)
        (key,), (n,) = added(keys, counts)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["word", "n"])

    return texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The class of every word, and the counts of frequent words and of classes."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.sum("n")).first()[0] or 0
        own = counts.orderBy(F.desc("n"), "word").limit(OWN).toArrow()
        self.own = np.sort(own["word"].to_numpy().view(np.uint64))
        self.frequent, self.n_frequent = np.zeros(0, np.uint64), np.zeros(0)
        self.size, self.n_rare = np.ones(CLASSES), 0
        if not total:
            return
        others = counts.where(~F.col("word").isin(own["word"].to_pylist()))
        frequent = F.col("n") * FREQUENT >= total
        table = others.where(frequent).toArrow()  # FREQUENT rows at most
        shared = F.shiftrightunsigned("word", 64 - SHARED_BITS).cast("int").alias("shared")
        sizes = others.groupBy(shared).agg(F.sum("n").alias("n")).toArrow()
        self.size[1 + OWN + sizes["shared"].to_numpy()] = sizes["n"].to_numpy()
        word, n = table["word"].to_numpy().view(np.uint64), table["n"].to_numpy()
        order = np.argsort(word)
        self.frequent, self.n_frequent = word[order], n[order].astype(np.float64)
        self.n_rare = int(self.size[1 + OWN :][sizes["shared"].to_numpy()].sum() - n.sum())

    @staticmethod
    def _shared(word: np.ndarray) -> np.ndarray:
        return (word >> np.uint64(64 - SHARED_BITS)).astype(np.int64)

    @staticmethod
    def _find(table: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, word), max(len(table) - 1, 0))
        return at, (table[at] == word if len(table) else np.zeros(len(word), bool))

    def classes(self, word: np.ndarray) -> np.ndarray:
        at, known = self._find(self.own, word)
        return np.where(known, 1 + at, 1 + OWN + self._shared(word))

    def in_frequent(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the frequent words, whether the word is one)."""
        return self._find(self.frequent, word)

    def is_rare(self, word: np.ndarray) -> np.ndarray:
        return ~self._find(self.own, word)[1] & ~self.in_frequent(word)[1]

    def found(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(class, place among the frequent words, whether the word is one, whether it is rare), each looked up once."""
        at, own = self._find(self.own, word)
        cls = np.where(own, 1 + at, 1 + OWN + self._shared(word))
        others = np.flatnonzero(~own)
        at[others], among = self.in_frequent(word[others])
        frequent, rare = np.zeros(len(word), bool), np.zeros(len(word), bool)
        frequent[others], rare[others] = among, ~among
        return cls, at, frequent, rare

    def log_in_class(self, word: np.ndarray) -> np.ndarray:
        """Of a word's share of its class; minus infinity for rare words, whose counts are in no table."""
        at, frequent = self.in_frequent(word)
        out = np.full(len(word), -np.inf)
        out[frequent] = np.log(self.n_frequent[at[frequent]] / self.size[self.classes(word[frequent])])
        out[self._find(self.own, word)[1]] = 0.0
        return out


def contexts(cls: np.ndarray, row: np.ndarray) -> np.ndarray:
    """words x REACH: classes of the neighbours in the same text."""
    out = np.full((len(cls), len(REACH)), OUTSIDE, np.int64)
    for k, reach in enumerate(REACH):
        a, b = (slice(-reach, None), slice(None, reach)) if reach < 0 else (slice(None, -reach), slice(reach, None))
        out[a, k] = np.where(row[a] == row[b], cls[b], OUTSIDE)
    return out


PLACES = np.arange(CLASSES * WIDTH).reshape(CLASSES, WIDTH)  # of the embedding of each class
ONES = np.ones(CLASSES, np.float32)


class Network:
    """Embeddings of the neighbours, a hidden layer, and a softmax over classes; trained with Adam."""

    SHAPES = ((CLASSES, WIDTH), (len(REACH) * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,))

    def __init__(self, flat: np.ndarray | None = None):
        if flat is None:
            random = np.random.default_rng(SEED)
            self.parts = [(random.standard_normal(s) * (0.1 if len(s) > 1 else 0)).astype(np.float32) for s in self.SHAPES]
        else:
            ends = np.cumsum([int(np.prod(s)) for s in self.SHAPES])
            self.parts = [part.reshape(s).astype(np.float32) for part, s in zip(np.split(flat, ends[:-1]), self.SHAPES)]
        self.first = [np.zeros_like(p) for p in self.parts]
        self.second = [np.zeros_like(p) for p in self.parts]
        self.steps = 0

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts]).astype(np.float64)

    def hidden(self, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(embeddings of the neighbours, the hidden layer and a column of ones for the bias behind it)."""
        embedded, inner, inner_bias = self.parts[:3]
        x = np.take(embedded, near, axis=0).reshape(len(near), -1)
        hidden = np.ones((len(near), HIDDEN + 1), np.float32)
        np.tanh(x @ inner + inner_bias, out=hidden[:, :HIDDEN])
        return x, hidden

    def scores(self, hidden: np.ndarray) -> np.ndarray:
        """Of every class, up to a number for each row; their exponentials and sums of these are finite and not 0."""
        outer = np.vstack(self.parts[3:])
        score = hidden @ outer
        if not np.abs(outer).sum(axis=0).max() <= SAFE:  # no score is above this sum, as the hidden layer is within 1
            score -= score.max(axis=1, keepdims=True)
        return score

    def log_probability(self, near: np.ndarray, cls: np.ndarray) -> np.ndarray:
        out = np.empty(len(cls))
        for at in range(0, len(cls), BATCH):
            score = self.scores(self.hidden(near[at : at + BATCH])[1])
            chosen = score[np.arange(len(score)), cls[at : at + BATCH]]
            out[at : at + BATCH] = chosen - np.log(np.exp(score, out=score) @ ONES)
        return out

    def learn(self, near: np.ndarray, cls: np.ndarray) -> None:
        """One step on a batch."""
        x, hidden = self.hidden(near)
        p = self.scores(hidden)
        total = np.exp(p, out=p) @ ONES
        p[np.arange(len(p)), cls] -= total
        share = (1 / (len(p) * total))[:, None]  # rows of p are divided where they are narrow
        back = (p @ self.parts[3].T) * (share * (1 - hidden[:, :HIDDEN] ** 2))
        places = np.take(PLACES, near, axis=0).ravel()
        embedded = np.bincount(places, (back @ self.parts[1].T).ravel(), CLASSES * WIDTH).reshape(CLASSES, WIDTH)
        behind = p.T @ (share * hidden)
        slopes = [embedded.astype(np.float32), x.T @ back, back.sum(axis=0), behind[:, :HIDDEN].T, behind[:, HIDDEN]]
        self.steps += 1
        pace = RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for part, first, second, slope in zip(self.parts, self.first, self.second, slopes):
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            part -= pace * first / (np.sqrt(second) + 1e-8)


def round_of(text: str) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(ROUNDS))


def trained(texts: DataFrame, vocabulary: Vocabulary) -> Network:
    """The network after ROUNDS rounds, each the average of what the tasks train on the documents of that round.

    texts: text, and its round where that is known already.
    """
    network = Network()
    texts = texts if "round" in texts.columns else texts.withColumn("round", round_of("text"))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = Network(network.flat()), 0
        for batch in batches:
            for piece in spans(batch["text"]):
                w = words(piece)
                cls = vocabulary.classes(hashes(w))
                near = contexts(cls, w.row)
                for at in range(0, len(cls), BATCH):
                    own.learn(near[at : at + BATCH], cls[at : at + BATCH])
                seen += len(cls)
        if seen:
            flat = own.flat()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), seen))], ["at", "value", "seen"])

    for part in range(ROUNDS):
        some = texts.where(F.col("round") == part).select("text")
        sums = some.mapInArrow(train, "at long, value double, seen long").groupBy("at").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
        table = sums.orderBy("at").toArrow()  # a row for each weight of the network
        if table.num_rows:
            network = Network(table["value"].to_numpy() / table["seen"].to_numpy())
    return network


# --- the word given its class and neighbours -------------------------------------------------------------------------


def log_beside(n: np.ndarray, size: np.ndarray, beside: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Of a word with n of size occurrences in its class, beside of around of those next to such neighbours."""
    alone = n / size
    return np.log(np.where(around > 0, (alone + beside / np.maximum(around, 1)) / 2, alone))


@dataclass
class Neighbours:
    """How often classes, and frequent words, stand after (0) and before (1) a class."""

    classes: np.ndarray  # side x neighbour x class
    frequent: np.ndarray  # frequent word x side x neighbour

    def around(self, left: np.ndarray, right: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Occurrences of the class next to either neighbour, other than this one."""
        return self.classes[0, left, cls] + self.classes[1, right, cls] - 2

    def log_known(self, vocabulary: Vocabulary, cls: np.ndarray, at: np.ndarray, frequent: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of own and frequent words, as found in the vocabulary; 0 for rare ones, which are answered elsewhere."""
        out = np.zeros(len(cls))
        at, left, right, cls = at[frequent], left[frequent], right[frequent], cls[frequent]
        beside = self.frequent[at, 0, left].astype(np.float64) + self.frequent[at, 1, right] - 2
        out[frequent] = log_beside(vocabulary.n_frequent[at], vocabulary.size[cls], beside, self.around(left, right, cls))
        return out


def neighbour_counts(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """block, at, n: the counts of each task that are not 0, as a row for BLOCK places."""
    places, cells = 2 * CLASSES * CLASSES, 2 * CLASSES * len(vocabulary.frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(places + cells, np.int64)
        for batch in batches:
            for piece in spans(batch["text"]):
                w = words(piece)
                cls, at, frequent, _ = vocabulary.found(hashes(w))
                near = contexts(cls, w.row)
                at = at[frequent]
                for side, reach in enumerate((1, 2)):
                    np.add.at(sums, (side * CLASSES + near[:, reach]) * CLASSES + cls, 1)
                    np.add.at(sums, places + (2 * at + side) * CLASSES + near[frequent, reach], 1)
        seen = np.flatnonzero(sums)
        blocks, starts = np.unique(seen // BLOCK, return_index=True)
        for block, at in zip(blocks.tolist(), np.split(seen, starts[1:])):
            sent = [[block], [(at % BLOCK).astype(np.uint16).tobytes()], [sums[at].tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(sent, (pa.int64(), pa.binary(), pa.binary()))], ["block", "at", "n"])

    return texts.mapInArrow(count, "block long, at binary, n binary")


def neighbours(texts: DataFrame, vocabulary: Vocabulary) -> Neighbours:
    places, cells = 2 * CLASSES * CLASSES, 2 * CLASSES * len(vocabulary.frequent)

    def add(table: pa.Table) -> pa.Table:
        sums = np.zeros(BLOCK, np.int64)
        for at, n in zip(table["at"].to_pylist(), table["n"].to_pylist()):
            sums[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int64)
        return pa.table({"block": table["block"][:1], "n": pa.array([sums.tobytes()], pa.binary())})

    table = neighbour_counts(texts, vocabulary).groupBy("block").applyInArrow(add, "block long, n binary").toArrow()
    sums = np.zeros((-(-(places + cells) // BLOCK), BLOCK))
    for block, n in zip(table["block"].to_pylist(), table["n"]):
        sums[block] = np.frombuffer(n.as_buffer(), np.int64)
    sums = sums.ravel()[: places + cells]
    return Neighbours(sums[:places].reshape(2, CLASSES, CLASSES), sums[places:].reshape(-1, 2, CLASSES).astype(np.uint32))


def packed(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of SENT."""
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["piece", "range", "a", "b", "c"])


# of a piece of the table: rows, numbers of words and scores (range below 0); rare words, neighbours and rows in the piece
SENT = "piece long, range long, a binary, b binary, c binary"


def scored(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, log_likelihood, and mean_log_likelihood of a word."""
    shipped(df.sparkSession)
    row = unused("row", df.columns)
    part = unused("round", df.columns)
    # a folder for each round of training, so that a round reads its own documents alone
    numbered = df.withColumn(row, F.monotonically_increasing_id()).withColumn(part, round_of(text))
    rows = stored(numbered, "rows", by=part)
    texts = rows.select(F.col(f"`{text}`").alias("text"), F.col(part).alias("round"))
    vocabulary = Vocabulary(stored(counted(texts.select("text")), "words"))
    network, beside = trained(texts, vocabulary), neighbours(texts.select("text"), vocabulary)
    ranges = vocabulary.n_rare // RANGE + 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for piece in spans(batch["text"]):
                if not len(piece):
                    continue
                own = batch["row"].slice(at, len(piece)).to_numpy()
                at += len(piece)
                w = words(piece)
                h = hashes(w)
                cls, at_frequent, frequent, is_rare = vocabulary.found(h)
                near = contexts(cls, w.row)
                each = network.log_probability(near, cls) + beside.log_known(vocabulary, cls, at_frequent, frequent, near[:, 1], near[:, 2])
                total = np.bincount(w.row, each, len(piece)).astype(np.float64)
                name = int(own[0])
                out = [(name, -1 - name % HEADS, own.astype(np.int64).tobytes(), np.diff(w.first).astype(np.int64).tobytes(), total.tobytes())]
                rare = np.flatnonzero(is_rare)
                to = (h[rare] % np.uint64(ranges)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                rare, ends = rare[order], np.cumsum(np.bincount(to, minlength=ranges))
                code, doc = (near[rare, 1] * CLASSES + near[rare, 2]).astype(np.uint16), w.row[rare].astype(np.int32)
                for k in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
                    part = slice(ends[k - 1] if k else 0, ends[k])
                    out.append((name, k, h[rare[part]].tobytes(), code[part].tobytes(), doc[part].tobytes()))
                yield packed(out)

    def answer(table: pa.Table) -> pa.Table:
        """Rare words replaced by the logarithms of their shares."""
        if not table.num_rows or table["range"][0].as_py() < 0:
            return table
        sent = table["a"].to_pylist()
        word, code = np.frombuffer(b"".join(sent), np.uint64), np.frombuffer(b"".join(table["b"].to_pylist()), np.uint16).astype(np.int64)
        left, right = code // CLASSES, code % CLASSES
        _, kind, n = np.unique(word, return_inverse=True, return_counts=True)
        near = np.full(len(word), -2)
        for side in (left, right):
            _, place, times = np.unique(kind * CLASSES + side, return_inverse=True, return_counts=True)
            near += times[place]
        cls = vocabulary.classes(word)
        value = log_beside(n[kind], vocabulary.size[cls], near, beside.around(left, right, cls))
        parts = np.split(value, np.cumsum([len(x) // 8 for x in sent])[:-1])
        answers = [part.tobytes() for part in parts]
        return table.set_column(2, "a", pa.array(answers, pa.binary())).set_column(3, "b", pa.array([b""] * len(sent), pa.binary()))

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("range")  # the sums of equal texts are added in equal order
        head, *parts = table.select(["a", "b", "c"]).to_pylist()
        place, n, total = (np.frombuffer(head[k], kind) for k, kind in (("a", np.int64), ("b", np.int64), ("c", np.float64)))
        doc, value = (np.frombuffer(b"".join(p[k] for p in parts), kind) for k, kind in (("c", np.int32), ("a", np.float64)))
        total = total + np.bincount(doc, value, len(place))
        return pa.table({"row": place, "n": n, "total": total, "mean": total / np.maximum(n, 1)})

    sent = rows.select(F.col(row).alias("row"), F.col(f"`{text}`").alias("text")).mapInArrow(send, SENT)
    answered = sent.groupBy("range").applyInArrow(answer, SENT)
    sums = answered.groupBy("piece").applyInArrow(add, "row long, n long, total double, mean double")
    outputs = {"n_words": "n", "log_likelihood": "total", "mean_log_likelihood": "mean"}
    kept = [F.col(f"rows.`{c}`") for c in df.columns if c.lower() not in outputs]
    found = rows.alias("rows").join(sums.alias("sums"), F.col(f"rows.{row}") == F.col("sums.row"))
    return found.select(*kept, *(F.col(f"sums.{c}").alias(name) for name, c in outputs.items()))
