"""Language identification by Bloom filters over byte n-grams, one bit of every cell for each language.

Fitting counts the n-grams of every text with a known language; an n-gram belongs to a language if at least one in
RARE of that language's n-grams is it, so that stray words do not fill the filters and a language holds at most RARE
n-grams however large the input. All languages share one array of cells: a cell is a mask, a bit for each language, and
the bitwise and of an n-gram's cells gives all languages that contain it at once. A text is given to the language with
most n-grams after the number expected by false positives has been taken away. A word of one byte is, with the spaces
around it, a further n-gram of three bytes, so every text with a letter has an n-gram.

Defined results: null text, or text without a letter, is `und` with score 0; without training rows every text is `und`;
ties go to the first language in order; repeated rows get equal results; only columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.words import added, mixed, spans, text_bytes
from granary.session import shipped

WIDTH = 4  # bytes in an n-gram
RARE = 50_000
CELLS, HASHES = 1 << 20, 3
SLICE = 1 << 20  # n-grams looked up at a time
MERGED = 1 << 20  # new n-grams that a task gathers before it adds them up
UNDECIDED = "und"


def _cleaned(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case texts in which each run of other characters is one space, and which of them have a letter."""
    import regex

    others = regex.compile(r"[^\p{L}\p{M}]+")
    plain = [others.sub(" ", t.lower()).strip() if t else "" for t in texts.to_pylist()]
    letters = regex.compile(r"\p{L}")
    return pa.array([f" {t} " if t else "" for t in plain], pa.string()), np.array([bool(letters.search(t)) for t in plain], bool)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as 32-bit numbers, row of each) within each text; no text holds a zero byte, so shorter ones are distinct."""
    data, offsets = text_bytes(texts)
    n = max(len(data) - WIDTH + 1, 0)
    gram = np.zeros(n, np.uint32)
    for k in range(WIDTH):
        gram |= data[k : k + n].astype(np.uint32) << np.uint32(8 * k)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(offsets))
    whole = row[:n] == row[WIDTH - 1 :] if n else np.zeros(0, bool)
    space = data == ord(" ")
    short = np.flatnonzero(space[:-2] & ~space[1:-1] & space[2:] & (row[:-2] == row[2:]))
    edges = np.uint32(ord(" ") << 16 | ord(" "))
    return np.concatenate([gram[whole], data[short + 1].astype(np.uint32) << np.uint32(8) | edges]), np.concatenate([row[:n][whole], row[short]])


def _cells(gram: np.ndarray) -> np.ndarray:
    """HASHES cells of each n-gram."""
    h = mixed(gram.astype(np.uint64))
    return np.stack([(h >> np.uint64(20 * k)).astype(np.int64) & (CELLS - 1) for k in range(HASHES)])


def counted(texts: DataFrame) -> DataFrame:
    """lang, gram, n over all texts (columns text, lang); each task adds up what it reads before anything is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in batches:
            langs, at = batch["lang"].to_pylist(), 0
            for piece in spans(batch["text"]):
                plain, _ = _cleaned(piece)
                gram, row = grams(plain)
                code = np.array([names.setdefault(x, len(names)) for x in langs[at : at + len(piece)]], np.uint64)
                at += len(piece)
                found, n = np.unique(code[row] << np.uint64(32) | gram, return_counts=True)
                keys.append(found)
                counts.append(n)
                if sum(map(len, keys[1:])) > len(keys[0]) + MERGED:
                    keys, counts = added(keys, counts)
        (key,), (n,) = added(keys, counts)
        own = pa.array(list(names), pa.string()).take(pa.array((key >> np.uint64(32)).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([own, pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    return texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """The fitted cells; small and of fixed size, so that every task may hold them."""

    def __init__(self, members: pa.Table):
        """members: lang and gram, at most RARE n-grams of each language."""
        self.langs = sorted(set(members["lang"].to_pylist()))
        self.cells = np.zeros((max(1, -(-len(self.langs) // 64)), CELLS), np.uint64)
        names, gram = np.array(members["lang"].to_pylist(), object), members["gram"].to_numpy()
        for i, lang in enumerate(self.langs):
            np.bitwise_or.at(self.cells[i // 64], _cells(gram[names == lang]).ravel(), np.uint64(1) << np.uint64(i % 64))
        filled = [(self.cells[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(self.langs))]
        self.false_rate = np.array(filled) ** HASHES

    def hits(self, gram: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """rows x languages: how many of a row's n-grams each language contains."""
        out = np.zeros((rows, len(self.langs)), np.int64)
        for at in range(0, len(gram), SLICE):
            cells, part = _cells(gram[at : at + SLICE]), row[at : at + SLICE]
            for word in range(len(self.cells)):
                mask = self.cells[word][cells[0]]
                for k in range(1, HASHES):
                    mask &= self.cells[word][cells[k]]
                for i in range(word * 64, min(len(self.langs), word * 64 + 64)):
                    bit = (mask >> np.uint64(i % 64) & np.uint64(1)).astype(np.float64)
                    out[:, i] += np.bincount(part, bit, rows).astype(np.int64)
        return out

    def predict(self, texts: pa.Array) -> pa.StructArray:
        plain, has_letter = _cleaned(texts)
        gram, row = grams(plain)
        total = np.bincount(row, minlength=len(texts))[:, None]
        known = has_letter & (total[:, 0] > 0) & bool(self.langs)
        lang, score = np.full(len(texts), UNDECIDED, object), np.zeros(len(texts))
        if self.langs:
            right = (self.hits(gram, row, len(texts)) - total * self.false_rate) / np.maximum(1 - self.false_rate, 1e-9)
            best = right.argmax(1)
            share = np.take_along_axis(right, best[:, None], 1)[:, 0] / np.maximum(total[:, 0], 1)
            lang[known] = np.array(self.langs, object)[best[known]]
            score[known] = np.clip(share[known], 0, 1)
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang_pred", "score"])


def fitted(texts: DataFrame) -> Filters:
    """Learn from all texts with a language (columns text, lang)."""
    shipped(texts.sparkSession)
    known = counted(texts.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang"))
    totals = known.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("total"))
    members = known.join(totals, F.col("lang") == F.col("of")).where(F.col("n") * RARE >= F.col("total"))
    return Filters(members.select("lang", "gram").toArrow())  # at most RARE rows for each language


def predicted(df: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """Add lang_pred and score."""
    shipped(df.sparkSession)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([filters.predict(piece) for piece in spans(texts)])

    kept = [c for c in df.columns if c.lower() not in ("lang_pred", "score")]
    found = df.withColumn("_found", F.arrow_udf(predict, "lang_pred string, score double")(F.col(text)))
    return found.select(*kept, "_found.lang_pred", "_found.score")


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identified(df: DataFrame) -> DataFrame:
    """Per document, its language predicted from the documents that are not held out."""
    filters = fitted(df.where(~held_out()).select("text", "lang"))
    return predicted(df.select("doc_id", "text", held_out().alias("held_out")), filters).drop("text")
