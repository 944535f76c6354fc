"""Quality rules whose cutoffs come from the data: quantile sketches per language and source.

Two fixed rules reject outright (too few words, too many repeated windows). All other measures are judged against
fences drawn from quantiles of their own language and source. The quantiles are read off a log-binned sketch (relative
error ALPHA): a count per bin, so sketches are added up in any order, partially before every shuffle, and the sketch of a
language is the sum of those of its sources. To the sketch of every source that of its language is added with the weight of
PRIOR rows: one rule at every size, which a large source hardly feels. Only DataFrame operations are used.

Defined results: a null or empty text, or one of white space, has no words and fails; rows are judged one by one, so
repeated rows are all kept or all rejected; null language or source is a group like any other; an empty table gives an
empty result; a value equal to its fence passes; a column named like the output is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from granary.session import stored, unused

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN, WORD_CHAR = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW, FEWEST_WORDS, MOST_REPEATED = 8, 20, 30  # words in a window, words in a text, percent of words in repeated windows
ALPHA = 0.01
LOG_GAMMA = math.log((1 + ALPHA) / (1 - ALPHA))
ZERO_BIN = -(1 << 30)
PRIOR = 100  # rows that the language adds to each of its sources, so that fences of few rows are near those of the language


@dataclass(frozen=True)
class Measure:
    """A rate and how far beyond its quartiles it may lie: spread times their distance, and margin at least."""

    rate: Callable[[], Column]
    margin: float
    spread: float = 3.0
    below: bool = False  # whether low values are rejected too


MEASURES = {
    "symbols": Measure(lambda: F.col("n_symbols") / F.col("n_words"), 0.1),
    "capitals": Measure(lambda: F.col("n_capitals") / F.col("word_chars"), 0.2),
    "dup_lines": Measure(lambda: F.col("n_dup_lines") / F.col("n_lines"), 0.5),
    "word_length": Measure(lambda: F.col("word_chars") / F.col("n_words"), 3.0, below=True),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words lying in windows of WINDOW words that occur twice or more in the array, each word counted once."""
    def joined(hashes: Column, apart: int) -> Column:
        return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + apart)))

    def windows(hashes: Column) -> Column:
        """Hashes of windows of twice the length from two of half the length, up to WINDOW."""
        whole = lambda eights: F.slice(eights, 1, F.greatest(F.size(eights) - WINDOW + 1, F.lit(0)))
        return let(joined(hashes, 1), lambda twos: let(joined(twos, 2), lambda fours: let(joined(fours, 4), whole)))

    def twice(ordered: Column) -> Column:
        same = lambda x, k: (k >= 0) & (k < F.size(ordered)) & (F.get(ordered, k)["h"] == x["h"])
        return F.filter(ordered, lambda x, k: F.coalesce(same(x, k - 1) | same(x, k + 1), F.lit(False)))

    def covered(starts: Column) -> Column:
        grow = lambda seen, at: F.struct(
            (at + WINDOW).alias("end"), (seen["n"] + at + WINDOW - F.greatest(seen["end"], at)).alias("n"))
        return F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), grow, lambda seen: seen["n"])

    def count(found: Column) -> Column:
        placed = F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        repeats = let(F.sort_array(placed), lambda ordered: F.sort_array(F.transform(twice(ordered), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(covered(repeats))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: let(windows(hashes), count))


def measured(df: DataFrame, text: str = "text", out: str = "quality") -> DataFrame:
    """Add a struct of counts over each whole text."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def counts(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda line: line.rlike(WORD_CHAR))
        words = F.filter(F.split(t, SPACE_RUN, -1), lambda w: w != "")
        without = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
        return let(lines, lambda ls: let(words, lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            (F.length(t) - without(SPACES)).cast("long").alias("word_chars"),
            without(SYMBOLS).cast("long").alias("n_symbols"),
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeated_words(ws).cast("long").alias("n_repeat_words"),
            F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("long").alias("n_capitals"),
        )))

    def judged(c: Column) -> Column:
        failed = (c["n_words"] < FEWEST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])
        return c.withField("base_failed", failed)

    return df.withColumn(out, let(let(whole, counts), judged))


def bin_of(value: Column) -> Column:
    return F.when(value > 0, F.ceil(F.ln(value) / LOG_GAMMA).cast("int")).otherwise(ZERO_BIN)


def bin_value(b: Column) -> Column:
    middle = 2 / (1 + math.exp(LOG_GAMMA))
    return F.when(b == ZERO_BIN, 0.0).otherwise(F.exp(b * LOG_GAMMA) * middle)


def sketches(rates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, measure and bin. rates: keys and one column for each measure."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bin_of(F.col(m)).alias("bin")) for m in MEASURES)))
    return rates.select(*keys, each.alias("at")).groupBy(*keys, "at.measure", "at.bin").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: n counted, and for each measure the lowest and highest value that passes."""
    group = Window.partitionBy(*keys, "measure")
    up_to = F.sum("n").over(group.orderBy("bin"))
    ranked = sketch.withColumns({"up_to": up_to, "total": F.sum("n").over(group)})
    quartile = lambda q: F.min(F.when(F.col("up_to") * 4 >= F.col("total") * q, F.col("bin")))
    quartiles = ranked.groupBy(*keys, "measure", "total").agg(bin_value(quartile(1)).alias("low"), bin_value(quartile(3)).alias("high"))

    def fence(name: str, m: Measure) -> Column:
        reach = F.greatest(m.spread * (F.col("high") - F.col("low")), F.lit(m.margin))
        least = F.col("low") - reach if m.below else F.lit(-1.0)
        return F.max(F.when(F.col("measure") == name, F.struct(least.alias("least"), (F.col("high") + reach).alias("most")))).alias(name)

    return quartiles.groupBy(*keys).agg(F.max("total").alias("n"), F.struct(*(fence(k, m) for k, m in MEASURES.items())).alias("fence"))


def blended(by_source: DataFrame) -> DataFrame:
    """The sketch of every language and source with that of the language added; counts are scaled to stay whole numbers."""
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    of_language = Window.partitionBy("lang", "measure")
    whole = merged(by_source, ["lang"]).withColumn("total", F.sum("n").over(of_language)).alias("whole")
    groups = by_source.select("lang", "source", "measure").distinct().alias("group")
    same_language = F.col("group.lang").eqNullSafe(F.col("whole.lang")) & (F.col("group.measure") == F.col("whole.measure"))
    bins = groups.join(whole, same_language).select("group.*", "whole.bin", F.col("whole.n").alias("lang_n"), "whole.total").alias("bins")
    same = (F.col("bins.lang").eqNullSafe(F.col("own.lang")) & F.col("bins.source").eqNullSafe(F.col("own.source"))
            & (F.col("bins.measure") == F.col("own.measure")) & (F.col("bins.bin") == F.col("own.bin")))
    n = F.coalesce(exact("own.n"), F.lit(0)) * F.col("bins.total") + PRIOR * exact("bins.lang_n")
    return bins.join(by_source.alias("own"), same, "left").select("bins.lang", "bins.source", "bins.measure", "bins.bin", n.cast("decimal(38,0)").alias("n"))


def group_fences(rates: DataFrame) -> DataFrame:
    """Fences of every language and source."""
    own = fences(blended(stored(sketches(rates, ["lang", "source"]), "sketches")), ["lang", "source"])
    return own.select(F.col("lang").alias("fence_lang"), F.col("source").alias("fence_source"), "fence")


def judged(rows: DataFrame, counts: str = "quality") -> DataFrame:
    """Add kept to the struct of counts; rows must have been stored, as they are read twice."""
    passing = rows.where(~F.col(f"{counts}.base_failed")).select("lang", "source", f"{counts}.*")
    limits = group_fences(passing.select("lang", "source", *(m.rate().alias(k) for k, m in MEASURES.items())))
    flat = {c: F.col(f"{counts}.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_capitals")}
    rate = lambda n, d: flat[n] / F.nullif(flat[d], F.lit(0))
    value = {"symbols": rate("n_symbols", "n_words"), "capitals": rate("n_capitals", "word_chars"),
             "dup_lines": rate("n_dup_lines", "n_lines"), "word_length": rate("word_chars", "n_words")}
    inside = lambda k: (value[k] >= F.col(f"fence.{k}.least")) & (value[k] <= F.col(f"fence.{k}.most"))
    kept = ~F.col(f"{counts}.base_failed")
    for k in MEASURES:
        kept = kept & F.coalesce(inside(k), F.lit(False))
    same = F.col("lang").eqNullSafe(F.col("fence_lang")) & F.col("source").eqNullSafe(F.col("fence_source"))
    joined = rows.join(limits, same, "left").withColumn(counts, F.col(counts).withField("kept", kept))
    return joined.select(*(F.col(c) for c in rows.columns))


def verdicts(df: DataFrame) -> DataFrame:
    """Per document: the counts, the fixed rules' verdict and the final one."""
    rows = stored(measured(df.select("doc_id", "text", "lang", "source")).drop("text"), "quality")
    q = F.col("quality")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged(rows).select("doc_id", *(q[c].alias(c) for c in names))


def filtered(df: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    counts = unused("quality", df.columns)
    return judged(stored(measured(df, out=counts), "quality"), counts).where(F.col(f"{counts}.kept")).drop(counts)
