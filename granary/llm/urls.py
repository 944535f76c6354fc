"""URL filter: fixed rules first, then a path-template tree learnt per host.

The tree is grown level by level over distinct paths: below one host and template prefix, a segment becomes a wildcard if
it looks like a number or an id, or if its values are many for the paths seen. Branches are then merged: at every level a
literal is compared with its siblings pooled (same host, same template elsewhere), and becomes a wildcard if both have
labels and their shares of bad pages do not differ significantly, or if neither has any. A template is rejected if its
smoothed share of bad labelled pages is high. Labels may come from anywhere; the query takes the verdicts of the rules.

Everything is counted per distinct path and per template before it moves, so a host may hold any share of the rows.

Defined results: a null url, or one without `://`, has empty host and path and is judged like any other; an empty path
has one empty segment; segments from DEPTH on are one wildcard; repeated rows are judged alike; ties between rules of one
length go to the first; an empty table gives an empty result; columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.session import stored

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEPTH = 5  # levels of the tree
MANY, PER_PATH = 16, 4  # a segment with so many values, and a value for every so many paths at least, is variable
LEAST_LABELS, SIGNIFICANT = 5, 1.96  # labelled pages on both sides of a comparison; standard errors
PRIOR_BAD, PRIOR_GOOD, REJECTED = 1.0, 1.0, 0.8  # pages added to every template; share of bad ones from which it goes
WILDCARD, REST = "*", "**"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @classmethod
    def parsed(cls, action: str, text: str) -> Rule:
        host, _, path = text.partition("/")
        return cls(action, host, "/" + path)

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def located(df: DataFrame, url: str = "url") -> DataFrame:
    """Add host and path."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return df.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def ruled(df: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Add rule, the longest that fits, and its action; null if none does."""
    ordered = sorted((Rule.parsed(*rule) for rule in rules), key=lambda r: -len(r.text))
    host, path = F.col("host"), F.col("path")
    none = F.lit(None).cast("string")
    chosen = F.coalesce(none, *(F.when(r.fits(host, path), F.lit(r.text)) for r in ordered))
    actions = {r.text: r.action for r in ordered}
    action = F.coalesce(none, *(F.when(F.col("rule") == text, F.lit(kind)) for text, kind in actions.items()))
    return df.withColumn("rule", chosen).withColumn("action", action)


def shape(segment: Column) -> Column:
    """A number or an id as a wildcard, with its file ending; any other segment as it is."""
    number = F.regexp_replace(segment, r"^[0-9]+(?=$|\.[a-z]+$)", WILDCARD)
    return F.regexp_replace(number, r"^(?=[0-9a-fA-F-]*[0-9])[0-9a-fA-F-]{8,}(?=$|\.[a-z]+$)", WILDCARD)


def grown(paths: DataFrame) -> DataFrame:
    """Add template, an array, to distinct (host, path)."""
    raw = F.split(F.substr(F.col("path"), F.lit(2)), "/", -1)
    tree = paths.withColumn("segments", F.transform(raw, shape)).withColumn("template", F.array().cast("array<string>"))
    for level in range(DEPTH):
        here = F.get("segments", F.lit(level))
        prefix = F.concat_ws("/", "template")
        deep = tree.where(F.size("segments") > level).groupBy(F.col("host").alias("at_host"), prefix.alias("at_prefix"))
        seen = deep.agg(F.approx_count_distinct(here).alias("values"), F.count("*").alias("seen"))
        variable = seen.where((F.col("values") >= MANY) & (F.col("values") * PER_PATH >= F.col("seen")))
        matched = tree.join(variable.select("at_host", "at_prefix", F.lit(True).alias("varies")), (F.col("host") == F.col("at_host")) & (prefix == F.col("at_prefix")), "left")
        ending = F.regexp_extract(here, r"\.[a-z]+$", 0)
        step = F.when(F.col("varies"), F.concat(F.lit(WILDCARD), ending)).otherwise(here)
        longer = F.when(F.size("segments") > level, F.concat("template", F.array(step))).otherwise(F.col("template"))
        tree = matched.withColumn("template", longer).drop("at_host", "at_prefix", "varies")
    whole = F.when(F.size("segments") > DEPTH, F.concat("template", F.array(F.lit(REST)))).otherwise(F.col("template"))
    return tree.withColumn("template", whole).drop("segments")


def merges(templates: DataFrame) -> DataFrame:
    """host, template, merged: literals replaced where a branch is like its siblings. templates: with labelled, bad."""
    levels = templates.select("*", F.posexplode("template").alias("level", "literal")).where(~F.col("literal").startswith(WILDCARD))
    others = F.transform("template", lambda segment, i: F.when(i == F.col("level"), WILDCARD).otherwise(segment))
    branches = levels.withColumn("others", others)
    keys = ["host", "level", "others"]
    pooled = branches.groupBy(*keys).agg(F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"), F.count("*").alias("siblings"))
    n, bad = F.col("labelled"), F.col("bad")
    rest_n, rest_bad = F.col("all_labelled") - n, F.col("all_bad") - bad
    share = F.try_divide(F.col("all_bad"), F.col("all_labelled"))
    error = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), rest_n)))
    alike = F.abs(F.try_divide(bad, n) - F.try_divide(rest_bad, rest_n)) <= SIGNIFICANT * error
    similar = ((n >= LEAST_LABELS) & (rest_n >= LEAST_LABELS) & alike) | (F.col("all_labelled") == 0)
    tested = branches.join(pooled, keys).where((F.col("siblings") > 1) & F.coalesce(similar, F.lit(False)))
    merged_levels = tested.groupBy("host", "template").agg(F.collect_set("level").alias("levels"))  # DEPTH at most
    ending = lambda segment: F.concat(F.lit(WILDCARD), F.regexp_extract(segment, r"\.[a-z]+$", 0))
    merged = F.transform("template", lambda segment, i: F.when(F.array_contains("levels", i), ending(segment)).otherwise(segment))
    joined = templates.join(merged_levels, ["host", "template"], "left")
    return joined.withColumn("merged", F.when(F.col("levels").isNull(), F.col("template")).otherwise(merged)).drop("levels")


def judged(df: DataFrame) -> DataFrame:
    """Add template, labelled, purity and rejected to rows with host, path and bad (1, 0, or null where unlabelled)."""
    paths = df.groupBy("host", "path").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    tree = stored(grown(paths), "paths")
    sums = [F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")]
    merged = merges(tree.groupBy("host", "template").agg(*sums))
    weighed = stored(merged, "templates")
    totals = weighed.groupBy("host", "merged").agg(*sums)
    purity = (F.col("bad") + PRIOR_BAD) / (F.col("labelled") + PRIOR_BAD + PRIOR_GOOD)
    verdicts = weighed.select("host", "template", "merged").join(totals, ["host", "merged"]).select(
        "host", "template", F.concat(F.lit("/"), F.concat_ws("/", "merged")).alias("merged"), "labelled", purity.alias("purity"))
    by_path = tree.select("host", "path", "template").join(verdicts, ["host", "template"]).select(
        "host", "path", F.col("merged").alias("template"), "labelled", "purity", (F.col("purity") >= REJECTED).alias("rejected"))
    rows = df.drop("template", "labelled", "purity", "rejected")
    return rows.join(by_path, ["host", "path"])


def filtered(pages: DataFrame) -> DataFrame:
    """Per page: host, path, rule, verdict, and what the verdict rests on."""
    known = ruled(located(pages.select("page_id", "url")))
    found = judged(known.withColumn("bad", (F.col("action") == "block").cast("int")))
    verdict = F.coalesce("action", F.when(F.col("rejected"), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "labelled", "purity")


