"""Overwriting published tables, with rule counts taken during the write."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from granary.operators.rules import Rule, enforce
from granary.sinks.layout import clustered

ROWS = "published_rows"


def publish(df: DataFrame, name: str, rules: Sequence[Rule] = (), comment: str = "",
            properties: Mapping[str, str] | None = None, cluster_by: Sequence[str] = (),
            path: str | None = None, keys_from: DataFrame | None = None,
            then: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """Recompute a table in full and return its row count and the violations of each rule.

    Counts are observed while the rows are written, so the plan runs once. They are taken after the last shuffle: what is
    counted before one counts again when bounds are sought or lost shuffle files are made anew. With a path the table is
    external. keys_from: rows that hold the keys of the clustering (or about those), if they are cheaper to read than df.
    then: adds to the rows, where they were laid, columns that follow from others, so that these need not be moved.
    """
    before, after = Observation(), Observation()
    arranged = clustered(df, cluster_by, keys_from)
    arranged = then(arranged) if then else arranged
    checked = arranged.observe(before, *[rule.violations for rule in rules]) if rules else arranged
    kept = enforce(checked, rules).observe(after, F.count(F.lit(1)).alias(ROWS))
    writer = kept.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    describe(df.sparkSession, name, comment, properties or {})
    return {**after.get, **(before.get if rules else {})}


def describe(spark, name: str, comment: str, properties: Mapping[str, str]) -> None:
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{quoted(key)} = {quoted(value)}" for key, value in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
