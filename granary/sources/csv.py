"""CSV ingestion into the raw layer."""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.dates import moment

CORRUPT = "corrupt_record"


def read_feed(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType | None = None,
              header: bool = True) -> DataFrame:
    """Read a CSV feed permissively: with a schema in one pass, without one by inferring the types first.

    With a schema, lines that do not fit it are kept whole in ``corrupt_record``. Surplus and absent fields are noticed in
    every query; a bad value only when its column is read, so write the raw layer with all columns.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_corrupt = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        reader.schema(with_corrupt)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .option("enforceSchema", not header)
        .csv(path)
    )


def headers(spark: SparkSession, deliveries: Sequence[str]) -> dict[str, list[str]]:
    """The files of all deliveries by their header line, found in one job. Files without a line have no header.

    Lines keep their order within a task, so the one with the smallest number is the first of its file; every task keeps one
    line of a file before anything is sent on. The reader of a header needs its file names, which are what reaches the driver.
    """
    lines = spark.read.text(list(deliveries)).where(F.col("_metadata.file_block_start") == 0)
    numbered = lines.select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("number"))
    # an aggregate of objects: keeps its strings in a hash table, where min_by alone would sort all lines by file
    first = numbered.groupBy("file").agg(F.min_by("value", "number").alias("header"), F.collect_set(F.lit(0)).alias("kept"))
    found: dict[str, list[str]] = {}
    for row in first.select("header", "file").orderBy("header", "file").toLocalIterator():
        found.setdefault(row["header"], []).append(unquote(row["file"]))
    return found


def read_merged(spark: SparkSession, deliveries: Sequence[str], schema: str, run_ts: dt.datetime) -> DataFrame:
    """Read deliveries (files, folders or globs) whose headers differ in order or in the columns they carry.

    One read per distinct header, however many files there are. Columns then meet by name; absent ones are NULL, undeclared
    ones are kept as text. Lineage columns are added here, as file names are only known per read.
    """
    declared = {field.name: field for field in T.StructType.fromDDL(schema)}

    def read(header: str, files: list[str]) -> DataFrame:
        names = next(csv.reader([header]))
        fields = [declared.get(name, T.StructField(name, T.StringType())) for name in names]
        return with_lineage(read_feed(spark, files, T.StructType(fields)), run_ts)

    parts = [read(*group) for group in headers(spark, deliveries).items()]
    if not parts:
        parts = [with_lineage(read_feed(spark, list(deliveries), schema), run_ts)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    absent = {name: F.lit(None).cast(f.dataType) for name, f in declared.items() if name not in merged.columns}
    extra = [name for name in merged.columns if name not in declared]
    return merged.withColumns(absent).select(*declared, *extra)


def with_lineage(df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Add the source file and the ingestion time to rows read from files."""
    return df.select("*", F.col("_metadata.file_path").alias("file_name"), moment(run_ts).alias("ingest_datetime"))
