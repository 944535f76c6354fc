"""CSV ingestion and published tables."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from granary.operators import rules
from granary.plans import refined
from granary.queries import PLANS, Tables, unstamped, write_csv
from granary.session import CHECKPOINT_DIR, scratch_dir
from granary.sinks import publish as publishing
from granary.sinks.layout import clustered, rank
from granary.sinks.publish import publish
from granary.sinks.refresh import Lakehouse
from granary.sources.csv import read_feed, read_merged, with_lineage
from granary.sources.schemas import FEEDS


def test_corrupt_lines_are_kept_whole(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("id,name\n1,a\nx,b\n3,c,surplus\n")
    feed = read_feed(spark, str(tmp_path), "id INT, name STRING")
    assert {r["corrupt_record"] for r in feed.collect()} == {None, "x,b", "3,c,surplus"}
    surplus = feed.select("name", "corrupt_record").where("corrupt_record LIKE '%surplus'").collect()
    assert [row["name"] for row in surplus] == ["c"]


def test_lineage_columns(spark, tmp_path, run_ts):
    (tmp_path / "feed.csv").write_text("id\n1\n")
    row = with_lineage(read_feed(spark, str(tmp_path), "id INT"), run_ts).first()
    assert row["file_name"].endswith("feed.csv") and row["ingest_datetime"] == run_ts


def test_headers_in_another_order_are_refused_or_merged_by_name(spark, tmp_path, run_ts):
    for folder, content in {"a": "id,name\n1,x\n", "b": "name,id\ny,2\n", "c": "id,color\n3,red\n"}.items():
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "feed.csv").write_text(content)
    with pytest.raises(Exception, match="header does not conform"):
        read_feed(spark, str(tmp_path / "b"), "id INT, name STRING").collect()
    merged = read_merged(spark, [str(tmp_path / f) for f in "abc"], "id INT, name STRING", run_ts)
    got = sorted((r["id"], r["name"], r["color"]) for r in merged.select("id", "name", F.coalesce(
        "color", F.lit("-")).alias("color")).fillna("-").collect())
    assert got == [(1, "x", "-"), (2, "y", "-"), (3, "-", "red")]


def test_publish_counts_in_one_pass_and_describes(spark, tmp_path):
    df = spark.range(10).withColumn("name", F.when(F.col("id") > 7, "x"))
    checks = [rules.Rule("early", "id < 9", rules.DROP), rules.Rule("named", "name IS NOT NULL")]
    options = {"rules": checks, "comment": "It's a test", "properties": {"layer": "silver"}}
    for keys in ([], ["name"]):  # overwriting gives the same table again, clustered or not
        counts = publish(df, "published_test", path=str(tmp_path / "t"), cluster_by=keys, **options)
        assert counts == {"published_rows": 9, "early": 1, "named": 8}
    assert spark.read.table("published_test").count() == 9
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED published_test").collect()}
    assert described["Comment"] == "It's a test" and "layer=silver" in described["Table Properties"]


def test_clustered_files_have_narrow_ranges_and_split_hot_keys(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the data is tiny
    rows = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    clustered(rows, ["k"]).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(str(tmp_path / "t")).groupBy(F.col("_metadata.file_name")).agg(
        F.min("k").alias("low"), F.max("k").alias("high"), F.count("k").alias("n")
    ).orderBy("low", "high").collect()
    assert sum(f["n"] for f in files) == 4000
    assert all(a["high"] <= b["low"] for a, b in zip(files, files[1:]))
    assert max(f["n"] for f in files) < 2667  # the hot key's rows are in several files


def files_touched(spark, path):
    """How many files a filter on one value of a, and of b, reads by the bounds of their columns, on average over values."""
    bounds = spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).collect()
    values = range(25, 1000, 50)
    return [sum(row[k] <= v <= row[k + 1] for row in bounds for v in values) / len(values) for k in (1, 3)]


def test_curve_prunes_files_by_either_key(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 6).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 997).alias("b"), "id")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    clustered(rows, ["a", "b"], rows.select("a", "b")).write.parquet(str(tmp_path / "curve"))
    rows.repartitionByRange("a", "b").write.parquet(str(tmp_path / "range"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "curve")).collect()) == list(range(20_000))
    curve, by_range = (files_touched(spark, str(tmp_path / kind)) for kind in ("curve", "range"))
    assert by_range[1] > 15 and max(curve) < 8 and sum(curve) < sum(by_range)


def test_ranks_count_the_bounds_that_are_not_above(spark):
    values = [None, float("-inf"), -1.0, 0.0, 0.5, 1.0, 2.0, 2.5, 40.0, 63.0, 99.0, float("inf"), float("nan")]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for bounds in ([], [1.0], [0.0, 2.0], [0.0, 0.5, 1.0, 2.0], [float(i) for i in range(63)]):
        found = rows.select("v", rank(F.col("v"), bounds).alias("r")).collect()
        assert [r.r for r in found] == [0 if v is None else sum(v != v or v >= b for b in bounds) for v in values]


def test_stage_that_places_wide_rows_is_short_enough_to_be_compiled(spark, capsys):
    keys = [(F.col("id") * p % 1000).alias(k) for k, p in (("a", 7919), ("b", 104729), ("c", 611953))]
    rows = spark.range(0, 5000, 1, 4).select("id", *keys, *[(F.col("id") + i).cast("string").alias(f"text{i}") for i in range(40)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan explained is the one that runs
    laid = clustered(rows, ["a", "b", "c"], rows.select("a", "b", "c"))
    laid.explain("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert len(sizes) > 1 and max(sizes) <= 8000  # the longest method that the JVM compiles
    assert laid.count() == 5000


def test_clustering_reads_the_rows_once_and_plans_without_them(spark, tmp_path, capsys):
    spark.range(100).select("id", F.col("id").cast("string").alias("name")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows")).withColumn("checked", F.assert_true(F.col("id") < 0))  # fails when it is run
    laid = clustered(rows, ["id", "name"], spark.range(100).select("id", F.col("id").cast("string").alias("name")))
    laid.explain()
    assert capsys.readouterr().out.count("/rows]") == 1
    empty = clustered(spark.createDataFrame([], "cell int, day date, flag boolean"), ["cell", "day", "flag"])
    assert empty.columns == ["cell", "day", "flag"] and empty.count() == 0
    odd = spark.createDataFrame([(None, None, None), (1, dt.date(2020, 1, 1), True), (1, dt.date(2020, 1, 1), True)], "cell int, day date, flag boolean")
    assert sorted(clustered(odd, ["cell", "day", "flag"]).collect(), key=str) == sorted(odd.collect(), key=str)


def test_features_are_derived_where_their_rows_lie(spark, sf_dir, monkeypatch):
    moved = []
    monkeypatch.setattr(publishing, "clustered", lambda df, *given: moved.append(df.columns) or clustered(df, *given))
    found = PLANS["clustered_roundtrip"](Tables(spark, sf_dir))
    assert "customer_region" in moved[0] and not {"estimated_profit", "order_month_name", "days_to_ship"} & set(moved[0])
    features = unstamped(Tables(spark, sf_dir).features)
    assert found.columns == features.columns and found.count() == features.count()
    assert found.exceptAll(features).isEmpty() and found.where("order_year is null").count() == features.where("order_year is null").count()


def test_file_names_are_parsed_after_the_rows_of_a_file_are_counted(spark, sf_dir):
    found = PLANS["file_lineage"](Tables(spark, sf_dir))
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    counting = [i for i, line in enumerate(plan) if "count(1)" in line]
    assert len(counting) == len(FEEDS) and all("Aggregate [file_name" in plan[i] for i in counting)
    assert not any("regexp_extract" in line for i in counting for line in plan[i + 1 : i + 3])  # down to the rows of the file


def test_scratch_is_new_and_in_the_shared_folder(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    assert shared is None or first.startswith(shared)


def test_full_refresh(spark, sf_dir, tmp_path, run_ts):
    tables = Tables(spark, sf_dir)
    paths = {name: str(tmp_path / "in" / name) for name in FEEDS}
    for name, path in paths.items():
        write_csv(tables.raw(name), path)
    lake = Lakehouse(spark, run_ts, location=str(tmp_path / "lake"), prefix="t_")
    lake.ingest(paths)
    lake.refine()
    lake.refine_classic()
    lake.build_marts(dt.date(1995, 1, 1), dt.date(2000, 12, 31))
    assert lake.audit["t_silver.crm_sales"]["valid_order_number"] == 7
    assert lake.audit["t_gold.fact_sales"]["published_rows"] == tables.fact.count()
    assert lake.audit["t_gold.fact_sales_effective"]["published_rows"] == tables.sales.count()
    assert lake.read("gold", "dim_calendar").count() == 2192
    columns = refined.refined("crm_product", tables.raw("crm_product"), run_ts).columns
    assert lake.read("silver", "crm_product").columns == columns
    for table in lake.audit:
        spark.sql(f"DROP TABLE {table}")


def test_one_read_per_header_and_a_moved_and_an_extra_column(spark, tmp_path, run_ts):
    from granary.sources.csv import headers, read_merged

    layouts = ["CID,CNTRY", "CNTRY,CID", "CID,CNTRY,note"]
    for i in range(30):
        values = {"CID": f"AW{i}", "CNTRY": "US", "note": "n"}
        names = layouts[i % 3].split(",")
        (tmp_path / f"part {i}.csv").write_text(f"{layouts[i % 3]}\n{','.join(values[n] for n in names)}\n")
    assert {h: len(f) for h, f in headers(spark, [str(tmp_path)]).items()} == {h: 10 for h in layouts}
    rows = read_merged(spark, [str(tmp_path)], "CID STRING, CNTRY STRING", run_ts).collect()
    assert {(r.CID, r.CNTRY) for r in rows} == {(f"AW{i}", "US") for i in range(30)}
    assert sum(r.note == "n" for r in rows) == 10
