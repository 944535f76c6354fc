"""Relational operators against brute force and hand-written rows."""

import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from granary.operators import joins, rules
from granary.operators.dedup import best_record
from granary.operators.joins import left_lookup
from granary.operators.versions import repeated, version_intervals


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_best_record_is_deterministic_on_ties(spark):
    data = [(1, "b", 5), (1, "a", 5), (1, "z", 4), (None, "x", 1), (None, "y", 1)]
    for order in itertools.islice(itertools.permutations(data), 0, 120, 30):
        df = spark.createDataFrame(list(order), "id int, name string, score int")
        assert rows_of(best_record(df, "id", [F.desc("score")])) == [(1, "a", 5), (None, "x", 1)]


def test_best_record_limits_groups_before_the_shuffle(spark, capsys, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderdate", "o_totalprice")
    best_record(orders, "o_custkey", [F.desc("o_totalprice")]).explain()
    plan = capsys.readouterr().out
    assert "Partial" in plan and "WindowGroupLimit" in plan


def brute_intervals(data):
    """Each row ends the day before the next row of its key, in order of start and remaining columns."""
    smallest = dt.date.min
    ordered = sorted(data, key=lambda r: (r[0] or "", r[0] is not None, r[1] or smallest, r[2]))
    out = []
    for row, after in itertools.zip_longest(ordered, ordered[1:]):
        same = after is not None and after[0] == row[0]
        end = after[1] - dt.timedelta(1) if same and after[1] else None
        out.append((row[0], row[1], row[2], end))
    return sorted(out, key=repr)


def test_version_intervals_match_brute_force(spark):
    random.seed(7)
    starts = [None, *[dt.date(2020, 1, day) for day in (1, 5, 9, 20)]]
    data = [(random.choice(["a", "b", None]), random.choice(starts), random.randint(1, 3)) for _ in range(120)]
    df = spark.createDataFrame(data, "key string, start date, id int").withColumn("end", F.lit(None).cast("date"))
    assert rows_of(version_intervals(df, "key", "start", "end")) == brute_intervals(data)


def test_version_intervals_ignore_given_end_dates(spark):
    day = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("a", day, 1, day), ("a", None, 2, day)], "key string, start date, id int, end date")
    expected = [("a", None, 2, dt.date(2019, 12, 31)), ("a", day, 1, None)]  # S-2
    assert rows_of(version_intervals(df, "key", "start", "end")) == sorted(expected, key=repr)


def test_repeated_numbers_copies_across_chunks(spark):
    df = spark.createDataFrame([("a", 7), ("b", 1)], "name string, n bigint")
    copies = repeated(df, F.col("n"), chunk=3).select("name", "_copy")
    assert rows_of(copies) == [*(("a", i) for i in range(1, 8)), ("b", 1)]


def test_lookup_with_hot_keys_equals_plain_join(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 2, 3, None])], "k int, part int")
    right = spark.createDataFrame([(1, n) for n in range(200)] + [(1, 7)] * 30 + [(2, 0), (2, None), (2, None), (None, 9)], "key int, n int")
    plain = left.join(right, F.col("k") == F.col("key"), "left")
    assert rows_of(left_lookup(left, right, "k", "key")) == rows_of(plain)
    assert left_lookup(left.where("false"), right, "k", "key").count() == 0
    assert rows_of(left_lookup(left, right.where("false"), "k", "key")) == rows_of(left.select("*", F.lit(None), F.lit(None)))


def test_lookup_splits_hot_keys_of_both_sides_and_reads_the_left_one_once(spark, tmp_path, capsys):
    left = spark.range(30_000).select((F.col("id") % 3 * F.col("id")).alias("k"), F.col("id").alias("i"))
    left.write.parquet(str(tmp_path / "left"))
    right = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), F.col("id").alias("n"))
    found = left_lookup(spark.read.parquet(str(tmp_path / "left")), right, "k", "key")
    found.explain()
    assert capsys.readouterr().out.count("/left]") == 1
    assert found.count() == left.join(right, F.col("k") == F.col("key"), "left").count()
    parts = left_lookup(spark.createDataFrame([(-1,)], "k long"), right, "k", "key").groupBy(F.pmod(F.xxhash64("n"), F.lit(64))).count()
    assert parts.agg(F.max("count") < 500).first()[0]  # a third of the rows has one key


def test_lookup_moves_the_left_side_once(spark, monkeypatch, capsys):
    left = spark.range(50).select((F.col("id") % 5).alias("k"), F.col("id").alias("i"))
    data = [(0, 7)] * 300 + [(1, n) for n in range(200)] + [(2, n) for n in range(9)] + [(3, 1)]
    right = spark.createDataFrame(data, "key long, n long")
    monkeypatch.setattr(joins, "ROWS", 20)  # keys 0 and 1 have several parts, of which 0 fills one
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = left_lookup(left, right, "k", "key")
        found.explain()
        plan = capsys.readouterr().out
        assert rows_of(found) == rows_of(left.join(right, F.col("k") == F.col("key"), "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning(k#") == 1


def test_rules_count_before_dropping_and_null_is_a_violation(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id int, name string")
    checks = [rules.Rule("has_id", "id IS NOT NULL", rules.DROP), rules.Rule("is_a", "name = 'a'")]
    assert rows_of(rules.report(df, checks)) == [("has_id", "drop", 1), ("is_a", "warn", 2)]
    assert rules.enforce(df, checks).count() == 2
    assert rules.enforce(df, checks[1:]).count() == 3
