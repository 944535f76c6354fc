
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.functions import codes, dates, numbers, text


def apply(spark, builder, values, kind="string"):
    """Results of a column builder for a list of values, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").repartition(1)
    return [row["r"] for row in rows.select("i", builder(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "builder, cases",
    [
        (text.squeeze, {None: "", "  a   b ": "a b", "\ta": " a"}),
        (text.title, {"o'brien mary-jane": "O'brien Mary-jane", "  ann  marie ": "Ann Marie"}),  # S-5
        (lambda c: text.or_missing(text.title(c)), {None: "N/A", "   ": "N/A", "\t": " ", "JON": "Jon"}),  # S-5
        (text.blank_to_null, {None: None, "  ": None, " x": " x"}),
        (lambda c: text.without_prefix(c, "NAS"),
         {"NASaw1 ": "AW1", "nasaw1": "NASAW1", " NASaw1": "NASAW1", "NAS": "", None: None}),  # S-9
        (text.without_dashes, {"AW-1-2 ": "AW12", None: None}),
        (text.key_category, {"MT-100-BK-42": "MT_10", None: None, "": ""}),  # S-3
        (text.key_remainder, {"MT-100-BK-42": "-BK-42", "CO-RF-FR-R92": "FR-R92", None: ""}),  # S-3
        (text.undashed_name,
         {"-abc": " abc", "---": " ", None: "N/A", " ": "N/A", "Road--Frame  x": "Road Frame x"}),  # S-10
        (codes.yes_flag, {"Yes": True, " yes": True, "No": False, None: False}),
        (lambda c: codes.expanded(c, codes.MARITAL_STATUS, text.title(c)),
         {"M": "Married", " S ": "Single", "m": "M", None: "N/A", " ": "N/A", "divorced": "Divorced"}),  # S-8
        (lambda c: codes.expanded(c, codes.CRM_GENDER, text.title(c)), {"F": "Female", " M": "Male", "f": "F"}),  # S-8
        (lambda c: codes.expanded(c, codes.PRODUCT_LINE, text.squeeze(c)),
         {"R ": "Road", "S": "Other Sales", "Z": "Z", None: "N/A"}),  # S-8
        (lambda c: codes.decoded(F.upper(text.trimmed(c)), codes.ERP_GENDER, F.lit("N/A")),
         {" female ": "Female", "m": "Male", "X": "N/A", None: "N/A"}),
        (lambda c: codes.decoded(c, codes.SHORT_GENDER, F.lit(None)), {"Male": "M", "F": "F", "male": None, None: None}),
        (lambda c: codes.decoded(c, codes.COUNTRY_ALIASES, text.or_missing(c)),
         {"Us": "USA", "De": "Denmark", "Germany": "Germany", "": "N/A"}),  # S-7
        (lambda c: codes.bucket(c, codes.REGIONS, F.lit("Other")),
         {"USA": "North America", "Denmark": "Europe", "N/A": "Unknown", "Japan": "Other"}),
    ],
)
def test_text(spark, builder, cases):
    assert apply(spark, builder, list(cases)) == list(cases.values())


def test_numbers(spark):
    assert apply(spark, numbers.positive_or_zero, [None, -1, 0, 3], "int") == [0, 0, 0, 3]
    assert [str(v) for v in apply(spark, numbers.cents, [1, 250], "int")] == ["0.01", "2.50"]
    assert apply(spark, codes.age_group, [None, 24, 25, 64, 65, 130], "int") == [
        "Unknown", "Under 25", "25-34", "55-64", "65+", "65+",
    ]
    margin = apply(spark, lambda c: numbers.margin_pct(F.lit(30), c), [20, 0, None], "int")
    assert margin == [33.33, None, None]


def parsed(spark, values, *bounds):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, n int").repartition(1)
    return [row["d"] for row in dates.with_dates(rows, {"n": "d"}, *bounds).orderBy("i").collect()]


def test_dates_from_numbers(spark):
    values = [20240229, 20230229, 20241301, 20240100, 20240132, 20240031, 0, 32154, None, -20240101, 99991231]
    expected = [dt.date(2024, 2, 29), *[None] * 9, dt.date(9999, 12, 31)]
    assert parsed(spark, values) == expected
    bounds = dates.EARLIEST, dt.date(2025, 1, 1)
    assert parsed(spark, [19891231, 19900101, 20250101, 20250102], *bounds) == [
        None, dt.date(1990, 1, 1), dt.date(2025, 1, 1), None,  # S-19: the run date itself is accepted
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10, 10**8 + 10**6), min_size=1, max_size=200))
def test_dates_agree_with_pattern_parser(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "n int")
    both = dates.with_dates(rows, {"n": "d"}).withColumn("p", F.try_to_date(F.col("n").cast("string"), "yyyyMMdd"))
    assert both.where(~F.col("d").eqNullSafe(F.col("p"))).count() == 0


def test_ages(spark, run_ts):
    born = [dt.date(2000, 1, 1), dt.date(2000, 1, 2), dt.date(1900, 6, 1)]
    assert apply(spark, lambda c: dates.whole_years(c, run_ts), born, "date") == [25, 24, 124]
    assert apply(spark, lambda c: dates.not_future(c, run_ts), [dt.date(2025, 1, 1), dt.date(2025, 1, 2)], "date") == [
        dt.date(2025, 1, 1), None,
    ]
