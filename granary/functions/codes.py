"""Code expansion: small lookup tables as parameters, applied as CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.text import MISSING, trimmed

# Code lists and buckets that results depend on.
MARITAL_STATUS = {"M": "Married", "S": "Single"}
CRM_GENDER = {"F": "Female", "M": "Male"}
ERP_GENDER = {"MALE": "Male", "FEMALE": "Female", "M": "Male", "F": "Female"}
SHORT_GENDER = {"M": "M", "Male": "M", "F": "F", "Female": "F"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "T": "Touring", "S": "Other Sales"}
COUNTRY_ALIASES = {"Us": "USA", "Usa": "USA", "United States": "USA", "De": "Denmark"}
REGIONS = {
    "Oceania": ["Australia", "New Zealand"],
    "North America": ["USA", "Canada", "Mexico"],
    "Europe": [
        "United Kingdom", "Germany", "France", "Italy", "Spain", "Netherlands", "Belgium", "Austria",
        "Switzerland", "Ireland", "Poland", "Sweden", "Norway", "Denmark", "Finland",
    ],
    "Unknown": [MISSING],
}
OTHER_REGION = "Other"
AGE_BOUNDS = [(25, "Under 25"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
OLDEST_GROUP = "65+"
UNKNOWN_AGE = "Unknown"


def bucket(value: Column, buckets: Mapping[str, Sequence[str]], default: Column) -> Column:
    """Name of the bucket a value is listed in, else the default."""
    result = default
    for name, members in reversed(buckets.items()):
        result = F.when(value.isin(list(members)), F.lit(name)).otherwise(result)
    return result


def decoded(value: Column, table: Mapping[str, str], default: Column) -> Column:
    """Meaning of a code, else the default."""
    buckets: dict[str, list[str]] = {}
    for key, meaning in table.items():
        buckets.setdefault(meaning, []).append(key)
    return bucket(value, buckets, default)


def expanded(raw: Column, table: Mapping[str, str], otherwise: Column) -> Column:
    """Meaning of a case-sensitive code; blank is missing, unlisted values give the last argument."""
    return decoded(trimmed(raw), {**table, "": MISSING}, otherwise)


def yes_flag(raw: Column) -> Column:
    """True for the word yes in any case, false for all else."""
    return F.upper(trimmed(raw)) == "YES"


def age_group(age: Column) -> Column:
    case = F.when(age.isNull(), F.lit(UNKNOWN_AGE))
    for upper, label in AGE_BOUNDS:
        case = case.when(age < upper, F.lit(label))
    return case.otherwise(F.lit(OLDEST_GROUP))
