"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "N/A"


def trimmed(text: Column) -> Column:
    """Strip outer spaces (spaces only, not tabs); NULL becomes the empty string."""
    return F.trim(F.coalesce(text, F.lit("")))


def squeeze(text: Column) -> Column:
    """Trim, then turn each run of whitespace into one space."""
    return F.regexp_replace(trimmed(text), r"\s+", " ")


def title(text: Column) -> Column:
    """Squeezed text in title case; only spaces separate words."""
    return F.initcap(squeeze(text))


def or_missing(text: Column) -> Column:
    """Replace the empty string with the missing marker; NULL stays NULL."""
    return F.when(text == "", F.lit(MISSING)).otherwise(text)


def blank_to_null(text: Column) -> Column:
    """Keep the value unless it is empty or only spaces."""
    return F.when(F.trim(text) != "", text)


def code(text: Column) -> Column:
    """Identifier code: trimmed and in upper case."""
    return F.upper(F.trim(text))


def without_prefix(text: Column, prefix: str) -> Column:
    """Identifier code with one literal leading prefix removed (before trimming, case-sensitive)."""
    tail = F.substr(text, F.lit(len(prefix) + 1))
    return code(F.when(F.startswith(text, F.lit(prefix)), tail).otherwise(text))


def without_dashes(text: Column) -> Column:
    """Identifier code with every dash removed."""
    return code(F.replace(text, F.lit("-"), F.lit("")))


def key_category(full_key: Column, width: int = 5) -> Column:
    """Leading category part of a composite key, dashes written as underscores."""
    return F.translate(F.trim(F.substring(full_key, 1, width)), "-", "_")


def key_remainder(full_key: Column, width: int = 5) -> Column:
    """What follows the category part and its separator in a composite key."""
    return squeeze(F.substr(full_key, F.lit(width + 2)))


def undashed_name(name: Column) -> Column:
    """Display name: dash runs become spaces, whitespace collapses; blank names are missing.

    Outer spaces go before dashes are replaced, so an outer dash leaves an outer space.
    """
    spaced = F.regexp_replace(F.regexp_replace(trimmed(name), "-+", " "), r"\s+", " ")
    return F.when(squeeze(name) == "", F.lit(MISSING)).otherwise(spaced)
