"""Deterministic surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_NAME_KEY = "unknown"
NAME_KEY_CHARS = 16
CONTENT_KEY_CHARS = 32


def content_key(parts: Sequence[Column], chars: int = CONTENT_KEY_CHARS) -> Column:
    """Leading hex characters of the SHA-256 over the `~`-joined parts; NULLs are skipped."""
    return F.sha2(F.concat_ws("~", *parts), 256).substr(1, chars)


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def name_key(name: Column) -> Column:
    """Hash key of a canonical name; the empty name has the unknown member's key."""
    return F.when(name == "", F.lit(UNKNOWN_NAME_KEY)).otherwise(F.sha2(name, 256).substr(1, NAME_KEY_CHARS))


def category_key(category: Column, subcategory: Column) -> Column:
    """Readable key such as `food_groceries`, without repeating the category."""
    sub = F.translate(F.lower(subcategory), " /", "__")
    prefix = F.concat(F.lower(category), F.lit("_"))
    return F.when(F.startswith(sub, prefix), sub).otherwise(F.concat(prefix, sub))
