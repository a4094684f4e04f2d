"""Column builders that turn export text into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.text import SPACE

ISO_DATE = "yyyy-MM-dd"
AMOUNT_TYPE = "decimal(18,2)"
ASCII_SPACE = " \t\n\x0b\f\r"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_col(value), F.lit(""))


def lenient_date(value: Column | str, pattern: str = ISO_DATE) -> Column:
    """Date of the trimmed text; NULL for blanks and anything unparsable."""
    return F.try_to_date(blank_to_null(F.trim(_col(value))), pattern)


def exact_date(value: Column | str, pattern: str = ISO_DATE) -> Column:
    """Date of the untrimmed text. Pair with `operators.reconcile.rejected_casts`,
    which counts the non-blank texts this leaves NULL."""
    return F.try_to_date(blank_to_null(value), pattern)


def is_real_date(value: Column | str) -> Column:
    """Whether the text names a calendar day, with or without leading zeros and with any white space around it."""
    text = F.regexp_replace(_col(value), f"^{SPACE}+|{SPACE}+$", "")
    shaped = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    return F.coalesce(shaped & F.try_to_date(text, "yyyy-M-d").isNotNull(), F.lit(False))


def tidy(value: Column | str) -> Column:
    return F.trim(_col(value))


def tidy_lower(value: Column | str) -> Column:
    return F.trim(F.lower(_col(value)))


def clean_identifier(value: Column | str) -> Column:
    """Identifier without apostrophes and blanks."""
    return F.translate(_col(value), f"'{ASCII_SPACE}", "")


def without_blanks(value: Column | str) -> Column:
    """Text without ASCII white space and no-break spaces."""
    return F.translate(_col(value), f"{ASCII_SPACE}\xa0", "")


def _plain_number(value: Column | str) -> Column:
    return blank_to_null(F.translate(_col(value), f",{ASCII_SPACE}\xa0", "."))


def locale_decimal(value: Column | str, type_name: str = AMOUNT_TYPE) -> Column:
    """Decimal from text such as `-1 234,50`; NULL when blank or malformed."""
    return _plain_number(value).try_cast(type_name)


def locale_double(value: Column | str) -> Column:
    return _plain_number(value).try_cast("double")
