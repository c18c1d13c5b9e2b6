"""Text cleaning and parsing expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters that count as white space.
WHITE_SPACE = " \t\n\r\x0b\x0c\u00a0\u2003\u3000"

# Texts that stand for a missing value in the files.
MISSING_TEXTS = ["", "nan", "NaN", "NaT", "No Time", "Unknown", "\\N"]


def strip(c: Column | str) -> Column:
    """Remove white space of every kind at both ends."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def title_case(c: Column | str) -> Column:
    return F.initcap(_col(c))


def null_if_missing(c: Column | str) -> Column:
    text = F.trim(_col(c))
    return F.when(~text.isin(MISSING_TEXTS), text)


def short_code(code: Column | str, surname: Column | str) -> Column:
    """Given code in upper case, or the first three letters of the surname where there is none."""
    given = strip(code)
    return F.when(F.coalesce(given, F.lit("")) == "", F.upper(F.substring(_col(surname), 1, 3))).otherwise(
        F.upper(given)
    )


def joined_name(first: Column | str, last: Column | str) -> Column:
    """First and last name with one blank; null if either is null."""
    return F.concat(strip(first), F.lit(" "), strip(last))


def is_numeric_text(c: Column | str) -> Column:
    return _col(c).rlike("^[0-9]+$")


def number_or_null(c: Column | str) -> Column:
    """Text to double; what is not a number, and the number NaN, become null."""
    return F.nanvl(strip(_col(c).cast("string")).try_cast("double"), F.lit(None).cast("double"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
