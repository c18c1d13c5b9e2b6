"""Dates, times of day and lap times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paddock.functions.text import _col, null_if_missing, strip


def date_or_null(c: Column | str, *formats: str) -> Column:
    """First format that fits wins; null if none does."""
    text = null_if_missing(c)
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats or ("yyyy-MM-dd",)]
    return F.coalesce(*tries)


def birth_date(c: Column | str) -> Column:
    """Day-first text or ISO text; ISO stays ISO."""
    return date_or_null(c, "d/M/yyyy", "yyyy-MM-dd")


def time_of_day_or_null(c: Column | str) -> Column:
    return F.when(_col(c).rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"), _col(c))


def lap_time_ms(c: Column | str) -> Column:
    """`M:SS.mmm` or `SS.mmm` to milliseconds as double; null where it cannot be read.

    Texts for missing times need no list here: none of them is a number.
    """
    text = strip(c)
    colon = F.instr(text, ":")
    minutes = F.when(colon > 0, F.substring(text, F.lit(1), colon - 1).try_cast("int") * 60).otherwise(0)
    seconds = F.substring(text, colon + 1, F.length(text)).try_cast("double")
    return (minutes + F.nanvl(seconds, F.lit(None).cast("double"))) * 1000


def lap_time_whole_ms(c: Column | str) -> Column:
    """`M:SS.mmm` to whole milliseconds, truncated; null without minutes."""
    return F.when(_col(c).contains(":"), lap_time_ms(c).cast("long"))
