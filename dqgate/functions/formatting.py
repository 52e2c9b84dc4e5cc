"""Text forms used in result tables and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqgate.functions.threshold import whole


def session_time(moment: dt.datetime) -> Column:
    """A moment as a timestamp; without an offset it is in the session's time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def thousands(value: Column, scale: int = 0) -> Column:
    """`1234567` as `1,234,567`."""
    return F.format_number(value, scale)


def plain_number(text: Column) -> Column:
    """Inverse of `thousands`; text that is no number becomes null."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("decimal(38,6)")


def number_text(value: Column) -> Column:
    """Thousands separators, keeping a fraction only where there is one.

    Works on decimals: trailing zeros of the fraction are dropped.
    """
    fraction = F.regexp_extract(value.cast("string"), r"\.(\d*?)0*$", 1)
    sign = F.when((value < 0) & (value > -1), "-").otherwise("")
    shown = F.concat(sign, F.format_number(whole(value), 0))
    return F.when(fraction == "", shown).otherwise(F.concat(shown, F.lit("."), fraction))


def validated_on(ts: Column) -> Column:
    """`01-31-2024 06:00`, to the minute."""
    return F.date_format(ts, "MM-dd-yyyy HH:mm")


def _quoted(item: Column) -> Column:
    # A text with an apostrophe but no double quote is shown in double quotes;
    # otherwise apostrophes are escaped.
    escaped = F.replace(item, F.lit("\\"), F.lit("\\\\"))
    double_quoted = item.contains("'") & ~item.contains('"')
    return F.when(double_quoted, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def list_text(items: Column) -> Column:
    """`['X', 'Z']` without its brackets: `'X', 'Z'`."""
    return F.array_join(F.transform(items, _quoted), ", ")


def heading(name: str) -> str:
    """Column name as a report heading."""
    return name.replace("_", " ")


def heading_text(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit(" "))
