"""Multi-format date parsing. The order of formats decides ambiguous texts."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layouts found in the feeds.
DAY_FIRST = [
    "yyyy-MM-dd HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "MM/dd/yyyy HH:mm",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
]
MONTH_FIRST_ISO = [
    "yyyy-MM-dd HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
]
EVENT_TIMES = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm:ss"]
REGISTRATION_DATES = ["yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy-MM-dd'T'HH:mm:ss"]
LENIENT_DATES = ["yyyy-M-d", "M/d/yyyy", "d-M-yyyy"]


_TOKEN = re.compile(r"'[^']*'|([a-zA-Z])\1*|.")
_LETTERS = "yMdHmsS"


def shape(fmt: str) -> str | None:
    """Regular expression of the texts that a format can read; null if it has other fields."""
    parts = []
    for token in (m.group() for m in _TOKEN.finditer(fmt)):
        if token in "[]":
            parts.append({"[": "(?:", "]": ")?"}[token])
        elif token.startswith("'"):
            parts.append(re.escape(token.strip("'")))
        elif not token[0].isalpha():
            parts.append(re.escape(token))
        elif token[0] not in _LETTERS or token == "MMM":
            return None
        else:
            parts.append(r"\d{1,2}" if len(token) == 1 else rf"\d{{{len(token)}}}")
    return "^" + "".join(parts) + "$"


def _try_format(c: Column, fmt: str) -> Column:
    # A failed parse costs several times a pattern match, and most formats of a list fail.
    parsed, pattern = F.try_to_timestamp(c, F.lit(fmt)), shape(fmt)
    return parsed if pattern is None else F.when(c.rlike(pattern), parsed)


def parse_timestamp(c: Column, formats: Sequence[str] = tuple(MONTH_FIRST_ISO)) -> Column:
    """First format that fits, else null. Never raises, also under ANSI mode."""
    return F.coalesce(*[_try_format(c, f) for f in formats])


def parse_date(c: Column, formats: Sequence[str] = tuple(REGISTRATION_DATES)) -> Column:
    return parse_timestamp(c, formats).cast("date")


def days_until(as_of: date, c: Column) -> Column:
    """Whole days from ``c`` to a fixed day, so that re-runs agree."""
    return F.datediff(F.lit(as_of), c)


def day_name(c: Column) -> Column:
    return F.date_format(c, "EEEE")


def time_period(hour: Column) -> Column:
    # Hours and words of the periods.
    return (
        F.when((hour >= 6) & (hour < 12), "Morning")
        .when((hour >= 12) & (hour < 17), "Afternoon")
        .when((hour >= 17) & (hour < 21), "Evening")
        .otherwise("Night")
    )
