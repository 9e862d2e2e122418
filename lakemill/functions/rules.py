"""Data-quality rules: a code, a severity and a boolean Column that is true on violation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemill.functions import dates, text
from lakemill.functions.numbers import WIDE

ERROR, WARNING = "ERROR", "WARNING"


@dataclass(frozen=True)
class Rule:
    code: Column
    violated: Column
    severity: str = ERROR


def rule(code: str, violated: Column, severity: str = ERROR) -> Rule:
    """A user-defined rule with a fixed code."""
    return Rule(F.lit(code), violated, severity)


def required(field: str) -> Rule:
    return rule(f"MISSING_REQUIRED_FIELD:{field}", text.is_blank(F.col(field)))


def numeric(field: str, negative_code: str = "NEGATIVE_VALUE") -> list[Rule]:
    """Not a number, or below zero. Blank values are left to ``required``."""
    c = F.col(field)
    value = c.try_cast(WIDE)
    return [
        rule(f"{negative_code}:{field}", value < 0),
        rule(f"INVALID_NUMERIC:{field}", ~text.is_blank(c) & value.isNull()),
    ]


def email(field: str) -> Rule:
    c = F.col(field)
    return rule(f"INVALID_EMAIL_FORMAT:{field}", (c != "") & ~c.rlike(text.EMAIL_PATTERN))


def phone(field: str) -> Rule:
    c = F.col(field)
    return rule(f"UNUSUAL_PHONE_FORMAT:{field}", ~text.is_blank(c) & ~c.rlike(text.PHONE_PATTERN), WARNING)


def calendar(field: str, future_code: str, as_of: date, formats: Sequence[str] = tuple(dates.LENIENT_DATES)) -> list[Rule]:
    """Unreadable date (error) and date after ``as_of`` (warning)."""
    c = F.col(field)
    parsed = dates.parse_date(c, formats)
    return [
        rule(f"INVALID_DATE_FORMAT:{field}", ~text.is_blank(c) & parsed.isNull()),
        rule(f"{future_code}:{field}", parsed > F.lit(as_of), WARNING),
    ]


def listed(field: str, values: Sequence[str], code: str) -> Rule:
    """Value outside a list; the value itself becomes part of the code."""
    c = F.col(field)
    outside = ~text.is_blank(c) & ~F.lower(c).isin(list(values))
    return Rule(F.concat(F.lit(f"{code}:"), c), outside, WARNING)


def boolean(field: str) -> Rule:
    c = F.col(field)
    known = text.folded(c).isin(text.TRUE_WORDS + text.FALSE_WORDS)
    return rule(f"INVALID_BOOLEAN:{field}", (c != "") & ~known)


def placeholder(field: str, words: Sequence[str] = tuple(text.PLACEHOLDER_WORDS)) -> list[Rule]:
    """One warning per placeholder word found in the value."""
    return [rule(f"POTENTIAL_TEST_DATA:{field}", F.lower(F.col(field)).contains(w), WARNING) for w in words]


def in_range(field: str, low: int, high: int, code: str) -> Rule:
    return rule(f"{code}:{field}", ~F.col(field).between(low, high))
