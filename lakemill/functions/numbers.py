"""Amounts and quantities from text, with a stated policy for bad values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemill.functions.text import is_blank

WIDE = "decimal(38,10)"


def decimal_or_null(c: Column, precision: int, scale: int = 2) -> Column:
    return c.try_cast(f"decimal({precision},{scale})")


def amount(c: Column, precision: int = 10, scale: int = 2, *, negative: str = "zero") -> Column:
    """Decimal amount.

    ``negative="zero"``: missing, unreadable or below zero becomes 0.
    ``negative="abs"``: the sign is dropped, blank becomes 0, unreadable stays null.
    """
    zero = F.lit(0).cast(f"decimal({precision},{scale})")
    value = decimal_or_null(c, precision, scale)
    if negative == "abs":
        return F.when(is_blank(c), zero).otherwise(F.abs(value))
    if negative == "zero":
        return F.greatest(F.coalesce(value, zero), zero)
    raise ValueError(f"unknown negative policy: {negative}")


def quantity(c: Column, *, negative: str = "one") -> Column:
    """Whole quantity; text such as ``3.0`` is read as 3.

    ``negative="one"``: missing, unreadable or below 1 becomes 1.
    ``negative="abs"``: as in ``amount``.
    """
    if negative == "abs":
        return amount(c, 10, 0, negative="abs")
    if negative == "one":
        return F.greatest(c.try_cast("decimal(10,0)").try_cast("int"), F.lit(1))
    raise ValueError(f"unknown negative policy: {negative}")


def reconcile(stated: Column, expected: Column, tolerance: str = "0.01") -> Column:
    """The stated amount, or the expected one where they differ by more than the tolerance."""
    off = F.abs(stated - expected) > F.lit(tolerance).cast("decimal(10,2)")
    return F.when(off, expected).otherwise(stated)


def band(c: Column, steps: Sequence[tuple[int, str]], otherwise: str) -> Column:
    """Label of the first lower bound that ``c`` reaches, bounds given highest first."""
    labelled = F
    for bound, label in steps:
        labelled = labelled.when(c >= bound, F.lit(label))
    return labelled.otherwise(F.lit(otherwise))


# Lower bounds of the business bands.
CUSTOMER_TIERS = [(5000, "platinum"), (2000, "gold"), (500, "silver")]
ORDER_VALUES = [(500, "high_value"), (100, "medium_value")]
ITEM_VALUES = [(100, "high_value"), (25, "medium_value")]
ITEM_QUANTITIES = [(5, "bulk"), (2, "multiple")]
ITEM_PRICES = [(100, "premium"), (25, "mid_range")]


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as decimal(10,2); 0 where the whole is not positive, null if too large."""
    zero = F.lit(0).cast("decimal(10,2)")
    return F.when(whole > 0, (part / whole * 100).try_cast("decimal(10,2)")).otherwise(zero)
