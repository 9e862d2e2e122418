"""Row filters on keys and quality flags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.text import email_valid, is_blank

# Columns that must be filled for a row to reach the silver layer.
CUSTOMER_IDS = ("customer_id", "email")
ORDER_IDS = ("order_id", "customer_id")
ITEM_IDS = ("item_id", "order_id", "product_id")


def filled(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [~is_blank(F.col(c)) for c in columns])


def acceptable(columns: Sequence[str]) -> Column:
    """All ids filled and no rule of severity ERROR violated. True or false, never null."""
    return filled(columns) & F.coalesce(F.col("_dq_error_count") == 0, F.lit(False))


def drop_invalid(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(acceptable(columns))


def drop_blank_ids(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(filled(columns))


def amount_mismatches(df: DataFrame) -> DataFrame:
    """Orders whose stated total is not subtotal + tax - discount."""
    expected = F.col("subtotal") + F.col("tax_amount") - F.col("discount_amount")
    return df.filter(F.col("total_amount") != expected)


def missing_email(df: DataFrame) -> DataFrame:
    return df.filter(F.col("email").isNull())


def present_email(df: DataFrame) -> DataFrame:
    return df.filter(F.col("email").isNotNull())


def unusable_email(df: DataFrame) -> DataFrame:
    return df.filter(~email_valid(F.col("email")))
