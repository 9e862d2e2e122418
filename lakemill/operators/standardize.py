"""Standardisation of the three feeds: text to typed, cleaned columns under the same names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions import dates, numbers, text


def standardize_customers(df: DataFrame, date_formats: Sequence[str] = tuple(dates.REGISTRATION_DATES)) -> DataFrame:
    raw_date = F.col("registration_date")
    parsed = dates.parse_date(raw_date, date_formats)
    return df.withColumns(
        {
            "first_name": text.name_case(F.col("first_name")),
            "last_name": text.name_case(F.col("last_name")),
            "email_valid": text.email_valid(F.col("email")),
            "registration_date": parsed,
            "registration_date_parsed": raw_date.isNull() | parsed.isNotNull(),
            "customer_segment": text.segment(F.col("customer_segment")),
            "lifetime_value": numbers.amount(F.col("lifetime_value"), 12),
            "is_active": text.yes_no(F.col("is_active")),
            "phone": text.us_phone(F.col("phone")),
        }
    )


def standardize_orders(df: DataFrame, date_formats: Sequence[str] = tuple(dates.MONTH_FIRST_ISO)) -> DataFrame:
    amounts = ["subtotal", "tax_amount", "discount_amount", "total_amount"]
    return df.withColumns(
        {
            "order_date": dates.parse_timestamp(F.col("order_date"), date_formats),
            "created_at": dates.parse_timestamp(F.col("created_at"), date_formats),
            "payment_method": text.payment_method(F.col("payment_method")),
            **{c: numbers.amount(F.col(c)) for c in amounts},
        }
    )


def repair_order_total(df: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Total = subtotal + tax - discount wherever the stated total is further off."""
    expected = (F.col("subtotal") + F.col("tax_amount") - F.col("discount_amount")).try_cast("decimal(10,2)")
    return df.withColumn("total_amount", numbers.reconcile(F.col("total_amount"), expected, tolerance))


def standardize_items(df: DataFrame) -> DataFrame:
    price = numbers.amount(F.col("unit_price")).cast("decimal(12,2)")
    return df.withColumns(
        {
            "product_name": text.folded(F.col("product_name")),
            "category": text.category(F.col("category")),
            "sku_cleaned": F.upper(F.trim(F.col("sku"))),
            "quantity": numbers.quantity(F.col("quantity")),
            "unit_price": price,
            "line_total": numbers.amount(F.col("line_total"), 12),
        }
    ).drop("sku")


def repair_line_total(df: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Line total = quantity x unit price wherever the stated one is further off."""
    expected = F.col("quantity") * F.col("unit_price")
    return df.withColumn("line_total", numbers.reconcile(F.col("line_total"), expected, tolerance))


def absolute_items(df: DataFrame) -> DataFrame:
    """The alternative item policy: signs dropped, totals recomputed with no tolerance."""
    quantity = numbers.quantity(F.col("quantity"), negative="abs")
    price = numbers.amount(F.col("unit_price"), negative="abs")
    stated = numbers.decimal_or_null(F.col("line_total"), 10)
    expected = (price * quantity).try_cast("decimal(10,2)")
    return df.withColumns(
        {
            "category": text.category_title(F.col("category")),
            "quantity": quantity,
            "unit_price": price,
            "line_total": numbers.reconcile(stated, expected, "0"),
        }
    )
