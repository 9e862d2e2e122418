"""Derived business columns. Dates are compared with a fixed ``as_of`` day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions import dates, numbers, text


def enrich_customers(df: DataFrame, as_of: date) -> DataFrame:
    return df.withColumns(
        {
            "full_name": text.full_name(F.col("first_name"), F.col("last_name")),
            "customer_age_days": dates.days_until(as_of, F.col("registration_date")),
            "customer_tier": numbers.band(F.col("lifetime_value"), numbers.CUSTOMER_TIERS, "bronze"),
            "email_domain": text.email_domain(F.col("email")),
            "has_verified_contact": F.col("email_valid") | F.col("phone").isNotNull(),
        }
    )


def add_calendar(df: DataFrame, column: str = "order_date", prefix: str = "order") -> DataFrame:
    at = F.col(column)
    hour, weekday = F.hour(at), F.dayofweek(at)
    return df.withColumns(
        {
            f"{prefix}_year": F.year(at),
            f"{prefix}_month": F.month(at),
            f"{prefix}_day": F.dayofmonth(at),
            f"{prefix}_quarter": F.quarter(at),
            f"{prefix}_day_of_week": weekday,
            f"{prefix}_day_name": dates.day_name(at),
            f"{prefix}_week_of_year": F.weekofyear(at),
            f"{prefix}_hour": hour,
            f"{prefix}_time_period": dates.time_period(hour),
            "is_weekend": weekday.isin(1, 7),
        }
    )


def add_order_values(df: DataFrame, as_of: date) -> DataFrame:
    return df.withColumns(
        {
            "order_value_category": numbers.band(F.col("total_amount"), numbers.ORDER_VALUES, "low_value"),
            "discount_percentage": numbers.percentage(F.col("discount_amount"), F.col("subtotal")),
            "has_discount": F.col("discount_amount") > 0,
            "days_since_order": dates.days_until(as_of, F.col("order_date")),
        }
    )


def enrich_orders(df: DataFrame, as_of: date) -> DataFrame:
    return add_order_values(add_calendar(df), as_of)


def enrich_items(df: DataFrame) -> DataFrame:
    total, quantity = F.col("line_total"), F.col("quantity")
    return df.withColumns(
        {
            "item_value_category": numbers.band(total, numbers.ITEM_VALUES, "low_value"),
            "quantity_category": numbers.band(quantity, numbers.ITEM_QUANTITIES, "single"),
            "price_category": numbers.band(F.col("unit_price"), numbers.ITEM_PRICES, "budget"),
            "is_high_quantity": quantity >= 3,
            "extended_price": total,
            "avg_price_per_item": (total / quantity).try_cast("decimal(10,2)"),
        }
    )
