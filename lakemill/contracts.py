"""Feed contracts: the columns, keys and rules a landing feed is held to."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql.types import StringType, StructField, StructType

from lakemill.functions import rules as r
from lakemill.functions.rules import Rule
from lakemill.functions.text import SEGMENTS


@dataclass(frozen=True)
class FeedContract:
    name: str
    key: str
    columns: tuple[str, ...]
    required: tuple[str, ...]
    rules: Callable[[date], list[Rule]]
    version: str = "1.0"

    @property
    def landing_schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in self.columns])

    @property
    def bronze_schema(self) -> StructType:
        """Schema of the stored bronze table.

        Drift is folded into ``_extra_fields``, so the table has one schema for good
        and readers need neither inference nor schema merging over all footers.
        """
        schema = self.landing_schema
        for field in StructType.fromDDL(BRONZE_COLUMNS).fields:
            schema = schema.add(field)
        return schema


# Columns that the bronze layer adds to every feed.
BRONZE_COLUMNS = """
    _extra_fields string,
    _dq_completeness_score decimal(5,2),
    _dq_has_errors boolean,
    _dq_error_count int,
    _dq_warning_count int,
    _dq_error_details string,
    _dq_warning_details string,
    _bronze_record_hash string,
    _dq_is_duplicate boolean,
    _dq_duplicate_of_batch string,
    _bronze_ingestion_timestamp timestamp,
    _bronze_source_file string,
    _bronze_source_line_number bigint,
    _bronze_raw_record string,
    _bronze_file_hash string,
    _schema_version string,
    _bronze_ingestion_date string,
    _bronze_ingestion_batch_id string
"""


def _customer_rules(as_of: date) -> list[Rule]:
    return [
        r.required("customer_id"),
        r.required("email"),
        r.email("email"),
        r.phone("phone"),
        *r.calendar("registration_date", "FUTURE_REGISTRATION_DATE", as_of),
        *r.numeric("lifetime_value"),
        r.listed("customer_segment", SEGMENTS, "UNKNOWN_SEGMENT"),
        r.boolean("is_active"),
        *r.placeholder("first_name"),
        *r.placeholder("last_name"),
    ]


def _order_rules(as_of: date) -> list[Rule]:
    amounts = ["total_amount", "subtotal", "tax_amount", "discount_amount"]
    return [r.required(f) for f in ORDERS.required] + [
        check for f in amounts for check in r.numeric(f, "NEGATIVE_AMOUNT")
    ]


def _item_rules(as_of: date) -> list[Rule]:
    return [r.required(f) for f in ORDER_ITEMS.required] + [
        check for f in ["quantity", "unit_price", "line_total"] for check in r.numeric(f)
    ]


CUSTOMERS = FeedContract(
    name="customers",
    key="customer_id",
    columns=(
        "customer_id", "first_name", "last_name", "email", "phone",
        "registration_date", "customer_segment", "is_active", "lifetime_value",
    ),
    required=("customer_id", "email"),
    rules=_customer_rules,
)

ORDERS = FeedContract(
    name="orders",
    key="order_id",
    columns=(
        "order_id", "customer_id", "order_date", "subtotal", "tax_amount",
        "discount_amount", "total_amount", "payment_method", "created_at",
    ),
    required=("order_id", "customer_id", "order_date", "created_at"),
    rules=_order_rules,
)

ORDER_ITEMS = FeedContract(
    name="order_items",
    key="item_id",
    columns=(
        "item_id", "order_id", "product_id", "product_name", "category",
        "quantity", "unit_price", "line_total", "sku",
    ),
    required=("item_id", "order_id", "product_id"),
    rules=_item_rules,
)
