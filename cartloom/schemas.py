"""Declared table schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The seventeen text columns of a landing file, in table order.
SOURCE_COLUMNS = [
    "order_id", "order_date", "customer_id", "customer_name", "customer_email",
    "customer_city", "customer_state", "product_name", "product_category", "quantity",
    "unit_price", "discount_amount", "revenue", "store_name", "shipping_method",
    "shipping_status", "payment_method",
]
METADATA_COLUMNS = ["_ingested_at", "_source_filename", "_pipeline_run_date", "_email_received_date"]
RAW_COLUMNS = SOURCE_COLUMNS + METADATA_COLUMNS

# Amounts have 29 digits before the point and nine after it.
AMOUNT = T.DecimalType(38, 9)
CORRECTED = T.DecimalType(31, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


RAW_SCHEMA = _struct(
    *[(name, T.StringType()) for name in SOURCE_COLUMNS],
    ("_ingested_at", T.TimestampType()),
    ("_source_filename", T.StringType()),
    ("_pipeline_run_date", T.DateType()),
    ("_email_received_date", T.StringType()),
)

# What happened to each file: started, loaded, empty or bad_date.
LOADS_SCHEMA = _struct(
    ("_source_filename", T.StringType()),
    ("_pipeline_run_date", T.DateType()),
    ("_ingested_at", T.TimestampType()),
    ("rows", T.LongType()),
    ("status", T.StringType()),
)

CLEANED_SCHEMA = _struct(
    ("order_id", T.StringType()),
    ("order_date", T.DateType()),
    ("customer_id", T.StringType()),
    ("customer_name", T.StringType()),
    ("customer_email", T.StringType()),
    ("customer_city", T.StringType()),
    ("customer_state", T.StringType()),
    ("store_name", T.StringType()),
    ("product_name", T.StringType()),
    ("product_category", T.StringType()),
    ("quantity", T.LongType()),
    ("unit_price", AMOUNT),
    ("discount_amount", AMOUNT),
    ("revenue", CORRECTED),
    ("_revenue_was_corrected", T.BooleanType()),
    ("shipping_method", T.StringType()),
    ("shipping_status", T.StringType()),
    ("payment_method", T.StringType()),
    ("_ingested_at", T.TimestampType()),
    ("_source_filename", T.StringType()),
    ("_pipeline_run_date", T.DateType()),
    ("_email_received_date", T.StringType()),
)

REJECTED_COLUMNS = [
    "order_id", "order_date", "customer_id", "customer_name", "customer_email",
    "customer_city", "customer_state", "product_name", "product_category", "store_name",
    "quantity", "unit_price", "discount_amount", "revenue", "shipping_method",
    "shipping_status", "payment_method", "_ingested_at", "_source_filename",
]
REJECTED_SCHEMA = _struct(
    *[(name, RAW_SCHEMA[name].dataType) for name in REJECTED_COLUMNS],
    ("rejection_reason", T.StringType()),
    ("_rejected_at", T.TimestampType()),
)

MART_GRAIN = ["order_date", "store_name", "product_category", "product_name", "shipping_status"]
MART_PARTITIONS = ["order_year", "order_month"]
MART_SCHEMA = _struct(
    ("order_date", T.DateType()),
    ("store_name", T.StringType()),
    ("product_category", T.StringType()),
    ("product_name", T.StringType()),
    ("shipping_status", T.StringType()),
    ("total_orders", T.LongType()),
    ("total_units_sold", T.LongType()),
    ("unique_customers", T.LongType()),
    ("total_revenue", T.DecimalType(38, 2)),
    ("total_discounts_given", T.DecimalType(38, 2)),
    ("discount_rate_pct", T.DecimalType(38, 2)),
    ("order_year", T.LongType()),
    ("order_month", T.LongType()),
    ("order_year_month", T.StringType()),
    ("order_day_of_week", T.StringType()),
    ("_last_updated", T.DateType()),
)

MANIFEST_SCHEMA = _struct(
    ("seq", T.LongType()),
    ("subject", T.StringType()),
    ("sender", T.StringType()),
    ("received_at", T.TimestampType()),
    ("attachments", T.ArrayType(T.StringType())),
)

ARRIVALS_SCHEMA = _struct(
    ("sender", T.StringType()),
    ("filename", T.StringType()),
    ("run_date", T.DateType()),
    ("first_at", T.TimestampType()),
    ("last_at", T.TimestampType()),
    ("deliveries", T.LongType()),
)
