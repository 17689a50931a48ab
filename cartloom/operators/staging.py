"""Raw text rows to typed, canonical, corrected orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.domains import REVENUE_TOLERANCE, STATES
from cartloom.functions import magnitude, null_if_empty, safe_date, safe_int, safe_num, title_words, ws_trim
from cartloom.functions.numbers import cents, expected_parts, further_than, same_sign, small_expected, small_further_than
from cartloom.operators.batch import current_batch, dedup_latest, has_order_id
from cartloom.operators.canonical import (
    canonical_category,
    canonical_product,
    canonical_status,
    canonical_store,
    product_key,
)
from cartloom.schemas import AMOUNT, CLEANED_SCHEMA, CORRECTED


def customer_columns() -> dict[str, Column]:
    return {
        "customer_id": ws_trim(F.col("customer_id")),
        "customer_name": null_if_empty(title_words(ws_trim(F.col("customer_name")))),
        "customer_email": null_if_empty(F.lower(ws_trim(F.col("customer_email")))),
        "customer_city": null_if_empty(title_words(ws_trim(F.col("customer_city")))),
        "customer_state": null_if_empty(F.upper(ws_trim(F.col("customer_state")))),
    }


def parsed_amounts() -> dict[str, Column]:
    return {
        "quantity": magnitude(safe_int(F.col("quantity"))),
        "unit_price": safe_num(F.col("unit_price")),
        "discount_amount": F.coalesce(safe_num(F.col("discount_amount")), F.lit(0).cast(AMOUNT)),
        "_stated": safe_num(F.col("revenue")),
    }


def checked_revenue() -> dict[str, Column]:
    """Revenue and its flag from what :func:`with_parts` gives: quantity × price − discount is expected, as one number
    (``_small``) for amounts of everyday size, as parts of one sign for all others. An overflow is an error.

    A stated revenue within the tolerance is kept, any other (also none at all) recomputed.
    The flag stays NULL when there was no readable revenue to compare with.
    """
    off = revenue_is_off()  # used twice in one projection, which computes it once
    expected = F.when(F.col("_small").isNotNull(), F.round("_small", 2).cast(CORRECTED)).otherwise(cents(F.col("_whole"), F.col("_rest")))
    return {"revenue": F.when(~off, F.round("_stated", 2).cast(CORRECTED)).otherwise(expected), "_revenue_was_corrected": off}


def with_parts(rows: DataFrame, quantity: str, price: str, discount: str) -> DataFrame:
    """``_small``, or else ``_whole`` and ``_rest``: the expected revenue beside the ``_stated`` one.

    Each projection copies whole rows, so there are no more of them than needed to compute every part once.
    """
    amounts = F.col(quantity), F.col(price), F.col(discount)
    small = small_expected(*amounts, F.col("_stated"))
    parts = {name: F.when(small.isNull(), part) for name, part in expected_parts(*amounts).items()}
    return rows.withColumns({"_small": small, **parts}).withColumns(same_sign(F.col("_whole"), F.col("_rest")))


def revenue_is_off() -> Column:
    """Whether the stated revenue is further from the expected one (see :func:`with_parts`) than the tolerance."""
    stated, tolerance = F.col("_stated"), F.lit(REVENUE_TOLERANCE)
    return F.when(F.col("_small").isNotNull(), small_further_than(stated, F.col("_small"), tolerance)).otherwise(
        further_than(stated, F.col("_whole"), F.col("_rest"), tolerance))


def correct_revenue(rows: DataFrame) -> DataFrame:
    """Typed quantity, price, discount and checked revenue in place of the raw texts."""
    parsed = with_parts(rows.withColumns(parsed_amounts()), "quantity", "unit_price", "discount_amount")
    return parsed.withColumns(checked_revenue()).drop("_stated", "_small", "_whole", "_rest")


def type_orders(rows: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """All per-column rules on deduplicated raw rows; row count is unchanged. Columns to ``carry`` come last.

    Projections prepare what later rules read many times, so Spark keeps them apart and computes
    each key, text and amount once.
    """
    prepared = rows.withColumns({
        **parsed_amounts(),
        "_product_key": product_key(F.col("product_name")),
        "store_name": ws_trim(F.col("store_name")),
        "product_category": ws_trim(F.col("product_category")),
        "shipping_status": ws_trim(F.col("shipping_status")),
    })
    typed = with_parts(prepared, "quantity", "unit_price", "discount_amount").withColumns({
        **customer_columns(),
        **checked_revenue(),
        "order_id": ws_trim(F.col("order_id")),
        "order_date": safe_date(F.col("order_date")),
        "product_name": canonical_product(F.col("product_name"), F.col("_product_key")),
        "store_name": canonical_store(F.col("store_name")),
        "product_category": canonical_category(F.col("product_category")),
        "shipping_method": null_if_empty(title_words(ws_trim(F.col("shipping_method")))),
        "shipping_status": canonical_status(F.col("shipping_status")),
        "payment_method": null_if_empty(title_words(ws_trim(F.col("payment_method")))),
    })
    return typed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CLEANED_SCHEMA], *(carry or []))


def valid_orders(orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Orders fit for reporting; a NULL in any tested column drops the row."""
    rows = orders.where(
        F.col("order_date").isNotNull()
        & (F.col("order_date") <= F.lit(as_of))
        & (F.col("quantity") > 0)
        & (F.col("unit_price") > 0)
        & F.col("customer_state").isin(STATES)
    )
    # A filter on the revenue would be moved below its projections and compute all of them again;
    # a generator that gives one row or none stays where it is.
    once = F.explode(F.when(F.col("revenue") > 0, F.array(F.lit(1)))).alias("_once")
    return rows.select(*orders.columns, once).drop("_once")


def clean_orders(
    raw: DataFrame, as_of: dt.date, trim_key: bool = False, run_dates: list[dt.date] | None = None
) -> DataFrame:
    """The cleaned table of the batch ingested on ``as_of``.

    Orders are told apart by the id as it came, so ``A1`` and `` A1`` both stay and look
    alike afterwards; ``trim_key`` treats them as one order instead.
    """
    rows = has_order_id(current_batch(raw, as_of, run_dates))
    if trim_key:
        rows = rows.withColumn("_key", ws_trim(F.col("order_id")))
        rows = dedup_latest(rows, "_key").drop("_key")
    else:
        rows = dedup_latest(rows)
    return valid_orders(type_orders(rows), as_of)
