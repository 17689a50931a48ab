"""Raw orders and landing messages derived from the shared test tables.

All noise is integer arithmetic on keys, so any SQL engine can build the same rows.
Raw orders are one projection over ``lineitem``: no join, and unused columns are pruned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.domains import PRODUCT_RULES, STATES
from cartloom.functions import utc_instant
from cartloom.schemas import RAW_COLUMNS
from cartloom.session import spread

AS_OF = dt.date(2001, 10, 15)
REJECTED_AT = utc_instant(AS_OF, 6, 40)
CHECKED_AT = utc_instant(AS_OF, 6, 45)

PRODUCTS = [name for name, _ in PRODUCT_RULES]
TYPOS = [
    "adirondack-chair", "Patio Dining Tabel", "Garden  Bench", "Sun Loungers", "Hammok",
    "Leaf Blowr", "GardenHose", "Prunning Shears", "Wheel Bar", "Trowl Set",
    "Gas Gril", "Charcol Grill", "BBQ Toolset", "Gas Grill Cover", "Firepit",
    "Solar Lantrn", "StringLights", "Path Light", "Deck-Lights", "floodlight led",
    "Wind Chimes", "bird bath", "Garden Stateu", "Plnt Pot", "Wall Plantr",
]
STRANGERS = ["Picnic-basket DELUXE", "sun_lounger", "Trowel", "", "  mystery\titem/box "]
CATEGORIES = [
    ["Furniture", "furniture ", "OUTDOOR FURNITURE"],
    ["Garden Tools", "garden-tools", "GardenTool"],
    ["BBQ & Grilling", "bbq", "grills & more"],
    ["Lighting", "LIGHTS", " lighting"],
    ["Outdoor Decor", "decor", "outdoor-decor"],
]
STORES = [
    ["PatioWorld", "patio_world!", "PATIO WORLD", " patio-world "],
    ["OutdoorHub", "outdoor hub", "OUTDOOR-HUB", "Outdoorhub"],
    ["NatureGoods", "nature goods", "Nature-Goods", "NATUREGOODS"],
    ["GardenPlus", "Garden + Plus", "garden-plus", "GARDEN PLUS "],
    ["HomeNest", "home-nest", "Home Nest", "homenest"],
]
STATUSES = ["Shipped", "dispatched", "IN TRANSIT", "processing", "Pending ", "delivered", "Complete",
            "returned", "REFUND", "canceled", "Cancelled", "back-ordered"]
CITIES = ["springfield", "  Salt Lake CITY", "winston-salem", "O'FALLON", "new york", ""]
METHODS = ["standard", "EXPRESS", "two-day", "store pickup"]
PAYMENTS = ["credit card", "PayPal", "gift-card", "APPLE PAY", "cash on delivery"]


MANIFEST_NOW = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def export_name(day: dt.date) -> str:
    return f"e_com_sales_{day:%Y%m%d}.csv"


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _pick_nested(lists: list[list[str]], outer: Column, inner: Column) -> Column:
    return _pick([v for values in lists for v in values], outer * len(lists[0]) + inner)


def _money(c: Column, digits: int = 14) -> Column:
    return F.round(c, 2).cast(f"decimal({digits},2)")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table: two loads on ``AS_OF`` (one of an older file) and one the day before."""
    line = spread(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    order, number, part, k = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "_k"))
    once, twice = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    line = line.withColumn("_k", order * 7 + number * 13 + part)
    line = line.withColumn("_copy", F.explode(F.when(k % 83 == 0, twice).otherwise(once)))

    def every(n: int, rest: int = 0) -> Column:
        return k % n == rest

    # Amounts are columns of their own, as many texts are made of them: decimals of doubles cost the most of a row.
    units, price, discount, exact = (F.col(c) for c in ("_units", "_price", "_discount", "_exact"))
    line = line.withColumns({
        "_units": F.col("l_quantity").cast("int"),
        "_price": _money(F.col("l_extendedprice").cast("decimal(18,2)") * F.lit("0.001").cast("decimal(4,3)"), 12),
    })
    line = line.withColumn("_discount", _money(units * price * F.col("l_discount").cast("decimal(4,2)")))
    line = line.withColumn("_exact", _money(units * price - discount))
    order_id = F.concat(F.lit("ORD-"), order, F.lit("-"), number)
    customer = (order - order % 3).cast("string")
    product = part % 25
    plain = _pick(PRODUCTS, product)
    state = _pick(STATES, order % 50)

    yesterday, older = AS_OF - dt.timedelta(days=1), AS_OF - dt.timedelta(days=2)
    loads = [
        (F.lit(True), utc_instant(AS_OF, 6, 30), AS_OF),
        (part % 5 == 0, utc_instant(AS_OF, 18, 45), older),
        (part % 4 == 3, utc_instant(yesterday, 6, 30), yesterday),
    ]

    def by_load(value) -> Column:
        (_, *today), (late, *second), (before, *first) = loads
        return F.when(before, value(*first)).when(late, value(*second)).otherwise(value(*today))

    columns = {
        "order_id": F.when(every(211), "").when(every(227), F.concat(F.lit(" "), order_id)).otherwise(order_id),
        "order_date": F.when(every(97), "").when(every(193), "2999-01-01").when(every(389), "not-a-date")
        .when(every(401), "2001-3-7").when(every(409), "2001")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")),
        "customer_id": F.concat(F.lit("C"), customer, F.when(every(5), " ").otherwise("")),
        "customer_name": F.when(every(37), "").when(every(3), F.concat(F.lit("  mary-ann SMITH "), customer))
        .otherwise(F.concat(F.lit("Customer "), customer)),
        "customer_email": F.when(every(29), "").when(every(31), F.concat(F.lit("user"), customer))
        .otherwise(F.concat(F.lit("User"), customer, F.lit("@Shop.example "))),
        "customer_city": _pick(CITIES, order % len(CITIES)),
        "customer_state": F.when(every(103), " ").when(every(101), "ZZ").when(every(7), F.lower(state)).otherwise(state),
        "product_name": F.when(every(149), _pick(STRANGERS, part % len(STRANGERS)))
        .when(every(7, 3), _pick(TYPOS, product)).when(every(5, 1), F.lower(plain)).when(every(5, 2), F.upper(plain))
        .when(every(5, 3), F.replace(plain, F.lit(" "), F.lit("-")))
        .when(every(5, 4), F.concat(F.lit(" "), F.replace(plain, F.lit(" "), F.lit("  ")))).otherwise(plain),
        "product_category": F.when(every(151), "misc-items")
        .otherwise(_pick_nested(CATEGORIES, ((product - product % 5) / 5).cast("int"), k % 3)),
        "quantity": F.when(every(53), (-units).cast("string")).when(every(59), "0").when(every(61), "abc")
        .when(every(67), "2.5").when(every(71), F.concat(F.lit(" "), units)).otherwise(units.cast("string")),
        "unit_price": F.when(every(173), "").when(every(179), "free").otherwise(price.cast("string")),
        "discount_amount": F.when(every(41), "").otherwise(discount.cast("string")),
        "revenue": F.when(every(73), "").when(every(79), (-exact).cast("string")).when(every(89), "n/a")
        .when(every(43), _money(exact + F.lit(1)).cast("string"))
        .when(every(47), _money(exact + F.lit("0.02").cast("decimal(3,2)")).cast("string"))
        .otherwise(exact.cast("string")),
        "store_name": F.when(every(307), "pop-up STAND").otherwise(_pick_nested(STORES, F.col("l_suppkey") % 5, k % 4)),
        "shipping_method": F.when(every(23), "").otherwise(_pick(METHODS, k % len(METHODS))),
        "shipping_status": _pick(STATUSES, (k + F.ascii("l_returnflag") + F.ascii("l_linestatus")) % len(STATUSES)),
        "payment_method": F.when(every(19), "").otherwise(_pick(PAYMENTS, k % len(PAYMENTS))),
        "_ingested_at": by_load(lambda instant, day: F.lit(instant)),
        "_source_filename": by_load(lambda instant, day: F.lit(export_name(day))),
        "_pipeline_run_date": by_load(lambda instant, day: F.lit(day)),
        "_email_received_date": by_load(lambda instant, day: F.lit(day.isoformat())),
    }
    return line.select(*[columns[c].alias(c) for c in RAW_COLUMNS])


def large_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order amounts of up to 28 digits before the point, built as text from ``lineitem``.

    The price is ``a`` with zeros behind it and nine decimals. The stated revenue is the exact one, off
    by the tolerance or a billionth more, far off, negative or missing.
    """
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order, number, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    k = order * 7 + number * 13 + part
    rows = line.select(
        order, number, k.alias("k"), F.col("l_quantity").cast("bigint").alias("q"),
        (order * 100 + part % 97 + 1).alias("a"), (k % 12 + 6).cast("int").alias("z"), (k * 7919 % 1000000000).alias("f"),
    )
    rows = rows.withColumns({
        "zeros": F.repeat(F.lit("0"), F.col("z")),
        "discounted": (F.col("k") % 4 == 0).cast("bigint"),
        "shift": F.when(F.col("k") % 5 == 1, 20000000).when(F.col("k") % 5 == 2, 20000001).otherwise(0),
    })
    billionths = F.col("q") * F.col("f") + F.col("shift")
    multiple = (F.col("q") - F.col("discounted")) * F.col("a")
    carry = F.expr("(q * f + shift) div 1000000000")
    whole = F.when(multiple == 0, carry.cast("string")).otherwise(
        F.concat(multiple.cast("string"), F.expr("lpad(cast((q * f + shift) div 1000000000 AS string), z, '0')"))
    )
    exact = F.concat(whole, F.lit("."), F.lpad((billionths % 1000000000).cast("string"), 9, "0"))
    price = F.concat(F.col("a").cast("string"), F.col("zeros"), F.lit("."), F.lpad(F.col("f").cast("string"), 9, "0"))
    return rows.select(
        "l_orderkey", "l_linenumber", F.col("q").cast("string").alias("quantity"), price.alias("unit_price"),
        F.when(F.col("discounted") == 1, F.concat(F.col("a").cast("string"), F.col("zeros"))).otherwise("").alias("discount_amount"),
        F.when(F.col("k") % 5 == 3, "n/a").when(F.col("k") % 5 == 4, F.concat(F.lit("-"), price)).otherwise(exact).alias("revenue"),
    )


def landing_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message list: one message per event, in arrival order of ``event_id``."""
    event = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind, key = F.col("event_type"), F.col("event_id")
    day = F.date_format("ts", "yyyy-MM-dd")
    name = F.concat(F.lit("e_com_sales_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv"))
    prefix = F.lit("[E-Com] Daily Sales Export ")
    subject = (
        F.when(kind == "purchase", F.concat(prefix, F.lit("– "), day))
        .when(kind == "view", F.concat(prefix, F.lit("- "), day))
        .when(kind == "click", F.concat(F.lit("Re: "), prefix, F.lit("– "), day))
        .when(kind == "signup", F.concat(F.upper(prefix), day))
        .otherwise(F.concat(F.lit("Weekly digest "), day))
    )
    attachments = (
        F.when(key % 11 == 0, F.array().cast("array<string>"))
        .when(key % 7 == 0, F.array(F.lit("notes.txt"), name, F.lit("e_com_sales_19990101.csv")))
        .otherwise(F.array(name))
    )
    return event.select(
        key.alias("seq"),
        subject.alias("subject"),
        F.concat(F.lit("sales"), F.col("user_id"), F.lit("@shop.example")).alias("sender"),
        F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC").alias("received_at"),
        attachments.alias("attachments"),
    )


def repeated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message list with deliveries spread over four days: some exports come late, some again."""
    message = landing_messages(spark, sf_dir)
    later = F.make_dt_interval((F.col("seq") % 4).cast("int"))
    return message.withColumn("received_at", F.col("received_at") + later)
