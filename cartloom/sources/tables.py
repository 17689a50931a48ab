"""Stored tables: scans with declared schemas and the sinks of each layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartloom.domains import CATEGORY_RULES, STORE_RULES
from cartloom.schemas import (
    CLEANED_SCHEMA, LOADS_SCHEMA, MART_PARTITIONS, MART_SCHEMA, RAW_SCHEMA, REJECTED_SCHEMA,
)
from cartloom.sources.files import exists

# Ids, names and amounts differ from row to row. Looking each up in a dictionary took a third of the time of a write, and the
# compressed files are no smaller for it; columns of few values keep theirs.
VARIED = ("order_id", "customer_id", "customer_name", "customer_email", "unit_price", "discount_amount", "revenue")
CODEC = {
    "compression": "zstd",  # whole rows of text: smaller by a third than by the default
    **{f"parquet.enable.dictionary#{name}": "false" for name in VARIED},
}

STARTED, LOADED, EMPTY, BAD_DATE = "started", "loaded", "empty", "bad_date"


def read_table(spark: SparkSession, path: str, schema: StructType, must_exist: bool = False) -> DataFrame:
    """A stored table in declared column order. A table not written yet has no rows, unless it
    ``must_exist``; any other problem is an error."""
    if not exists(spark, path):
        if must_exist:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_raw(spark: SparkSession, path: str, must_exist: bool = False) -> DataFrame:
    return read_table(spark, path, RAW_SCHEMA, must_exist)


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, CLEANED_SCHEMA)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, REJECTED_SCHEMA)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, MART_SCHEMA)


def append_raw(rows: DataFrame, path: str) -> int:
    """Append to the raw table, stored by run date, and return the number of rows.

    Rows are counted while they are written, not by a second pass.
    """
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.options(**CODEC).mode("append").partitionBy("_pipeline_run_date").parquet(path)
    return seen.get["rows"]


def loads_path(raw_path: str) -> str:
    """Where the loads of a raw table are recorded, beside it."""
    return f"{raw_path.rstrip('/')}_loads"


def record_loads(spark: SparkSession, raw_path: str, loads: list[tuple]) -> None:
    """Append to the small table of loads: file, run date, instant, rows, status."""
    if loads:
        spark.createDataFrame(loads, LOADS_SCHEMA).coalesce(1).write.mode("append").parquet(loads_path(raw_path))


def read_loads(spark: SparkSession, raw_path: str) -> DataFrame:
    """The recorded loads. A raw table from before they were kept is summed up once."""
    path = loads_path(raw_path)
    if not exists(spark, path) and exists(spark, raw_path):
        keys = ["_source_filename", "_pipeline_run_date", "_ingested_at"]
        loads = read_raw(spark, raw_path).groupBy(*keys).agg(F.count("*").alias("rows"))
        loads.withColumn("status", F.lit(LOADED)).coalesce(1).write.parquet(path)
    return read_table(spark, path, LOADS_SCHEMA)


def history_months(rows: DataFrame) -> DataFrame:
    day = F.col("order_date")
    return rows.withColumns({"order_year": F.year(day).cast("bigint"), "order_month": F.month(day).cast("bigint")})


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned orders of all batches, stored by order month (``order_year``, ``order_month`` come last)."""
    schema = StructType([*CLEANED_SCHEMA.fields])
    for name in MART_PARTITIONS:
        schema = schema.add(MART_SCHEMA[name])
    return read_table(spark, path, schema)


HISTORY_ORDER = [*MART_PARTITIONS, "order_id"]


def history_layout(orders: DataFrame) -> DataFrame:
    """Rows with their month, those of a month and id in one task, sorted by both."""
    return history_months(orders).repartitionByRange(*HISTORY_ORDER).sortWithinPartitions(*HISTORY_ORDER)


def replace_history_months(orders: DataFrame, path: str) -> None:
    """Replace the months that ``orders`` has rows of; the table is stored by month, sorted by id.

    Orders that are stored in this way already, as their month among the columns tells, are not shuffled again.
    """
    stored = set(MART_PARTITIONS) <= set(orders.columns)
    rows = orders.sortWithinPartitions(*HISTORY_ORDER) if stored else history_layout(orders)
    (
        rows.write.options(**CODEC).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*MART_PARTITIONS).parquet(path)
    )


def overwrite_table(rows: DataFrame, path: str) -> None:
    """Replace a staging table as a whole."""
    rows.write.options(**CODEC).mode("overwrite").parquet(path)


def _place(value: Column, names: list[str]) -> Column:
    """How many of the names are smaller: 0 to their number, in the order of the values, unknown ones included."""
    return sum((F.coalesce(value > F.lit(name), F.lit(False)).cast("int") for name in names), F.lit(0))


def _woven(*places: tuple[Column, int]) -> Column:
    """The bits of several numbers in turn, the highest first; a number with fewer bits is done earlier."""
    key = F.lit(0)
    for step in range(max(bits for _, bits in places)):
        for number, bits in places:
            if step < bits:
                key = key * 2 + F.shiftright(number, bits - 1 - step).bitwiseAND(F.lit(1))
    return key


def mart_layout(mart: DataFrame, files: int | None = None) -> DataFrame:
    """Near days, stores and categories together, so that a filter on any one of them skips files and row groups.

    Within a month, rows follow a key woven from the bits of category, store and day (Z-order), which keeps the order of
    each. Ranges are cut by size: one busy month fills several tasks, and its rows land in few files.
    """
    key = _woven(
        (_place(F.col("product_category"), [name for name, _ in CATEGORY_RULES]), 3),
        (_place(F.col("store_name"), [name for name, _ in STORE_RULES]), 3),
        (F.day("order_date") - 1, 5),
    )
    layout = [*MART_PARTITIONS, "_key", "order_date", "store_name", "product_category"]
    rows = mart.withColumn("_key", key)
    ranges = rows.repartitionByRange(*layout) if files is None else rows.repartitionByRange(files, *layout)
    return ranges.sortWithinPartitions(*layout).drop("_key")


def write_mart(mart: DataFrame, path: str) -> None:
    """Replace the mart. It is stored by month: a day has too few rows for files of its own."""
    mart_layout(mart).write.mode("overwrite").partitionBy(*MART_PARTITIONS).parquet(path)


def replace_mart_months(mart: DataFrame, path: str) -> None:
    """Replace the months that ``mart`` has rows of and leave all others alone."""
    (
        mart_layout(mart).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*MART_PARTITIONS)
        .parquet(path)
    )


def keep_results(results: DataFrame, path: str, run: dt.date) -> None:
    """Keep the results of every run, by its day: a repeated run replaces its own."""
    (
        results.withColumn("_run", F.lit(run)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("_run").parquet(path)
    )
