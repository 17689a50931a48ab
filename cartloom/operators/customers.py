"""Different customers that add up: a sketch beside the exact count of each group of the mart.

``unique_customers`` of the mart must not be summed, as a customer may buy in many groups. Sketches
of groups merge instead: any roll-up of the mart gets its customers from them, without the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.schemas import MART_GRAIN, MART_PARTITIONS

LOG_BUCKETS = 14  # a full sketch has 16 KB, a small one a few bytes a customer


def stated_error(log_buckets: int = LOG_BUCKETS) -> float:
    """Share by which an estimate may be off: five standard errors of merged HyperLogLog sketches."""
    return 5 * 1.04 / 2 ** (log_buckets / 2)


def customer_sketches(cleaned: DataFrame, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """Per group of the mart: its year, month, and the sketch of its customers. NULL ids do not count.

    Sketches combine before the shuffle, so a group that holds much of the table sends one row per task.
    """
    sketch = F.hll_sketch_agg("customer_id", log_buckets).alias("customer_sketch")
    day = F.col("order_date")
    months = [F.year(day).cast("bigint").alias("order_year"), F.month(day).cast("bigint").alias("order_month")]
    return cleaned.groupBy(*MART_GRAIN).agg(sketch).select(*MART_GRAIN, "customer_sketch", *months)


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Replace the months that ``sketches`` has groups of; other months stay. Stored by month like the mart."""
    (
        sketches.repartitionByRange(*MART_PARTITIONS, "order_date", "store_name")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MART_PARTITIONS).parquet(path)
    )


def customers_over(sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated different customers per value of ``keys``; without keys one row, over all groups."""
    merged = F.hll_union_agg("customer_sketch").alias("_merged")
    estimate = F.coalesce(F.hll_sketch_estimate("_merged"), F.lit(0)).alias("customers_estimate")
    return sketches.groupBy(*keys).agg(merged).select(*keys, estimate)
