"""Which raw rows a run looks at, and which copy of a row counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.functions import is_blank, utc_instant
from cartloom.functions.packing import pack_texts, unpack_texts
from cartloom.schemas import SOURCE_COLUMNS


def current_batch(raw: DataFrame, as_of: dt.date, run_dates: list[dt.date] | None = None) -> DataFrame:
    """Rows ingested on the UTC day ``as_of``.

    The day is a half-open range of instants: unlike a date function around the column it
    reaches the parquet reader, and every load has one instant, so whole files are skipped.
    ``run_dates`` prunes partitions too when the caller knows which runs were loaded that day.
    """
    rows = raw.where(
        (F.col("_ingested_at") >= F.lit(utc_instant(as_of)))
        & (F.col("_ingested_at") < F.lit(utc_instant(as_of + dt.timedelta(days=1))))
    )
    return rows if run_dates is None else rows.where(F.col("_pipeline_run_date").isin(run_dates))


def run_dates_of(loads: DataFrame, as_of: dt.date) -> list[dt.date]:
    """Run dates of the files loaded on the UTC day ``as_of``, by the table of loads: a few values."""
    today = (F.col("_ingested_at") >= F.lit(utc_instant(as_of))) & (F.col("_ingested_at") < F.lit(utc_instant(as_of + dt.timedelta(days=1))))
    rows = loads.where(today & (F.col("status") == "loaded")).select("_pipeline_run_date").distinct().collect()
    return sorted(r[0] for r in rows)


def latest_run(raw: DataFrame, loads: DataFrame | None = None) -> DataFrame:
    """Rows of the highest run date.

    The scalar subquery runs first and prunes the partitions of a table stored by run date. With the
    table of loads it reads that instead of all of raw.
    """
    source = raw if loads is None else loads.where("status = 'loaded'")
    newest = source.agg(F.max("_pipeline_run_date")).scalar()
    return raw.where(F.col("_pipeline_run_date") == newest)


def exact_distinct(rows: DataFrame) -> DataFrame:
    return rows.distinct()


def with_copies(rows: DataFrame, copies: str = "_copies") -> DataFrame:
    """Each different row once, with its number of copies.

    Copies meet before the shuffle, so a row that fills a third of the table travels once
    per task. Counts over all rows become sums of ``copies``.
    """
    return rows.groupBy(*rows.columns).agg(F.count("*").alias(copies))


def row_digest(rows: DataFrame) -> dict[str, Column]:
    """256 bits that tell different rows apart, as four hashes from different seeds, and which columns are null.

    Each column's hash starts from that of the columns before it, so it matters where one ends; nulls, which a hash
    leaves out, have bits of their own. No text is built: SHA-256 of all columns as one text took twice the time of a scan.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    hashes = {f"_digest{k}": F.xxhash64(F.lit(k), *columns) for k in range(4)}
    nulls = flag_numbers([c.isNull() for c in columns])
    return {**hashes, **{f"_digest{name}": number for name, number in nulls.items()}}


def copies_of(rows: DataFrame, about: dict[str, Column], copies: str = "_copies") -> DataFrame:
    """Like :func:`with_copies`, but only what is asked ``about`` each different row: whole rows are read, their digests shuffled.

    A task groups narrow rows of one size, so its memory does not follow the texts.
    """
    digest = row_digest(rows)
    narrow = rows.select(*[value.alias(name) for name, value in {**digest, **about}.items()])
    return narrow.groupBy(*digest, *about).agg(F.count("*").alias(copies)).drop(*digest)


FLAGS_IN_ONE = 60


def flag_numbers(flags: list[Column]) -> dict[str, Column]:
    """Flags as the bits of a few numbers; null counts as false. :func:`flag` reads one."""
    parts = [flags[i:i + FLAGS_IN_ONE] for i in range(0, len(flags), FLAGS_IN_ONE)]
    return {
        f"_flags{n}": sum((F.when(flag, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, flag in enumerate(part)),
                          F.lit(0).cast("bigint"))
        for n, part in enumerate(parts)
    }


def flag(number: int) -> Column:
    return F.getbit(F.col(f"_flags{number // FLAGS_IN_ONE}"), F.lit(number % FLAGS_IN_ONE)) == 1


def has_order_id(rows: DataFrame) -> DataFrame:
    return rows.where(~is_blank(F.col("order_id")))


def dedup_latest(rows: DataFrame, key: str = "order_id") -> DataFrame:
    """One row per order: the latest ingested, ties broken by every other raw column.

    The order is total up to exact copies, so the result does not depend on partitioning,
    and exact copies need no DISTINCT (with its shuffle of whole rows) beforehand. Spark
    keeps the top row per order already before the shuffle (``WindowGroupLimit``), which
    leaves at most one row per task of an order that fills much of the table. The texts of a row
    travel as one, which is in order as they are.
    """
    texts = [c for c in SOURCE_COLUMNS if c != "order_id"]
    ranking = [F.col("_ingested_at").desc_nulls_last(), F.col("_source_filename").desc_nulls_last()]
    ranking += [F.col(c).asc_nulls_last() for c in ("order_id", "_texts", "_pipeline_run_date", "_email_received_date")]
    newest_first = Window.partitionBy(key).orderBy(*ranking)
    newest = pack_texts(rows, texts).withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1")
    return unpack_texts(newest, texts, rows.columns)
