"""What became of every raw row of a day: cleaned, rejected, both or neither."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.operators.batch import current_batch, dedup_latest, has_order_id
from cartloom.operators.staging import type_orders
from cartloom.schemas import CLEANED_SCHEMA, RAW_COLUMNS, REJECTED_COLUMNS

# Each raw row has one of the first six; the last two are stored rows without a raw row.
OUTCOMES = ["cleaned", "both", "rejected", "superseded", "dropped", "copy", "unexplained_cleaned", "unexplained_rejected"]


def row_key(columns: list[str], name: str) -> dict[str, Column]:
    """A 128 bit name of a row as two numbers, ``<name>1`` and ``<name>2``; a NULL differs from every value and keeps its place."""
    values = [part for c in columns for part in (F.col(c), F.isnull(c))]
    return {f"{name}{seed}": F.xxhash64(F.lit(seed), *values) for seed in (1, 2)}


def _numbers(**counts: object) -> list[Column]:
    return [F.lit(count).cast("bigint").alias(name) if isinstance(count, int) else count.cast("bigint").alias(name) for name, count in counts.items()]


def _trace(rows: DataFrame, key: list[str], row: list[str], found: str) -> DataFrame:
    """``rows`` with ``found``: is one of the ``_stored`` rows of its key this ``row``?

    Stored rows stand among the others, without a ``row``. The rows of a key take its stored rows one each; ``<found>_extra`` counts
    those left over, on the first of them. Keys name rows almost whole, so few rows share one.
    """
    in_turn = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in row])
    all_of_key = in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place, stored, others = F.row_number().over(in_turn), F.sum("_stored").over(all_of_key), F.count(row[0]).over(all_of_key)
    return rows.select(
        "*", *_numbers(**{found: F.col(row[0]).isNotNull() & (place <= stored),
                          f"{found}_extra": F.when(place == others + 1, F.greatest(stored - others, F.lit(0))).otherwise(0)}))


def reconcile(
    raw: DataFrame, cleaned: DataFrame, rejected: DataFrame, as_of: dt.date, run_dates: list[dt.date] | None = None
) -> DataFrame:
    """Rows per outcome of the batch ingested on ``as_of``, traced through the stored tables by hash and multiplicity.

    The first six outcomes add up to the batch. ``cleaned``, ``rejected`` and ``both`` are different rows found in
    these tables; ``superseded`` rows lost against another row of their order and broke no rule; ``dropped`` rows won
    and are in neither table; ``copy`` are exact copies. An order is followed through the one row of it that wins.
    Unexplained rows of a table have no raw row that gives them. All outcomes have a row, also for an empty batch.
    """
    rows = current_batch(raw, as_of, run_dates)
    # A row is named by what the rejected table has of it and by the rest, so that the rows of a rejected one meet under one key.
    rest = row_key([c for c in RAW_COLUMNS if c not in REJECTED_COLUMNS], "_rest")
    row = {**row_key(REJECTED_COLUMNS, "_row"), "_rest1": rest["_rest1"]}
    key, as_cleaned = ["_row1", "_row2"], row_key(CLEANED_SCHEMA.names, "_cleaned")
    named = [c.alias(name) for name, c in row.items()]
    winners = type_orders(dedup_latest(has_order_id(rows)).withColumns(row), carry=[*row]).select(
        *row, *[c.alias(name) for name, c in as_cleaned.items()], *_numbers(_stored=0))
    in_cleaned = current_batch(cleaned, as_of).select(*[c.alias(name) for name, c in as_cleaned.items()], *_numbers(_stored=1))
    won = _trace(winners.unionByName(in_cleaned, allowMissingColumns=True), [*as_cleaned], [*row], "_kept").where(
        "_row1 IS NOT NULL OR _kept_extra > 0")
    in_rejected = current_batch(rejected, as_of).select(*[c.alias(name) for name, c in row.items() if name in key], *_numbers(_stored=1))
    # Copies meet before the shuffle, also those of a row that fills much of the table.
    different = (
        rows.select(*named, *_numbers(_copies=1))
        .unionByName(won.select(*row, "_kept", "_kept_extra", *_numbers(_won=F.col("_row1").isNotNull())), allowMissingColumns=True)
        .unionByName(in_rejected, allowMissingColumns=True)
        .groupBy(*row).agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("_copies", "_kept", "_kept_extra", "_won", "_stored")])
    )
    traced = _trace(different, key, ["_rest1"], "_held")
    is_row = F.col("_copies") > 0
    kept, held, won = (is_row & (F.col(c) > 0) for c in ("_kept", "_held", "_won"))
    counts = {
        "cleaned": F.count_if(kept & ~held), "both": F.count_if(kept & held), "rejected": F.count_if(~kept & held),
        "superseded": F.count_if(is_row & ~kept & ~held & ~won), "dropped": F.count_if(won & ~kept & ~held),
        "copy": F.sum(F.when(is_row, F.col("_copies") - 1)), "unexplained_cleaned": F.sum("_kept_extra"), "unexplained_rejected": F.sum("_held_extra"),
    }
    one = traced.agg(*[F.coalesce(counts[o], F.lit(0)).cast("bigint").alias(o) for o in OUTCOMES])
    return one.select(F.inline(F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(o).alias("rows")) for o in OUTCOMES])))
