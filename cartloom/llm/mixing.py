"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are dealt into blocks. With a share of ``q`` in a period of ``Q`` slots, block
``i`` of a source is released at slot ``floor(i * Q / q)`` and due before slot ``ceil((i + 1) * Q / q)``.
Among the released blocks the one with the earliest deadline takes a slot. As all shares add up to
the period, no deadline is missed, so up to any slot a source that still has blocks is less than one
block from its share, however many rows there are: releases and deadlines follow the running block
number, and the period is ``SHARES``, longer than any mix, so that shares are as good as the weights.

The driver schedules one slot per block, in one pass that holds one heap entry per source. Its work does not
grow with the rows: blocks have ``BLOCK_ROWS`` rows, or as many more as it takes to have about ``PLAN_BLOCKS`` blocks
(and one per source) at most. ``plan_blocks`` slots at a time go to a stored table, from which Spark gives every block its
slot. A source that runs out leaves its later slots empty; the rest go on in proportion. Every document keeps
its place in the mix: none is dropped or repeated. Each of up to ``MAX_STREAMS`` sources has a weight of its own.

Null sources form the stream ``(none)``. Repeated rows and null ids are rows like all others. An
empty table gives an empty mix. Other columns pass through; the columns added are named in
``MIX_COLUMNS`` and replace input columns of the same name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import running_offsets
from cartloom.session import broadcast_if_small, fresh_folder, written

MIX_COLUMNS = ["stream", "block", "row_in_block", "release", "deadline", "slot"]
NO_SOURCE, OTHER = "(none)", "(other)"
# Weights are whole shares of this sum: over 2^31 slots less than half a block is lost to rounding.
SHARES = 1 << 32
# Blocks of a source in a row of the stored schedule.
PART = 1000
BLOCK_ROWS, PLAN_BLOCKS, PART_ROWS, MAX_STREAMS = 16, 1 << 22, 100_000, 200_000


def apportion(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole slots per period by largest remainder; those of less than one slot get one, off the largest."""
    names = sorted(weights)
    if not names:
        return {}
    if min(weights.values()) <= 0 or period < len(names):
        raise ValueError("weights must be positive and the period must hold a slot for each source")
    total = sum(weights.values())
    ideal = {n: weights[n] / total * period for n in names}
    slots = {n: max(1, int(ideal[n])) for n in names}
    by_rest = sorted(names, key=lambda n: (slots[n] - ideal[n], n))
    for n in by_rest[: max(0, period - sum(slots.values()))]:
        slots[n] += 1
    for _ in range(sum(slots.values()) - period):
        slots[max((n for n in names if slots[n] > 1), key=lambda n: (slots[n] - ideal[n], n))] -= 1
    return slots


def scheduled(slots: dict[str, int], period: int, blocks: dict[str, int]) -> Iterator[tuple[int, str, int]]:
    """Slot, source and number of each block, slot by slot: released blocks, earliest deadline first."""
    waiting = [(0, -(-period // slots[name]), name, 0) for name, n in blocks.items() if n]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, due, name, i = heapq.heappop(waiting)
            heapq.heappush(ready, (due, name, i))
        due, name, i = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a deadline was missed")
        yield slot, name, i
        if i + 1 < blocks[name]:
            q = slots[name]
            heapq.heappush(waiting, ((i + 1) * period // q, -(-(i + 2) * period // q), name, i + 1))
        slot += 1


def schedule(slots: dict[str, int], period: int) -> dict[str, list[int]]:
    """The slots of each source's blocks in one period."""
    taken: dict[str, list[int]] = {name: [] for name in slots}
    for slot, name, _ in scheduled(slots, period, slots):
        taken[name].append(slot)
    return taken


def _stored_plan(
    spark: SparkSession, shares: dict[str, int], blocks: dict[str, int], period: int, plan_blocks: int = 500_000
) -> DataFrame:
    """Rows of (stream, part, at): the slots of up to ``PART`` blocks of a stream, stored as they are made."""
    path, schema = fresh_folder(spark, "mix-plan"), "stream string, part long, at array<long>"
    open_parts: dict[str, list[int]] = {}
    full: list[tuple[str, int, list[int]]] = []
    held = 0

    def store() -> None:
        spark.createDataFrame(full, schema).write.mode("append").parquet(path)
        full.clear()

    for slot, name, i in scheduled(shares, period, blocks):
        part = open_parts.setdefault(name, [])
        part.append(slot)
        if len(part) == PART or i + 1 == blocks[name]:
            full.append((name, i // PART, open_parts.pop(name)))
            held += len(part)
            if held >= plan_blocks:
                store()
                held = 0
    store()
    return spark.read.schema(schema).parquet(path)


def tempered_weights(docs: DataFrame, source: str = "source", power: float = 0.7, max_streams: int = MAX_STREAMS) -> dict[str, float]:
    """Target weights ``rows ** power`` of all sources. Beyond ``max_streams`` sources, what the driver can hold,
    the smallest share a stream."""
    counts = docs.groupBy(F.coalesce(F.col(source), F.lit(NO_SOURCE)).alias("stream")).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "stream").limit(max_streams).collect()
    weights = {r.stream: float(r.n) ** power for r in top}
    if len(top) == max_streams:
        rest = docs.count() - sum(r.n for r in top)
        if rest:
            weights[OTHER] = weights.get(OTHER, 0.0) + float(rest) ** power
    return weights


def pfair_mix(
    docs: DataFrame, weights: dict[str, float], order_by: Column, source: str = "source",
    block_rows: int | None = None, period: int = SHARES, part_rows: int = PART_ROWS,
) -> DataFrame:
    """Every row with its stream, block, place in the block, release, deadline and slot.

    Sources that ``weights`` does not name go to the stream ``(other)`` (weight: the smallest given
    one, unless named), which exists only if there are such rows. Within a source, rows are ordered by
    ``order_by``'s hash. A source's rows are numbered in parts of about ``part_rows``, so a source with a third of
    all rows is no single task. A shorter ``period`` rounds the weights to whole slots of it.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in MIX_COLUMNS]
    named = spark.createDataFrame([(name,) for name in weights], "stream string")
    rows = docs.select(
        *kept, F.coalesce(F.col(source), F.lit(NO_SOURCE)).alias("__source"),
        F.xxhash64(F.lit(0), order_by).alias("__salt"), F.xxhash64(F.lit(1), order_by).alias("__order"),
    )
    known = F.broadcast(named.withColumn("__source", F.col("stream")))  # a name for each given weight
    rows = rows.join(known, "__source", "left").withColumn("stream", F.coalesce("stream", F.lit(OTHER))).drop("__source")
    counts = {r.stream: r.n for r in rows.groupBy("stream").agg(F.count("*").alias("n")).collect()}
    if block_rows is None:
        block_rows = max(BLOCK_ROWS, -(-sum(counts.values()) // PLAN_BLOCKS))
    blocks = {name: -(-n // block_rows) for name, n in counts.items()}
    if OTHER in blocks:
        weights = {OTHER: min(weights.values(), default=1.0), **weights}
    shares = apportion(weights, period)
    plan = _stored_plan(spark, shares, blocks, period)
    streams = F.broadcast(spark.createDataFrame(
        [(name, shares[name], -(-n // part_rows)) for name, n in counts.items()], "stream string, share long, __parts long"
    ))
    dealt = rows.join(streams, "stream").withColumn("__part", F.pmod("__salt", "__parts").cast("int")).drop("__salt", "__parts")
    parts = dealt.groupBy("stream", "__part").agg(F.count("*").alias("n"))
    offsets = written(running_offsets(parts, ["stream"], "__part").select("stream", "__part", "offset"), "mix-parts")
    numbered = dealt.withColumn(
        "__rank", F.row_number().over(Window.partitionBy("stream", "__part").orderBy("__order"))
    ).join(broadcast_if_small(offsets), ["stream", "__part"]).withColumn("__rank", F.col("__rank") - 1 + F.col("offset"))
    placed = numbered.select(
        *kept, "stream", "share", F.expr(f"__rank div {block_rows}").alias("block"),
        (F.col("__rank") % block_rows).cast("int").alias("row_in_block"),
    ).withColumn("__at", F.expr(f"block div {PART}"))
    return placed.join(broadcast_if_small(plan.withColumnRenamed("part", "__at")), ["stream", "__at"]).select(
        *kept, "stream", "block", "row_in_block",
        F.expr(f"(block * {period}L) div share").alias("release"),
        F.expr(f"((block + 1) * {period}L + share - 1) div share").alias("deadline"),
        F.element_at("at", (F.col("block") % PART + 1).cast("int")).alias("slot"),
    )


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """The rows range-partitioned and sorted by slot, so files written from them follow the mix."""
    return mixed.repartitionByRange("slot", "row_in_block").sortWithinPartitions("slot", "row_in_block")
