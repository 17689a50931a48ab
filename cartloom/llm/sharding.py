"""Sharding by longest-processing-time scheduling: shards of near equal bytes.

Documents with equal texts form a group and stay together. Groups are taken by falling size and each
goes to the least loaded shard (ties: the lower number), through a heap. Groups of one size are
interchangeable, so the plan needs only how many groups there are of each size: one streaming task
reads those counts in order, holds one load per shard and tells how many groups of the size each
shard takes. Texts, documents and groups stay distributed; different group sizes are at most about
the square root of twice the total bytes, and in practice as many as the longest text has bytes.

A null text has no bytes, checksum 0 and is a group of its own beside the empty text. Repeated rows
are rows like all others. A null id is kept. An empty table gives an empty result. Only the id and the
text column are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm.common import running_offsets, salt, text_key, text_or_empty

SHARDS = 40
ROW_BYTES = 16


def deal(loads: list[tuple[int, int]], size: int, count: int) -> dict[int, int]:
    """Give ``count`` groups of ``size`` to the least loaded shards; ``loads`` is a heap of (load, shard).

    Long runs are not dealt one by one: below a level that all of them reach, each shard takes as
    many as it would, and the heap deals the rest.
    """
    taken: dict[int, int] = {}
    if count > 4 * len(loads) and size > 0:
        def below(level: int) -> int:
            return sum(max(0, -(-(level - load) // size)) for load, _ in loads)

        low, high = loads[0][0], loads[0][0] + size * (count + 1)
        while high - low > 1:  # the highest level with at most ``count`` deals below it
            middle = (low + high) // 2
            low, high = (middle, high) if below(middle) <= count else (low, middle)
        for i, (load, shard) in enumerate(loads):
            k = max(0, -(-(low - load) // size))
            if k:
                taken[shard], loads[i] = k, (load + k * size, shard)
                count -= k
        heapq.heapify(loads)
    for _ in range(count):
        load, shard = loads[0]
        heapq.heapreplace(loads, (load + size, shard))
        taken[shard] = taken.get(shard, 0) + 1
    return taken


def _plan(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loads = [(0, shard) for shard in range(shards)]
        for batch in batches:
            bounds = []
            for size, count in zip(batch["group_bytes"], batch["n"], strict=True):
                taken, upto, row = deal(loads, int(size), int(count)), 0, []
                for shard in range(shards):
                    upto += taken.get(shard, 0)
                    row.append(upto)
                bounds.append(row)
            yield pd.DataFrame({"group_bytes": batch["group_bytes"], "bounds": bounds})

    return run


def lpt_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
               splits: int = 128, order_by: tuple[Column, Column] | None = None) -> DataFrame:
    """Per row: id, ``size``, ``text_crc32``, ``shard`` and ``slot``, its gapless place in the shard.

    ``order_by`` is a part of the rows and a place in it: slots then follow parts and their places.
    Without it, slots follow a hash.
    """
    text = text_or_empty(F.col(text_col))
    ordered = [c.alias(n) for c, n in zip(order_by or (), ("part", "place"))]
    rows = docs.select(
        *ordered,
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.coalesce(text_key(F.col(text_col)), F.lit(b"")).alias("group"),
    )
    groups = rows.groupBy("group").agg(F.sum("size").alias("group_bytes")).withColumn("part", salt(splits, F.col("group")))
    sizes = groups.groupBy("group_bytes").agg(F.count("*").alias("n"))
    plan = sizes.repartition(1).sortWithinPartitions(F.desc("group_bytes")).mapInPandas(
        _plan(shards), "group_bytes long, bounds array<long>"
    )
    offsets = running_offsets(groups.groupBy("group_bytes", "part").agg(F.count("*").alias("n")), ["group_bytes"], "part")
    place = F.row_number().over(Window.partitionBy("group_bytes", "part").orderBy("group")) - 1
    placed = (
        groups.withColumn("place", place)
        .join(offsets.select("group_bytes", "part", "offset"), ["group_bytes", "part"])
        .join(plan, "group_bytes")
        .select("group", F.size(F.filter("bounds", lambda b: b <= F.col("place") + F.col("offset"))).alias("shard"))
    )
    by = ["part", "place"] if order_by else [salt(splits, F.col("doc_id"), F.col("text_crc32")).alias("part")]
    dealt = rows.join(placed, "group").select("doc_id", "size", "text_crc32", "shard", *by)
    starts = running_offsets(dealt.groupBy("shard", "part").agg(F.count("*").alias("n")), ["shard"], "part")
    starts = starts.select("shard", "part", "offset")
    row = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*(["place"] if order_by else ["doc_id", "text_crc32"]))) - 1
    return (
        dealt.withColumn("row", row)
        # Without an order shards x splits rows at most; given parts can be many more.
        .join(starts if order_by else F.broadcast(starts), ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("row") + F.col("offset")).alias("slot"))
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The documents as Parquet, one folder per shard, in slot order.

    Documents and ``assigned`` rows are matched by id (null is an id), size and checksum, and rows alike in these
    by their number: every document is written once, whatever repeats.
    """
    name = ["doc_id", "size", "text_crc32"]
    text = text_or_empty(F.col(text_col))
    about = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    # Equal texts are in one shard, so which of the rows alike takes which slot changes no text of a shard.
    # Documents and slots lie together by name, the slots of rows alike before the rows: one shuffle of the texts brings
    # each to its slot, where a join by name and number would need another one.
    slots = assigned.select(*name, F.struct("shard", "slot").alias("to"))
    none = {"doc": F.lit(None).cast(about.schema["doc"].dataType), "to": F.lit(None).cast(slots.schema["to"].dataType)}
    both = about.withColumn("to", none["to"]).unionByName(slots.withColumn("doc", none["doc"])).withColumn("is_doc", F.col("to").isNull())
    alike = Window.partitionBy(*name, "is_doc").orderBy("to", F.xxhash64("doc"))
    numbered = both.repartition(*name).withColumn("nth", F.row_number().over(alike))
    matched = numbered.withColumn("at", F.lag("to").over(Window.partitionBy(*name, "nth").orderBy("is_doc")))
    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    out = matched.where("is_doc AND at IS NOT NULL").select(*kept, "at.shard", "at.slot")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
