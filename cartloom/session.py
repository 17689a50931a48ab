"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.sources import files

# A frame is broadcast by hint only below these bounds; beyond them Spark picks the join.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20


def local_session(cores: str | int = "*", name: str = "cartloom") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    parallel = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder for written tables, below the folder the cluster shares.

    ``spark.checkpoint.dir`` names that folder. Only a local session may go without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="cartloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe if executors are lost."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The same for as long as the block lasts; afterwards the table is gone."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        files.remove(spark, path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting rows and bytes (as text); a larger frame is left to the optimizer."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))
    rows, taken = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and taken <= BROADCAST_BYTES else df


SPREAD_BELOW = 8 << 20  # bytes a core: larger tables are read by splits of their files


def spread(table: DataFrame) -> DataFrame:
    """Use all cores on a small table of few files; a table with enough files or bytes is not shuffled."""
    spark, paths = table.sparkSession, table.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    few = len(paths) < cores and sum(files.size(spark, p) for p in paths) < cores * SPREAD_BELOW
    return table.repartition(cores) if few else table


# The JVM does not compile methods above 8000 bytes of code. Below that limit Spark gives up whole-stage
# code for such a plan and uses split-up, compiled expressions instead.
_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
# Rows of the raw table are some ten times as large in memory as in their files. A task that sorts or groups
# what it has read, before a shuffle, holds all rows of one split.
_SPLIT, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", 32 << 20
# Without open writers for the few folders a task writes, Spark sorts whole rows by folder first, and spills them.
_WRITERS = ("spark.sql.maxConcurrentOutputFileWriters", "8")
# Adaptive execution joins small shuffle partitions but splits no group of rows that are counted or ranked together: with a
# fixed few partitions, each grows with the table. It starts with many and brings them to its own target size instead.
_PARTITIONS, LEAST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 400


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def _tuning(spark: SparkSession) -> dict[str, str]:
    split = min(_bytes(spark.conf.get(_SPLIT)), SPLIT_BYTES)
    first = max(int(spark.conf.get(_PARTITIONS, None) or 0), int(spark.conf.get("spark.sql.shuffle.partitions")), LEAST_PARTITIONS)
    return dict([_METHOD_LIMIT, _WRITERS, (_SPLIT, f"{split}b"), (_PARTITIONS, str(first))])


def tune(spark: SparkSession) -> SparkSession:
    """Set a session up for these jobs, for good: for the owner of the session only."""
    for name, value in _tuning(spark).items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def _set(spark: SparkSession, settings: Callable[[SparkSession], dict[str, str]]) -> Iterator[None]:
    """Settings within a block; afterwards the session is as it was."""
    values = settings(spark)
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def tuned(spark: SparkSession) -> AbstractContextManager[None]:
    """What :func:`tune` sets, within a block."""
    return _set(spark, _tuning)


def freeing_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Within a block, shuffle files go when their step ends. They stay until the driver happens to collect its garbage
    otherwise, so a run of many steps fills the disks with those of steps long done.

    Only for steps that end at once, not for a whole session: rows read one by one (``toLocalIterator``) could lose their files.
    """
    return _set(spark, lambda _: {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})
