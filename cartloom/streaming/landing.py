"""Landing as a stream: new exports in a folder are appended to the raw table.

The stream is one of file names, not of rows: each micro-batch hands its new exports to the
batch landing, which reads every header on its own and skips files loaded before. The
checkpoint finds each file once; the skip keeps that true after a failed or repeated batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartloom.domains import FILE_PATTERN
from cartloom.sources.landing import land_exports
from cartloom.sources.manifest import filename_day

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def new_exports(files: DataFrame) -> DataFrame:
    """One message per export among ``files`` (path, modificationTime) with its path, dated by its name.

    An export is a file of the expected name, or a folder of that name with part files.
    """
    last = F.regexp_extract("path", "([^/]+)$", 1)
    above = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    folder = F.regexp_extract(above, "([^/]+)$", 1)
    found = F.when(folder.rlike(FILE_PATTERN), F.struct(folder.alias("filename"), above.alias("path"))).when(
        last.rlike(FILE_PATTERN), F.struct(last.alias("filename"), F.col("path").alias("path"))
    )
    return (
        files.select(found.alias("found"), "modificationTime").where("found IS NOT NULL")
        .groupBy("found.filename", "found.path")
        .agg(F.min("modificationTime").alias("received_at"))
        .withColumn("run_date", filename_day(F.col("filename")))
    )


def stream_landing(
    spark: SparkSession,
    folder: str,
    raw_path: str,
    checkpoint: str,
    clock: Callable[[], dt.datetime],
    max_files: int = 1000,
) -> StreamingQuery:
    """Land everything that is in ``folder`` now and stop; run it again for later arrivals.

    Exports may lie in sub-folders. Empty ones and impossible dates are kept by name in the table of
    loads and do not stop the stream, however files fall into micro-batches. Exports must appear whole, as a rename into the folder does. File contents are not read
    by the stream itself, as only path and time are selected.
    """
    files = (
        spark.readStream.schema(_FILES)
        .format("binaryFile")
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(folder)
        .select("path", "modificationTime")
    )

    def land(batch: DataFrame, _: int) -> None:
        land_exports(batch.sparkSession, new_exports(batch), folder, raw_path, clock(), skip_bad=True)

    return (
        files.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
