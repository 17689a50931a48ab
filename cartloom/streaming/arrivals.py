"""Late, repeated and missing exports, from a stream of messages.

Deliveries of the same export no more than ``gap`` apart are one arrival. Each arrival is a session
window with a watermark: it is written once, as soon as the watermark has passed its end, and its
state is dropped then, so that state holds the arrivals of the last days however long the stream runs.
The same function on a batch of messages gives all arrivals, those still open included.

Sessions and their partial merges are kept by Spark's state store, progress by the checkpoint and
written files by the sink's own log: a run that broke off goes on where it was, and no arrival is
written twice. A message older than the watermark of its micro-batch is dropped by Spark, so ``delay``
must cover how far the mailbox may be out of order.

Messages without an export, with an impossible date in its name or without an instant are no arrivals;
a missing sender counts as an empty one. Copies of a message count as deliveries of their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartloom.schemas import ARRIVALS_SCHEMA, MANIFEST_SCHEMA
from cartloom.sources.manifest import filename_day, matching_attachment
from cartloom.sources.tables import read_table

# An export of a day is due at 06:00 UTC of that day; an alert is raised at 06:15.
DUE = dt.timedelta(hours=6)
ALERT = dt.timedelta(hours=6, minutes=15)
GAP = "36 hours"
DELAY = "1 day"


def arrivals(messages: DataFrame, gap: str = GAP, delay: str = DELAY) -> DataFrame:
    """One row per arrival: sender, file, its day, first and last delivery, number of deliveries.

    ``messages`` may be a stream; a batch ignores the watermark.
    """
    name = matching_attachment(F.col("attachments"))
    sender = F.coalesce("sender", F.lit("")).alias("sender")
    exports = messages.select(sender, "received_at", name.alias("filename")).withColumn("run_date", filename_day(F.col("filename")))
    return (
        exports.where("run_date IS NOT NULL AND received_at IS NOT NULL")
        .withWatermark("received_at", delay)
        .groupBy("sender", "filename", "run_date", F.session_window("received_at", gap).alias("open"))
        .agg(F.min("received_at").alias("first_at"), F.max("received_at").alias("last_at"), F.count("*").alias("deliveries"))
        .select(*ARRIVALS_SCHEMA.names)
    )


def stream_arrivals(
    spark: SparkSession, folder: str, path: str, checkpoint: str, gap: str = GAP, delay: str = DELAY, max_files: int = 1000
) -> StreamingQuery:
    """Take in all message files (Parquet) that are in ``folder`` now, append the arrivals that are over to ``path``, and stop.

    Run it again for later messages; files must appear in the order of their messages, but for ``delay``.
    """
    messages = spark.readStream.schema(MANIFEST_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(folder)
    return (
        arrivals(messages, gap, delay).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )


def read_arrivals(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, ARRIVALS_SCHEMA)


def _after(day: Column, time: dt.timedelta) -> Column:
    """An instant of a day in UTC, whatever the session's time zone."""
    return F.timestamp_micros(F.unix_date(day).cast("bigint") * 86_400_000_000 + int(time.total_seconds()) * 1_000_000)


def lateness(found: DataFrame, due: dt.timedelta = DUE, alert: dt.timedelta = ALERT) -> DataFrame:
    """Every arrival with its status: ``on_time``, ``late``, ``alert``, or ``repeat`` if the sender's export arrived before.

    Whole minutes after the due instant count, those of an arrival in time as 0. Repeats are found by the first arrival of
    a sender's export, an aggregate of two instants, and not by a window over its arrivals.
    """
    key = ["sender", "filename"]
    firsts = found.groupBy(*key).agg(F.min("first_at").alias("_earliest"))
    at, day = F.col("first_at"), F.col("run_date")
    minutes = F.floor((F.unix_micros(at) - F.unix_micros(_after(day, due))) / F.lit(60_000_000)).cast("bigint")
    status = (
        F.when(at > F.col("_earliest"), "repeat").when(at <= _after(day, due), "on_time")
        .when(at <= _after(day, alert), "late").otherwise("alert")
    )
    return found.join(firsts, key).select(
        *ARRIVALS_SCHEMA.names, F.greatest(minutes, F.lit(0)).alias("minutes_late"), status.alias("status")
    )


def missing_exports(found: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Sender and day of every export that each sender seen should have sent from ``first`` to ``last`` and that did not arrive.

    Senders and their days are aggregated to one set of days each, at most as many as asked for.
    """
    wanted = F.sequence(F.lit(first), F.lit(last))
    asked = F.when(F.col("run_date").between(first, last), F.col("run_date"))
    had = found.groupBy("sender").agg(F.collect_set(asked).alias("had"))
    return had.select("sender", F.explode(F.array_except(wanted, "had")).alias("run_date"))
