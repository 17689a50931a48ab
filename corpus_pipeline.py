"""The corpus pipeline: documents through five stages, each written and read again.

Every stage takes all rows its predecessor kept. Null, empty and very long texts, repeated rows, null
ids, empty tables and further columns are handled as the operators' docstrings say; stages carry each
document whole, so further columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm import decontam, langid, mixing, neardup, sharding
from cartloom.llm.common import text_key
from cartloom.session import fresh_folder, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A text of which less than this share of n-grams belongs to its best language is rejected.
MIN_LANGUAGE_SCORE = 0.15


def _whole(docs: DataFrame) -> DataFrame:
    """Each document as one value beside the columns that operators read."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language; texts without letters go. Where no row names a language,
    nothing can be learned and all documents stay."""
    model = langid.train_filter(docs)
    if not model.languages:
        return docs
    found = langid.predict_language(_whole(docs), model, F.col("doc.text"))
    known = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(known).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the least id, of each group of near duplicates."""
    return neardup.keep_one_each(docs, neardup.near_duplicates(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    name = F.struct(F.col("doc.doc_id"), text_key(F.col("doc.text")).alias("text_key"))
    whole = _whole(docs)
    leaks = decontam.leaked_items(whole.select(name.alias("name"), F.col("doc.text").alias("text")), items, "name")
    leaking = leaks.select(F.col("doc_id").alias("name")).distinct()
    return whole.withColumn("name", name).join(leaking, "name", "left_anti").select("doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mix; the sharding stage reads that order."""
    rows = _whole(docs).select("doc", F.col("doc.source").alias("source"), F.col("doc.doc_id").alias("id"))
    mixed = mixing.pfair_mix(rows, mixing.tempered_weights(docs), F.col("id"))
    return mixing.in_mix_order(mixed).select("doc.*")


def written_order(docs: DataFrame, part_rows: int = 100_000) -> tuple[Column, Column]:
    """Part and place in it of each row as it was written: file by file, row by row. A stage returns the columns of
    documents only, so the order of the files is what carries the mix from one stage to the next; whoever
    rewrites them between the stages must keep it. Rows that come from no file follow the frame's partitions."""
    try:
        stored = docs.metadataColumn("_metadata")
        docs.select(stored["row_index"])
    except AnalysisException:
        return F.spark_partition_id(), F.monotonically_increasing_id()
    task = F.try_to_number(F.regexp_extract(stored["file_name"], r"^part-(\d+)", 1), F.lit("999999999999"))
    return F.struct(task, stored["file_path"], F.floor(stored["row_index"] / part_rows)), stored["row_index"]


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document; in each shard, slots follow the order of the mix.

    The shards with their texts are written as well, one folder each, to ``shards-...`` in the shared folder."""
    assigned = written(sharding.lpt_shards(docs, order_by=written_order(docs)), "shard-slots")
    sharding.write_shards(docs, assigned, fresh_folder(spark, "shards"))
    return assigned


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mix),
    ("sharding", shards),
]

# The stages fit models and follow fingerprints, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_folder(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
