"""Quality by importance resampling.

Two generative bag models over hashed word unigrams and bigrams are fitted: one to target text (a
bounded sample of documents labelled good), one to all raw text. A document's log weight is the sum
of its n-grams' log probability ratios. Gumbel noise drawn from a hash of the id turns the top ``k`` of weight plus noise into a sample without
replacement in proportion to the weights.

Null and empty texts have no n-grams and weight 0. Rows tied at the last place are all sampled.
Repeated rows share their noise. Without target rows all weights are 0 and the sample is uniform. An
empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 20_000
CACHED_WORDS = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        code = zlib.crc32(word)
        if len(word) <= 64:
            self[word] = code
        return code


_hashes = _WordHashes()


def gram_buckets(text: str | None) -> np.ndarray:
    """Bucket of each unigram and each bigram of the lower-cased text."""
    words = text.lower().encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.empty(0, np.int64)
    one = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words)) * _MIX
    two = ((one[:-1] >> np.uint64(7)) ^ one[1:]) * _MIX
    both = np.concatenate((one, two)) >> np.uint64(33)
    return (both % np.uint64(BUCKETS)).astype(np.int64)


def _bucket_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text, wanted in zip(batch["text"], batch["target"], strict=True):
            counts = np.bincount(gram_buckets(text), minlength=BUCKETS)
            raw += counts
            if wanted:
                target += counts
    used = np.flatnonzero(raw)
    yield pd.DataFrame({"bucket": used, "raw": raw[used], "target": target[used]})


def fit_ratio(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              sample_rows: int = 20_000, smoothing: float = 1.0) -> np.ndarray:
    """Log ratio of target to raw probability per bucket.

    Raw counts cover all of ``docs``; the target takes the ``sample_rows`` of ``target_ids`` (column
    ``doc_id``) with the least hashes.
    """
    order = F.xxhash64(F.lit(7), F.col("doc_id"))
    sample = target_ids.select("doc_id").distinct().orderBy(order, "doc_id").limit(sample_rows)
    wanted = F.broadcast(sample.select("doc_id", F.lit(True).alias("target")))
    marked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(wanted, "doc_id", "left")
    counts = (
        marked.select("text", F.coalesce("target", F.lit(False)).alias("target"))
        .mapInPandas(_bucket_counts, "bucket long, raw long, target long")
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()  # at most one row per bucket
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counts["bucket"]], target[counts["bucket"]] = counts["raw"], counts["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + smoothing) / (target.sum() + smoothing * BUCKETS)) - np.log(
        (raw + smoothing) / (raw.sum() + smoothing * BUCKETS)
    )


def log_weights(docs: DataFrame, ratio: np.ndarray, text: Column) -> DataFrame:
    """``docs`` with ``n_grams`` and ``log_weight``, the sum of their log ratios."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    @F.pandas_udf("n_grams long, log_weight double")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        ratio, sizes, sums = shared.value, [], []
        for text in texts:
            grams = gram_buckets(text)
            sizes.append(len(grams))
            sums.append(float(ratio[grams].sum()))
        return pd.DataFrame({"n_grams": np.array(sizes, np.int64), "log_weight": np.array(sums, np.float64)})

    kept = [c for c in docs.columns if c not in ("n_grams", "log_weight")]
    weighed = docs.select(*kept, weigh(text).alias("__w"))
    return weighed.select(*kept, "__w.n_grams", "__w.log_weight")


def gumbel(seed: int, key: Column) -> Column:
    """Standard Gumbel noise from a hash of the key."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def kth_largest(values: DataFrame, column: str, k: int, few: int = 10_000, bins: int = 4096) -> float | None:
    """The ``k``-th largest value (None beyond the end), by histograms narrowed until few values are left."""
    low, high, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if k < 1 or k > n:
        return None
    rest, n_rest = values.where(F.col(column).isNotNull()).select(column), n
    while n_rest > few and high > low:
        width = (high - low) / bins
        if width == 0 or low + width == low:
            break
        number = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).alias("bin")
        histogram = rest.groupBy(number).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        ).orderBy(F.desc("bin")).collect()  # at most ``bins`` rows
        for row in histogram:
            if k <= row["n"]:
                break
            k -= row["n"]
        low, high, n_rest = row["low"], row["high"], row["n"]
        rest = rest.where(F.col(column).between(F.lit(low), F.lit(high)))
    if high == low:
        return low
    return rest.orderBy(F.desc(column)).limit(k).agg(F.min(column)).first()[0]


def gumbel_top_k(weighed: DataFrame, k: int, key: Column, seed: int = 0) -> DataFrame:
    """``weighed`` (a stored table) with ``gumbel_key`` and ``selected``."""
    keyed = weighed.withColumn("gumbel_key", F.col("log_weight") + gumbel(seed, key))
    least = kth_largest(keyed, "gumbel_key", k)
    chosen = F.lit(k > 0) if least is None else F.col("gumbel_key") >= F.lit(least)
    return keyed.withColumn("selected", F.coalesce(chosen, F.lit(False)))
