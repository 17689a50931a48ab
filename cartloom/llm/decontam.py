"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Texts are read as lower-cased words of letters and digits. A document leaks an item if a window of the item's
length (shorter where the document's ends cut it) has weighted shingle similarity ``threshold`` or more with
it: the sum of smaller over the sum of larger multiplicities of their five-word shingles (the whole sequence
if an item has fewer words).

1. Where to look. A similar window holds all but ``lost_of_item`` of the item's shingles, in whatever order. So
   the shingles at all places of the documents, as narrow rows of three numbers, are joined with those of the
   items, and a document and item that share fewer places are done with. For the others, windows begin where
   the item would begin for one of the shared shingles, and at shared places that are followed by enough others
   within the item's length. A window of greatest similarity is among these: moved to the right up to
   its first shared place, a window loses none and may gain some.
2. The windows and the items get 64 bit SimHashes of their words. The order of words does not matter to them, so
   moved parts cost no bit. Fingerprints within ``RADIUS`` bits agree in one of ``RADIUS + 1`` blocks; the join
   on the blocks finds them all.
3. The shingles of the windows found are compared with the item's exactly.

``RADIUS`` is wide because at a similarity of 0.8 a tenth of a window's words may differ, which turns about nine
of 64 bits; unrelated windows differ in 32 (standard deviation 4). Items of any length cost in proportion to
it. The items are joined in parts of about ``part_words`` words, so what is broadcast is bounded; of the
documents only narrow rows that share a shingle are shuffled, and only documents with windows are read again.

Null and empty texts leak nothing and empty items match nothing. Null ids form one row per item. Repeated
rows and repeated items change nothing. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import text_or_empty
from cartloom.session import broadcast_if_small, written

SHINGLE, THRESHOLD = 5, 0.8
RADIUS, BITS = 20, 64
_LANES = 0x0000000100000001  # a bit in each half of a long: sums count two bits at once
_WINDOW = ["name", "item_no", "low", "words"]


def plain_words(text: Column) -> Column:
    flat = F.trim(F.regexp_replace(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+", " "))
    return F.array_remove(F.split(flat, " "), "")


def word_hashes(text: Column) -> Column:
    return F.transform(plain_words(text), lambda w: F.xxhash64(w))


def lost_of_item(shingles: Column, threshold: float = THRESHOLD) -> Column:
    """Shingles of an item that a similar window may lack, also one cut short by the document's ends: the
    common ones are at least ``threshold`` of the item's."""
    return F.floor(shingles * (1 - threshold) + 1e-9).cast("int")


def gram_hashes(hashes: Column, size: int) -> Column:
    """Hash of the ``size`` words at each place of an array of word hashes; null if there are fewer."""
    return F.when(F.size(hashes) >= size, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(*[F.get(hashes, i + t) for t in range(size)])
    ))


def fingerprints(rows: DataFrame, keys: list[str], hashes: str) -> DataFrame:
    """``keys`` and SimHash ``fp`` of each row: a bit is set if more than half of the words' hashes have it."""
    words = rows.select(*keys, F.explode(hashes).alias("x"))
    lanes = [F.sum(F.shiftrightunsigned("x", k).bitwiseAND(F.lit(_LANES))).alias(f"lane{k}") for k in range(BITS // 2)]
    sums = words.groupBy(*keys).agg(F.count("*").alias("n"), *lanes)

    def bit(count: Column, k: int) -> Column:
        return F.shiftleft((count * 2 > F.col("n")).cast("long"), k)

    low = [bit(F.col(f"lane{k}").bitwiseAND(F.lit(0xFFFFFFFF)), k) for k in range(BITS // 2)]
    high = [bit(F.shiftrightunsigned(f"lane{k}", 32), k + BITS // 2) for k in range(BITS // 2)]
    return sums.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), low + high).alias("fp"))


def blocks(fp: Column, radius: int) -> Column:
    """Keys of the ``radius + 1`` blocks of a fingerprint: number and bits."""
    edges = [BITS * b // (radius + 1) for b in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(b).alias("block"), (F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << high - low) - 1)) if high - low < BITS else fp).alias("bits"))
        for b, (low, high) in enumerate(zip(edges, edges[1:], strict=False))
    ])


def near_pairs(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """Windows (with ``fp``) whose fingerprint is within ``radius`` bits of their item's, by the blocks they share."""
    probes = windows.select(*_WINDOW, "fp", F.explode(blocks(F.col("fp"), radius)).alias("at")).select(*_WINDOW, "fp", "at.*")
    known = items.select("item_no", F.col("fp").alias("item_fp"), F.explode(blocks(F.col("fp"), radius)).alias("at"))
    met = probes.join(known.select("item_no", "item_fp", "at.*"), ["item_no", "block", "bits"])
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(*_WINDOW).distinct()


def window_places(docs: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """Places of windows to look at, a row per document: ``name`` and structs of item_no, low and words.

    ``docs`` has ``name`` and word hashes ``h``; ``items`` has item_no, n, grams, need and h. ``sizes`` are the
    lengths of the items' shingles.
    """
    about = ["item_no", "n", "grams", "need"]
    shared = []
    for size in sizes:
        own = items.where(F.least("n", F.lit(SHINGLE)) == size)
        known = own.select(*about, F.posexplode(gram_hashes(F.col("h"), size)).alias("offset", "key"))
        places = docs.select("name", F.posexplode(gram_hashes(F.col("h"), size)).alias("p", "key"))
        shared.append(places.join(F.broadcast(known), "key").select("name", *about, "p", (F.col("p") - F.col("offset")).alias("begin")))
    met = reduce(DataFrame.unionByName, shared).groupBy("name", *about).agg(
        F.sort_array(F.collect_set("p")).alias("places"), F.collect_set("begin").alias("begins")
    ).where(F.size("places") >= F.col("need"))
    followed = F.filter("places", lambda p, i: F.get("places", i + F.col("need") - 1) - p < F.col("grams"))
    starts = met.select("name", "item_no", "n", F.explode(F.array_union("begins", followed)).alias("begin"))
    windows = starts.select("name", "item_no", F.greatest("begin", F.lit(0)).alias("low"), (F.col("n") + F.least("begin", F.lit(0))).alias("words"))
    return windows.groupBy("name").agg(F.collect_set(F.struct("item_no", "low", "words")).alias("windows"))


def similarities(windows: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """Exact weighted similarity of each window (word hashes ``w``) to its item."""
    def counted(rows: DataFrame, keys: list[str], hashes: str, length: Column, times: str) -> DataFrame:
        grams = F.coalesce(*[F.when(F.least(length, F.lit(SHINGLE)) == s, gram_hashes(F.col(hashes), s)) for s in sizes])
        return rows.select(*keys, F.explode(grams).alias("key")).groupBy(*keys, "key").agg(F.count("*").alias(times))

    own = counted(items, ["item_no", "grams"], "h", F.col("n"), "item_times")
    held = counted(windows, ["doc_id", *_WINDOW, "n"], "w", F.col("n"), "times")
    total = F.sum("times")
    common = held.join(own, ["item_no", "key"], "left").groupBy("doc_id", *_WINDOW).agg(
        F.sum(F.least("times", F.coalesce("item_times", F.lit(0)))).alias("common"), total.alias("total"), F.max("grams").alias("grams")
    )
    return common.select("doc_id", "item_no", "low", (F.col("common") / (F.col("total") + F.col("grams") - F.col("common"))).alias("similarity"))


def leaked_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", threshold: float = THRESHOLD, part_words: int = 400_000, radius: int = RADIUS,
) -> DataFrame:
    """(doc_id, item_id) of every leak, with its greatest ``similarity`` and the first word it starts ``at``."""
    named = items.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("h")).where(F.size("h") > 0).distinct()
    grams = F.greatest(F.size("h") - SHINGLE + 1, F.lit(1))
    known = written(named.select(
        "item_id", "h", F.xxhash64("item_id", F.hash("h"), "h").alias("item_no"), F.size("h").alias("n"), grams.alias("grams"),
        (grams - lost_of_item(grams, threshold)).alias("need"),
    ), "items")
    total, sizes = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.collect_set(F.least("n", F.lit(SHINGLE)))).first()
    name = F.xxhash64(F.col(id_col), F.col(text_col)).alias("name")
    hashed = docs.select(name, word_hashes(F.col(text_col)).alias("h"))
    parts = -(-total // part_words)
    found = []
    for part in range(parts):
        some = known.where(F.pmod("item_no", F.lit(parts)) == part) if parts > 1 else known
        places = broadcast_if_small(written(window_places(hashed, some, sorted(sizes)), "places"))
        texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), name).join(places, "name")
        cut = texts.select("doc_id", "name", word_hashes(F.col("text")).alias("h"), "windows").select("doc_id", "name", "h", F.explode("windows").alias("x"))
        cut = cut.select("doc_id", "name", "x.*", F.slice("h", F.col("x.low") + 1, F.col("x.words")).alias("w"))
        windows = written(cut.join(broadcast_if_small(some.select("item_no", "n")), "item_no").distinct(), "windows")
        near = near_pairs(fingerprints(windows, _WINDOW, "w"), fingerprints(some, ["item_no"], "h"), radius)
        close = similarities(windows.join(near, _WINDOW, "left_semi"), some, sorted(sizes))
        found.append(close.where(F.col("similarity") >= threshold).join(some.select("item_no", "item_id"), "item_no"))
    if not found:
        return docs.limit(0).select(
            F.col(id_col).alias("doc_id"), F.lit(None).cast(named.schema["item_id"].dataType).alias("item_id"),
            F.lit(0.0).alias("similarity"), F.lit(0).alias("at"),
        )
    best = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(F.min(F.struct(-F.col("similarity"), "low")).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.col1")).alias("similarity"), F.col("best.low").alias("at"))
