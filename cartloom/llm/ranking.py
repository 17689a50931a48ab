"""Ranked lexical search the other way round: the documents are streamed through an index of the items.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, only A-Z lower-cased. The
items' terms form an inverted index, term to items, that every task holds. One pass over the documents
keeps, for each, its number of terms and the index terms in it with their occurrences, as a table; from that
come the statistics. A second pass streams the table through the postings and keeps the best ``top``
documents of each item in a heap of that size. The heaps of all tasks are merged in two steps.

The index is bounded: items are taken in parts of at most ``PART_POSTINGS`` postings and ``PART_BYTES`` bytes
of terms (a larger item is a part of its own), and each part is a run of its own over all documents.

Score of a document: N documents have a term, L terms in all; n are in the document, df documents hold a
term, tf times in this one; w = floor(1000 ln((2N+2)/(2df+1))), m = 100-90+((90 n N) div L); the sum over the
item's terms of w * ((1000000000 tf) div (1000 tf + 8 m)). Equal scores go by ascending doc_id, null ids last.

Null and empty texts have no terms: such a document is in no result and not in N, such an item has no rows.
Rows of the benchmark with the same id, null included, are one item with the terms of all. Repeated
documents count and rank as often as they stand there, each with a rank of its own. Texts of any length are
read whole. Empty tables give an empty result. Only id and text columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartloom.session import fresh_folder, written

PART_POSTINGS, PART_BYTES = 1 << 20, 16 << 20
BLOCK_POSTINGS = 1 << 21  # postings met by documents at once
BLOCK_BYTES = 8 << 20  # text cut at once
MERGE_WAYS = 64
LAST = -(1 << 70)  # stands for a null id, behind all others

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_TERMS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])
_TERMS_SQL = "doc_id long, n long, terms array<int>, times array<int>"
_BEST = pa.schema([("item", pa.int32()), ("score", pa.int64()), ("doc_id", pa.int64()), ("way", pa.int32())])
_BEST_SQL = "item int, score long, doc_id long, way int"


@dataclass
class Index:
    """Terms with their ids and the items that hold them, as one list per term behind ``starts``."""

    terms: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    ids: list  # of the items

    @classmethod
    def of(cls, pairs: list[tuple[object, bytes]]) -> Index:
        ids = list(dict.fromkeys(i for i, _ in pairs))
        number = {i: k for k, i in enumerate(ids)}
        terms = {t: k for k, t in enumerate(dict.fromkeys(t for _, t in pairs))}
        held = np.array([terms[t] for _, t in pairs], np.int64)
        order = np.argsort(held, kind="stable")
        items = np.array([number[i] for i, _ in pairs], np.int64)[order]
        return cls(terms, np.r_[0, np.cumsum(np.bincount(held, minlength=len(terms)))], items, ids)


def item_parts(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[object, bytes]]]:
    """Different (item id, term) pairs in order of the items, in parts of bounded size."""
    capital, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cut = F.split(F.translate(F.coalesce(F.col(text_col), F.lit("")), capital, small), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    pairs = items.select(F.col(id_col).alias("id"), F.explode(cut).alias("term")).where("term <> ''").distinct().orderBy("id", "term")
    part, size = [], 0
    for _, rows in groupby(pairs.toLocalIterator(), key=lambda r: r.id):
        item = [(r.id, r.term.encode()) for r in rows]
        taken = sum(len(term) for _, term in item)
        if part and (len(part) + len(item) > PART_POSTINGS or size + taken > PART_BYTES):
            yield part
            part, size = [], 0
        part += item
        size += taken
    if part:
        yield part


def _terms_of(batch: pa.RecordBatch, index: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    ids, texts, at = batch.column(0), batch.column(1), 0
    while at < len(texts):
        found, lengths, start, size = [], [], at, 0
        while at < len(texts) and size < BLOCK_BYTES:
            cut = texts[at].as_py().translate(_TABLE).split()
            size += sum(map(len, cut)) + 1
            found += [index.get(t, -1) for t in cut]
            lengths.append(len(cut))
            at += 1
        n, doc = np.array(lengths, np.int64), np.repeat(np.arange(len(lengths)), lengths)
        term = np.array(found, np.int64)
        key, times = np.unique(doc[term >= 0] * len(index) + term[term >= 0], return_counts=True)
        ends = np.cumsum(np.bincount(key // max(len(index), 1), minlength=len(n)))
        offsets = pa.array(np.r_[0, ends], pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (key % max(len(index), 1), times)]
        rows = pa.RecordBatch.from_arrays([ids.slice(start, len(n)), pa.array(n), *lists], schema=_TERMS)
        yield rows.filter(pa.array(n > 0))


def term_table(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with a term: doc_id, number of terms ``n``, the index terms and their ``times``."""
    shared = docs.sparkSession.sparkContext.broadcast(index.terms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _terms_of(batch, shared.value)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, _TERMS_SQL)


class Heaps:
    """The best ``top`` documents of each item so far."""

    def __init__(self, items: int, top: int):
        self.top, self.heaps, self.least = top, [[] for _ in range(items)], np.zeros(items)

    def add(self, scores: np.ndarray, doc_ids: list[int | None]) -> None:
        """``scores``: a row for each document, a column for each item."""
        docs, items = np.nonzero((scores >= self.least) & (scores > 0))
        for doc, item, score in zip(docs.tolist(), items.tolist(), scores[docs, items].tolist(), strict=True):
            heap, name = self.heaps[item], doc_ids[doc]
            entry = (int(score), LAST if name is None else -name)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[item] = heap[0][0]


def _scores(docs: pa.RecordBatch, index: Index, weights: np.ndarray, documents: int, terms: int) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and scores of the documents, some at a time. Sums stay below 2**53, so doubles hold them exactly."""
    n = docs.column(1).to_numpy()
    if 90 * documents * int(n.max(initial=0)) < 1 << 63:
        m = 10 + 90 * documents * n // max(terms, 1)
    else:
        m = np.array([10 + 90 * documents * int(x) // terms for x in n], np.int64)
    lists = [docs.column(2), docs.column(3)]
    starts = lists[0].offsets.to_numpy().astype(np.int64)
    first = starts[0]
    term, tf = (x.values.to_numpy(zero_copy_only=False)[first:starts[-1]].astype(np.int64) for x in lists)
    starts = starts - first
    doc = np.repeat(np.arange(len(n)), np.diff(starts))
    value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    size = index.starts[term + 1] - index.starts[term]
    met = np.r_[0, np.cumsum(size)][starts]  # postings met before each document
    ids, at = docs.column(0).to_pylist(), 0
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(met, met[at] + max(BLOCK_POSTINGS, len(index.ids)), "right")) - 1)
        end = min(end, at + max(1, BLOCK_POSTINGS // len(index.ids)))
        a, b = starts[at], starts[end]
        many = size[a:b]
        posting = np.repeat(index.starts[term[a:b]] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        cell = np.repeat((doc[a:b] - at) * len(index.ids), many) + index.items[posting]
        total = np.bincount(cell, np.repeat(value[a:b], many), minlength=(end - at) * len(index.ids))
        yield ids[at:end], total.reshape(end - at, -1)
        at = end


def _part_ranks(docs: DataFrame, pairs: list[tuple[object, bytes]], id_type, top: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    index = Index.of(pairs)
    table = written(term_table(docs, index, id_col, text_col), "terms")
    documents, terms = table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(index.terms), np.int64)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(shared.value[0].starts.size - 1, np.int64)
        for batch in batches:
            seen += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=seen.size)
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(seen[found])], names=["term", "df"])

    shared = spark.sparkContext.broadcast((index,))
    for row in table.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        held[row.term] = row.df
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, heaps, way = shared.value[0], None, 0
        for batch in batches:
            heaps = heaps or Heaps(len(own.ids), top)
            for ids, scores in _scores(batch, own, weights, documents, terms) if batch.num_rows else ():
                heaps.add(scores, ids)
                way = way or hash(ids[0]) % MERGE_WAYS
        rows = [(k, s, None if d == LAST else -d) for k, heap in enumerate(heaps.heaps if heaps else []) for s, d in heap]
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([way] * len(rows), pa.int32())], schema=_BEST)

    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = table.mapInArrow(best, _BEST_SQL)
    for keys in (("item", "way"), ("item",)):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(index.ids)), f"item int, item_id {id_type}")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``top`` documents of each item with a score above 0: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    kind = dict(items.dtypes)["item_id"]
    folder, parts = fresh_folder(spark, "ranks"), 0
    empty = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for pairs in item_parts(items):
        ranks = _part_ranks(docs, pairs, kind, top, id_col, text_col)
        ranks.write.mode("append").parquet(folder)
        parts += 1
    return spark.read.schema(empty.schema).parquet(folder) if parts else empty
