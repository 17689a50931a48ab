"""Main text of web pages: marked-up parts first, then what a host repeats.

``markup`` cuts a page into blocks and leaves out menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments by their elements, roles and names. The blocks of the article (or of the
main part, or of a container named as content) are the page's token stream; if none is marked, all blocks.

Host suffix array: the token streams of a host's pages are concatenated and their suffixes sorted by prefix
doubling, to a depth of ``run`` words. Neighbours in that order with an equal prefix are a substring that
repeats; every longer repeated substring is made of such ones. One that many distinct pages of the host hold is
boilerplate, and the words it covers go; the unique runs between them stay. "Many" is ``share`` of the pages,
and ``marked_share`` of them for pages whose main text is marked, never less than ``least_pages``. Where
boilerplate would cover more than half of a marked main text, the pages are copies of each other, not
templates, and the text stays whole. Pages with equal streams are one page.

A large host is dealt into sections of about ``SECTION_BYTES`` of html with a suffix array each, so that no task
gets a whole host; what is boilerplate in one section is so on the whole host. Anything that the share of all
pages of a host hold is held by that share of the pages of one section at least. Words that too few pages hold
are left out of the sorting: no frequent substring has them.

Null and empty html give an empty text; pages without a host (null url) are cut by their markup alone. Repeated
rows, null ids and very long pages are treated like any other, an empty table gives an empty result. Only
page_id, url and html are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.markup import main_blocks
from cartloom.session import broadcast_if_small, written

SECTION_BYTES = 2 << 20
RUN_WORDS, LEAST_PAGES, SHARE, MARKED_SHARE = 8, 5, 0.25, 0.5

_RUNS_SQL = "host string, run string, marked boolean"


def host_of(url: Column) -> Column:
    """Host of a url in small letters; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def repeated_windows(pages: list[list[str]], run: int, least: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Start of one window of ``run`` words for each that ``least`` pages hold, the number of these pages, and all words.

    The suffixes of the concatenated pages are ranked by their first word, then by 2, 4, ... words; equal ranks
    stand together in the suffix array. Suffixes with a prefix that too few pages hold are dropped on the way.
    """
    words = [w for page in pages for w in page]
    page = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
    ends = np.repeat(np.cumsum([len(p) for p in pages]), [len(p) for p in pages])
    rank = pd.factorize(np.array(words, object), sort=False)[0].astype(np.int64) if words else np.zeros(0, np.int64)

    def held(rank: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the order of the suffix array, with ranks anew, and pages per rank."""
        order = np.lexsort((page[at], rank))
        at, rank = at[order], rank[order]
        fresh = np.r_[True, rank[1:] != rank[:-1]][:len(rank)]
        other = fresh | np.r_[True, page[at][1:] != page[at][:-1]][:len(rank)]
        rank = np.cumsum(fresh) - 1
        counts = np.bincount(rank, other).astype(np.int64) if len(rank) else np.zeros(0, np.int64)
        return at, rank, counts

    at, size = np.arange(len(words)), 1
    while True:
        at, rank, counts = held(rank, at)
        frequent = counts[rank] >= least
        at, rank = at[frequent], rank[frequent]
        if size == run:
            starts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]][:len(rank)])
            return at[starts], counts[rank[starts]], words
        step = min(size, run - size)
        of = np.full(len(words) + run, -1, np.int64)
        of[at] = rank
        follows = of[at + step]
        whole = (follows >= 0) & (at + step + size <= ends[at])
        at, rank = at[whole], rank[whole] * (len(words) + 1) + follows[whole]
        size += step


def _streams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [zlib.compress("\n".join(main_blocks(html)[1]).encode("utf-8", "replace"), 1) for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["host", "section", "stream"])


def host_boilerplate(pages: DataFrame, run: int = RUN_WORDS, least_pages: int = LEAST_PAGES, share: float = SHARE,
                     marked_share: float = MARKED_SHARE, section_bytes: int = SECTION_BYTES) -> DataFrame:
    """Repeated substrings of ``run`` words of each host; ``marked``: frequent enough for marked main texts, too.

    ``pages`` has host, salt (a number), html.
    """

    def find(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        streams = [zlib.decompress(s).decode().split() for s in dict.fromkeys(group.column("stream").to_pylist())]
        least = max(least_pages, int(np.ceil(min(share, marked_share) * len(streams))))
        starts, held, words = repeated_windows(streams, run, least)
        return pa.table({
            "host": pa.array([key[0].as_py()] * len(starts), pa.string()),
            "run": pa.array([" ".join(words[i:i + run]) for i in starts.tolist()], pa.string()),
            "marked": pa.array(held >= max(least_pages, marked_share * len(streams)), pa.bool_()),
            "plain": pa.array(held >= max(least_pages, share * len(streams)), pa.bool_()),
        })

    sizes = pages.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.octet_length("html")).alias("size")).where(F.col("n") >= least_pages)
    sections = written(sizes.select("host", F.ceil(F.col("size") / section_bytes).cast("int").alias("sections")), "hosts")
    dealt = pages.join(broadcast_if_small(sections), "host").select(
        "host", F.pmod("salt", F.greatest("sections", F.lit(1))).cast("int").alias("section"), "html"
    )
    streams = dealt.mapInArrow(_streams, "host string, section int, stream binary")
    found = streams.groupBy("host", "section").applyInArrow(find, _RUNS_SQL + ", plain boolean")
    return found.groupBy("host", "run").agg(F.max("marked").alias("marked"), F.max("plain").alias("plain"))


def unique_runs(blocks: list[str], boilerplate: set[str], run: int) -> tuple[list[str], int]:
    """The blocks without the words that ``boilerplate`` covers, and the number of these words."""
    words = [w for block in blocks for w in block.split()]
    covered = bytearray(len(words))
    starts = {b.split(" ", 1)[0] for b in boilerplate}
    for i in range(len(words) - run + 1):
        if words[i] in starts and " ".join(words[i:i + run]) in boilerplate:
            covered[i:i + run] = b"\1" * run
    out, at = [], 0
    for block in blocks:
        n = len(block.split())
        out.append(" ".join(w for w, gone in zip(words[at:at + n], covered[at:at + n], strict=True) if not gone))
        at += n
    return [block for block in out if block], sum(covered)


def main_text(html: str, runs: list[dict] | None, run: int = RUN_WORDS) -> str:
    """Main text of a page whose host has the boilerplate ``runs``."""
    marked, blocks = main_blocks(html)
    boilerplate = {r["run"] for r in runs or () if r["marked" if marked else "plain"]}
    if boilerplate:
        rest, gone = unique_runs(blocks, boilerplate, run)
        if not marked or 2 * gone <= sum(len(b.split()) for b in blocks):
            blocks = rest
    return " ".join(blocks)


def extract_pages(pages: DataFrame, run: int = RUN_WORDS, least_pages: int = LEAST_PAGES, share: float = SHARE,
                  marked_share: float = MARKED_SHARE, section_bytes: int = SECTION_BYTES) -> DataFrame:
    """Per page: page_id, url, ``text`` and its code points ``n_chars``."""
    rows = pages.select(
        "page_id", "url", host_of(F.col("url")).alias("host"), F.xxhash64("page_id", "url").alias("salt"), F.coalesce("html", F.lit("")).alias("html")
    )
    found = host_boilerplate(rows.where("host <> ''"), run, least_pages, share, marked_share, section_bytes)
    runs = written(found.groupBy("host").agg(F.collect_list(F.struct("run", "marked", "plain")).alias("runs")), "boilerplate")
    kinds = dict(rows.dtypes)

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, known, run) for html, known in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            sizes = pa.array(list(map(len, texts)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    known = rows.join(broadcast_if_small(runs), "host", "left").select("page_id", "url", "html", "runs")
    return known.mapInArrow(extract, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
