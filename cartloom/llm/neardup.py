"""Near duplicates by SimHash, found with pigeonring filtering.

Fingerprints of 64 bits link when at most ``d`` bits differ. The fingerprint is a ring of ``m > d``
segments, so some segment starts a chain on which, for every length ``l``, the first ``l`` segments
together differ in at most ``floor(l * d / m)`` bits: the first segment is equal, the first two differ
in at most one bit, and so on up to all of them, the full Hamming check.

Candidates come from chains of two. For each start a fingerprint owns the key of its two segments; if
its second segment has odd parity it also visits the keys one bit away, as a pair that differs there
has one odd member. A bucket needs an owner and another member. Buckets of two are one row of an
aggregate; larger ones are read by tasks in blocks of bounded size, and each pair of blocks gives only
a spanning forest of the links found, so a group of near copies is never expanded into all pairs.
Links between different fingerprints are never lost. Components come from alternating star
contractions of tables in the shared folder.

Null and empty texts have the fingerprint zero and link like any other. Equal texts share a
fingerprint, repeated rows stay rows of their own. Rows without an id link like others but do not name
a component unless all of it is without ids (the name is then null). An empty table gives an empty
result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import text_key
from cartloom.session import written

SEED = 42
BLOCK = 1024
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of a text's word shingles as an unsigned number."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(first[at:at + _CHUNK], last[at:at + _CHUNK], strict=True)], "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprint_column(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return simhash(text)


def segments(distance: int, bits: int = 64) -> list[tuple[int, int]]:
    """Offset and width of each segment: one more than the distance, three at least."""
    m = max(3, distance + 1)
    widths = [bits // m + (i < bits % m) for i in range(m)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def budget(length: int, distance: int) -> int:
    """Bits in which the first ``length`` segments of a chain may differ."""
    return length * distance // len(segments(distance))


def _ring(start: int, length: int, distance: int) -> int:
    """Mask of ``length`` segments from ``start`` on the ring, as a signed long."""
    parts = segments(distance)
    mask = 0
    for k in range(length):
        offset, width = parts[(start + k) % len(parts)]
        mask |= ((1 << width) - 1) << offset
    return mask - (1 << 64) if mask >> 63 else mask


def chain_keys(fp: str, distance: int) -> Column:
    """Array of (start, key, owner) for a fingerprint: the key it owns per start, and those it visits."""
    parts, starts = segments(distance), []
    for i in range(len(parts)):
        (first, wide), (second, width) = parts[i], parts[(i + 1) % len(parts)]
        head = f"(shiftrightunsigned({fp}, {first}) & {(1 << wide) - 1}L)"
        tail = f"(shiftrightunsigned({fp}, {second}) & {(1 << width) - 1}L)"
        key = f"(({i}L << 58) | ({head} << {width}) | {tail})"
        starts.append(
            f"if(bit_count({tail}) % 2 = 1, "
            f"transform(sequence(-1, {width - 1}), b -> struct(if(b < 0, {key}, {key} ^ (1L << b)) AS bucket, b < 0 AS owner)), "
            f"array(struct({key} AS bucket, true AS owner)))"
        )
    return F.expr(f"concat({', '.join(starts)})")


def chain_holds(left: str, right: str, bucket: str, distance: int) -> Column:
    """Whether all chains from the bucket's start keep their budgets, the whole ring included."""
    differ, m = f"({left} ^ {right})", len(segments(distance))
    cases = " ".join(
        f"WHEN {i} THEN " + " AND ".join(
            f"bit_count({differ} & ({_ring(i, n, distance)}L)) <= {budget(n, distance)}" for n in range(2, m)
        )
        for i in range(m)
    )
    return F.expr(f"(CASE shiftrightunsigned({bucket}, 58) {cases} END) AND bit_count({differ}) <= {distance}")


def block_links(fps: np.ndarray, chain: np.uint64, allowed: int, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one block or pair of blocks."""
    links: list[tuple[int, int]] = []
    rest = np.unique(fps)
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            differ = rest ^ at
            near = np.bitwise_count(differ & chain) <= allowed
            near[near] = np.bitwise_count(differ[near]) <= distance
            found = rest[near]
            links += [(int(at), int(f)) for f in found]
            frontier += list(found)
            rest = rest[~near]
    return links


def _bucket_links(distance: int):
    chains = [np.uint64(_ring(i, 3, distance) & (1 << 64) - 1) for i in range(len(segments(distance)))]

    def flush(names: tuple, parts: list[np.ndarray], out: list[tuple[int, int]]) -> None:
        # A chain that starts at another segment may also hold; the bucket of that start finds those.
        out += block_links(np.concatenate(parts), chains[names[0] >> 58], budget(3, distance), distance)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, parts = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            keys = batch[["bucket", "low", "high"]].to_numpy()
            fps = batch["fp"].to_numpy(np.int64).view(np.uint64)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if a == b:
                    continue
                here = tuple(keys[a].tolist())
                if here != name:
                    if parts:
                        flush(name, parts, out)
                    name, parts = here, []
                parts.append(fps[a:b])
            yield _link_frame(out)
        if parts:
            out = []
            flush(name, parts, out)
            yield _link_frame(out)

    return run


def _link_frame(links: list[tuple[int, int]]) -> pd.DataFrame:
    pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def simhash_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``fps`` (column ``fp``, distinct) within the distance."""
    keys = fps.select("fp", F.explode(chain_keys("fp", distance)).alias("k")).select("fp", "k.bucket", "k.owner")
    buckets = keys.groupBy("bucket").agg(
        F.count("*").alias("n"), F.max("owner").alias("owned"), F.min("fp").alias("a"), F.max("fp").alias("b")
    ).where((F.col("n") > 1) & F.col("owned"))
    buckets = written(buckets, "simhash-buckets")
    pairs = buckets.where((F.col("n") == 2) & chain_holds("a", "b", "bucket", distance)).select("a", "b")

    large = buckets.where("n > 2").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    # By merge at every size: the keys are many, and the large buckets grow with the corpus.
    members = keys.join(large.hint("merge"), "bucket").select(
        "bucket", "fp", "blocks", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("own")
    )
    met = members.select("bucket", "fp", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")).select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp"
    )
    order = ["bucket", "low", "high"]
    blocks = met.repartition(*order).sortWithinPartitions(*order).mapInPandas(_bucket_links(distance), "a long, b long")
    return pairs.union(blocks)


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of one partition as links to the least fingerprint they connect in it."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            low, high = sorted((root(a), root(b)))
            above[high] = low
    rows = [(x, root(x)) for x in list(above)]
    rows = [(x, r) for x, r in rows if x != r]
    yield pd.DataFrame({"a": [x for x, _ in rows], "b": [r for _, r in rows]}, dtype="int64")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) but the roots, the least node of each component.

    Large-star and small-star steps alternate until nothing changes; each round is a written table.
    """
    edges = written(links.repartition("a").mapInPandas(_contract, "a long, b long").distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if tuple(state) == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = tuple(state)
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "links")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """Per row: id, ``text_key``, ``fingerprint`` (signed long), ``component`` (the least fingerprint
    linked) and ``component_id`` (the least id linked).
    """
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
        fingerprint_column(F.col(text_col), shingle).alias("fingerprint"),
    ), "fingerprints")
    fps = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    tree = components(simhash_links(fps.select(F.col("fingerprint").alias("fp")), distance))
    # In a finished contraction every node points at its root, and the root is the only one that does not.
    linked = tree.union(tree.select("root", "root").distinct()).toDF("fingerprint", "component")
    ids = linked.join(fps, "fingerprint").groupBy("component").agg(F.min("least").alias("component_id"))
    linked = linked.join(ids, "component")
    names = fps.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("component"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    return rows.join(names, "fingerprint").select("doc_id", "text_key", "fingerprint", "component", "component_id")


def keep_one_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the least id, and one row of it if it is repeated."""
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("one")
    kept = found.groupBy("component").agg(one).select(
        F.col("one.doc_id").alias("__id"), F.col("one.text_key").alias("__text")
    ).distinct()
    keyed = docs.withColumn("__key", text_key(F.col(text_col)))
    same = F.col("__id").eqNullSafe(F.col(id_col)) & F.col("__text").eqNullSafe(F.col("__key"))
    return keyed.join(kept, same, "left_semi").dropDuplicates([id_col, "__key"]).drop("__key")
