"""Collocations: frequent phrases whose parts rarely stand without each other.

Texts are lower-cased (A-Z only) and cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces, pieces into words
``[^\\x20\\x09]+``; phrases never leave a piece. Everything is counted per language.

Direct-address tiling: the words of a language get ids by falling frequency, so frequent pairs of words
meet in few square tiles of the table of all pairs. A task counts tiles that are well filled by a dense
``bincount`` and the others as sorted coordinates (COO). Frequent pairs get ids by frequency in turn, and
(pair, word) is counted in the same way, and so on to the longest phrase. A phrase can only be frequent if
its first and its last part are, so phrases with an infrequent part are not counted at all.

The ids live in a dictionary that every task holds: at most ``HEAD_WORDS`` words of at most
``WORD_BYTES`` bytes and ``HEAD_PHRASES`` phrases of each length, the most frequent ones. Beyond
these bounds nothing is lost: phrases with a part that is not in the dictionary are counted by their text,
unless the dictionary is known to hold every frequent part. Counts of a task are summed by Spark, by phrase,
so no task gets all counts of a tile. Scores are computed in 38 digits.

Null texts are empty, a null language is ``und``; repeated rows count as often as they stand there; an empty
table gives an empty result. Texts of any length are read whole, in blocks that end at the end of a piece.
Only the text and language columns are read. Ties go by the rules of ``top_phrases``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm.common import salt
from cartloom.session import written

UNKNOWN_LANGUAGE = "und"
HEAD_WORDS, WORD_BYTES, HEAD_PHRASES = 1 << 19, 64, 1 << 20
TILE_BITS = 9  # a tile has 512 x 512 counters
BLOCK_BYTES = 4 << 20  # text cut and counted at once
HELD = 1 << 20  # different phrases a task holds before it hands them on

_BREAK, _OUTSIDE, _TAIL = b"\xff", -2, -1  # a byte that no UTF-8 text has; ids of a piece's end and of an unlisted word
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c == 9 else 255 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256)
)
_COUNTS = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("phrase", pa.binary()), ("n", pa.int64())])
_COUNTS_SQL = "lang string, code long, phrase binary, n long"


class Head:
    """Ids of the most frequent words and phrases of one language, opened from their packed form.

    ``packed`` words stand in the order of their ids, one a line (no word holds a line's end); ``ranked`` has,
    by length, the codes of the phrases in that order.
    """

    def __init__(self, packed: bytes, ranked: list[np.ndarray]):
        self.names = packed.split(b"\n") if packed else []
        self.words = dict(zip(self.names, range(len(self.names)), strict=True))
        self.ranked = ranked
        self.sorted = [(codes[order], order) for codes in ranked for order in [np.argsort(codes)]]

    def extend(self, ids: np.ndarray, level: int) -> np.ndarray:
        """Ids of the phrases of ``level`` words that start at each place."""
        at = ids
        for length in range(2, level + 1):
            at = self._found(at[:-1], ids[length - 1:], *self.sorted[length - 2])
        return at

    @staticmethod
    def _found(left: np.ndarray, right: np.ndarray, codes: np.ndarray, named: np.ndarray) -> np.ndarray:
        outside, known = (left == _OUTSIDE) | (right == _OUTSIDE), (left >= 0) & (right >= 0)
        found = np.where(outside, _OUTSIDE, _TAIL)
        if len(codes):
            code = _code(left[known], right[known])
            place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            found[known] = np.where(codes[place] == code, named[place], _TAIL)
        return found

    def spell(self, codes: np.ndarray, length: int) -> list[bytes]:
        """Texts of coded phrases."""
        left, right = codes // HEAD_WORDS, (codes % HEAD_WORDS).tolist()
        first = [self.names[i] for i in left.tolist()] if length == 2 else self.spell(self.ranked[length - 3][left], length - 1)
        return [a + b" " + self.names[i] for a, i in zip(first, right, strict=True)]


class Dictionary:
    """The heads of all languages: packed while they travel, opened once in each worker."""

    def __init__(self, levels: int = 0):
        self.packed: dict[str, tuple[bytes, list[np.ndarray]]] = {}
        self.levels, self._open = levels, {}

    def __getstate__(self) -> dict:
        return {"packed": self.packed, "levels": self.levels, "_open": {}}

    def head(self, lang: str) -> Head:
        if lang not in self._open:
            self._open[lang] = Head(*self.packed.get(lang, (b"", [np.zeros(0, np.int64)] * self.levels)))
        return self._open[lang]

    def add_words(self, listed: pa.Table) -> None:
        order = np.lexsort((np.array(listed["phrase"].to_pylist(), object), -listed["n"].to_numpy()))
        for lang, rows in _by_language(listed.take(order)):
            self.packed[lang] = (b"\n".join(rows["phrase"].to_pylist()), [])

    def add_phrases(self, listed: pa.Table) -> None:
        codes = {lang: rows["code"].to_numpy() for lang, rows in _by_language(listed.take(np.lexsort((listed["code"], -listed["n"].to_numpy()))))}
        for lang, (_, ranked) in self.packed.items():
            ranked.append(codes.get(lang, np.zeros(0, np.int64)))
        self.levels += 1
        self._open = {}


def _by_language(rows: pa.Table) -> Iterator[tuple[str, pa.Table]]:
    langs = np.array(rows["lang"].to_pylist(), object)
    yield from ((lang, rows.filter(pa.array(langs == lang))) for lang in dict.fromkeys(langs.tolist()))


def _code(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left * HEAD_WORDS + right


def merged(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different codes and the sums of their counts."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return codes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def tile_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of pairs of ids and how often they occur: dense tiles by ``bincount``, the rest as sorted COO."""
    side, mask = 1 << TILE_BITS, (1 << TILE_BITS) - 1
    tiles = _code(left >> TILE_BITS, right >> TILE_BITS)
    order = np.argsort(tiles, kind="stable")
    left, right, tiles = left[order], right[order], tiles[order]
    starts = np.flatnonzero(np.r_[True, tiles[1:] != tiles[:-1]]) if len(tiles) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(tiles)]
    sparse, codes, counts = np.ones(len(tiles), bool), [], []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=False):
        if b - a >= side * side // 8:
            dense = np.bincount((left[a:b] & mask) << TILE_BITS | right[a:b] & mask, minlength=side * side)
            cells = np.flatnonzero(dense)
            codes.append(_code((left[a] & ~mask) + (cells >> TILE_BITS), (right[a] & ~mask) + (cells & mask)))
            counts.append(dense[cells])
            sparse[a:b] = False
    rest, n = np.unique(_code(left[sparse], right[sparse]), return_counts=True)
    return np.concatenate([*codes, rest]).astype(np.int64), np.concatenate([*counts, n]).astype(np.int64)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Words of one language, with a break at both ends of every piece; a block ends where a piece ends."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter[str] = Counter()

    def cut(lang: str) -> list[bytes]:
        sizes[lang] = 0
        return _BREAK.join([b"", *held.pop(lang), b""]).replace(_BREAK, b" \xff ").split()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text, start = text.as_py().translate(_TABLE), 0
            while start < len(text):
                end = len(text) if len(text) - start <= BLOCK_BYTES else text.find(_BREAK, start + BLOCK_BYTES) % (len(text) + 1)
                held.setdefault(lang, []).append(text[start:end])
                sizes[lang] += end - start
                start = end
                if sizes[lang] >= BLOCK_BYTES:
                    yield lang, cut(lang)
                elif sum(sizes.values()) >= 4 * BLOCK_BYTES:  # many languages
                    yield from [(name, cut(name)) for name in list(held)]
    yield from [(name, cut(name)) for name in list(held)]


class _Counts:
    """Counts of one task, handed on when there are too many to hold."""

    def __init__(self) -> None:
        self.coded: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.texts: dict[str, Counter[bytes]] = {}

    def add_codes(self, lang: str, codes: np.ndarray, counts: np.ndarray) -> None:
        self.coded.setdefault(lang, []).append((codes, counts))

    def full(self) -> bool:
        if sum(len(codes) for parts in self.coded.values() for codes, _ in parts) > HELD:
            self.coded = {lang: [self._merge(parts)] for lang, parts in self.coded.items()}
        return max(sum(len(p[0][0]) for p in self.coded.values()), sum(map(len, self.texts.values()))) > HELD // 2

    @staticmethod
    def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return merged(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    def hand_on(self) -> Iterator[pa.RecordBatch]:
        for lang, parts in self.coded.items():
            codes, counts = self._merge(parts)
            yield _rows(lang, pa.array(codes), pa.nulls(len(codes), pa.binary()), pa.array(counts))
        for lang, texts in self.texts.items():
            yield _rows(lang, pa.nulls(len(texts), pa.int64()), pa.array(list(texts), pa.binary()), pa.array(list(texts.values()), pa.int64()))
        self.__init__()


def _rows(lang: str, codes: pa.Array, phrases: pa.Array, counts: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), codes, phrases, counts], schema=_COUNTS)


def _summed(docs: DataFrame, count) -> DataFrame:
    """``count(lang, words, counts)`` over all blocks of all texts, summed by language and phrase."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for lang, words in _blocks(batches):
            count(lang, words, counts)
            if counts.full():
                yield from counts.hand_on()
        yield from counts.hand_on()

    return docs.mapInArrow(run, _COUNTS_SQL).groupBy("lang", "code", "phrase").agg(F.sum("n").alias("n"))


def _count_words(lang: str, words: list[bytes], counts: _Counts) -> None:
    texts = counts.texts.setdefault(lang, Counter())
    texts.update(words)
    texts[b""] += len(words) - texts.pop(_BREAK, 0)  # all words of the language


def _count_phrases(shared, level: int, complete: bool):
    def count(lang: str, words: list[bytes], counts: _Counts) -> None:
        head = shared.value.head(lang)
        known = head.words
        ids = np.fromiter((known.get(w, _TAIL) for w in words), np.int64, len(words))
        ids[np.fromiter((w == _BREAK for w in words), bool, len(words))] = _OUTSIDE
        parts = head.extend(ids, level - 1)
        left, right, last = parts[:-1], parts[1:], ids[level - 1:]
        listed = (left >= 0) & (last >= 0) & ((right >= 0) | (not complete and right == _TAIL))
        counts.add_codes(lang, *tile_counts(left[listed], last[listed]))
        if not complete:
            rest = (left != _OUTSIDE) & (right != _OUTSIDE) & ~listed
            texts = counts.texts.setdefault(lang, Counter())
            texts.update(b" ".join(words[i:i + level]) for i in np.flatnonzero(rest).tolist())

    return count


def _most_frequent(table: DataFrame, bound: int) -> tuple[DataFrame, bool]:
    """At most ``bound`` rows, all those above some count; and whether these are all."""
    size = F.floor(F.log2("n") * 16)
    sizes = {r.size: r.rows for r in table.groupBy(size.alias("size")).agg(F.count("*").alias("rows")).collect()}
    taken, least = 0, max(sizes, default=0) + 1
    for at in sorted(sizes, reverse=True):
        if taken + sizes[at] > bound:
            break
        taken, least = taken + sizes[at], at
    return table.where(size >= least), taken == sum(sizes.values())


def count_phrases(docs: DataFrame, longest: int = 3, min_count: int = 10, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All phrases of 1 to ``longest`` words that occur ``min_count`` times or more: ``lang``, ``phrase``
    (words joined by a space), ``words``, ``n``. The phrase of no words has the number of all words."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    )
    singles = written(_summed(rows, _count_words).where((F.col("n") >= min_count) | (F.octet_length("phrase") == 0)), "words")
    empty = F.octet_length("phrase") == 0
    levels = [singles.select("lang", F.col("phrase").cast("string").alias("phrase"), F.when(empty, 0).otherwise(1).alias("words"), "n")]
    listed, whole = _most_frequent(singles.where(~empty & (F.octet_length("phrase") <= WORD_BYTES)), HEAD_WORDS)
    complete = whole and not singles.where(F.octet_length("phrase") > WORD_BYTES).head(1)
    dictionary = Dictionary()
    dictionary.add_words(listed.select("lang", "phrase", "n").toArrow())
    for level in range(2, longest + 1):
        shared = spark.sparkContext.broadcast(dictionary)
        frequent = _summed(rows, _count_phrases(shared, level, complete)).where(F.col("n") >= min_count)
        table = written(frequent.mapInArrow(_spell(shared, level), _COUNTS_SQL), f"phrases-{level}")
        shared.unpersist()
        levels.append(table.select("lang", F.col("phrase").cast("string").alias("phrase"), F.lit(level).alias("words"), "n"))
        if level < longest:
            listed, whole = _most_frequent(table.where("code IS NOT NULL"), HEAD_PHRASES)
            complete = complete and whole and not table.where("code IS NULL").head(1)
            dictionary.add_phrases(listed.select("lang", "code", "n").toArrow())
    out = levels[0]
    for table in levels[1:]:
        out = out.unionByName(table)
    return out


def _spell(shared, level: int):
    """Puts the text of coded phrases beside their codes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            coded = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            texts = np.array(batch.column(2).to_pylist(), object)
            codes = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
            for lang in set(langs[coded].tolist()):
                own = coded & (langs == lang)
                texts[own] = np.array([*shared.value.head(lang).spell(codes[own], level), None], object)[:-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary()), batch.column(3)], schema=_COUNTS)

    return run


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.concat_ws(" ", F.slice(words, start, length))


def score_phrases(phrases: DataFrame) -> DataFrame:
    """Phrases of two words or more with ``a``, ``l``, ``r`` and ``score`` of their lowest-scoring cut."""
    of = phrases.select("lang", F.col("phrase").alias("part"), "n")
    words, k = F.split("phrase", " "), F.col("k")
    cuts = phrases.where("words > 1").select(
        "lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    cuts = cuts.select("*", _part(words, F.lit(1), k).alias("first"), _part(words, k + 1, F.col("words") - k).alias("rest"))
    cuts = cuts.join(of.select("lang", F.col("part").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(of.select("lang", F.col("part").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    big = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.withColumn("square", F.lit(1_000_000).cast("decimal(38,0)") * big("a") * big("a")).withColumn("product", big("l") * big("r"))
    best = F.min(F.struct(F.expr("square div product").alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def _held(phrases: DataFrame, inside_percent: int) -> DataFrame:
    """The phrases inside longer ones that occur often enough beside them."""
    longer = phrases.where("words > 2").select("lang", F.split("phrase", " ").alias("w"), "words", F.col("n").alias("f"))
    sized = longer.select("lang", "w", "words", "f", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    placed = sized.select("lang", "w", "f", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
    parts = placed.select("lang", _part(F.col("w"), F.col("at"), F.col("size")).alias("phrase"), "f")
    most = parts.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    inner = phrases.where("words > 1").join(most, ["lang", "phrase"])
    return inner.where(F.col("f") * 100 >= F.col("n") * inside_percent).select("lang", "phrase")


def top_phrases(docs: DataFrame, longest: int = 3, min_count: int = 10, inside_percent: int = 50, top: int = 2000,
                splits: int = 64, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A cut of a phrase scores floor(1000000 a a / (l r)) with a, l and r the counts of the phrase and of its two
    parts; the lowest-scoring cut counts, the shortest first part on ties. A phrase inside a longer candidate that
    occurs at least ``inside_percent`` % as often is dropped. Order: score, then a, descending, then phrase.
    """
    phrases = count_phrases(docs, longest, min_count, text_col, lang_col)
    scored = score_phrases(phrases).join(_held(phrases, inside_percent), ["lang", "phrase"], "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    share = scored.withColumn("share", salt(splits, F.col("phrase")))  # the best of a language are among the best of its shares
    share = share.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    ranked = share.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = phrases.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
