"""Language identification by language-bitmask n-gram filters.

A bit-sliced Bloom filter holds one mask of languages per slot. An n-gram has two slots, and the
conjunction of their masks names all languages that contain it. Per language the hits of a text are
counted and corrected for the share of false positives that the language's fill makes likely; the
language with the largest corrected share of n-grams decides, and that share is the score.

N-grams are 3 and 4 letters of lower-cased words, with word ends. A language's filter takes the
n-grams that make up at least ``min_share`` of its training text, so it holds at most ``1/min_share``
of them per length, whatever the corpus; rarer ones are noise as often as not. All languages are learned. Training reads at most about ``sample_rows`` labelled rows
per language, dealt by a hash of their id.

A text without letters, null texts included, gets ``und`` with score 0. Rows without a language are
not learned from. Equal shares go to the alphabetically first language. If no row is labelled, all
texts get ``und``. Repeated rows and null ids are rows like all others; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
LENGTHS = (3, 4)
SLOT_BITS = 20
_SPACE, _MIX = 32, np.uint64(0x9E3779B97F4A7C15)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def ngram_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the texts, and the index of the text each belongs to."""
    lowered = [t.lower() if t else "" for t in texts]
    lengths = np.fromiter((len(t) + 2 for t in lowered), np.int64, len(lowered))
    chars = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = np.where(_is_letter()[chars], chars, np.uint32(_SPACE))
    owner = np.repeat(np.arange(len(lowered), dtype=np.int32), lengths)
    space = chars == _SPACE
    keep = np.ones(len(chars), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    chars, owner, space = chars[keep].astype(np.uint64), owner[keep], space[keep]
    hashes, owners = [], []
    for n in LENGTHS:
        if len(chars) < n:
            continue
        count = len(chars) - n + 1
        code, inner = np.full(count, np.uint64(n)), np.ones(count, bool)
        for k in range(n):
            code = code * np.uint64(0x10001B3) + chars[k:k + count]
            if 0 < k < n - 1:
                inner &= ~space[k:k + count]
        code = code[inner] * _MIX
        hashes.append(code ^ (code >> np.uint64(29)))
        owners.append(owner[1:1 + count][inner])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    return np.concatenate(hashes), np.concatenate(owners)


def slots_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    last = np.uint64((1 << SLOT_BITS) - 1)
    return (hashes & last).astype(np.int64), (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


@dataclass
class LanguageFilter:
    languages: list[str]
    masks: np.ndarray  # (words of 64 languages, slots)

    _chance: np.ndarray | None = None

    def chance(self) -> np.ndarray:
        """Per language: the chance that a foreign n-gram hits, from the filter's fill."""
        if self._chance is None:
            self._chance = self._false_positives()
        return self._chance

    def _false_positives(self) -> np.ndarray:
        fill = [
            np.count_nonzero(self.masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / self.masks.shape[1]
            for i in range(len(self.languages))
        ]
        return np.array(fill) ** 2

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of n-grams per text and language; n-grams per text."""
        total = np.zeros(len(texts), np.int64)
        hits = np.zeros((len(texts), len(self.languages)), np.int64)
        for first, group in _pieces(texts):
            hashes, owner = ngram_hashes(group)
            owner = first[owner]
            total += np.bincount(owner, minlength=len(texts))
            one, two = slots_of(hashes)
            for word, masks in enumerate(self.masks):
                hit = masks[one] & masks[two]
                for i in range(word * 64, min(len(self.languages), word * 64 + 64)):
                    own = (hit >> np.uint64(i % 64) & np.uint64(1)).astype(bool)
                    hits[:, i] += np.bincount(owner[own], minlength=len(texts))
        chance = self.chance()
        share = hits / np.maximum(total, 1)[:, None]
        return np.clip((share - chance) / np.maximum(1 - chance, 1e-9), 0, 1), total


def _word_end(text: str, at: int) -> int:
    """The first place from ``at`` on that is not within a word."""
    while at < len(text) and text[at].isalpha() and text[at - 1].isalpha():
        at += 1
    return at


def _pieces(texts: list[str | None], chars: int = 500_000) -> Iterator[tuple[np.ndarray, list[str]]]:
    """All texts in groups of about ``chars`` characters, with each piece's text index; longer texts are cut
    between words, which cuts no n-gram."""
    index, group, size = [], [], 0
    for i, text in enumerate(texts):
        text, at = (text or "").lower(), 0
        while at < len(text):
            end = _word_end(text, min(at + chars, len(text)))
            index.append(i)
            group.append(text[at:end])
            size += end - at
            at = end
            if size >= chars:
                yield np.array(index), group
                index, group, size = [], [], 0
    if group:
        yield np.array(index), group


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, rows in batch.groupby("lang"):
            for _, group in _pieces(rows["text"].tolist()):
                hashes, _ = ngram_hashes(group)
                grams, n = np.unique(hashes, return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": grams.view(np.int64), "n": n})


def train_filter(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_rows: int = 20_000, min_share: float = 1e-5,
) -> LanguageFilter:
    """The filter of all languages of the labelled rows: 8 MB for each 64 of them."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    languages = sorted(counts)
    masks = np.zeros(((len(languages) + 63) // 64, 1 << SLOT_BITS), np.uint64)
    if not languages:
        return LanguageFilter(languages, masks)
    spark = labelled.sparkSession
    wanted = F.broadcast(spark.createDataFrame(
        [(lang, i, min(1.0, sample_rows / counts[lang])) for i, lang in enumerate(languages)],
        "lang string, number int, rate double",
    ))
    dealt = F.pmod(F.xxhash64(F.lit(8), F.col("id")), F.lit(1_000_003)) / 1_000_003.0
    sample = rows.join(wanted, "lang").where(dealt < F.col("rate")).select("lang", "text")
    grams = sample.mapInPandas(_gram_counts, "lang string, gram long, n long")
    summed = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = F.broadcast(grams.groupBy("lang").agg(F.sum("n").alias("total")))  # a row per language
    frequent = summed.join(totals, "lang").where(F.col("n") >= F.col("total") * min_share).join(wanted, "lang")
    last = (1 << SLOT_BITS) - 1
    slots = F.array(
        F.col("gram").bitwiseAND(F.lit(last)), F.shiftrightunsigned("gram", 64 - SLOT_BITS)
    )
    bits = (
        frequent.select((F.col("number") / 64).cast("int").alias("word"), (F.col("number") % 64).alias("bit"), F.explode(slots).alias("slot"))
        .groupBy("word", "slot").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    )
    found = bits.toPandas()  # at most one row per slot and 64 languages
    masks[found["word"].to_numpy(), found["slot"].to_numpy()] = found["mask"].to_numpy(np.int64).view(np.uint64)
    return LanguageFilter(languages, masks)


def predict_language(docs: DataFrame, model: LanguageFilter, text: Column) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model, all_texts, langs, scores = shared.value, texts.tolist(), [], []
        for at in range(0, len(all_texts), 1000):
            some = all_texts[at:at + 1000]
            if not model.languages:
                langs += [UNDETERMINED] * len(some)
                scores += [0.0] * len(some)
                continue
            shares, total = model.shares(some)
            best = shares.argmax(axis=1)
            langs += [model.languages[b] if n else UNDETERMINED for b, n in zip(best, total, strict=True)]
            scores += np.where(total > 0, shares[np.arange(len(some)), best], 0.0).tolist()
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    out = docs.select(*kept, predict(text).alias("__pred"))
    return out.select(*kept, "__pred.lang_pred", "__pred.score")
