"""Quality rules: base counts per document and the frequency of lines across documents.

Lines are normalised (lower case, digits to 0, white space to single blanks) and hashed. Per host the
different documents with a line are counted; copies of a text count once. A line in more than
``max_share`` of its host's documents is boilerplate and is removed. The limit is never below ``min_docs``
documents, so small hosts keep their lines, nor above ``max_docs``, so it does not loosen as a host grows.
A document that keeps less than ``min_kept`` of its words is depleted and rejected, as is one that fails
the base rules. ``without_frequent_lines`` gives the texts without these lines.

A null text has no words and fails the base rules, like an empty one. Null hosts count as the host
``''``. Repeated rows and null ids are rows like all others; repeated rows are one document to the
line counts. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import bind, text_key, text_or_empty, words
from cartloom.session import written

MAX_SHARE, MIN_DOCS, MAX_DOCS, MIN_KEPT = 0.01, 10, 100, 0.7
SYMBOL, IN_WORD = r"[#*$%&|<>]", r"[^\x20\x09-\x0D]"
MIN_WORDS, MAX_REPEATED = 50, 50


def repeated_words(tokens: Column) -> Column:
    """Words inside 3-word windows that occur twice or more."""
    last = F.size(tokens) - 3

    def covered(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        twice = bind(placed, lambda s: F.filter(
            s, lambda x, k: (F.get(s, k - 1)["g"] == x["g"]) | (F.get(s, k + 1)["g"] == x["g"])
        ))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return bind(places, lambda p: F.aggregate(
            F.transform(p, lambda a, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - a, F.lit(3)))), F.lit(0), lambda s, x: s + x
        ))

    grams = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))
    return F.when(last < 0, F.lit(0)).otherwise(bind(
        grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g))
    ))


def base_counts(text: Column) -> Column:
    """Struct of the base counts of a text."""
    text = text_or_empty(text)
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(IN_WORD))
    return bind(words(text), lambda tokens: F.struct(
        F.size(tokens).cast("long").alias("n_words"),
        F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(tokens).cast("long").alias("n_repeat_words"),
    ))


def normalised_lines(text: Column) -> Column:
    """Structs of place, hash and number of words of each line with a word."""
    zeros = F.regexp_replace(F.lower(text_or_empty(text)), "[0-9]", "0")
    flat = F.regexp_replace(zeros, r"[ \t\x0B\f\r]{2,}|[\t\x0B\f\r]", " ")  # single blanks stay as they are
    lines = F.transform(F.split(flat, "\n", -1), lambda x, i: F.struct(i.alias("at"), F.trim(x).alias("x")))
    return F.transform(F.filter(lines, lambda s: s["x"] != ""), lambda s: F.struct(
        s["at"].alias("at"), F.xxhash64(s["x"]).alias("line"),
        (F.length(s["x"]) - F.length(F.replace(s["x"], F.lit(" "), F.lit(""))) + 1).alias("words"),
    ))


def _named(text: Column, host: Column) -> list[Column]:
    return [F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(text_key(text), F.lit(b"")).alias("key")]


def _frequent(lines: DataFrame, copies: DataFrame, max_share: float, min_docs: int, max_docs: int) -> DataFrame:
    """Boilerplate (``host``, ``line``) among ``lines``, which has a row per host, text and line."""
    hosts = copies.groupBy("host").agg(F.count("*").alias("host_docs"))
    limit = F.greatest(F.lit(min_docs), F.least(F.lit(max_docs), F.col("host_docs") * max_share))
    return (
        lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > min_docs)
        .join(hosts, "host").where(F.col("n") > limit).select("host", "line")
    )


def quality_verdict(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, max_docs: int = MAX_DOCS, min_kept: float = MIN_KEPT,
) -> DataFrame:
    """Per row: id, the base counts, ``base_failed``, ``removed_words`` and ``kept``."""
    text = F.col(text_col)
    named = _named(text, F.col(host_col))
    lines = written(  # read twice, made once
        docs.select(*named, F.explode(normalised_lines(text)).alias("x"))
        .groupBy("host", "key", F.col("x.line").alias("line")).agg(F.sum("x.words").alias("words")), "lines"
    )
    copies = docs.select(*named).groupBy("host", "key").agg(F.count("*").alias("copies"))
    frequent = _frequent(lines, copies, max_share, min_docs, max_docs)
    removed = lines.join(frequent, ["host", "line"]).groupBy("host", "key").agg(F.sum("words").alias("words"))
    removed = removed.join(copies, ["host", "key"]).select(
        "host", "key", F.expr("words div copies").alias("removed_words")
    )
    counted = docs.select(F.col(id_col).alias("doc_id"), *named, base_counts(text).alias("base")).select("doc_id", "host", "key", "base.*")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    out = counted.join(removed, ["host", "key"], "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    depleted = F.col("n_words") - F.col("removed_words") < F.col("n_words") * min_kept
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "removed_words", (~failed & ~depleted).alias("kept"),
    )


def without_frequent_lines(
    docs: DataFrame, text_col: str = "text", host_col: str = "source",
    max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, max_docs: int = MAX_DOCS,
) -> DataFrame:
    """All rows and columns of ``docs``, the texts without their host's boilerplate lines.

    Other lines stay as they are and in order, blank ones too; a null text stays null. The places of a
    text's boilerplate lines travel as one array per text, never the lines themselves.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_named(F.col(text_col), F.col(host_col)))
    placed = written(
        rows.select("host", "key", F.explode(normalised_lines(F.col(f"row.{text_col}"))).alias("x"))
        .groupBy("host", "key", F.col("x.line").alias("line")).agg(F.collect_set("x.at").alias("places")), "placed_lines"
    )
    frequent = _frequent(placed, rows.select("host", "key").distinct(), max_share, min_docs, max_docs)
    gone = placed.join(frequent, ["host", "line"]).groupBy("host", "key").agg(F.sort_array(F.flatten(F.collect_list("places"))).alias("gone"))
    found = rows.join(gone, ["host", "key"], "left")

    def rest(lines: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda p: p + 1))
        ends = F.concat("gone", F.array(F.size(lines)))
        return F.array_join(F.flatten(F.transform(starts, lambda s, i: F.slice(lines, s + 1, F.get(ends, i) - s))), "\n")

    text = F.col(f"row.{text_col}")
    cleaned = F.when(F.col("gone").isNull(), text).otherwise(bind(F.split(text, "\n", -1), rest))
    return found.select(*[cleaned.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
