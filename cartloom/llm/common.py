"""Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE_RUN = r"[\x20\x09-\x0D]+"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for a null text."""
    return F.array_remove(F.split(text_or_empty(text), WHITE_RUN), "")


def text_key(text: Column) -> Column:
    """A 16 byte name of a text; null stays null."""
    return F.unhex(F.md5(text))


def salt(splits: int, *keys: Column) -> Column:
    """A number below ``splits`` that depends on the keys only, so a repeated task deals rows alike."""
    return F.pmod(F.xxhash64(*keys), F.lit(splits)).cast("int")


def running_offsets(counts: DataFrame, group: list[str], order: str, count: str = "n") -> DataFrame:
    """``counts`` with ``offset``: the sum of ``count`` over the earlier rows of each group."""
    from pyspark.sql import Window

    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("offset", F.coalesce(F.sum(count).over(before), F.lit(0)).cast("long"))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def prefix_sums(values: Column) -> Column:
    """Running sums of an array of any length: each step adds sixteen sums a stride apart."""
    def step(stride: int):
        def reach(a: Column) -> Column:
            def add(v: Column, i: Column) -> Column:
                for k in range(1, 16):
                    v = v + F.coalesce(F.get(a, i - k * stride), F.lit(0))
                return v

            return F.when(F.size(a) > stride, F.transform(a, add)).otherwise(a)

        return reach

    for power in range(7):
        values = bind(values, step(16**power))
    return values


def match_spans(text: Column, regex: str) -> Column:
    """Leftmost non-overlapping matches: structs of ``start``, ``end`` (code points, exclusive),
    ``match``, and the text ``before`` (back to the last match) and ``after`` it.
    """
    def located(both: Column) -> Column:
        lengths = prefix_sums(F.transform(both["gaps"], lambda g, i: F.length(g) + F.coalesce(F.length(F.get(both["found"], i)), F.lit(0))))
        return bind(lengths, lambda ends: F.transform(both["found"], lambda m, i: F.struct(
            (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("match"),
            F.get(both["gaps"], i).alias("before"), F.get(both["gaps"], i + 1).alias("after"),
        )))

    quoted = F.lit(regex)
    parts = F.struct(F.regexp_extract_all(text, quoted, F.lit(0)).alias("found"), F.split(text, regex, -1).alias("gaps"))
    return F.when(text.rlike(regex), bind(parts, located))
