"""Messy names to canonical names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.domains import CATEGORY_RULES, PRODUCT_RULES, STATUS_SYNONYMS, STORE_RULES
from cartloom.functions import collapse_blanks, title_words, ws_trim


def _first_match(rules: list[tuple[Column, str]], otherwise: Column) -> Column:
    chain = reduce(lambda c, rule: c.when(rule[0], rule[1]), rules[1:], F.when(*rules[0]))
    return chain.otherwise(otherwise)


def product_key(c: Column) -> Column:
    """Lower case without blanks and hyphens. ``translate`` drops characters without a regex."""
    return F.lower(ws_trim(F.translate(c, " \t\n\f\r\x0b-", "")))


def canonical_product(name: Column, key: Column) -> Column:
    """Canonical product of a raw ``name`` whose :func:`product_key` is ``key``.

    The key comes as a column of its own so that it is computed once, not per rule.
    """
    rules = [
        (reduce(Column.__or__, [F.contains(key, F.lit(part)) for part in parts]), product)
        for product, parts in PRODUCT_RULES
    ]
    return _first_match(rules, title_words(ws_trim(collapse_blanks(name))))


def _by_pattern(text: Column, patterns: list[tuple[str, str]]) -> Column:
    low = F.lower(text)
    return _first_match([(low.rlike(p), name) for name, p in patterns], title_words(text))


def canonical_category(text: Column) -> Column:
    """Canonical category of a trimmed text; likewise for stores and statuses."""
    return _by_pattern(text, CATEGORY_RULES)


def canonical_store(text: Column) -> Column:
    return _by_pattern(text, STORE_RULES)


def canonical_status(text: Column) -> Column:
    low = F.lower(text)
    return _first_match([(low.isin(words), name) for name, words in STATUS_SYNONYMS], title_words(text))
