"""Text expressions. All are built-ins that stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space.
ASCII_WHITE_SPACE = "\t\n\x0b\x0c\r "
WHITE_SPACE = ASCII_WHITE_SPACE + (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The punctuation that starts a new word in title case.
WORD_BREAKS = "[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"

_BREAK_CLASS = "[" + "".join("\\" + c for c in WORD_BREAKS) + r"\t\n\x0B\f\r]"
_MARK = "\x01 "


def ws_trim(c: Column) -> Column:
    """Trim every kind of white space; ``F.trim`` alone takes off only blanks.

    Each end is compared with the whole set, so texts of single-byte characters get the short
    set: all other white space takes more bytes.
    """
    plain = F.octet_length(c) == F.length(c)
    return F.when(plain, F.btrim(c, F.lit(ASCII_WHITE_SPACE))).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def is_blank(c: Column) -> Column:
    return F.coalesce(ws_trim(c), F.lit("")) == ""


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def title_words(c: Column) -> Column:
    """Title case with punctuation as word breaks (``home-nest`` -> ``Home-Nest``).

    ``initcap`` breaks words at blanks only, so a marked blank is put behind each other
    break and taken out again. Texts without such a break skip both replacements.
    """
    marked = F.regexp_replace(c, f"({_BREAK_CLASS})", "$1" + _MARK)
    return F.when(
        c.rlike(_BREAK_CLASS), F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))
    ).otherwise(F.initcap(c))


def collapse_blanks(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", " ")
