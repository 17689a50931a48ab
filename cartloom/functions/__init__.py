"""Column expressions shared by all operators."""

from cartloom.functions.numbers import magnitude, percent, ratio_percent, safe_int, safe_num
from cartloom.functions.text import collapse_blanks, is_blank, null_if_empty, title_words, ws_trim
from cartloom.functions.time import last_complete_month, parse_day, safe_date, utc_day, utc_instant

__all__ = [
    "collapse_blanks", "is_blank", "last_complete_month", "magnitude", "null_if_empty", "parse_day",
    "percent", "ratio_percent", "safe_date", "safe_int", "safe_num", "title_words", "utc_day",
    "utc_instant", "ws_trim",
]
