from annualis.functions.calc import (
    clamp, date_day, date_month, date_year, div, fill, flag, in_ranges, null_if, row_total,
)
from annualis.functions.lookups import attach_code, code_table, prefilter, scattered_join
from annualis.functions.text import (
    birth_month, birth_year, plain_int, safe_int, strip, strip_zeros, without_prefix,
)

__all__ = [
    "attach_code", "birth_month", "birth_year", "clamp", "code_table", "date_day",
    "date_month", "date_year", "div", "fill", "flag", "in_ranges", "null_if", "plain_int",
    "prefilter", "row_total", "safe_int", "scattered_join", "strip", "strip_zeros", "without_prefix",
]
