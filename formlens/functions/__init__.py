"""Column expressions used by the operators (all JVM-side except header NFKD)."""

from formlens.functions.dates import age_at_year_end, in_year, parse_day_first, year_end
from formlens.functions.numbers import coerce_number, render_int_float
from formlens.functions.text import (
    clean_category,
    col_of,
    collapse_ws,
    normalize_header,
    normalize_text,
    strip_category,
    strip_ws,
)

__all__ = [
    "age_at_year_end",
    "clean_category",
    "coerce_number",
    "col_of",
    "collapse_ws",
    "in_year",
    "normalize_header",
    "normalize_text",
    "parse_day_first",
    "render_int_float",
    "strip_category",
    "strip_ws",
    "year_end",
]
