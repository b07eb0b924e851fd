"""Numeric coercion with the same acceptance as a strict decimal parser.

``try_cast`` alone accepts suffixes such as ``5d``/``5f``; the ``NUM``
guard keeps only plain decimal and exponent forms.  ``inf``/``nan`` and
thousands separators are rejected (null).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INT_FLOAT_RE = r"^[+-]?\d+\.0$"


def coerce_number(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.rlike(NUM_RE), F.trim(s).try_cast("double"))


def render_int_float(c: Column) -> Column:
    """``3.0`` -> ``3`` for text that came from an integer column with gaps."""
    s = c.cast("string")
    return F.when(s.rlike(INT_FLOAT_RE), F.regexp_replace(s, r"\.0$", "")).otherwise(s)
