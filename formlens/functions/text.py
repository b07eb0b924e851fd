"""Text expressions (JVM-side, no Python in the row path).

Python's ``str.strip``/``\\s`` know more whitespace than Java's ``\\s`` and
Spark's ``trim``; ``WS`` below is Python's whitespace set (up to U+FFFF)
written as a Java regex class, so collapsing then trimming matches the
form cleaning rules exactly.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from formlens.config import FILL_VALUE

# Python whitespace, as a Java regex class.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
# The same class in RE2 (DuckDB), for oracle SQL.
WS_RE2 = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _fold_table() -> tuple[str, str]:
    """Latin letters whose NFKD form is one ASCII base letter plus marks.

    Built from a rule over U+00C0..U+024F rather than listed by hand.
    """
    src, dst = [], []
    for cp in range(0xC0, 0x250):
        ch = chr(cp)
        decomposed = unicodedata.normalize("NFKD", ch)
        base = "".join(c for c in decomposed if not unicodedata.combining(c))
        if len(base) == 1 and base != ch and base.isascii():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_table()


def col_of(name: str) -> Column:
    """Column reference that is safe for labels with dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


# Every character Python treats as whitespace (rule: str.isspace over the BMP).
WS_CHARS = "".join(ch for ch in map(chr, range(0x10000)) if ch.isspace())
_SPACES = " " * len(WS_CHARS)


def _to_spaces(c: Column) -> Column:
    """Map every whitespace character to a plain space (no regex)."""
    return F.translate(c, WS_CHARS, _SPACES)


def collapse_ws(c: Column) -> Column:
    """Whitespace runs become one space, then edge spaces are removed.

    ``translate`` turns all whitespace into spaces; the regex only runs on
    values that contain a double space.
    """
    t = _to_spaces(c)
    return F.trim(F.when(F.instr(t, "  ") > 0, F.regexp_replace(t, " {2,}", " ")).otherwise(t))


def strip_ws(c: Column) -> Column:
    """Remove edge whitespace only (inner runs are kept).

    The regex only runs when the first or last character is whitespace.
    """
    ws = F.lit(WS_CHARS)
    edge = (F.length(c) > 0) & (
        (F.instr(ws, F.substring(c, 1, 1)) > 0) | (F.instr(ws, F.substring(c, -1, 1)) > 0)
    )
    return F.when(edge, F.regexp_replace(c, "^" + WS + "+|" + WS + "+$", "")).otherwise(c)


def clean_category(c: Column, fill: str = FILL_VALUE) -> Column:
    """Null or blank -> fill; otherwise whitespace collapsed and trimmed.

    Case and accents are kept.  Idempotent.
    """
    return F.coalesce(F.nullif(collapse_ws(c.cast("string")), F.lit("")), F.lit(fill))


def strip_category(c: Column, fill: str = FILL_VALUE) -> Column:
    """Null -> fill, edge whitespace stripped, '' -> fill (inner runs kept)."""
    return F.coalesce(F.nullif(strip_ws(c.cast("string")), F.lit("")), F.lit(fill))


class _Folding(dict):
    """Character table: each character's compatibility form without marks, filled as characters occur."""

    def __missing__(self, code: int) -> str:
        self[code] = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        return self[code]


_FOLDING = _Folding(str.maketrans(FOLD_FROM, FOLD_TO))


def normalize_text(value: object) -> str:
    """Header normalisation in Python (used on header tables only): accents
    and compatibility forms folded, lower case, single spaces; None is ''."""
    return "" if value is None else " ".join(str(value).translate(_FOLDING).lower().split())


def _normalize_series(s):
    return s.map({h: normalize_text(h) for h in s.unique()})


def normalize_header(c: Column) -> Column:
    """Arrow-batched Python normalisation for header tables (exact NFKD)."""
    return _normalize_udf(c)


_normalize_udf = F.pandas_udf(_normalize_series, StringType())
