"""Column functions: dates, age, text, numbers."""

import datetime as dt
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import one_col
from formlens.functions import (
    age_at_year_end,
    clean_category,
    coerce_number,
    normalize_text,
    parse_day_first,
    render_int_float,
    strip_category,
)

D = dt.datetime


def run(spark, values, expr, dtype="string"):
    df = one_col(spark, values, dtype=dtype)
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_dates_fixed_formats(spark):
    cases = {
        "31/12/2025": D(2025, 12, 31),
        "5/6/2025": D(2025, 6, 5),
        "5/6/2025 10:00:00": D(2025, 6, 5, 10),
        "05/06/2025 9:07:03": D(2025, 6, 5, 9, 7, 3),
        "2025-03-04": D(2025, 3, 4),          # ISO stays ISO
        "2025-03-04 10:11:12": D(2025, 3, 4, 10, 11, 12),
        "  5/6/2025 ": D(2025, 6, 5),          # edge whitespace is stripped
        "31/02/2025": None,                    # impossible date
        "12/31/2025": None,                    # month first is not accepted
        "5/6/25": None,                        # two-digit year is ambiguous
        "45000": None,                         # serial numbers are not dates
        "sin fecha": None,
        "": None,
        "5/6/2025 25:00:00": None,
        None: None,
    }
    got = run(spark, list(cases), parse_day_first)
    assert got == list(cases.values())


def test_dates_independent_of_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
        got = run(spark, ["05/09/2010", "2010-09-05 00:30:00"], parse_day_first)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [D(2010, 9, 5), D(2010, 9, 5, 0, 30)]


def test_age_edges(spark):
    births = [D(2007, 12, 31), D(2008, 1, 1), D(2025, 12, 31), D(2025, 12, 31, 10), D(2026, 1, 1), None]
    df = spark.createDataFrame([(b,) for b in births], "b timestamp_ntz")
    got = [r[0] for r in df.select(age_at_year_end(F.col("b"), 2025)).collect()]
    # 365.25-day years: 2008-01-01 gives 17, 2007-12-31 gives 18; later births null
    assert got == [18.0, 17.0, 0.0, None, None, None]


def test_age_matches_pandas_rule(spark):
    import pandas as pd

    births = [D(1990, 2, 28, 13), D(2000, 2, 29), D(1980, 12, 31, 23, 59), D(2024, 12, 30, 12)]
    cutoff = pd.Timestamp(2025, 12, 31)
    expected = [float(int((cutoff - pd.Timestamp(b)).days / 365.25)) for b in births]
    df = spark.createDataFrame([(b,) for b in births], "b timestamp_ntz")
    got = [r[0] for r in df.select(age_at_year_end(F.col("b"), 2025)).collect()]
    assert got == expected


def py_clean(value, fill="Sin dato"):
    if value is None:
        return fill
    text = str(value).strip()
    if not text:
        return fill
    return " ".join(text.split())


TEXTS = [None, "", "   ", " ", "\t", "a  b", "  lead", "trail  ", "Ñandú  Bogotá", "x y", "a　　b", "\x1cz\x1f"]


def test_clean_category_matches_python(spark):
    assert run(spark, TEXTS, clean_category) == [py_clean(t) for t in TEXTS]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab \t  　\x1cñ")), max_size=8), min_size=1, max_size=8))
def test_clean_category_property(spark, values):
    got = run(spark, values, clean_category)
    assert got == [py_clean(v) for v in values]
    # idempotent
    assert run(spark, got, clean_category) == got


def test_strip_category_keeps_inner_runs(spark):
    got = run(spark, [None, "  a  b ", " x", ""], strip_category)
    assert got == ["Sin dato", "a  b", "x", "Sin dato"]


def test_numbers_guarded(spark):
    cases = {
        "5": 5.0, " 5 ": 5.0, "5.": 5.0, ".5": 0.5, "1e3": 1000.0, "-2.5E-1": -0.25,
        "5d": None, "5f": None, "1_0": None, "1,5": None, "VIII": None, "inf": None, "nan": None,
        "Sin dato": None, "": None, None: None,
    }
    assert run(spark, list(cases), coerce_number) == list(cases.values())


def test_render_int_float(spark):
    assert run(spark, ["3.0", "3.5", "x", "-2.0"], render_int_float) == ["3", "3.5", "x", "-2"]


HEADERS = [
    "¿Cuál es tu identidad de géneros? ( es decir, ¿Cómo te vives, sientes, percibes, etc.?)",
    "  Estrato   socioeconómico ",
    "DIRECCIÓN DE RESIDENCIA",
    "Ñandú Ü",
]


def test_normalize_text_rule():
    assert normalize_text(None) == ""
    assert normalize_text("  Estrato   socioeconómico ") == "estrato socioeconomico"
    assert normalize_text("ﬁn") == "fin"  # NFKD compatibility decomposition


def test_fold_table_built_by_rule():
    from formlens.functions.text import FOLD_FROM, FOLD_TO

    assert len(FOLD_FROM) == len(FOLD_TO) > 100
    for a, b in zip(FOLD_FROM, FOLD_TO):
        base = "".join(c for c in unicodedata.normalize("NFKD", a) if not unicodedata.combining(c))
        assert base == b


@pytest.mark.parametrize("value", ["Sin dato", "X", None])
def test_semester_after_cleaning_is_null(spark, value):
    got = run(spark, [value], lambda c: coerce_number(clean_category(c)))
    assert got == [None]
