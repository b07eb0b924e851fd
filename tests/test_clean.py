"""Cleaned-table build (O23-O35) on small hand-made exports."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from formlens import config as C
from formlens.operators import clean as K
from formlens.operators.common import FormValidationError

MAPPED_TEXT = [raw for raw, clean in C.RAW_TO_CLEANED.items() if clean not in (C.BIRTH_LABEL, C.SEMESTER_LABEL)]


def raw_export(spark, rows, drop=()):
    """rows: (file_id, submitted, filled, birth, semester, text, address)."""
    cols = ["file_id", C.SUBMITTED_LABEL, C.FILLED_LABEL, C.BIRTH_LABEL, C.SEMESTER_LABEL]
    data = []
    for fid, sub, fil, birth, sem, text, addr in rows:
        data.append((fid, sub, fil, birth, sem, addr, *([text] * len(MAPPED_TEXT))))
    names = cols + ["Dirección de residencia", "Unnamed: 60"][:1] + MAPPED_TEXT
    df = spark.createDataFrame(data, ", ".join(f"c{i} {'bigint' if i == 0 else 'string'}" for i in range(len(names))))
    df = df.toDF(*names)
    return df.drop(*drop)


ROWS = [
    (1, "01/03/2025 10:00:00", "01/03/2025", "31/12/2007", "3", "  a   b ", "Calle 1"),
    (1, "02/03/2025 10:00:00", "02/03/2025", "01/01/2008", "Sin dato", None, "Calle 2"),
    (1, "02/03/2024 10:00:00", "sin fecha", "31/02/2001", "5d", "", "Calle 3"),
    (2, "05/05/2024 10:00:00", "05/05/2024", "05/06/2031", " 4 ", "x", "Calle 4"),
    (2, "06/05/2023 10:00:00", "06/05/2025", None, "1e1", "y", "Calle 5"),
]


def test_build_raw(spark):
    df = raw_export(spark, ROWS)
    out = K.build_cleaned(df, "raw", 2030)
    assert out.columns == C.CLEANED_NAMES
    rows = out.orderBy("birth_date").collect()
    by_year = {r["analysis_year"] for r in rows}
    # file 1: 2025 twice, 2024 once -> 2025; file 2: 2024 and 2023 tie -> smallest (2023)
    assert by_year == {2025, 2023}
    got = {(r["analysis_year"], r["birth_date"], r["age"]) for r in rows}
    assert (2025, dt.datetime(2007, 12, 31), 18.0) in got
    assert (2025, dt.datetime(2008, 1, 1), 17.0) in got
    assert (2023, dt.datetime(2031, 6, 5), None) in got
    texts = {r["gender_identity"] for r in rows}
    assert texts == {"a b", "Sin dato", "x", "y"}
    sems = sorted((r["semester"] for r in rows), key=lambda v: (v is None, v))
    assert sems == [3.0, 4.0, 10.0, None, None]


def test_identifiers_never_reach_output(spark):
    df = raw_export(spark, ROWS)
    out = K.build_cleaned(df, "raw", 2025)
    values = {v for r in out.collect() for v in r.asDict().values()}
    assert not any(isinstance(v, str) and v.startswith("Calle") for v in values)


def test_optional_columns_filled(spark):
    optional_raw = [raw for raw, clean in C.RAW_TO_CLEANED.items() if clean in C.OPTIONAL_CLEANED]
    df = raw_export(spark, ROWS, drop=optional_raw)
    out = K.build_cleaned(df, "raw", 2025).collect()
    assert all(r["birth_date"] is None and r["age"] is None for r in out)
    assert all(r["religion"] == C.FILL_VALUE and r["employment_detail"] == C.FILL_VALUE for r in out)


def test_missing_mandatory_column_is_an_error(spark):
    df = raw_export(spark, ROWS, drop=["Estamento"])
    with pytest.raises(FormValidationError):
        K.build_cleaned(df, "raw", 2025)


def test_unknown_kind_is_an_error(spark):
    with pytest.raises(FormValidationError):
        K.build_cleaned(raw_export(spark, ROWS), "desconocido", 2025)


def test_year_filter_counts_add_up(spark):
    df = raw_export(spark, ROWS)
    counts = K.year_filter_counts(df, 2025).first()
    assert counts["total"] == counts["null_or_invalid"] + counts["other_year"] + counts["kept"]
    assert (counts["total"], counts["null_or_invalid"], counts["kept"]) == (5, 1, 3)
    obs = Observation("year")
    kept = K.filter_year(df, 2025, observation=obs).count()
    assert kept == 3 and obs.get["kept"] == 3 and obs.get["other_year"] == 1


def test_year_filter_typed_column_is_a_range(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1),), (dt.datetime(2024, 12, 31, 23, 59),), (None,)], f"`{C.FILLED_LABEL}` timestamp_ntz"
    )
    kept = K.filter_year(df, 2025)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert ">= 2025-01-01" in plan and "< 2026-01-01" in plan
    assert kept.count() == 1


def test_year_filter_text_parses_once(spark):
    kept = K.filter_year(raw_export(spark, ROWS), 2025)
    assert kept.count() == 3
    assert dict(kept.dtypes)[C.FILLED_LABEL] == "timestamp_ntz"


def test_build_from_cleaned_input(spark):
    labels = [c for c in C.CLEANED_COLUMNS if c not in C.OPTIONAL_CLEANED]
    row = []
    for c in labels:
        row.append({C.YEAR_LABEL: "2024", C.AGE_LABEL: "21", C.SEMESTER_LABEL: "Sin dato"}.get(c, " v  w "))
    df = spark.createDataFrame([tuple(row)], ", ".join(f"c{i} string" for i in range(len(labels)))).toDF(*labels)
    out = K.build_cleaned(df, "cleaned", 2025).first()
    assert out["analysis_year"] == 2024 and out["age"] == 21.0 and out["semester"] is None
    assert out["stratum"] == "v w" and out["religion"] == C.FILL_VALUE and out["birth_date"] is None


def test_single_file_year_uses_scalar_mode(spark):
    df = raw_export(spark, ROWS).drop("file_id")
    years = {r["analysis_year"] for r in K.build_cleaned(df, "raw", 2030, file_col=None).collect()}
    # 2025 and 2024 appear twice each: the tie goes to the smallest year
    assert years == {2024}


def test_with_labels_roundtrip(spark):
    out = K.with_labels(K.build_cleaned(raw_export(spark, ROWS), "raw", 2025))
    assert out.columns == C.CLEANED_COLUMNS


def test_empty_result_is_an_error_with_the_counts(spark):
    rows = raw_export(spark, ROWS)
    with pytest.raises(FormValidationError, match="total 5, null_or_invalid 1, other_year 4, kept 0"):
        K.raise_if_empty(K.filter_year(rows, 1990), rows, 1990)
    K.raise_if_empty(K.filter_year(rows, 2025), rows, 2025)


def test_bad_year_values_are_null(spark):
    labels = [c for c in C.CLEANED_COLUMNS if c not in C.OPTIONAL_CLEANED]
    rows = [tuple(v if c == C.YEAR_LABEL else "x" for c in labels) for v in ("99999999999", "2024", "?", None)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(labels)))).toDF(*labels)
    assert sorted(str(r["analysis_year"]) for r in K.build_cleaned(df, "cleaned", 2025).collect()) == ["2024", "None", "None", "None"]


def test_year_warnings(spark):
    from formlens.operators.metrics import year_warnings

    got = {(r["file_id"], r["analysis_year"]) for r in year_warnings(raw_export(spark, ROWS), 2025).collect()}
    assert got == {(2, 2023)}


def test_normalise_ints_option(spark):
    rows = [(1, "01/03/2025 10:00:00", "01/03/2025", "31/12/2007", "3", "3.0", "Calle 1")]
    df = raw_export(spark, rows)
    plain = K.build_cleaned(df, "raw", 2025).first()
    ints = K.build_cleaned(df, "raw", 2025, normalise_ints=True).first()
    assert plain["stratum"] == "3.0" and ints["stratum"] == "3"
