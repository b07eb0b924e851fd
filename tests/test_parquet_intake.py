"""Parquet exports of several layouts and types."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from formlens import config as C
from formlens.functions import col_of
from formlens.operators.common import FormValidationError
from formlens.plans.parquet_intake import read_layouts, run_parquet_intake

DAY = dt.datetime(2025, 2, 1, 10, 0)


def frame(spark, n=2, **values):
    """A raw export of ``n`` rows; values by header, text unless given otherwise."""
    dated = {C.FILLED_LABEL: "01/02/2025", C.SUBMITTED_LABEL: "01/02/2025 10:00:00", C.BIRTH_LABEL: "03/04/2001"}
    full = {h: values.get(h, dated.get(h, "v")) for h in C.RAW_COLUMNS}
    return spark.range(n).select(*[F.lit(v).alias(h) for h, v in full.items()])


def test_layouts_of_differing_types_are_stacked(spark, tmp_path):
    text = frame(spark, 3)
    typed = frame(spark, 2, **{C.FILLED_LABEL: DAY, C.SUBMITTED_LABEL: DAY, C.BIRTH_LABEL: dt.date(2001, 4, 3), C.SEMESTER_LABEL: 4})
    late = frame(spark, 4, **{C.FILLED_LABEL: dt.datetime(2024, 2, 1)})
    text.coalesce(1).write.parquet(str(tmp_path / "a 1"))
    text.coalesce(1).write.parquet(str(tmp_path / "a[2]"))
    typed.withColumnsRenamed({h: h.upper() for h in C.RAW_COLUMNS}).write.parquet(str(tmp_path / "b"))
    late.select(*map(col_of, reversed(late.columns))).write.parquet(str(tmp_path / "c"))
    layouts = read_layouts(spark, str(tmp_path / "*"))
    assert len(layouts) == 3 and len(layouts[0].files) == 2
    res = run_parquet_intake(spark, str(tmp_path / "*"), 2025)
    rows = res.cleaned.collect()
    assert res.cleaned.columns == C.CLEANED_NAMES and len(rows) == 8
    assert {(r["analysis_year"], r["birth_date"], r["age"]) for r in rows} == {(2025, dt.datetime(2001, 4, 3), 24.0)}
    assert sorted({r["semester"] for r in rows}, key=str) == [4.0, None]
    assert res.year_counts.first().asDict() == {"total": 12, "null_or_invalid": 0, "other_year": 4, "kept": 8}
    summary = dict((r["indicator"], r["value"]) for r in res.summary.collect())
    assert summary["Filas en base raw filtrada"] == 8 and summary["Registros con edad calculada o válida"] == 8
    assert sorted((r["kind"], r["n_files"]) for r in res.layouts.collect())[0] == ("raw", 2)
    with pytest.raises(FormValidationError, match="no rows left.*total 12"):
        run_parquet_intake(spark, str(tmp_path / "*"), 1990)


def test_year_filter_reaches_the_scan_of_typed_layouts(spark, tmp_path):
    frame(spark, 2, **{C.FILLED_LABEL: DAY}).write.parquet(str(tmp_path / "a"))
    plan = run_parquet_intake(spark, str(tmp_path / "*"), 2025).cleaned._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(`Fecha de diligenciamiento`)" in plan or "GreaterThanOrEqual" in plan.split("PushedFilters:")[1].split("\n")[0]
    assert "correo" not in plan.split("ReadSchema")[1].split("\n")[0]  # identifiers are not read


def test_odd_files_are_named_or_set_aside(spark, tmp_path):
    good, bad, short = str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "short")
    frame(spark).coalesce(1).write.parquet(good)
    spark.range(3).coalesce(1).write.parquet(bad)
    frame(spark).drop("Estamento").coalesce(1).write.parquet(short)
    with pytest.raises(FormValidationError, match="2 exports can't be read.*unknown_kind"):
        run_parquet_intake(spark, str(tmp_path / "*"), 2025)
    with pytest.raises(FormValidationError, match="Estamento"):
        run_parquet_intake(spark, [good, short], 2025)
    res = run_parquet_intake(spark, str(tmp_path / "*"), 2025, set_aside=True)
    assert res.cleaned.count() == 2
    assert sorted((r["finding"], r["header"]) for r in res.rejected.collect()) == [("missing_mandatory", "Estamento"), ("unknown_kind", None)]
    with pytest.raises(FormValidationError, match="no export files"):
        run_parquet_intake(spark, good, 2025, glob="*.none")
