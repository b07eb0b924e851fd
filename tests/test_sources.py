"""Scans with drifting headers and sinks."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from formlens import config as C
from formlens.sources import for_csv, read_exports, write_cleaned


def write_csv(path, header, rows):
    import csv

    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def test_drifting_headers_are_harmonised(spark):
    base = tempfile.mkdtemp(prefix="formlens-src-")
    hdr = list(C.RAW_COLUMNS)
    row = ["01/02/2025 10:00:00", "a@b.c", "si", "01/02/2025"] + ["v"] * (len(hdr) - 4)
    write_csv(os.path.join(base, "a.csv"), hdr, [row])
    upper = [h.upper() for h in reversed(hdr)]
    write_csv(os.path.join(base, "b.csv"), upper, [list(reversed(row)), list(reversed(row))])
    rows, plan = read_exports(spark, base)
    assert rows.count() == 3
    assert C.SUBMITTED_LABEL in rows.columns and "Estamento" in rows.columns
    per_file = rows.groupBy("source_file").count().collect()
    assert sorted(r["count"] for r in per_file) == [1, 2]
    # identifiers are not renamed into cleaned columns
    assert plan.where(F.col("header").rlike("(?i)direcci")).where(F.col("layer") == "fuzzy").count() == 0


def test_csv_sink_formats_birth_date(spark):
    df = spark.createDataFrame(
        [(2025, dt.datetime(2001, 2, 3)), (2025, None)], "analysis_year int, birth_date timestamp_ntz"
    )
    assert [r[0] for r in for_csv(df).select("birth_date").collect()] == ["03/02/2001", None]
    path = os.path.join(tempfile.mkdtemp(prefix="formlens-sink-"), "out")
    write_cleaned(df, path, fmt="csv", labels=True)
    assert [p for p in os.listdir(path) if "=" in p] == ["year=2025"]


def test_run_intake_mixed_kinds(spark):
    from formlens.plans.intake import run_intake

    base = tempfile.mkdtemp(prefix="formlens-intake-")
    hdr = list(C.RAW_COLUMNS)
    row = ["01/02/2025 10:00:00", "a@b.c", "si", "01/02/2025"] + ["v"] * (len(hdr) - 4)
    write_csv(os.path.join(base, "raw.csv"), hdr, [row, row])
    cl_hdr = [h for h in C.CLEANED_COLUMNS if h != C.BIRTH_LABEL]
    cl_row = ["2024" if h == C.YEAR_LABEL else "20" if h == C.AGE_LABEL else "x" for h in cl_hdr]
    write_csv(os.path.join(base, "cleaned.csv"), cl_hdr, [cl_row])
    res = run_intake(spark, base, 2025)
    got = sorted((r["analysis_year"], r["age"]) for r in res.cleaned.collect())
    assert got == [(2024, 20.0), (2025, None), (2025, None)]
    notices = res.findings.where("severity = 'notice'").collect()
    assert [r["header"] for r in notices] == [C.BIRTH_LABEL]
    assert res.report.where("report = 'resumen_calidad'").count() == 8


def test_clean_dataframe_renames_and_detects(spark):
    from formlens.plans.intake import clean_dataframe

    hdr = [h.upper() for h in C.RAW_COLUMNS]
    row = ["01/02/2025 10:00:00", "a@b.c", "si", "01/02/2025"] + ["  v  w "] * (len(hdr) - 4)
    df = spark.createDataFrame([tuple(row)], ", ".join(f"c{i} string" for i in range(len(hdr)))).toDF(*hdr)
    res = clean_dataframe(df, 2025, file_col=None)
    assert res.kind == "raw"
    out = res.cleaned.first()
    assert out["analysis_year"] == 2025 and out["estate"] == "v w"
    assert res.plan.where("status = 'renamed'").count() > 30


def test_greedy_mode_never_reads_rows(spark):
    import pytest

    from formlens.plans.intake import clean_dataframe

    base = tempfile.mkdtemp(prefix="formlens-greedy-")
    write_csv(os.path.join(base, "a.csv"), C.RAW_COLUMNS, [["x"] * len(C.RAW_COLUMNS)])
    with pytest.raises(ValueError):
        read_exports(spark, base, mode="greedy")
    df = spark.createDataFrame([tuple(["x"] * 3)], "a string, b string, c string")
    with pytest.raises(ValueError):
        clean_dataframe(df, 2025, mode="greedy")


def raw_row(**values):
    return [values.get(h, "01/02/2025" if h == C.FILLED_LABEL else "01/02/2025 10:00:00" if h == C.SUBMITTED_LABEL else "v") for h in C.RAW_COLUMNS]


def test_no_listed_file_is_lost(spark, tmp_path):
    import pytest

    from formlens.operators.common import FormValidationError
    from formlens.plans.intake import run_intake

    folder = tmp_path / "año 2025 %20"
    folder.mkdir()
    hdr = list(C.RAW_COLUMNS)
    broken = ["Estado\ncivil" if h == "Estado civil" else h for h in hdr]
    write_csv(folder / "base 2025.csv", hdr, [raw_row(), raw_row()])
    write_csv(folder / "línea.csv", broken, [raw_row(**{"Estado civil": "con\nsalto, y coma"})])
    (folder / "blank.csv").write_text("\n" + (folder / "base 2025.csv").read_text(encoding="utf-8"), encoding="utf-8")
    (folder / "bom.csv").write_text("\ufeff" + (folder / "base 2025.csv").read_text(encoding="utf-8"), encoding="utf-8")
    res = run_intake(spark, str(folder), 2025)
    assert res.cleaned.count() == 7 and res.plan.select("file_id").distinct().count() == 4
    assert res.cleaned.where("marital_status = 'con salto, y coma'").count() == 1
    assert res.year_counts.first()["kept"] == 7
    (folder / "empty.csv").write_text("\n\n")
    with pytest.raises(FormValidationError, match="1 export files without a header record.*empty.csv"):
        run_intake(spark, str(folder), 2025)


def test_other_separator_and_encoding(spark, tmp_path):
    from formlens.plans.intake import run_intake

    import csv

    with open(tmp_path / "a.csv", "w", newline="", encoding="latin-1") as fh:
        w = csv.writer(fh, delimiter=";")
        w.writerow(C.RAW_COLUMNS)
        w.writerow(raw_row(Estamento="Niñez"))
    res = run_intake(spark, str(tmp_path), 2025, options={"sep": ";", "encoding": "ISO-8859-1"})
    assert res.cleaned.first()["estate"] == "Niñez"


def test_names_equal_but_for_case(spark, tmp_path):
    from formlens.plans.intake import run_intake

    write_csv(tmp_path / "a.csv", [*C.RAW_COLUMNS, "ESTAMENTO"], [[*raw_row(Estamento="first"), "second"]])
    assert run_intake(spark, str(tmp_path), 2025).cleaned.first()["estate"] == "first"


def test_address_does_not_reach_the_cleaned_table(spark, tmp_path):
    import pytest

    from formlens.operators.common import FormValidationError
    from formlens.plans.intake import run_intake

    hdr = ["Dirección de la residencia" if h == "Dirección de residencia" else h for h in C.RAW_COLUMNS if h != "Barrio de residencia"]
    write_csv(tmp_path / "a.csv", hdr, [["Calle 5 # 10-20" if h.startswith("Direcc") else "01/02/2025" for h in hdr]])
    with pytest.raises(FormValidationError, match="Barrio de residencia"):
        run_intake(spark, str(tmp_path), 2025)
    out = run_intake(spark, str(tmp_path), 2025, strict=False).cleaned.first()
    assert out["neighbourhood"] == C.FILL_VALUE and "Calle 5 # 10-20" not in list(out)


def test_structure_is_checked_per_file(spark, tmp_path):
    import pytest

    from formlens.operators.common import FormValidationError
    from formlens.plans.intake import run_intake

    short = [h for h in C.RAW_COLUMNS if h != "Estamento"]
    write_csv(tmp_path / "a.csv", C.RAW_COLUMNS, [raw_row()])
    write_csv(tmp_path / "b.csv", short, [[v for h, v in zip(C.RAW_COLUMNS, raw_row()) if h != "Estamento"]])
    with pytest.raises(FormValidationError, match="1 required columns missing.*b.csv.*Estamento"):
        run_intake(spark, str(tmp_path), 2025)


def test_year_is_filled_per_file_and_summary_counts_each_kind(spark, tmp_path):
    import pytest

    from formlens.operators.common import FormValidationError
    from formlens.plans.intake import run_intake

    write_csv(tmp_path / "raw.csv", C.RAW_COLUMNS, [raw_row()] * 3)
    with_year = {C.YEAR_LABEL: "2023", C.AGE_LABEL: "20"}
    write_csv(tmp_path / "c1.csv", C.CLEANED_COLUMNS, [[with_year.get(h, "x") for h in C.CLEANED_COLUMNS]] * 2)
    less = [h for h in C.CLEANED_COLUMNS if h != C.YEAR_LABEL]
    write_csv(tmp_path / "c2.csv", less, [[with_year.get(h, "x") for h in less]] * 3)
    res = run_intake(spark, str(tmp_path), 2025)
    assert sorted(r["analysis_year"] for r in res.cleaned.collect()) == [2023] * 2 + [2025] * 6
    got = [(r["indicator"], r["value"]) for r in res.summary.orderBy("ord").collect()]
    assert got[:4] == [("Filas en base raw filtrada", 3), ("Columnas en base raw filtrada", 63), ("Filas en base cleaned cargada", 5), ("Columnas en base cleaned cargada", 35)]
    assert dict(got)["Filas en base cleaned final"] == 8
    with pytest.raises(FormValidationError, match="no rows left.*total 3, null_or_invalid 0, other_year 3, kept 0"):
        run_intake(spark, str(tmp_path), 1990)


def test_second_year_keeps_the_first(spark, tmp_path):
    from formlens.sources import read_cleaned

    path = str(tmp_path / "out")
    one = lambda y: spark.createDataFrame([(y, dt.datetime(2001, 2, 3))], "analysis_year int, birth_date timestamp_ntz")
    for year in (2024, 2025, 2025):
        write_cleaned(one(year), path)
    assert sorted(r["analysis_year"] for r in read_cleaned(spark, path).collect()) == [2024, 2025]
    csv_path = str(tmp_path / "csv")
    write_cleaned(one(2024), csv_path, fmt="csv", labels=True)
    files = [os.path.join(d, f) for d, _, fs in os.walk(csv_path) for f in fs if f.endswith(".csv")]
    assert open(files[0], encoding="utf-8").read().split("\n")[:2] == [f"{C.YEAR_LABEL},{C.BIRTH_LABEL}", "2024,03/02/2001"]
