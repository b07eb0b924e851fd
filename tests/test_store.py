"""The store of exports: replacement by export, publication, dead letters, ledger, reports."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from formlens import config as C
from formlens.operators.common import FormValidationError
from formlens.plans.delivery import list_files, literal_path, sync_exports
from formlens.plans.intake import run_intake
from formlens.sources import store as S
from formlens.streaming import read_intake, start_intake


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def raw_row(year=2025, **values):
    dated = {C.FILLED_LABEL: f"01/02/{year}", C.SUBMITTED_LABEL: f"01/02/{year} 10:00:00", C.BIRTH_LABEL: "03/04/2001"}
    return [values.get(h, dated.get(h, "v")) for h in C.RAW_COLUMNS]


def delivered(spark, store, export, rows):
    """One commit of ``rows``: (estate, year)."""
    data = spark.createDataFrame([(export, *r) for r in rows] or [], "name string, estate string, analysis_year int")
    full = data.select("name", *[F.col(n) if n in data.columns else F.lit(None).cast(t).alias(n) for n, t in COLUMNS])
    files = spark.createDataFrame([(export, None, None)], "export string, length long, modified timestamp")
    return S.commit(spark, store, full, files, export="name")


COLUMNS = [(n, {"analysis_year": "int", "birth_date": "timestamp_ntz", "age": "double", "semester": "double"}.get(n, "string")) for n in C.CLEANED_NAMES]


def content(spark, store, version=None):
    return sorted((r["export"], r["estate"], r["analysis_year"]) for r in S.read_store(spark, store, version).collect())


def test_an_export_replaces_only_itself(spark, tmp_path):
    store = str(tmp_path / "store")
    assert content(spark, store) == []
    delivered(spark, store, "north", [("a", 2024), ("b", 2025)])
    delivered(spark, store, "south", [("c", 2025)])
    assert content(spark, store) == [("north", "a", 2024), ("north", "b", 2025), ("south", "c", 2025)]
    # again, without the rows of 2024 and with a null year
    assert delivered(spark, store, "north", [("d", 2025), ("e", None)]) == 3
    assert sorted(map(str, content(spark, store))) == sorted(map(str, [("north", "d", 2025), ("north", "e", None), ("south", "c", 2025)]))
    assert content(spark, store, 1) == [("north", "a", 2024), ("north", "b", 2025)]  # an earlier state is still there
    delivered(spark, store, "south", [])
    assert [r["estate"] for r in S.read_store(spark, store).orderBy("estate").collect()] == ["d", "e"]
    assert len(S.superseded(spark, store)) == 2


def test_a_year_filter_prunes_folders(spark, tmp_path):
    store = str(tmp_path / "store")
    delivered(spark, store, "north", [("a", 2024), ("b", 2025)])
    plan = S.read_store(spark, store).where("analysis_year = 2025")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(analysis_year" in plan


def test_a_crash_before_publication_changes_nothing(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    delivered(spark, store, "north", [("a", 2025)])

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(S, "_publish", crash)
        with pytest.raises(RuntimeError, match="lost"):
            delivered(spark, store, "north", [("b", 2025)])
    assert content(spark, store) == [("north", "a", 2025)]
    assert len(S.superseded(spark, store)) == 1
    delivered(spark, store, "north", [("b", 2025)])
    assert content(spark, store) == [("north", "b", 2025)]


def test_of_two_commits_at_once_none_is_lost(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    delivered(spark, store, "north", [("a", 2025)])
    publish, first = S._publish, []

    def later(*args):
        if not first:
            first.append(1)
            delivered(spark, store, "south", [("b", 2025)])  # another writer comes first
        return publish(*args)

    monkeypatch.setattr(S, "_publish", later)
    assert delivered(spark, store, "east", [("c", 2025)]) == 3
    assert content(spark, store) == [("east", "c", 2025), ("north", "a", 2025), ("south", "b", 2025)]


def test_sync_reads_only_what_changed(spark, tmp_path):
    src, store = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    write_csv(src / "a 1%.csv", C.RAW_COLUMNS, [raw_row(Estamento="a")] * 3)
    write_csv(src / "b[x]{y}.csv", C.RAW_COLUMNS, [raw_row(Estamento="b")] * 2)
    first = sync_exports(spark, str(src), store, 2025)
    assert (first.listed, first.read, first.rejected, first.versions) == (2, 2, 0, [1])
    # other contents, same length and time of change: proof that the file is not looked at again
    state = os.stat(src / "a 1%.csv")
    write_csv(src / "a 1%.csv", C.RAW_COLUMNS, [raw_row(Estamento="z")] * 3)
    os.utime(src / "a 1%.csv", ns=(state.st_atime_ns, state.st_mtime_ns))
    again = sync_exports(spark, str(src), store, 2025)
    assert (again.read, again.versions) == (0, [])
    write_csv(src / "b[x]{y}.csv", C.RAW_COLUMNS, [raw_row(Estamento="c")])
    write_csv(src / "d.csv", C.RAW_COLUMNS, [raw_row(2024, Estamento="d")])  # no row of the year
    third = sync_exports(spark, str(src), store, 2025, files_per_commit=1)
    assert (third.read, third.versions) == (2, [2, 3])
    assert sorted((r["estate"], r["n"]) for r in S.read_store(spark, store).groupBy("estate").agg(F.count("*").alias("n")).collect()) == [("a", 3), ("c", 1)]
    assert sync_exports(spark, str(src), store, 2025).read == 0


def test_broken_files_become_dead_letters(spark, tmp_path):
    src, store = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    write_csv(src / "good.csv", C.RAW_COLUMNS, [raw_row()] * 2)
    short = [h for h in C.RAW_COLUMNS if h not in ("Estamento", "Estado civil")]
    write_csv(src / "short.csv", short, [["01/02/2025"] * len(short)])
    write_csv(src / "other.csv", ["x", "y"], [["1", "2"]])
    (src / "empty.csv").write_text("\n\n")
    done = sync_exports(spark, str(src), store, 2025)
    assert (done.read, done.rejected) == (4, 3)
    letters = sorted((os.path.basename(r["export"]), r["finding"], r["header"] or "") for r in S.read_rejected(spark, store).collect())
    assert letters == [("empty.csv", "no_header_record", ""), ("other.csv", "unknown_kind", ""),
                       ("short.csv", "missing_mandatory", "Estado civil"), ("short.csv", "missing_mandatory", "Estamento")]
    assert S.read_store(spark, store).count() == 2
    assert sync_exports(spark, str(src), store, 2025).read == 0  # a dead letter is not read again
    # a sound delivery takes its place; a broken one leaves the earlier rows
    write_csv(src / "short.csv", C.RAW_COLUMNS, [raw_row()] * 5)
    write_csv(src / "good.csv", ["x"], [["1"]])
    assert sync_exports(spark, str(src), store, 2025).rejected == 1
    assert S.read_store(spark, store).count() == 7
    assert {os.path.basename(r["export"]) for r in S.read_rejected(spark, store).collect()} == {"good.csv", "other.csv", "empty.csv"}


def test_only_broken_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "empty.csv").write_text("\n")
    res = run_intake(spark, str(tmp_path / "in"), 2025, set_aside=True)
    assert res.cleaned.count() == 0 and [r["finding"] for r in res.rejected.collect()] == ["no_header_record"]
    assert res.year_counts.first().asDict() == {"total": 0, "null_or_invalid": 0, "other_year": 0, "kept": 0}


def test_stream_sets_broken_files_aside_and_keeps_reports(spark, tmp_path):
    src, store = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    for i, year in enumerate((2024, 2025, 2025)):
        write_csv(src / f"f{i}.csv", C.RAW_COLUMNS, [raw_row(year, Estamento=f"e{i}", Sede="s")] * (i + 1))
    write_csv(src / "broken.csv", ["x"], [["1"]])
    args = (spark, str(src), store, str(tmp_path / "ckpt"), 2025)
    start_intake(*args, filter_by_year=False, on_bad="set_aside", max_files_per_trigger=2).awaitTermination()
    assert max(S._versions(spark, store)) == 2 and read_intake(spark, store).count() == 6
    assert [os.path.basename(r["export"]) for r in S.read_rejected(spark, store).collect()] == ["broken.csv"]
    os.remove(src / "broken.csv")
    whole = run_intake(spark, str(src), 2025, filter_by_year=False)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, S.store_report(spark, store).collect())) == sorted(map(key, whole.report.collect()))
    assert sorted(map(key, S.store_summary(spark, store).collect())) == sorted(map(key, whole.summary.collect()))
    # a batch that is run again (its checkpoint lost) leaves the same store
    start_intake(spark, str(src), store, str(tmp_path / "ckpt2"), 2025, filter_by_year=False).awaitTermination()
    assert read_intake(spark, store).count() == 6
    with pytest.raises(ValueError, match="on_bad"):
        start_intake(*args, on_bad="ignore")


def test_strict_stream_fails_and_publishes_nothing(spark, tmp_path):
    src, store = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    write_csv(src / "good.csv", C.RAW_COLUMNS, [raw_row()])
    write_csv(src / "broken.csv", ["x"], [["1"]])
    with pytest.raises(Exception, match="exports of unknown kind"):
        start_intake(spark, str(src), store, str(tmp_path / "ckpt"), 2025).awaitTermination()
    assert S.read_manifest(spark, store).count() == 0


def test_intake_reads_the_exports_once(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", C.RAW_COLUMNS, [raw_row(), raw_row(2024), raw_row(**{C.FILLED_LABEL: "??"}), raw_row(**{C.BIRTH_LABEL: "31/02/2001"})])
    res = run_intake(spark, str(tmp_path), 2025)
    results = [res.cleaned, res.summary, res.year_counts, res.date_losses, res.report, res.by_export]
    for df in results:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "csv" not in plan.lower().replace(".csv", "") and "Scan parquet" in plan
    os.remove(tmp_path / "raw.csv")  # all results come from the stored rows
    assert [len(df.collect()) for df in results[:4]] == [2, 6, 1, 2]
    assert res.year_counts.first().asDict() == {"total": 4, "null_or_invalid": 1, "other_year": 1, "kept": 2}
    assert {r["date_column"]: (r["non_null"], r["parsed"], r["lost"]) for r in res.date_losses.collect()} == {C.FILLED_LABEL: (2, 2, 0), C.BIRTH_LABEL: (2, 1, 1)}


def test_strict_errors_as_before(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", C.RAW_COLUMNS, [raw_row()])
    with pytest.raises(FormValidationError, match="no rows left.*total 1, null_or_invalid 0, other_year 1, kept 0"):
        run_intake(spark, str(tmp_path), 1990)
    assert run_intake(spark, str(tmp_path), 1990, strict=False).cleaned.count() == 0


def test_listing_and_literal_paths(spark, tmp_path):
    (tmp_path / "a{b}.csv").write_text("x")
    (tmp_path / "c.txt").write_text("x")
    rows = list_files(spark, str(tmp_path)).collect()
    assert [(os.path.basename(r["path"]), r["length"]) for r in rows] == [("a{b}.csv", 1)]
    assert spark.read.text(literal_path(rows[0]["path"])).count() == 1
