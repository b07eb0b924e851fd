"""End-to-end intake: detect, harmonise, validate, filter, build, report.

``run_intake`` is the whole flow over a folder (or list) of CSV exports, raw
or cleaned, of any header layout, in one scan.  Structure is checked per
file before any row is read.  The rows are then read once and stored; what
it returns are lazy DataFrames over the stored rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlens import config as C
from formlens.functions import col_of, parse_day_first
from formlens.operators import clean as K
from formlens.operators import headers as H
from formlens.operators import metrics as M
from formlens.operators import report as R
from formlens.operators.common import FormValidationError, reused
from formlens.sources.scan import raise_missing, scan_exports


@dataclass
class IntakeResult:
    cleaned: DataFrame      # 35 columns (+ keep columns), internal names
    summary: DataFrame      # quality indicators (ord, indicator, value)
    findings: DataFrame     # validation findings on the harmonised headers
    plan: DataFrame         # rename plan per export file
    changes: DataFrame      # headers that were renamed (file_id, pos, old, new)
    unmatched: DataFrame    # headers without a target (file_id, pos, header)
    year_counts: DataFrame  # raw rows: total, null_or_invalid, other_year, kept
    date_losses: DataFrame  # per date column: non_null, parsed, lost
    make_report: Callable[[], DataFrame] = field(repr=False, default=None)
    by_export: DataFrame = None      # cleaned rows with ``source_file`` and ``kind`` (files only)
    export_counts: DataFrame = None  # additive counts of each file (``metrics.export_counts``; files only)
    rejected: DataFrame = None       # files set aside (file_id, finding, header)

    @cached_property
    def report(self) -> DataFrame:
        """Report suite (long table), built on first use: it runs its own pass."""
        return self.make_report()


def check_findings(findings: DataFrame) -> None:
    """Raise if any file lacks a required column; names files and columns."""
    raise_missing(findings)


def date_losses(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(date_column, non_null, parsed, lost)`` of each column, in one pass."""
    parts = F.array(*[F.struct(F.lit(c).alias("date_column"), col_of(c).alias("v"), parse_day_first(col_of(c)).alias("d")) for c in columns])
    return df.select(F.inline(parts)).groupBy("date_column").agg(
        F.count("v").alias("non_null"), F.count("d").alias("parsed"), F.count_if(F.col("v").isNotNull() & F.col("d").isNull()).alias("lost"))


def run_intake(spark: SparkSession, paths: list[str] | str, year: int, fill: str = C.FILL_VALUE,
               mode: str = "safe", filter_by_year: bool = True, strict: bool = True,
               keep: list[str] | None = None, report_keys: list[str] | None = None,
               file_col: str = "file_id", normalise_ints: bool = False,
               options: dict[str, str] | None = None, multi_line: bool | str = True, set_aside: bool = False) -> IntakeResult:
    """Run the whole flow on CSV exports.

    Raw exports are filtered to fill-in dates in ``year`` (when
    ``filter_by_year``) and projected through the mapping; cleaned exports
    are read by their labels.  ``strict`` (default) raises before any row is
    read if a file lacks a required column, and if the filter leaves no row
    of the raw exports.  With ``set_aside``, files without a header record,
    of unknown kind or without a required column are left out instead and
    listed in ``rejected``.  Per-export analysis years group by ``file_col``
    when the exports carry such a column, else by source file.

    The exports are read once: their typed rows are stored as Parquet in the
    shared folder (``clean.stage_mixed``), and rows, counts, losses, summary
    and report all come from there.
    """
    on_bad = "set_aside" if set_aside else "raise" if strict else "raise_kind"
    ex = scan_exports(spark, paths, mode, options, keep=list(dict.fromkeys([*(keep or []), file_col])), multi_line=multi_line, on_bad=on_bad)
    group = file_col if file_col in ex.keep else "source_file"
    keep = [k for k in (keep or []) if k in ex.keep]
    carried = list(dict.fromkeys([*keep, *([group] if group != "source_file" else [])]))
    staged = reused(K.stage_mixed(ex.rows, year, filter_by_year, fill, carried, normalise_ints), "staged", spark)
    dated = K.date_mixed(staged, year, group)
    names = H.harmonised_headers(ex.plan).join(ex.files.select("file_id", "kind"), "file_id").where(~F.col("header").isin(list({*keep, file_col})))
    counts = reused(M.export_counts(dated, names, year), "export-counts")
    year_counts = M.filter_counts(counts)
    if strict and filter_by_year and not set_aside and not ex.files.where("kind = 'raw'").isEmpty():
        found = year_counts.first().asDict()
        if not found["kept"]:
            raise FormValidationError(f"no rows left after filtering the fill-in date by year {year}: " + ", ".join(f"{k} {v}" for k, v in found.items()))
    kept = dated.where("kept")
    cleaned = K.final_projection(kept, keep)
    summary = M.mixed_summary(counts, len(C.CLEANED_NAMES))

    # the report has the quality counts of its own pass over the rows
    def make_report() -> DataFrame:
        return R.report_suite(cleaned, summary, keys=report_keys, fill=fill)

    return IntakeResult(
        cleaned=cleaned, summary=summary, findings=ex.findings, plan=ex.plan, changes=H.change_log(ex.plan), unmatched=H.unmatched_headers(ex.plan),
        year_counts=year_counts, date_losses=M.loss_counts(counts), make_report=make_report,
        by_export=K.final_projection(kept, ["source_file", "kind", *keep]), export_counts=counts, rejected=ex.rejected)


@dataclass
class FrameResult(IntakeResult):
    kind: str = "raw"       # detected kind: raw or cleaned


def clean_dataframe(df: DataFrame, year: int, fill: str = C.FILL_VALUE, mode: str = "safe",
                    filter_by_year: bool = True, strict: bool = True, keep: list[str] | None = None,
                    file_col: str | None = "file_id", report_keys: list[str] | None = None,
                    normalise_ints: bool = False) -> FrameResult:
    """The documented flow on one DataFrame (of any source): detect, harmonise, validate, build.

    The frame's column list becomes a one-file header table (metadata only);
    kind detection and the rename plan run on it, the columns are renamed
    one-to-one, findings are checked, and the rows go through the year filter
    (raw) and the cleaned-table build.  Columns in ``keep`` (and
    ``file_col``) are carried through untouched.
    """
    if mode != "safe":
        raise ValueError("rows are only renamed with the safe harmonisation mode; greedy is for plan comparison")
    spark = df.sparkSession
    carried = [c for c in dict.fromkeys([*(keep or []), *([file_col] if file_col else [])]) if c in df.columns]
    data_cols = [c for c in df.columns if c not in carried]
    headers = spark.createDataFrame([(0, i, h) for i, h in enumerate(data_cols, start=1)],
                                    "file_id int, pos int, header string")
    files = H.by_file(headers)
    kind = files.first()["kind"]
    if kind == "unknown":
        raise FormValidationError("the frame is neither a raw nor a cleaned export")
    planned = sorted(H.header_plan(files, mode).collect(), key=lambda r: r["pos"])  # one row per column of this frame
    plan = spark.createDataFrame(planned, "file_id int, pos int, header string, canonical string, layer string, status string")
    # known columns under their canonical names; every other one stays behind
    taken = [(r["header"], r["canonical"]) for r in planned if r["canonical"] is not None]
    renamed = df.select(*[F.col(c) for c in carried], *[col_of(old).alias(new) for old, new in taken])
    findings = H.schema_findings(H.harmonised_headers(plan))
    if strict:
        check_findings(findings)
    source = K.filter_year(renamed, year) if kind == "raw" and filter_by_year else renamed
    if strict and kind == "raw" and filter_by_year:
        K.raise_if_empty(source, renamed, year)
    group = file_col if file_col in source.columns else None
    cleaned = K.build_cleaned(source, kind, year, fill, file_col=group, keep=[k for k in (keep or []) if k in carried],
                              normalise_ints=normalise_ints)
    summary = M.quality_summary(len(data_cols), cleaned, kind, len(C.CLEANED_NAMES))

    def make_report() -> DataFrame:
        return R.report_suite(cleaned, summary, keys=report_keys, fill=fill)

    dates = [c for c in (C.FILLED_LABEL, C.BIRTH_LABEL) if c in renamed.columns]
    return FrameResult(
        cleaned=cleaned, summary=summary, findings=findings, plan=plan, changes=H.change_log(plan), unmatched=H.unmatched_headers(plan),
        year_counts=K.year_filter_counts(renamed, year) if C.FILLED_LABEL in renamed.columns else None, date_losses=date_losses(renamed, dates) if dates else None,
        make_report=make_report, kind=kind)
