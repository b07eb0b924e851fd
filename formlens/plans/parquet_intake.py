"""Parquet exports whose columns and types drift from delivery to delivery (O1, O3).

A Parquet file says in its footer which columns it has, and of which types.
Files with the same footer schema are one layout: one typed relation, so the
year filter of a layout with stored dates reaches its scan, and only columns
that the build uses are read.  Kind, rename plan and findings are made once
for each layout.  The cleaned tables of the layouts have the same columns and
are stacked by name.

Footers are read file by file (schemas only, ``FOOTER_THREADS`` at once); the
plan grows with the number of layouts, not of files.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from formlens import config as C
from formlens.operators import headers as H
from formlens.operators import metrics as M
from formlens.operators.common import FormValidationError, reused
from formlens.plans.delivery import list_files, literal_path
from formlens.plans.intake import FrameResult, clean_dataframe

FOOTER_THREADS = 16
SOURCE = "source_file"


@dataclass
class Layout:
    schema: StructType
    files: list[str]


@dataclass
class ParquetIntake:
    cleaned: DataFrame      # 35 columns (+ keep columns), internal names
    summary: DataFrame      # quality indicators (ord, indicator, value)
    layouts: DataFrame      # (layout, kind, n_files, columns); kind null where set aside
    findings: DataFrame     # (layout, kind, severity, finding, ord, header)
    year_counts: DataFrame  # raw rows: total, null_or_invalid, other_year, kept
    rejected: DataFrame     # files set aside: (file_id, finding, header)


def read_layouts(spark: SparkSession, paths: list[str] | str, glob: str = "*.parquet") -> list[Layout]:
    """The layouts of the Parquet files under ``paths``, by their first file's name."""
    files = [literal_path(r["path"]) for r in list_files(spark, paths, glob).select("path").orderBy("path").collect()]
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        schemas = list(pool.map(lambda f: spark.read.parquet(f).schema, files))
    by_schema: dict[str, Layout] = {}
    for file, schema in zip(files, schemas):
        by_schema.setdefault(schema.json(), Layout(schema, [])).files.append(file)
    return list(by_schema.values())


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def run_parquet_intake(spark: SparkSession, paths: list[str] | str, year: int, fill: str = C.FILL_VALUE, filter_by_year: bool = True,
                       strict: bool = True, set_aside: bool = False, keep: list[str] | None = None, file_col: str = "file_id",
                       normalise_ints: bool = False, glob: str = "*.parquet") -> ParquetIntake:
    """The flow of ``run_intake`` on Parquet exports.

    Analysis years group by ``file_col`` in layouts that have it, else by file.
    ``strict`` raises if a layout lacks a required column, and if the year
    filter leaves no row of the raw exports; files of unknown kind are an error
    also without it, as are raw ones that lack a mapped column.  With ``set_aside`` such files are listed in ``rejected``
    instead.
    """
    layouts = read_layouts(spark, paths, glob)
    if not layouts:
        raise FormValidationError("no export files to read")
    carried = {*(keep or []), file_col, SOURCE}
    names = [[h for h in x.schema.names if h not in carried] for x in layouts]
    headers = spark.createDataFrame([(n, i, h) for n, own in enumerate(names) for i, h in enumerate(own, start=1)], "file_id int, pos int, header string")
    files = reused(H.by_file(headers), "layouts")
    findings = reused(H.schema_findings(H.harmonised_headers(H.header_plan(files))).withColumnRenamed("file_id", "layout"), "findings")
    unknown = {n for n in range(len(layouts))} - {r[0] for r in files.where("kind <> 'unknown'").select("file_id").collect()}
    # at most the required columns of each layout
    errors = [tuple(r) for r in findings.where("severity = 'error'").select("layout", "finding", "header").orderBy("layout", "finding", "ord").collect()]
    rejected = [(f, "unknown_kind", None) for n in sorted(unknown) for f in layouts[n].files]
    rejected += [(f, finding, header) for n, finding, header in errors for f in layouts[n].files]
    if rejected and not set_aside and (unknown or strict):
        some = ", ".join(f"{f}: {finding}" + (f": {header}" if header else "") for f, finding, header in rejected[:20])
        raise FormValidationError(f"{len({f for f, *_ in rejected})} exports can't be read: {some}")
    results: list[tuple[int, Layout, FrameResult]] = []
    for n, layout in enumerate(layouts):
        if n in unknown or set_aside and any(e[0] == n for e in errors):
            continue
        rows = spark.read.schema(layout.schema).parquet(*layout.files).withColumn(SOURCE, F.col("_metadata.file_path"))
        group = file_col if file_col in layout.schema.names else SOURCE
        results.append((n, layout, clean_dataframe(
            rows, year, fill, filter_by_year=filter_by_year, strict=False, keep=list(dict.fromkeys([*(keep or []), SOURCE])), file_col=group, normalise_ints=normalise_ints)))
    described = [(n, res.kind, len(x.files), x.schema.names) for n, x, res in results]
    known = {n for n, *_ in described}
    described += [(n, None, len(x.files), x.schema.names) for n, x in enumerate(layouts) if n not in known]
    turned_away = spark.createDataFrame(rejected, "file_id string, finding string, header string")
    if not results:
        raise FormValidationError(f"none of {len(layouts)} layouts can be read: {rejected[:5]}")
    rows = _stacked([res.cleaned.withColumn("layout", F.lit(n)) for n, _, res in results])
    own = spark.createDataFrame([(n, res.kind, names[n]) for n, _, res in results], "layout int, kind string, columns array<string>")
    counted = rows.groupBy("layout").agg(F.count(F.lit(1)).alias("kept"), F.count("birth_date").alias("births"), F.count("age").alias("ages"))
    counts = own.join(counted, "layout", "left").na.fill(0)
    years = [res.year_counts for _, _, res in results if res.kind == "raw" and res.year_counts is not None]
    empty = spark.createDataFrame([], "total long, null_or_invalid long, other_year long, kept long")
    year_counts = _stacked([empty, *years]).agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in empty.columns])
    if strict and filter_by_year and not set_aside and years:
        found = year_counts.first().asDict()
        if not found["kept"]:
            raise FormValidationError(f"no rows left after filtering the fill-in date by year {year}: " + ", ".join(f"{k} {v}" for k, v in found.items()))
    return ParquetIntake(
        cleaned=rows.drop("layout", *([] if SOURCE in (keep or []) else [SOURCE])), summary=M.mixed_summary(counts, len(C.CLEANED_NAMES)),
        layouts=spark.createDataFrame(described, "layout int, kind string, n_files int, columns array<string>"),
        findings=findings, year_counts=year_counts, rejected=turned_away)


__all__ = ["Layout", "ParquetIntake", "read_layouts", "run_parquet_intake"]
