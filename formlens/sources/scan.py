"""Form-export scans with drifting headers (O1-O3).

Exports from different years have different header lists.  A plain
``spark.read.csv(dir, header=True)`` would apply the first file's header to
all of them, so the scan works in two steps:

1. Header discovery, one distributed job with a task for each file: it reads
   the first record (a record, not a line: headers may hold line breaks) and
   stops.  A file without any record is named in an error.
2. One scan over all files, by position.  Each file has a layout (its ordered
   header list); a layout says where each known column stands.  Rows get
   their file's layout by equi-joins with small stored tables (broadcast by
   Spark's own threshold on their size), and pick their cells by it.

Neither paths nor layouts pass through the driver, and the plan does not
grow with the number of files or layouts.  Only known columns (the targets
of harmonisation) and those asked for are read, so identifiers stay behind.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlens import config as C
from formlens.operators import headers as H
from formlens.operators.common import FormValidationError, reused
from formlens.sources.ranges import read_records

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    "sep": ",",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "enforceSchema": "true",
    "encoding": "UTF-8",
}

# Every column that harmonisation can name, in fixed order (both kinds).
KNOWN_COLUMNS = list(dict.fromkeys([*H.TARGETS["raw"], *C.CLEANED_COLUMNS]))

# Larger than any file: no file is split, and no two share a task.
_WHOLE_FILE = str(1 << 50)


def first_record(lines: Iterable[bytes], sep: str, quote: str, encoding: str) -> list[str] | None:
    """The first record that is not blank; ``None`` if there is none."""
    def decoded() -> Iterator[str]:
        for i, line in enumerate(lines):
            text = line.decode(encoding, "replace")
            yield (text.removeprefix("﻿") if i == 0 else text) + "\n"

    for record in csv.reader(decoded(), delimiter=sep, quotechar=quote):
        if any(cell.strip() for cell in record):
            record[-1] = record[-1].rstrip("\r\n")
            return record
    return None


def header_table(spark: SparkSession, paths: list[str] | str, options: dict[str, str] | None = None) -> DataFrame:
    """``(file_id, pos, header)`` for every file under ``paths``, written to the shared folder.

    Separator, quote and encoding are those of the row scan (an encoding whose
    line breaks are those of ASCII).  Empty header cells get the
    spreadsheet-style name ``Unnamed: <index>``.  Files without a record are
    an error.
    """
    headers, lost = discover_headers(spark, paths, options)
    raise_named(lost, "export files without a header record")
    return headers


def discover_headers(spark: SparkSession, paths: list[str] | str, options: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The header table of the files that have a record, and the ``file_id`` of those that have none."""
    opts = CSV_OPTIONS | (options or {})
    sep, quote = opts.get("sep") or opts["delimiter"], opts["quote"]
    encoding = opts["encoding"]
    # a session of its own for the settings that give each file one task
    probe = spark.newSession()
    probe.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILE)
    probe.conf.set("spark.sql.files.openCostInBytes", _WHOLE_FILE)
    probe.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return

        def lines() -> Iterator[bytes]:
            yield from first.column("value").to_pylist()
            for batch in batches:
                yield from batch.column("value").to_pylist()

        record = first_record(lines(), sep, quote, encoding)
        if record is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first.column("file_id")[0].as_py()]), pa.array([record])], names=["file_id", "cells"])

    text = probe.read.text(paths).select(F.col("_metadata.file_path").alias("file_id"), F.col("value").cast("binary").alias("value"))
    cells = text.mapInArrow(head, "file_id string, cells array<string>").select("file_id", F.posexplode("cells").alias("p", "header"))
    found = cells.select(
        "file_id",
        (F.col("p") + 1).cast("int").alias("pos"),
        F.when(F.trim("header") == "", F.concat(F.lit("Unnamed: "), F.col("p").cast("string"))).otherwise(F.col("header")).alias("header"),
    )
    path = reused(found, "headers")
    listed = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file_id"))
    return path, listed.join(path.select("file_id").distinct(), "file_id", "left_anti")


def raise_named(bad: DataFrame, what: str, show: int = 20) -> None:
    """Raise if ``bad`` (first column: what to name) has rows; states how many."""
    named = [str(r[0]) for r in bad.limit(show).collect()]
    if named:
        total = bad.count()
        more = f" and {total - len(named)} more" if total > len(named) else ""
        raise FormValidationError(f"{total} {what}: {', '.join(named)}{more}")


@dataclass
class Exports:
    rows: DataFrame      # known columns, asked-for columns, ``source_file``, ``kind``, ``has_year``
    files: DataFrame     # one row per file with its headers and kind (``headers.by_file``)
    plan: DataFrame      # rename plan per file (file_id = source_file)
    keep: list[str]      # asked-for columns that some file has
    findings: DataFrame  # of all files that have a known kind (``headers.schema_findings``)
    rejected: DataFrame  # files set aside: (file_id, finding, header), a row for each reason


def _layouts(files: DataFrame, plan: DataFrame, columns: list[str]) -> DataFrame:
    """Per file: its kind and the position of each of ``columns`` (null where it lacks one).

    Winners of the plan stand for their canonical name; another header stands
    for its own name, the first of equal ones, if no winner has it.
    """
    own = plan.select("file_id", "pos", F.coalesce("canonical", "header").alias("name"), F.col("canonical").isNull().alias("other"))
    named = own.where(F.col("name").isin(columns) & (~F.col("other") | ~F.col("name").isin(KNOWN_COLUMNS)))
    places = named.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("name", "other", "pos"))).alias("p"))
    position = F.transform(F.array(*[F.lit(c) for c in columns]), lambda c: F.try_element_at(F.filter("p", lambda x: x["name"] == c), F.lit(1))["pos"])
    kinds = files.select("file_id", "kind")
    return kinds.join(places, "file_id", "left").select("file_id", "kind", F.coalesce(position, F.array().cast("array<int>")).alias("positions"))


def read_exports(spark: SparkSession, paths: list[str] | str, mode: str = "safe", options: dict[str, str] | None = None,
                 keep: list[str] | None = None, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Scan CSV exports with drifting headers into one DataFrame.

    Returns ``(rows, plan)``: ``rows`` has the known columns by their
    canonical names, the columns of ``keep``, ``source_file`` (the plan's
    ``file_id``) and ``kind``; ``plan`` is the rename plan of every file.
    """
    ex = scan_exports(spark, paths, mode, options, keep, multi_line)
    return ex.rows, ex.plan


def scan_exports(spark: SparkSession, paths: list[str] | str, mode: str = "safe", options: dict[str, str] | None = None,
                 keep: list[str] | None = None, multi_line: bool | str = True, on_bad: str = "raise_kind") -> Exports:
    """``read_exports`` with headers, kinds and findings kept for reuse.

    Large files are read by several tasks, also where cells hold line breaks
    (``ranges``); ``multi_line="whole"`` has Spark read each file in one task
    (records that end in a lone CR), and ``multi_line=False`` says that no cell
    holds a line break.  Quotes that are not escaped by doubling are left to
    Spark's readers, too.  ``on_bad`` says what happens to a file without a header
    record, of unknown kind or without a required column: ``raise`` names
    them in an error before any row is read; ``raise_kind`` lets missing
    columns pass; ``set_aside`` leaves them out and lists them in ``rejected``.
    """
    if mode != "safe":
        # greedy matching can rename an identifier column into a cleaned one;
        # it exists to compare plans (operators.headers.header_plan), never to read rows
        raise ValueError("rows are only read with the safe harmonisation mode; use header_plan(..., 'greedy') to compare")
    paths = [paths] if isinstance(paths, str) else list(paths)
    opts = CSV_OPTIONS | {"multiLine": str(bool(multi_line)).lower()} | (options or {})
    headers, lost = discover_headers(spark, paths, options)
    files = reused(H.by_file(headers), "files")
    unknown = files.where(F.col("kind") == "unknown").select("file_id")
    plan = reused(H.header_plan(files, mode), "plan")
    findings = H.schema_findings(H.harmonised_headers(plan))
    reason = lambda df, name: df.select("file_id", F.lit(name).alias("finding"), F.lit(None).cast("string").alias("header"))
    rejected = reason(lost, "no_header_record").limit(0)
    if on_bad == "set_aside":
        missing = findings.where(F.col("severity") == "error").select("file_id", "finding", "header")
        rejected = reused(reason(lost, "no_header_record").unionByName(reason(unknown, "unknown_kind")).unionByName(missing), "rejected")
        good = lambda df: df.join(rejected.select("file_id").distinct(), "file_id", "left_anti")
        files, plan = reused(good(files), "files"), reused(good(plan), "plan")
    else:
        raise_named(lost, "export files without a header record")
        raise_named(unknown.orderBy("file_id"), "exports of unknown kind")
        if on_bad == "raise":
            raise_missing(findings)
    width = headers.agg(F.max("pos")).first()[0]
    if width is None and rejected.isEmpty():
        raise FormValidationError("no export files to read")
    width = width or 1
    keep = [k for k in (keep or []) if k not in KNOWN_COLUMNS]
    # only files that are read count: a column of a rejected one is no column of the rows
    present = {r[0] for r in plan.where(F.col("header").isin(keep)).select("header").distinct().collect()} if keep else set()
    keep = [k for k in keep if k in present]  # at most the names asked for
    columns = [*KNOWN_COLUMNS, *keep]
    # few layouts, many files: rows first get their file's layout, then its positions
    per_file = reused(_layouts(files, plan, columns).withColumn("layout", F.md5(F.to_json(F.struct("kind", "positions")))), "positions")
    # stored tables: their sizes are known when the joins are planned
    layout_of = reused(per_file.select(F.col("file_id").alias("source_file"), "layout"), "layout-of")
    layouts = reused(per_file.groupBy("layout").agg(F.first("kind").alias("kind"), F.first("positions").alias("positions")), "layouts")
    schema = T.StructType([T.StructField(f"_p{i}", T.StringType()) for i in range(width)])
    cells = F.array(*[F.col(f"_p{i}") for i in range(width)]).alias("cells")
    if multi_line is True and opts["quote"] == opts["escape"]:
        records = read_records(spark, paths, opts.get("sep") or opts["delimiter"], opts["quote"], opts["encoding"])
        parsing = {k: v for k, v in opts.items() if k not in ("header", "enforceSchema", "encoding")}
        cells = records.select("source_file", F.from_csv("record", schema.simpleString()[len("struct<"):-1].replace(":", " "), parsing).alias("c")).select("source_file", "c.*").select("source_file", cells)
    else:
        cells = spark.read.options(**opts).schema(schema).csv(paths).select(F.col("_metadata.file_path").alias("source_file"), cells)
    placed = cells.join(layout_of, "source_file").join(layouts, "layout")
    rows = placed.select(
        "source_file", "kind", F.col("positions")[columns.index(C.YEAR_LABEL)].isNotNull().alias("has_year"),
        *[F.get("cells", F.get("positions", F.lit(i)) - 1).alias(c) for i, c in enumerate(columns)],
    )
    return Exports(rows=rows, files=files, plan=plan, keep=keep, findings=findings, rejected=rejected)


def raise_missing(findings: DataFrame) -> None:
    """Raise if any file lacks a required column; names files and columns."""
    errors = findings.where(F.col("severity") == "error").select(F.concat_ws(": ", F.col("file_id").cast("string"), "finding", "header").alias("what"))
    raise_named(errors.orderBy("what"), "required columns missing (all are in the findings table)")


__all__ = ["KNOWN_COLUMNS", "Exports", "first_record", "discover_headers", "header_table", "raise_missing", "raise_named", "read_exports", "scan_exports"]
