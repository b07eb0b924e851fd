"""Cleaned-table sinks.

Parquet keeps types (birth date stays a timestamp); CSV renders the birth
date as ``dd/MM/yyyy`` with empty cells for nulls.  Both are partitioned by
analysis year, so a later year filter prunes whole directories.  (Several
exports of one year, delivered one by one, belong into a ``store``.)  A write
replaces the years that it holds and keeps all others, so a retried job
(lost executor) rewrites the same output, and next year's export does not
take this year's away.  In CSV the year also stays a column of the file, so
the files can be read by themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlens import config as C
from formlens.operators.clean import with_labels

# Folder of a year: ASCII, and apart from the year column inside the files.
YEAR_FOLDER = "year"


def for_csv(df: DataFrame, date_format: str = C.DATE_OUTPUT_FORMAT) -> DataFrame:
    """Birth date as text in the export format (nulls stay null)."""
    if "birth_date" not in df.columns:
        return df
    return df.withColumn("birth_date", F.date_format(F.col("birth_date"), date_format))


def write_cleaned(df: DataFrame, path: str, fmt: str = "parquet", labels: bool = False,
                  partition_by: str | None = "analysis_year") -> str:
    out = for_csv(df) if fmt == "csv" else df
    part = partition_by if partition_by in out.columns else None
    if part and fmt == "csv":
        out = out.withColumn(YEAR_FOLDER, F.col(part))
        part = YEAR_FOLDER
    if labels:
        out = with_labels(out)
        part = C.NAME_TO_LABEL.get(part, part) if part else None
    writer = out.write.mode("overwrite")
    if part:
        writer = writer.partitionBy(part).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer.option("header", "true").option("escape", '"').csv(path)
    else:
        writer.parquet(path)
    return path


def read_cleaned(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
