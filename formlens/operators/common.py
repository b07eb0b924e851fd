"""Shared helpers: validation error, reuse of an intermediate table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from formlens.session import shared_path

# Empty headers: a spreadsheet's ``Unnamed: N`` or a CSV reader's ``_cN``.
UNNAMED_RE = r"^(Unnamed:.*|_c\d+)$"


class FormValidationError(Exception):
    """A form export does not have the structure the pipeline needs."""


def raise_if_missing(columns: list[str], required: list[str], what: str) -> None:
    missing = [c for c in required if c not in columns]
    if missing:
        listed = ", ".join(repr(c) for c in missing)
        raise FormValidationError(f"{what}: missing columns {listed}")


def reused(df: DataFrame, name: str = "reused", spark: SparkSession | None = None) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back (by ``spark``, or its own session).

    For tables that several results are derived from: computed once, and a
    lost executor does not replay what they were computed from.
    """
    spark = spark or df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
