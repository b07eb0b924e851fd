"""Deliveries of export files into a store: only what is new or has changed.

The store's manifest is the ledger.  A listing of the source (paths, lengths,
times of change; no contents) is joined against it, and only files that it
does not have in this state are read.  Sound files go to the store, where each
replaces its own earlier rows; broken ones become dead letters with their
findings.  Both are published by one commit, so a delivery that is run again
after a failure, in whole or in part, leaves the same store.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlens.plans.intake import run_intake
from formlens.sources.store import commit, read_manifest

#: Files that one commit takes; its scan is handed their paths.
FILES_PER_COMMIT = 10_000


@dataclass
class Delivery:
    listed: int      # files of the source
    read: int        # files that were new or changed
    rejected: int    # of these, set aside
    versions: list[int]  # manifest versions that were published


def list_files(spark: SparkSession, paths: list[str] | str, glob: str = "*.csv") -> DataFrame:
    """``(path, export, length, modified)`` of the files under ``paths``; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
    return found.select("path", F.col("_metadata.file_path").alias("export"), "length", F.col("modificationTime").alias("modified"))


def changed_files(listed: DataFrame, manifest: DataFrame) -> DataFrame:
    """The listed files that the manifest does not have in this state."""
    state = ["export", "length", "modified"]
    return listed.join(manifest.select(*state), state, "left_anti")


def literal_path(path: str) -> str:
    """A path in which no character acts as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def to_rows(files: DataFrame) -> list:
    """``files`` on the driver, times in microseconds: they must come back exactly, whatever the time zones."""
    return files.select("path", "export", "length", F.unix_micros("modified").alias("modified")).collect()


def deliver(spark: SparkSession, store: str, files: list, year: int, keep: list[str] | None = None, file_col: str = "file_id",
            filter_by_year: bool = True, set_aside: bool = True, options: dict[str, str] | None = None, multi_line: bool = True) -> tuple[int, int]:
    """Read ``files`` (``to_rows``) and commit them; returns the
    manifest's version and the number of rejected files."""
    res = run_intake(spark, [literal_path(f["path"]) for f in files], year, keep=keep, file_col=file_col, filter_by_year=filter_by_year,
                     options=options, multi_line=multi_line, set_aside=set_aside)
    named = spark.createDataFrame([(f["export"], f["length"], f["modified"]) for f in files], "export string, length long, micros long")
    named = named.select("export", "length", F.timestamp_micros("micros").alias("modified"))
    rejected = res.rejected.withColumnRenamed("file_id", "export")
    version = commit(spark, store, res.by_export, named, res.export_counts, rejected)
    return version, rejected.select("export").distinct().count()


def sync_exports(spark: SparkSession, paths: list[str] | str, store: str, year: int, keep: list[str] | None = None, file_col: str = "file_id",
                 filter_by_year: bool = True, glob: str = "*.csv", options: dict[str, str] | None = None, multi_line: bool = True,
                 files_per_commit: int = FILES_PER_COMMIT) -> Delivery:
    """Bring the store up to date with the files under ``paths``.

    Files whose length and time of change are those of the manifest are not
    read.  Files that are gone from the source stay in the store.
    """
    listed = list_files(spark, paths, glob)
    out = Delivery(listed.count(), 0, 0, [])
    while True:
        # in blocks, and each one sees what the one before has published
        files = to_rows(changed_files(listed, read_manifest(spark, store)).orderBy("export").limit(files_per_commit))
        if not files:
            return out
        version, rejected = deliver(spark, store, files, year, keep, file_col, filter_by_year, True, options, multi_line)
        out.read, out.rejected = out.read + len(files), out.rejected + rejected
        out.versions.append(version)


__all__ = ["Delivery", "changed_files", "deliver", "list_files", "literal_path", "sync_exports", "to_rows"]
