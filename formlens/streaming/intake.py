"""Incremental intake of form exports with Structured Streaming.

Exports arrive as files in a folder.  A file stream lists new files
(``binaryFile`` without the contents, so they are not read by the stream
itself); ``foreachBatch`` runs the batch intake on each micro-batch's files
(``plans.delivery.deliver``: raw and cleaned exports, findings, year filter,
build) and commits them to a store (``sources.store``).

A commit replaces the rows of its own exports only and is published by one
rename, so a batch that is replayed after a failure leaves the same store,
and readers see whole batches.  With ``on_bad="set_aside"`` a broken file goes
to the dead letters of the same commit instead of failing its batch at every
restart.  Reports follow each batch from the store's counts
(``store_report``).  The row operators are stateless; the only per-export
state (the analysis year) is computed inside the batch, so a whole export must
land in one micro-batch, which the file source guarantees for each file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from formlens.plans.delivery import deliver, to_rows
from formlens.sources.store import read_rejected, read_store, store_report


def start_intake(spark: SparkSession, source_dir: str, sink: str, checkpoint: str, year: int,
                 file_col: str = "file_id", keep: list[str] | None = None,
                 filter_by_year: bool = True, on_bad: str = "raise",
                 available_now: bool = True, max_files_per_trigger: int = 1000,
                 glob: str = "*.csv") -> StreamingQuery:
    """Start the intake stream; ``available_now`` processes what is there and stops.

    A micro-batch takes ``max_files_per_trigger`` files at most, which bounds
    the list of paths that each batch hands to its scan.  ``on_bad`` is
    ``raise`` (a broken file fails its batch) or ``set_aside``.
    """
    if on_bad not in ("raise", "set_aside"):
        raise ValueError(f"on_bad is 'raise' or 'set_aside', not {on_bad!r}")
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.load(source_dir).select("path", F.col("_metadata.file_path").alias("export"), "length", F.col("modificationTime").alias("modified"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = to_rows(batch)  # bounded by max_files_per_trigger
        if rows:
            deliver(spark, sink, rows, year, keep, file_col, filter_by_year, on_bad == "set_aside")

    writer = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_intake(spark: SparkSession, sink: str) -> DataFrame:
    """The cleaned rows of all committed micro-batches."""
    return read_store(spark, sink).drop("export", "export_key")


__all__ = ["read_intake", "read_rejected", "start_intake", "store_report"]
