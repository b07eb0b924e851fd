"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import shared_path

#: Bytes of text that a task handles at once; a longer single text is a slab of its own.
SLAB_BYTES = 8 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared checkpoint folder: cuts the
    lineage, and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of an installed public vocabulary; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns that new ones of these names would clash with (case-blind)."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def held_out(doc_id: Column) -> Column:
    """Whether labels of the row are kept for testing: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def slabs(batch: pa.RecordBatch, column: str = "text", limit: int = SLAB_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows, each of about ``limit`` bytes of text at most."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n
    if first < batch.num_rows:
        yield batch.slice(first)


def release() -> None:
    """What a task has freed goes back to the system: its worker stays, and so would that memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def add_columns(df: DataFrame, ddl: str, make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
                column: str = "text") -> DataFrame:
    """``df`` plus the columns of ``ddl``; input columns with the same names give way.

    ``make()`` runs once in a task and returns what computes the new arrays of
    one slab.  Other columns pass through as Arrow, untouched.
    """
    new = StructType.fromDDL(ddl)
    base = without(df, new.names)
    schema = StructType(base.schema.fields + new.fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for slab in slabs(batch, column):
                yield pa.RecordBatch.from_arrays([*slab.columns, *compute(slab)], names=names)
        del compute
        release()

    return base.mapInArrow(run, schema)


def emit(df: DataFrame, ddl: str, make: Callable[[], Callable[[pa.RecordBatch], dict[str, object]]],
         column: str = "text") -> DataFrame:
    """Rows of ``ddl`` that ``make()`` returns (arrays by name) for each slab."""
    schema = StructType.fromDDL(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for slab in slabs(batch, column):
                out = compute(slab)
                yield pa.RecordBatch.from_arrays([out[n] for n in schema.names], names=schema.names)
        del compute
        release()

    return df.mapInArrow(run, schema)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
