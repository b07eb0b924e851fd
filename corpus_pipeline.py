"""Corpus preparation: language, near-duplicates, repeats, benchmark passages, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a table, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``; columns
that an operator would name itself are set aside for it and come back after.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlens.llm import decontaminate as _decontaminate
from formlens.llm import language as _language
from formlens.llm import near_dedup as _near_dedup
from formlens.llm import packing as _packing
from formlens.llm import suffix_dedup as _suffix_dedup
from formlens.llm.common import held_out, quoted, table, tokenizer_path, written

#: The last stage's token ids come from a tokenizer library, which SQL can't express.
ORACLE_SQL = None


def _apart(docs: DataFrame, used: tuple[str, ...], apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``apply(docs)``, cut to the columns of ``docs``, with all columns but the
    used ones renamed meanwhile, so that no name clashes."""
    names = {c: c if c in used else f"_own{i}" for i, c in enumerate(docs.columns)}
    out = apply(docs.select(*[quoted(c).alias(n) for c, n in names.items()]))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language (no letter at all) go."""
    train_on = ~held_out(F.col("doc_id"))
    return _apart(docs, ("doc_id", "text", "lang"), lambda d: _language.identify(d, train_on).where(F.col("lang_pred") != _language.UNDETERMINED))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) one
    document stays: of the smallest id (null after all others) that of the
    smallest text hash; of equal rows, one."""
    key = F.xxhash64("text").alias("_text_key")
    found = _near_dedup.near_duplicates(docs.select("doc_id", "text", key), group=True)
    rows = found.groupBy("group", F.col("doc_id").alias("_id"), F.col("_text_key").alias("_key")).agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_key", "copies")).alias("first")
    wordless = rows.where("group IS NULL").select("_id", "_key", "copies")
    kept = written(rows.where("group IS NOT NULL").groupBy("group").agg(first).select("first._id", "first._key", "first.copies").unionByName(wordless), "kept")

    def apply(d: DataFrame) -> DataFrame:
        keyed = d.withColumn("_text_key", key)
        out = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left_semi")
        if kept.where("copies > 1").isEmpty():
            return out
        return out.dropDuplicates(["doc_id", "_text_key"])

    return _apart(docs, ("doc_id", "text"), apply)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that occurred earlier are cut out; a
    document of which nothing is left goes."""

    def apply(d: DataFrame) -> DataFrame:
        out = _suffix_dedup.remove_repeats(d)
        out = out.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))).where("n_removed = 0 or text <> ''")
        return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))) if "n_chars" in d.columns else out

    return _apart(docs, ("doc_id", "text", "n_chars"), apply)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _apart(docs, ("doc_id", "text"), lambda d: _decontaminate.decontaminate(d, benchmark).where("not contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as pieces in sequences of 2048 tokens."""
    out = _packing.pack_documents(docs.select("doc_id", "text"), tokenizer_path())
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
