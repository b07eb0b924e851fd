"""A store of cleaned exports in which an export replaces only itself.

Each commit writes its rows to a folder of its own,
``data/write=<id>/export_key=<key>/analysis_year=<year>``, and their report
counts to ``counts/write=<id>``.  What counts is the manifest: one row for
each export, with the folder that holds its rows, the state of its file
(length and time of change) and its counts.  A commit writes a new manifest
beside the others and publishes it by one rename that fails if another commit
came first, in which case the manifest is made anew from that one.

* Two exports of one year stay side by side; an export that comes again
  replaces its own rows, also those of years that it no longer has.
* Until the rename, and after a crash before it, readers see the old state;
  a commit that is run again replaces what it wrote before.
* A rejected file is a row of the manifest with the reasons; rows that an
  earlier, sound delivery of it brought stay.
* Reports add up the counts of the exports that are in the manifest, so they
  follow each commit without a look at the rows.

Rows are partitioned by export and year, so a year filter prunes folders.
The manifest has a row for each export, like the file listing.  Folders that
no manifest names any more are left for ``superseded``.  Renames are atomic on
HDFS and local file systems; on an object store commits need one writer.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from formlens import config as C
from formlens.operators import metrics as M
from formlens.operators import report as R

_COUNTS = "total long, null_or_invalid long, other_year long, kept long, filled_set long, filled_parsed long, birth_set long, births long, ages long"
MANIFEST = (
    "export string, length long, modified timestamp, export_key string, write string, columns_json string, kind string, columns array<string>, "
    f"years array<int>, {_COUNTS}, findings array<struct<finding: string, header: string>>"
)
COUNTS = "export_key string, report string, category string, x double, year int, n long"
ATTEMPTS = 20


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, store: str) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/manifest")
    fs = _fs(spark, store)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[1:]) for n in names if n.startswith("v"))


def _publish(spark: SparkSession, made: str, version: str) -> bool:
    """Renames ``made`` to ``version``; false if that is there already."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (made, version))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_fs(spark, made).getUri(), conf)
    try:
        context.rename(source, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        if context.util().exists(target) and context.util().exists(source):
            return False
        raise e
    return True


def read_manifest(spark: SparkSession, store: str, version: int | None = None) -> DataFrame:
    """One row for each export of the store, by the last (or the given) commit."""
    store = store.rstrip("/")
    versions = _versions(spark, store)
    if not versions:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{store}/manifest/v{versions[-1] if version is None else version:012d}")


def export_key(export):
    return F.concat(F.lit("x"), F.sha1(export.cast("string")))


def commit(spark: SparkSession, store: str, rows: DataFrame, files: DataFrame, counts: DataFrame | None = None,
           rejected: DataFrame | None = None, export: str = "source_file") -> int:
    """Add the exports of ``files`` to the store; returns the manifest's version.

    ``files`` is ``(export, length, modified)`` with a row for each export of
    this delivery (length and time may be null); ``rows`` the cleaned rows with
    the name of their export in the column ``export``; ``counts`` the
    ``metrics.export_counts``; ``rejected`` is ``(export, finding, header)``.
    """
    store, write = store.rstrip("/"), uuid.uuid4().hex[:16]
    cleaned = rows.drop("kind").withColumn("export_key", export_key(F.col(export))).drop(*([] if export != "source_file" else [export]))
    cleaned.write.partitionBy("export_key", "analysis_year").parquet(f"{store}/data/write={write}")
    stored = spark.read.schema(cleaned.schema).parquet(f"{store}/data/write={write}")
    R.suite_counts(stored, by=["export_key"]).write.parquet(f"{store}/counts/write={write}")
    years = stored.groupBy("export_key").agg(F.array_sort(F.collect_set("analysis_year")).alias("years"))
    named = files.select("export", "length", "modified", export_key(F.col("export")).alias("export_key"))
    if counts is None:
        counts = stored.groupBy("export_key").agg(F.count(F.lit(1)).alias("kept"), F.count("birth_date").alias("births"), F.count("age").alias("ages"))
    else:
        counts = counts.withColumn("export_key", export_key(F.col("source_file"))).drop("source_file")
    if rejected is None:
        rejected = spark.createDataFrame([], "export string, finding string, header string")
    reasons = rejected.groupBy("export").agg(F.array_sort(F.collect_set(F.struct("finding", "header"))).alias("findings"))
    came = named.join(years, "export_key", "left").join(counts, "export_key", "left").join(reasons, "export", "left").select(
        "*", F.lit(write).alias("write"), F.lit(cleaned.schema.json()).alias("columns_json"))
    came = _like_manifest(came)
    for _ in range(ATTEMPTS):
        version = max(_versions(spark, store), default=0)
        old = read_manifest(spark, store, version or None)
        made = f"{store}/manifest/_{uuid.uuid4().hex}"
        _merged(old, came).write.parquet(made)
        if _publish(spark, made, f"{store}/manifest/v{version + 1:012d}"):
            return version + 1
    raise RuntimeError(f"{ATTEMPTS} other commits came first")


def _like_manifest(df: DataFrame) -> DataFrame:
    schema = StructType.fromDDL(MANIFEST)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def _merged(old: DataFrame, came: DataFrame) -> DataFrame:
    """The manifest after a delivery: its exports in place of their old rows;
    a rejected one keeps what an earlier delivery brought."""
    own = ["length", "modified", "findings"]
    sound = F.col("findings").isNull()
    stays = old.drop(*own).withColumnRenamed("export", "e")
    bad = came.where(~sound).select("export", *own).join(stays, F.col("export") == F.col("e"), "left").drop("e")
    gone = old.join(came.select("export"), "export", "left_anti")
    return _like_manifest(came.where(sound)).unionByName(_like_manifest(bad)).unionByName(_like_manifest(gone)).coalesce(8)


def _folders(manifest: DataFrame, base: str) -> list[str]:
    """The export folders that hold rows: as many as the manifest has rows at most."""
    live = manifest.where("write is not null and kept > 0").select("write", "export_key").collect()
    return [f"{base}/write={r['write']}/export_key={r['export_key']}" for r in live]


def read_store(spark: SparkSession, store: str, version: int | None = None) -> DataFrame:
    """The cleaned rows of all exports in the manifest, with ``export`` and ``export_key``."""
    store = store.rstrip("/")
    manifest = read_manifest(spark, store, version)
    shapes = [StructType.fromJson(json.loads(r[0])) for r in manifest.where("write is not null").select("columns_json").distinct().collect()]
    fields: dict[str, StructField] = reduce(lambda known, s: {f.name: f for f in s.fields} | known, shapes, {})
    schema = StructType([StructField(f.name, f.dataType) for f in fields.values()] + ([] if "write" in fields else [StructField("write", StructType.fromDDL("w string")[0].dataType)]))
    folders = _folders(manifest, f"{store}/data")
    if not folders:
        return spark.createDataFrame([], schema).drop("write").withColumn("export", F.lit(None).cast("string"))
    rows = spark.read.schema(schema).option("basePath", f"{store}/data").parquet(*folders).drop("write")
    return rows.join(manifest.select("export_key", "export"), "export_key")


def read_rejected(spark: SparkSession, store: str) -> DataFrame:
    """The dead letters: ``(export, length, modified, finding, header)`` of files that were set aside."""
    return read_manifest(spark, store).select("export", "length", "modified", F.inline("findings"))


def store_summary(spark: SparkSession, store: str) -> DataFrame:
    """The quality summary of all exports in the store, from the manifest alone."""
    return M.mixed_summary(read_manifest(spark, store).where("kind is not null"), len(C.CLEANED_NAMES))


def store_report(spark: SparkSession, store: str, keys: list[str] | None = None, k: int = C.TOP_K) -> DataFrame:
    """The report suite of all exports in the store, from their counts alone."""
    from formlens.operators.common import reused

    store = store.rstrip("/")
    live = read_manifest(spark, store).where("write is not null and kept > 0").select("write", "export_key")
    writes = [r[0] for r in live.select("write").distinct().collect()]
    if writes:
        counts = spark.read.schema(f"{COUNTS}, write string").option("basePath", f"{store}/counts").parquet(*[f"{store}/counts/write={w}" for w in writes])
        counts = counts.join(live, ["write", "export_key"], "left_semi")
    else:
        counts = spark.createDataFrame([], COUNTS)
    merged = reused(counts.groupBy("report", "category", "x", "year").agg(F.sum("n").alias("n")), "suite")
    return R.suite_from_counts(merged, store_summary(spark, store), keys, k)


def superseded(spark: SparkSession, store: str) -> list[str]:
    """Write folders that no row of the current manifest names; nothing reads them any more."""
    store = store.rstrip("/")
    used = {r[0] for r in read_manifest(spark, store).select("write").distinct().collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/data")
    fs = _fs(spark, store)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(f"{store}/data/{n}" for n in names if n.removeprefix("write=") not in used)


__all__ = ["commit", "export_key", "read_manifest", "read_rejected", "read_store", "store_report", "store_summary", "superseded"]
