"""Physical-plan properties."""

import datetime as dt
import os
import tempfile

from conftest import SF_SMALL
from formlens.functions import in_year
from formlens.operators import report as R
from formlens.operators import clean as K
from formlens.plans import catalog
from formlens.plans import derived as D
from pyspark.sql import functions as F


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaned_table_has_no_python(spark):
    plan = executed(catalog.QUERIES["cleaned_all_years"](spark, SF_SMALL))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_cleaned_table_is_one_codegen_projection_over_the_scan(spark):
    df = catalog.QUERIES["cleaned_table"](spark, SF_SMALL)
    plan = executed(df)
    # data rows are not shuffled; the only exchanges are broadcast sides and what the years are counted from
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert plan.count("Exchange hashpartitioning") <= 2


def test_year_range_reaches_the_parquet_scan(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="formlens-plan-"), "t")
    spark.createDataFrame(
        [(dt.datetime(2025, 3, 1),), (dt.datetime(2024, 3, 1),)], "filled_on timestamp_ntz"
    ).write.parquet(path)
    from formlens.operators.clean import filter_year

    df = filter_year(spark.read.parquet(path), 2025, column="filled_on")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(filled_on), GreaterThanOrEqual(filled_on" in plan
    assert df.count() == 1


def test_year_partition_pruning_on_sink(spark):
    from formlens.sources import read_cleaned, write_cleaned

    cleaned = catalog.QUERIES["cleaned_all_years"](spark, SF_SMALL)
    path = write_cleaned(cleaned, os.path.join(tempfile.mkdtemp(prefix="formlens-plan-"), "c"))
    df = read_cleaned(spark, path).where(F.col("analysis_year") == 1998)
    assert "PartitionFilters: [isnotnull(analysis_year" in executed(df)


def test_report_suite_reads_data_once(spark):
    suite = catalog.QUERIES["report_suite_by_year"](spark, SF_SMALL)
    plan = executed(suite)
    # after the one aggregate pass everything is computed from the small stored table
    assert "orders" not in plan and "FileScan parquet" in plan


def test_report_aggregate_is_single_shuffle(spark):
    cleaned = catalog.QUERIES["cleaned_all_years"](spark, SF_SMALL)
    counted = R.age_counts(cleaned)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    # one for the counts, two for the (export, year) counts of the broadcast years
    assert plan.count("Exchange hashpartitioning") <= 3
    assert "partial_count" in plan and "SortMergeJoin" not in plan  # map-side combine before the shuffle


def test_building_starts_no_job_and_stays_in_the_jvm(spark):
    tracker = spark.sparkContext.statusTracker()
    form = D.survey_form(spark, SF_SMALL)  # reading the tables' schemas does start jobs
    spark.sparkContext.setJobGroup("lazy", "lazy")
    df = K.build_cleaned(form, "raw", 1998, file_col=None)  # with several exports, their years are stored
    assert not tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "Python" not in executed(df)


def test_discovery_reads_one_task_for_each_file_and_no_whole_text(spark, tmp_path):
    from formlens.sources import header_table

    for i in range(3):
        (tmp_path / f"f {i}.csv").write_text("a,b\n" + "x,y\n" * 50_000, encoding="utf-8")
    rows = header_table(spark, str(tmp_path)).collect()
    assert sorted((r["pos"], r["header"]) for r in rows) == [(1, "a")] * 3 + [(2, "b")] * 3


def test_reused_table_is_stored(spark):
    from formlens.operators.common import reused

    agg = spark.range(1000).groupBy((F.col("id") % 50).alias("g")).count()
    stored = reused(agg)
    assert "Scan parquet" in executed(stored) and sorted(stored.collect()) == sorted(agg.collect())
