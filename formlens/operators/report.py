"""Distributions, histograms and the report suite.

Everything is aggregated before anything is ranked: rows are combined
map-side into (category, year) or (year, age) counts, and ranking, top-k,
bin edges and totals work on those small tables.  A category or year that
holds a third of all rows only makes one partial-aggregate entry per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formlens import config as C
from formlens.functions import strip_category
from formlens.operators.common import reused

YEAR = "analysis_year"


# --- O38 ---------------------------------------------------------------------

def prepare_category(df: DataFrame, column: str, fill: str = C.FILL_VALUE) -> DataFrame:
    """Null -> fill, text, edge whitespace stripped, '' -> fill (inner kept)."""
    return df.withColumn(column, strip_category(F.col(column), fill))


def top_categories(df: DataFrame, column: str, k: int = C.TOP_K, fill: str = C.FILL_VALUE) -> DataFrame:
    """The k most frequent categories ``(category, n, rank)``; ties by name."""
    counts = prepare_category(df, column, fill).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc(column)).limit(k)
    w = Window.orderBy(F.desc("n"), F.asc("category"))
    # the window runs over at most k rows (after the limit)
    return top.select(F.col(column).alias("category"), "n").withColumn("rank", F.row_number().over(w))


def topk_rows(df: DataFrame, column: str, k: int = C.TOP_K, fill: str = C.FILL_VALUE) -> DataFrame:
    """Rows whose prepared category is among the top k.

    The ranking reads the one column it needs; the semi join's small side has
    at most k rows, a proven bound, so it is broadcast.
    """
    prepared = prepare_category(df, column, fill)
    top = top_categories(df.select(column), column, k, fill).select(F.col("category").alias(column))
    return prepared.join(F.broadcast(top), column, "left_semi")


# --- O39, O40 ----------------------------------------------------------------

def category_distribution(df: DataFrame, column: str, k: int = C.TOP_K, fill: str = C.FILL_VALUE) -> DataFrame:
    """Single-year chart data: count per top-k category, in chart order."""
    return top_categories(df, column, k, fill)


def category_by_year(df: DataFrame, column: str, k: int = C.TOP_K, fill: str = C.FILL_VALUE,
                     year: str = YEAR) -> DataFrame:
    """Multi-year chart data: top k over all years, count per (category, year).

    One data-sized aggregate on (category, year); the top-k ranking runs on
    its per-category totals.  Empty (category, year) pairs are absent.
    """
    per_year = (
        prepare_category(df, column, fill)
        .groupBy(F.col(column).alias("category"), F.col(year).alias("year"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _rank_categories(per_year, ["category"], k).select("category", "year", "n", "rank")


def _rank_categories(per_year: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Add ``total`` and dense ``rank`` (total desc, category asc); keep rank <= k.

    ``per_year`` is already aggregated, so these windows see only the
    (report, category, year) counts, never data rows.
    """
    part = keys[:-1]
    total_w = Window.partitionBy(*keys)
    ranked = per_year.withColumn("total", F.sum("n").over(total_w))
    rank_w = (Window.partitionBy(*part) if part else Window.partitionBy()).orderBy(
        F.desc("total"), F.asc(keys[-1])
    )
    return ranked.withColumn("rank", F.dense_rank().over(rank_w)).where(F.col("rank") <= k)


# --- O42, O43 ----------------------------------------------------------------

def _bins_expr(x, lo, hi, n):
    """Equal-width bin (1..n) of x between lo and hi; last bin closed."""
    return F.least(F.floor((x - lo) * n / (hi - lo)), n - F.lit(1)).cast("int") + F.lit(1)


def age_counts(df: DataFrame, age: str = "age", year: str = YEAR) -> DataFrame:
    """Rows counted per (year, age): ``(year, x, c)``; x is null for rows without an age."""
    return (
        df.groupBy(F.col(year).alias("year"), F.col(age).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("c"))
    )


def histogram_from_counts(counted: DataFrame, by_year: bool | None = None,
                          max_bins: int = C.HIST_MAX_BINS, min_bins: int = C.HIST_MIN_BINS) -> DataFrame:
    """Histogram rows from ``(year, x, c)`` counts (see ``age_histogram``).

    ``counted`` should be a stored table (it is small); edges and number of
    bins are one row of it, which reaches the bins as a scalar subquery.
    Whether there are several years is decided over all rows, with and
    without an age.
    """
    single = F.least(F.lit(max_bins), F.greatest(F.lit(min_bins), F.count_distinct("x")))
    if by_year is None:
        nb = F.when(F.count_distinct("year") > 1, F.lit(max_bins)).otherwise(single)
    else:
        nb = F.lit(max_bins) if by_year else single
    mn, mx = F.min("x"), F.max("x")
    edges = counted.agg(F.struct(
        F.when(mn == mx, mn - 0.5).otherwise(mn).cast("double").alias("lo"),
        F.when(mn == mx, mx + 0.5).otherwise(mx).cast("double").alias("hi"),
        nb.cast("int").alias("nb"),
    ).alias("e")).scalar()
    aged = counted.where(F.col("x").isNotNull()).withColumn("e", edges)
    lo, hi, n = F.col("e.lo"), F.col("e.hi"), F.col("e.nb")
    binned = aged.withColumn("bin", _bins_expr(F.col("x"), lo, hi, n)).groupBy("year", "bin").agg(F.sum("c").alias("n"))
    grid = aged.select("year", "e").distinct().select("year", "e", F.explode(F.sequence(F.lit(1), n)).alias("bin"))
    width = (hi - lo) / n
    return (
        grid.join(binned, ["year", "bin"], "left")
        .select(
            "year", "bin",
            (lo + (F.col("bin") - 1) * width).alias("bin_lo"),
            (lo + F.col("bin") * width).alias("bin_hi"),
            F.coalesce(binned["n"], F.lit(0)).cast("long").alias("n"),
        )
    )


def age_histogram(df: DataFrame, by_year: bool | None = None, age: str = "age", year: str = YEAR,
                  max_bins: int = C.HIST_MAX_BINS, min_bins: int = C.HIST_MIN_BINS) -> DataFrame:
    """Histogram rows ``(year, bin, bin_lo, bin_hi, n)`` including empty bins.

    ``by_year=None`` decides like the report: by year when there is more
    than one analysis year.  Single year: ``min(10, max(5, distinct ages))``
    bins; by year: 10 bins with edges common to all years.  When min = max
    the range is widened by 0.5 on each side.  Ages are counted per
    (year, age) in one pass over the data; that small table is stored, and
    edges, bin count and bins are computed from it.  Without any age the
    result is empty.
    """
    counted = reused(age_counts(df, age, year), "ages")
    return histogram_from_counts(counted, by_year, max_bins, min_bins)


# --- O44 ---------------------------------------------------------------------

def report_suite(cleaned: DataFrame, summary: DataFrame | None = None, keys: list[str] | None = None,
                 k: int = C.TOP_K, fill: str = C.FILL_VALUE, input_columns: int | None = None,
                 kind: str = "raw") -> DataFrame:
    """All chosen reports as one long table, from one pass over the data.

    ``(ord, report, category, year, n, rank, bin_lo, bin_hi)``: the quality
    summary first (ord 0), then the chosen keys in order; unknown keys are
    ignored.  Each row of ``cleaned`` is unpivoted into one entry per
    categorical report, one for its age and one for its birth date, and a
    single partial aggregate counts them per (report, category, age, year).
    That table is stored once, and ranks, histogram bins and the quality
    counts are all derived from it.

    The quality table is either given (``summary``) or, with
    ``input_columns``, computed from the same pass (the cleaned table is a
    row-preserving projection of its input).
    """
    counts = reused(suite_counts(cleaned, fill=fill, keys=keys), "suite")
    if summary is None and input_columns is not None:
        summary = _quality_from_counts(counts, input_columns, len(cleaned.columns), kind)
    return suite_from_counts(counts, summary, keys, k)


def suite_counts(cleaned: DataFrame, by: list[str] | None = None, fill: str = C.FILL_VALUE, keys: list[str] | None = None) -> DataFrame:
    """Rows counted per (report, category, age, year), and per column of ``by``.

    ``(report, category, x, year, n)``: one entry of each row for each chosen
    categorical report, its age and its birth date.  Counts of disjoint sets of
    rows add up, so tables of several batches are merged by a sum.
    """
    none = F.lit(None).cast("string")
    items = [F.struct(F.lit(key).alias("report"), strip_category(F.col(_name_of(label)), fill).alias("category"), F.lit(None).cast("double").alias("x"))
             for key, label in C.REPORT_CATALOGUE.items() if not keys or key in keys]
    items.append(F.struct(F.lit("_age").alias("report"), none.alias("category"), F.col("age").cast("double").alias("x")))
    items.append(F.struct(F.lit("_birth").alias("report"), F.when(F.col("birth_date").isNotNull(), "set").otherwise("null").alias("category"), F.lit(None).cast("double").alias("x")))
    by = by or []
    return (
        cleaned.select(*by, F.col(YEAR).alias("year"), F.inline(F.array(*items)))
        .groupBy(*by, "report", "category", "x", "year")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def suite_from_counts(counts: DataFrame, summary: DataFrame | None = None, keys: list[str] | None = None, k: int = C.TOP_K) -> DataFrame:
    """``report_suite`` from a stored table of ``suite_counts``."""
    keys = [key for key in (keys or C.REPORT_KEYS) if key in C.REPORT_CATALOGUE or key == "edad"]
    cat_keys = [key for key in keys if key in C.REPORT_CATALOGUE]
    parts = []
    if summary is not None:
        parts.append(summary.select(
            F.lit(0).alias("ord"), F.lit("resumen_calidad").alias("report"),
            F.col("indicator").alias("category"), F.lit(None).cast("int").alias("year"),
            F.col("value").cast("long").alias("n"), F.col("ord").cast("int").alias("rank"),
            F.lit(None).cast("double").alias("bin_lo"), F.lit(None).cast("double").alias("bin_hi"),
        ))
    if cat_keys:
        place = F.create_map(*[F.lit(x) for key in cat_keys for x in (key, keys.index(key) + 1)])
        per_year = counts.where(F.col("report").isin(cat_keys)).select(place[F.col("report")].alias("ord"), "report", "category", "year", "n")
        ranked = _rank_categories(per_year, ["ord", "report", "category"], k)
        parts.append(ranked.select(
            "ord", "report", "category", "year", F.col("n").cast("long").alias("n"), F.col("rank").cast("int"),
            F.lit(None).cast("double").alias("bin_lo"), F.lit(None).cast("double").alias("bin_hi"),
        ))
    if "edad" in keys:
        ages = counts.where(F.col("report") == "_age").select(
            "year", "x", F.col("n").alias("c"))
        hist = histogram_from_counts(ages)
        parts.append(hist.select(
            F.lit(keys.index("edad") + 1).alias("ord"), F.lit("edad").alias("report"),
            F.col("bin").cast("string").alias("category"), F.col("year").cast("int").alias("year"),
            "n", F.col("bin").cast("int").alias("rank"), "bin_lo", "bin_hi",
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _quality_from_counts(counts: DataFrame, input_columns: int, output_columns: int, kind: str) -> DataFrame:
    """The six quality indicators from the suite's aggregate (no extra pass)."""
    base = C.QUALITY_BASE_RAW if kind == "raw" else C.QUALITY_BASE_CLEANED
    labels = [t.format(base=base) for t in C.QUALITY_LABELS]
    stats = counts.agg(
        F.sum(F.when(F.col("report") == "_birth", F.col("n"))).alias("rows"),
        F.sum(F.when((F.col("report") == "_birth") & (F.col("category") == "set"), F.col("n"))).alias("births"),
        F.sum(F.when((F.col("report") == "_age") & F.col("x").isNotNull(), F.col("n"))).alias("ages"),
    )
    values = [F.col("rows"), F.lit(input_columns), F.col("rows"), F.lit(output_columns), F.col("births"), F.col("ages")]
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("ord"), F.lit(lab).alias("indicator"),
                 F.coalesce(v.cast("long"), F.lit(0).cast("long")).alias("value"))
        for i, (lab, v) in enumerate(zip(labels, values))
    ])
    return stats.select(F.inline(rows))


def _name_of(label: str) -> str:
    return C.LABEL_TO_NAME.get(label, label)
