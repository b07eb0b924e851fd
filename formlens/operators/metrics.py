"""Quality summary, shape summary and the multi-year test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formlens import config as C
from formlens.operators.clean import analysis_year_by_file

__all__ = ["analysis_year_by_file", "export_counts", "filter_counts", "loss_counts", "mixed_summary", "multi_year", "quality_summary", "shape_summary"]


def _indicators(base: str) -> list[str]:
    return [t.format(base=base) for t in C.QUALITY_LABELS]


def _long(stats: DataFrame, values: list[tuple[str, Column]]) -> DataFrame:
    rows = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(label).alias("indicator"), F.coalesce(v.cast("long"), F.lit(0).cast("long")).alias("value"))
        for i, (label, v) in enumerate(values, start=1)
    ])
    return stats.select(F.inline(rows))


def quality_summary(input_columns: int, cleaned: DataFrame, kind: str, output_columns: int | None = None) -> DataFrame:
    """Six indicators as a long table ``(ord, indicator, value)``.

    The cleaned table is a row-preserving projection of its (filtered)
    input, so one aggregate over it gives every count in a single pass.
    """
    labels = _indicators(C.QUALITY_BASE_RAW if kind == "raw" else C.QUALITY_BASE_CLEANED)
    stats = cleaned.agg(F.count(F.lit(1)).alias("rows"), F.count("birth_date").alias("births"), F.count("age").alias("ages"))
    out = output_columns or len(cleaned.columns)
    return _long(stats, list(zip(labels, [F.col("rows"), F.lit(input_columns), F.col("rows"), F.lit(out), F.col("births"), F.col("ages")])))


# --- per-export counts: additive, so they can be summed over any set of exports ---

def export_counts(dated: DataFrame, names: DataFrame, year: int) -> DataFrame:
    """A row of counts for each export, from one pass over ``clean.date_mixed`` rows.

    ``(source_file, kind, columns, total, null_or_invalid, other_year, kept,
    filled_set, filled_parsed, birth_set, births, ages)``: the first counts are
    over all rows, those from ``kept`` on over the rows that the year filter
    leaves.  ``names`` has the headers ``(file_id, kind, header)`` of each
    export, so one without any row is there as well.
    """
    kept, filled = F.col("kept"), F.col("filled_year")
    counted = dated.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(filled.isNull()).alias("null_or_invalid"),
        F.count_if(filled != int(year)).alias("other_year"), F.count_if(kept).alias("kept"),
        F.count_if("filled_set").alias("filled_set"), F.count_if(kept & filled.isNotNull()).alias("filled_parsed"),
        F.count_if("birth_set").alias("birth_set"), F.count("birth_date").alias("births"), F.count("age").alias("ages"))
    files = names.groupBy(F.col("file_id").alias("source_file"), "kind").agg(F.collect_set("header").alias("columns"))
    return files.join(counted, "source_file", "left").na.fill(0)


def filter_counts(counts: DataFrame) -> DataFrame:
    """O24's four counts, over the rows of raw exports."""
    raw = counts.where("kind = 'raw'")
    in_all = lambda n: F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n)
    rest = raw.agg(in_all("total"), in_all("null_or_invalid"), in_all("other_year"))
    # kept by the year alone, also where the intake does not filter
    return rest.select("*", (F.col("total") - F.col("null_or_invalid") - F.col("other_year")).alias("kept"))


def loss_counts(counts: DataFrame) -> DataFrame:
    """``(date_column, non_null, parsed, lost)`` of the two date columns, over the kept rows."""
    sums = counts.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in ("filled_set", "filled_parsed", "birth_set", "births")])
    rows = [F.struct(F.lit(c).alias("date_column"), F.col(a).alias("non_null"), F.col(b).alias("parsed"), (F.col(a) - F.col(b)).alias("lost"))
            for c, a, b in ((C.FILLED_LABEL, "filled_set", "filled_parsed"), (C.BIRTH_LABEL, "birth_set", "births"))]
    return sums.select(F.inline(F.array(*rows)))


def mixed_summary(counts: DataFrame, output_columns: int) -> DataFrame:
    """The indicators of exports of both kinds: rows and columns of each kind
    that is there, then of the result; from their ``export_counts``."""
    width = counts.select("kind", F.explode("columns").alias("c")).groupBy("kind").agg(F.count_distinct("c").alias("columns_in"))
    per_kind = counts.groupBy("kind").agg(*[F.sum(a).alias(b) for a, b in (("kept", "rows"), ("births", "births"), ("ages", "ages"))])
    both = per_kind.join(width, "kind", "left").groupBy().agg(F.collect_list(F.struct("kind", F.coalesce("columns_in", F.lit(0)).alias("columns_in"), "rows", "births", "ages")).alias("k"))
    total = lambda name: F.aggregate("k", F.lit(0).cast("long"), lambda t, x: t + x[name])
    def block(base: str, kind: str) -> Column:
        rows, columns, *_ = _indicators(base)
        return F.flatten(F.transform(F.filter("k", lambda x: x["kind"] == kind), lambda x: F.array(
            F.struct(F.lit(rows).alias("indicator"), x["rows"].cast("long").alias("value")), F.struct(F.lit(columns).alias("indicator"), x["columns_in"].cast("long").alias("value")))))
    last = _indicators("")[2:]
    result = F.array(*[F.struct(F.lit(label).alias("indicator"), v.cast("long").alias("value")) for label, v in zip(last, [total("rows"), F.lit(output_columns), total("births"), total("ages")])])
    lines = both.select(F.posexplode(F.concat(block(C.QUALITY_BASE_RAW, "raw"), block(C.QUALITY_BASE_CLEANED, "cleaned"), result)).alias("p", "line"))
    return lines.select((F.col("p") + 1).alias("ord"), "line.indicator", "line.value")


def shape_summary(df: DataFrame, first: int = 10) -> DataFrame:
    """Row and column count and the first column names (joined by `` | ``)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.lit(" | ".join(df.columns[:first])).alias("first_columns"),
    )


def multi_year(df: DataFrame, column: str = "analysis_year") -> DataFrame:
    """Number of distinct analysis years (nulls ignored) and whether it exceeds one."""
    return df.agg(F.count_distinct(column).alias("n_years")).select(
        "n_years", (F.col("n_years") > 1).alias("multi_year")
    )


def year_warnings(df: DataFrame, configured: int, file_col: str = "file_id") -> DataFrame:
    """Exports whose derived analysis year differs from the configured year.

    Ages are computed at the end of the derived year while the fill-in
    filter uses the configured one; when they differ the export is listed
    ``(file_id, analysis_year, configured_year)``.
    """
    years = analysis_year_by_file(df, file_col)
    return years.where(F.col("analysis_year") != F.lit(int(configured))).select(
        file_col, "analysis_year", F.lit(int(configured)).alias("configured_year")
    )
