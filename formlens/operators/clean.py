"""Row operators: dates, year filter, age, text and number cleaning, projection.

Every operator takes and returns a DataFrame and only adds Column
expressions, so the whole cleaned-table build is one projection over the
scan (no Python, no shuffle) except for the analysis-year derivation, which
is a per-export aggregate.  It is stored, so that its size is known when it
is joined back: Spark broadcasts it up to its own threshold.  Building a
table starts no other job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlens import config as C
from formlens.functions import (
    age_at_year_end,
    clean_category,
    coerce_number,
    col_of,
    in_year,
    parse_day_first,
    render_int_float,
)
from formlens.operators.common import UNNAMED_RE, FormValidationError, raise_if_missing, reused


# --- O23 ---------------------------------------------------------------------

def date_loss_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: non-null inputs, parsed values and values lost to parsing."""
    raw = col_of(column)
    parsed = parse_day_first(raw)
    return df.agg(
        F.count(raw).alias("non_null"),
        F.count(parsed).alias("parsed"),
        F.count_if(raw.isNotNull() & parsed.isNull()).alias("lost"),
    )


# --- O24 ---------------------------------------------------------------------

def filter_year(df: DataFrame, year: int, column: str = C.FILLED_LABEL,
                observation: Observation | None = None) -> DataFrame:
    """Keep rows whose fill-in date falls in ``year``; the column becomes typed.

    A stored timestamp column is filtered with a range the Parquet scan can
    use (``PushedFilters``).  Text dates cannot be pushed down, so the filter
    tests the year of a single parse per row.  With an ``Observation`` the
    four counts (total, null or invalid, other year, kept) are collected in
    the same pass as the rows (an observed plan keeps its filter above the
    observation, so use it on text dates).
    """
    if column not in df.columns:
        raise FormValidationError(f"column {column!r} is needed to filter by year")
    c = col_of(column)
    typed = isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
    if observation is not None:
        parsed = df.withColumn(column, c.cast("timestamp_ntz") if typed else parse_day_first(c))
        y = F.year(col_of(column))
        return parsed.observe(
            observation,
            F.count(F.lit(1)).alias("total"),
            F.count_if(y.isNull()).alias("null_or_invalid"),
            F.count_if(y != F.lit(int(year))).alias("other_year"),
            F.count_if(y == F.lit(int(year))).alias("kept"),
        ).where(y == F.lit(int(year)))
    if typed:
        return df.where(in_year(c, year)).withColumn(column, c.cast("timestamp_ntz"))
    return df.where(F.year(parse_day_first(c)) == F.lit(int(year))).withColumn(column, parse_day_first(c))


def year_filter_counts(df: DataFrame, year: int, column: str = C.FILLED_LABEL) -> DataFrame:
    """Total, null or invalid, other year and kept, from one parse per row."""
    y = df.select(F.year(parse_day_first(col_of(column))).alias("y"))
    return y.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("y").isNull()).alias("null_or_invalid"),
        F.count_if(F.col("y") != F.lit(int(year))).alias("other_year"),
        F.count_if(F.col("y") == F.lit(int(year))).alias("kept"),
    )


def raise_if_empty(kept: DataFrame, source: DataFrame, year: int) -> None:
    """Raise, with the four counts, if the year filter left nothing.

    Looks for one row only; the counts are taken when there is none.
    """
    if kept.isEmpty():
        counts = year_filter_counts(source, year).first().asDict()
        raise FormValidationError(f"no rows left after filtering the fill-in date by year {year}: " + ", ".join(f"{k} {v}" for k, v in counts.items()))


# --- O8, O26, O27 ------------------------------------------------------------

def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop columns named like empty spreadsheet/CSV headers."""
    import re

    return df.drop(*[c for c in df.columns if re.match(UNNAMED_RE, c)])


def required_raw_for_mapping() -> list[str]:
    return [raw for raw, clean in C.RAW_TO_CLEANED.items() if clean not in C.OPTIONAL_CLEANED]


def check_mapping(df: DataFrame) -> None:
    """Every mapped raw column must exist, unless it maps to an optional one."""
    raise_if_missing(df.columns, required_raw_for_mapping(), "cannot build the cleaned table")


def project_raw(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Keep mapped raw columns that exist, renamed to internal names.

    Every other column (identifiers included) is dropped here; ``keep``
    carries extra columns such as a row key or the analysis year.
    """
    cols = [col_of(raw).alias(C.LABEL_TO_NAME[clean]) for raw, clean in C.RAW_TO_CLEANED.items() if raw in df.columns]
    return df.select(*[F.col(k) for k in (keep or [])], *cols)


# --- O28, O32 ----------------------------------------------------------------

def fill_optional(df: DataFrame, fill: str = C.FILL_VALUE) -> DataFrame:
    """Absent optional columns: text gets ``fill``; the birth date a typed null."""
    adds = {}
    for name in C.OPTIONAL_NAMES:
        if name not in df.columns:
            adds[name] = F.lit(None).cast("string") if name == "birth_date" else F.lit(fill)
    return df.withColumns(adds) if adds else df


def add_analysis_year(df: DataFrame, year: Column | int) -> DataFrame:
    if "analysis_year" in df.columns:
        return df
    y = year if isinstance(year, Column) else F.lit(int(year))
    return df.withColumn("analysis_year", y.cast("int"))


# --- O29-O31 -----------------------------------------------------------------

def clean_text(df: DataFrame, fill: str = C.FILL_VALUE, names: list[str] | None = None) -> DataFrame:
    """Apply the category cleaning to the text columns of the final list."""
    targets = [n for n in (names or C.TEXT_NAMES) if n in df.columns]
    return df.withColumns({n: clean_category(F.col(n), fill) for n in targets})


def coerce_numeric(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: coerce_number(F.col(n)) for n in names if n in df.columns})


# --- O35 ---------------------------------------------------------------------

def submitted_year(df: DataFrame) -> Column:
    return F.year(parse_day_first(col_of(C.SUBMITTED_LABEL)))


def analysis_year_by_file(df: DataFrame, file_col: str = "file_id") -> DataFrame:
    """Most frequent submission year per file (ties: the smallest year).

    A two-phase aggregate on (file, year) first, so a file holding a third
    of all rows is combined map-side; the mode is then taken over the tiny
    per-(file, year) counts.
    """
    return most_frequent_year(df.select(F.col(file_col), submitted_year(df).alias("y")), file_col)


def most_frequent_year(years: DataFrame, file_col: str) -> DataFrame:
    """``analysis_year_by_file`` of rows with a year ``y`` each."""
    # Null years are skipped inside the aggregate (max ignores nulls), not by
    # a filter: Catalyst would push such a filter into the scan and evaluate
    # the date parse there once per reference, instead of once per row.
    counts = years.groupBy(file_col, "y").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.when(F.col("y").isNotNull(), F.struct(F.col("n"), (-F.col("y")).alias("neg_y"))))
    return (
        counts.groupBy(file_col).agg(best.alias("b"))
        .select(F.col(file_col), (-F.col("b.neg_y")).cast("int").alias("analysis_year"))
        .where(F.col("analysis_year").isNotNull())
    )


def with_analysis_year(df: DataFrame, year: int, file_col: str | None = "file_id") -> DataFrame:
    """Attach ``analysis_year``: derived per export when ``Marca temporal`` exists.

    ``file_col`` names the export of each row: the source file, or a column
    with one value for one or more files.
    """
    if C.SUBMITTED_LABEL not in df.columns:
        return df.withColumn("analysis_year", F.lit(int(year)))
    if file_col and file_col in df.columns:
        joined = df.join(reused(analysis_year_by_file(df, file_col), "years"), [file_col], "left")
        return joined.withColumn("analysis_year", F.coalesce(F.col("analysis_year"), F.lit(int(year))))
    one = df.select(submitted_year(df).alias("y")).groupBy("y").count()
    best = one.agg(F.max(F.when(F.col("y").isNotNull(), F.struct("count", (-F.col("y")).alias("neg_y")))).alias("b"))
    mode = best.select((-F.col("b.neg_y")).cast("int"))
    return df.withColumn("analysis_year", F.coalesce(mode.scalar(), F.lit(int(year))).cast("int"))


# --- O33, O34 ----------------------------------------------------------------

def final_projection(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    missing = [n for n in C.CLEANED_NAMES if n not in df.columns]
    if missing:
        raise FormValidationError(f"cleaned table lacks columns {missing}")
    return df.select(*(keep or []), *C.CLEANED_NAMES)


def build_cleaned(df: DataFrame, kind: str, year: int, fill: str = C.FILL_VALUE,
                  file_col: str | None = "file_id", keep: list[str] | None = None,
                  normalise_ints: bool = False) -> DataFrame:
    """The cleaned table: 35 columns in fixed order, internal names.

    ``kind`` is ``raw`` or ``cleaned``; anything else is an error.  Raw input
    is projected through the mapping (identifiers never pass), cleaned input
    is read by its labels.  Birth date -> timestamp_ntz, age at 31 December
    of the analysis year (raw) or numeric (cleaned), text columns cleaned,
    semester numeric, year kept or derived.  ``normalise_ints`` renders
    text like ``3.0`` (an integer column with gaps read as float) as ``3``.
    """
    if kind not in ("raw", "cleaned"):
        raise FormValidationError(f"unknown file kind {kind!r}")
    keep = [k for k in (keep or []) if k in df.columns]
    if kind == "cleaned" and C.YEAR_LABEL in df.columns:
        # a cleaned export keeps its own year column
        staged = df.withColumn("analysis_year", _own_year())
    else:
        # raw exports always derive it (the mapping never carries a year column)
        staged = with_analysis_year(df, year, file_col)
    if kind == "raw":
        staged = drop_unnamed(staged)
        check_mapping(staged)
        body = project_raw(staged, keep=["analysis_year", *keep])
    else:
        raise_if_missing(staged.columns, C.MINIMUM_CLEANED, "cleaned input")
        body = staged.select("analysis_year", *keep, *[
            col_of(label).alias(C.LABEL_TO_NAME[label])
            for label in C.CLEANED_COLUMNS if label in staged.columns and label != C.YEAR_LABEL
        ])
    return _finish(fill_optional(body, fill), F.lit(kind == "raw"), fill, keep, normalise_ints)


def _own_year() -> Column:
    """The year column of a cleaned export; values that are no year are null."""
    return coerce_number(col_of(C.YEAR_LABEL)).try_cast("int")


def stage_mixed(rows: DataFrame, year: int, filter_by_year: bool = True, fill: str = C.FILL_VALUE,
                keep: list[str] | None = None, normalise_ints: bool = False) -> DataFrame:
    """Rows of exports of both kinds with all that needs no look at other rows.

    ``rows`` come from the scan: known columns, ``kind`` and ``has_year``
    (whether the row's file has a year column).  Each column takes the raw or
    the cleaned header's value by the row's kind, typed and cleaned.
    ``kept`` says whether the year filter leaves the row (raw rows only);
    a row that it does not leave keeps no value but its fill-in year, for the
    counts.  ``date_mixed`` adds what depends on the other rows of an export.
    """
    raw = F.col("kind") == "raw"
    from_raw = {clean: header for header, clean in C.RAW_TO_CLEANED.items()}
    picked = []
    for label in C.CLEANED_COLUMNS:
        if label != C.YEAR_LABEL:
            value = F.when(~raw, col_of(label))
            header = from_raw.get(label)
            value = col_of(label) if header == label else value.when(raw, col_of(header)) if header else value
            picked.append(value.alias(C.LABEL_TO_NAME[label]))
    names = ["source_file", "kind", "has_year", *(keep or [])]
    filled = col_of(C.FILLED_LABEL)
    body = rows.select(
        *map(F.col, names), filled.isNotNull().alias("filled_set"), F.year(parse_day_first(filled)).alias("filled_year"),
        submitted_year(rows).alias("submitted_year"), F.when(~raw & F.col("has_year"), _own_year()).alias("own_year"),
        col_of(C.BIRTH_LABEL).isNotNull().alias("birth_set"), *picked)
    left = ~raw | (F.col("filled_year") == int(year)) if filter_by_year else F.lit(True)
    marked = body.withColumn("kept", F.coalesce(left, F.lit(False)))
    source = lambda n: render_int_float(F.col(n)) if normalise_ints else F.col(n)
    values = {"birth_date": parse_day_first(F.col("birth_date")), "own_age": F.when(~raw, coerce_number(F.col("age")))}
    values |= {n: clean_category(source(n), fill) for n in C.TEXT_NAMES if n != "semester"}
    values["semester"] = coerce_number(clean_category(F.col("semester"), fill))
    own = ["filled_set", "submitted_year", "own_year", "birth_set"]
    return marked.select(*names, "kept", "filled_year", *[F.when(F.col("kept"), F.col(n)).alias(n) for n in own],
                         *[F.when(F.col("kept"), v).alias(n) for n, v in values.items()])


def date_mixed(staged: DataFrame, year: int, file_col: str = "source_file") -> DataFrame:
    """``staged`` plus ``analysis_year`` and ``age``.

    Files without a year column, raw or cleaned, get the most frequent year of
    submission of their kept rows, or ``year`` where there is none.
    """
    votes = staged.where("kept").select(file_col, F.col("submitted_year").alias("y"))
    years = reused(most_frequent_year(votes, file_col).withColumnRenamed("analysis_year", "voted_year"), "years")
    raw = F.col("kind") == "raw"
    derived = F.coalesce(F.col("voted_year"), F.lit(int(year)))
    dated = staged.join(years, [file_col], "left").withColumn("analysis_year", F.when(~raw & F.col("has_year"), F.col("own_year")).otherwise(derived).cast("int"))
    return dated.withColumn("age", F.when(raw, age_at_year_end(F.col("birth_date"), F.col("analysis_year"))).otherwise(F.col("own_age")))


def _finish(body: DataFrame, raw: Column, fill: str, keep: list[str], normalise_ints: bool) -> DataFrame:
    """Typed and cleaned columns in final order; ``raw``: whether the age is computed."""
    def source(n: str):
        return render_int_float(F.col(n)) if normalise_ints else F.col(n)

    # the birth date is parsed once, before the age uses it
    dated = body.withColumn("birth_date", parse_day_first(F.col("birth_date")))
    computed = age_at_year_end(F.col("birth_date"), F.col("analysis_year"))
    age = F.when(raw, computed).otherwise(coerce_number(F.col("age"))) if "age" in body.columns else computed
    text = {n: clean_category(source(n), fill) for n in C.TEXT_NAMES if n != "semester"}
    out = dated.select(
        *[F.col(k) for k in keep],
        F.col("analysis_year").cast("int").alias("analysis_year"),
        "birth_date",
        age.alias("age"),
        *[text[n].alias(n) for n in text],
        coerce_number(clean_category(F.col("semester"), fill)).alias("semester"),
    )
    return final_projection(out, keep)


def with_labels(df: DataFrame) -> DataFrame:
    """Rename internal names to the display labels (for sinks and reports)."""
    return df.withColumnsRenamed({n: C.NAME_TO_LABEL[n] for n in df.columns if n in C.NAME_TO_LABEL})
