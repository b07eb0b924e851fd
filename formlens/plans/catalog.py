"""Query catalogue: every operator as a Spark query plus its DuckDB oracle.

Each query takes ``(spark, sf_dir)``, derives its input from the driver
tables (so its work grows with them) and returns a DataFrame.  The oracle
dictionary holds an independent DuckDB statement with the same output
columns.  Column types are aligned on both sides: counts BIGINT, ranks and
years INTEGER, ages and semesters DOUBLE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlens import config as C
from formlens.functions import coerce_number, col_of, parse_day_first
from formlens.operators import clean as K
from formlens.operators import metrics as M
from formlens.operators import report as R
from formlens.plans import derived as D
from formlens.plans import duck as Q

YEAR = 1998          # configured analysis year for the filtered pipeline
TOPK_COLUMN = "campus"   # 25 nations: more than k categories, real ties possible

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------

def form(spark: SparkSession, sf: str) -> DataFrame:
    return D.survey_form(spark, sf)


def cleaned_year(spark: SparkSession, sf: str) -> DataFrame:
    """Fill-in year filter, then the cleaned table (one analysis year)."""
    return K.build_cleaned(K.filter_year(form(spark, sf), YEAR), "raw", YEAR, keep=["respondent_id"])


def cleaned_all(spark: SparkSession, sf: str) -> DataFrame:
    """All exports stacked; the analysis year is derived per export."""
    return K.build_cleaned(form(spark, sf), "raw", YEAR, keep=["respondent_id", "file_id"])


_FORM = Q.form_cte()
_FILTERED = Q.filtered_cte(YEAR)
_CLEANED_YEAR = Q.cleaned_cte("filtered", YEAR, keep=["respondent_id"])
_CLEANED_ALL = Q.cleaned_cte("form", YEAR, keep=["respondent_id", "file_id"])


def _year_sql(*ctes: str, select: str) -> str:
    return Q.with_ctes(_FORM, _FILTERED, _CLEANED_YEAR, *ctes, select=select)


def _all_sql(*ctes: str, select: str) -> str:
    return Q.with_ctes(_FORM, _CLEANED_ALL, *ctes, select=select)


# ---------------------------------------------------------------------------
# Dates, year filter, age
# ---------------------------------------------------------------------------

@register(
    "date_coerce_loss",
    Q.with_ctes(
        _FORM,
        select=(
            f"SELECT file_id, count(b) AS non_null, count(d) AS parsed, "
            f"count(*) FILTER (WHERE b IS NOT NULL AND d IS NULL) AS lost FROM "
            f"(SELECT file_id, {Q.q(C.BIRTH_LABEL)} AS b, {Q.parse_day_first(Q.q(C.BIRTH_LABEL))} AS d FROM form) "
            f"GROUP BY file_id"
        ),
    ),
)
def date_coerce_loss(spark, sf):
    """Values of the birth date that cannot be read, per export."""
    f = form(spark, sf)
    raw = col_of(C.BIRTH_LABEL)
    parsed = parse_day_first(raw)
    return f.groupBy("file_id").agg(
        F.count(raw).alias("non_null"),
        F.count(parsed).alias("parsed"),
        F.count_if(raw.isNotNull() & parsed.isNull()).alias("lost"),
    )


@register(
    "year_filter",
    Q.with_ctes(
        _FORM,
        _FILTERED,
        select=f"SELECT respondent_id, file_id, {Q.parse_day_first(Q.q(C.FILLED_LABEL))} AS filled_on FROM filtered",
    ),
)
def year_filter(spark, sf):
    """Rows filled in during the analysis year, fill-in date typed."""
    kept = K.filter_year(form(spark, sf), YEAR)
    return kept.select("respondent_id", "file_id", col_of(C.FILLED_LABEL).alias("filled_on"))


_d_filled = Q.parse_day_first(Q.q(C.FILLED_LABEL))


@register(
    "year_filter_counts",
    Q.with_ctes(
        _FORM,
        select=(
            f"SELECT count(*) AS total, count(*) FILTER (WHERE d IS NULL) AS null_or_invalid, "
            f"count(*) FILTER (WHERE d IS NOT NULL AND NOT {Q.in_year('d', YEAR)}) AS other_year, "
            f"count(*) FILTER (WHERE {Q.in_year('d', YEAR)}) AS kept "
            f"FROM (SELECT {_d_filled} AS d FROM form)"
        ),
    ),
)
def year_filter_counts(spark, sf):
    """O24 counts: total = null or invalid + other year + kept."""
    return K.year_filter_counts(form(spark, sf), YEAR)


@register(
    "age_at_cutoff",
    Q.with_ctes(
        _FORM,
        select=(
            f"SELECT respondent_id, b AS birth_date, {Q.age_at_year_end('b', str(YEAR))} AS age FROM "
            f"(SELECT respondent_id, {Q.parse_day_first(Q.q(C.BIRTH_LABEL))} AS b FROM form)"
        ),
    ),
)
def age_at_cutoff(spark, sf):
    """Age on 31 December of the configured year for every respondent."""
    from formlens.functions import age_at_year_end

    f = form(spark, sf).select("respondent_id", parse_day_first(col_of(C.BIRTH_LABEL)).alias("birth_date"))
    return f.select("respondent_id", "birth_date", age_at_year_end(F.col("birth_date"), YEAR).alias("age"))


# ---------------------------------------------------------------------------
# Projection, optional fill, text and numbers
# ---------------------------------------------------------------------------

_TEXT_RAW = [(raw, C.LABEL_TO_NAME[clean]) for raw, clean in C.RAW_TO_CLEANED.items()
             if C.LABEL_TO_NAME[clean] in C.TEXT_NAMES and C.LABEL_TO_NAME[clean] != "semester"]


@register(
    "text_clean",
    Q.with_ctes(
        _FORM,
        select="SELECT respondent_id, " + ", ".join(f"{Q.clean_category(Q.q(raw))} AS {n}" for raw, n in _TEXT_RAW) + " FROM form",
    ),
)
def text_clean(spark, sf):
    """Every text column of the final list cleaned."""
    f = form(spark, sf)
    projected = f.select("respondent_id", *[col_of(raw).alias(n) for raw, n in _TEXT_RAW])
    return K.clean_text(projected, names=[n for _, n in _TEXT_RAW])


@register(
    "numeric_coerce",
    Q.with_ctes(
        _FORM,
        select=(
            f"SELECT respondent_id, {Q.q(C.SEMESTER_LABEL)} AS semester_raw, "
            f"{Q.coerce_number(Q.clean_category(Q.q(C.SEMESTER_LABEL)))} AS semester FROM form"
        ),
    ),
)
def numeric_coerce(spark, sf):
    """Semester after text cleaning, as a number (``Sin dato``, ``X``, ``5d`` -> null)."""
    from formlens.functions import clean_category, coerce_number

    s = col_of(C.SEMESTER_LABEL)
    return form(spark, sf).select("respondent_id", s.alias("semester_raw"), coerce_number(clean_category(s)).alias("semester"))


@register(
    "project_raw_to_cleaned",
    Q.with_ctes(
        _FORM,
        select="SELECT respondent_id, " + ", ".join(
            f"{Q.q(raw)} AS {C.LABEL_TO_NAME[clean]}" for raw, clean in C.RAW_TO_CLEANED.items()
        ) + " FROM form",
    ),
)
def project_raw_to_cleaned(spark, sf):
    """Mapped columns renamed; identifiers and unmapped columns dropped."""
    f = form(spark, sf)
    K.check_mapping(f)
    return K.project_raw(f, keep=["respondent_id"])


_OPTIONAL_RAW = [raw for raw, clean in C.RAW_TO_CLEANED.items() if clean in C.OPTIONAL_CLEANED]


@register(
    "optional_fill",
    Q.with_ctes(
        _FORM,
        Q.years_cte("form", "oy"),
        select=(
            "SELECT f.respondent_id, CAST(coalesce(oy.analysis_year, 1998) AS INTEGER) AS analysis_year, "
            "CAST(NULL AS TIMESTAMP) AS birth_date, CAST(NULL AS DOUBLE) AS age, "
            f"{Q.sql_str(C.FILL_VALUE)} AS employment_detail, {Q.sql_str(C.FILL_VALUE)} AS religion "
            "FROM form f LEFT JOIN oy ON f.file_id = oy.file_id"
        ),
    ),
)
def optional_fill(spark, sf):
    """An export without the optional columns (a 2024-style file)."""
    f = form(spark, sf).drop(*_OPTIONAL_RAW)
    out = K.build_cleaned(f, "raw", YEAR, keep=["respondent_id"])
    return out.select("respondent_id", "analysis_year", "birth_date", "age", "employment_detail", "religion")


# ---------------------------------------------------------------------------
# Cleaned table and analysis year
# ---------------------------------------------------------------------------

@register("cleaned_table", _year_sql(select="SELECT * FROM cleaned"))
def cleaned_table(spark, sf):
    """The full cleaned table for the configured year."""
    return cleaned_year(spark, sf)


@register("cleaned_all_years", _all_sql(select="SELECT * FROM cleaned"))
def cleaned_all_years(spark, sf):
    """All yearly exports stacked, analysis year per export."""
    return cleaned_all(spark, sf)


@register(
    "analysis_year_mode",
    Q.with_ctes(_FORM, Q.years_cte("form", "ym"), select="SELECT file_id, analysis_year FROM ym"),
)
def analysis_year_mode(spark, sf):
    """Most frequent submission year per export (ties: smallest)."""
    return K.analysis_year_by_file(form(spark, sf))


# ---------------------------------------------------------------------------
# metrics
# ---------------------------------------------------------------------------

def _quality_sql(source_cte_sql, cleaned_name: str, input_name: str, kind: str) -> str:
    base = C.QUALITY_BASE_RAW if kind == "raw" else C.QUALITY_BASE_CLEANED
    labels = [t.format(base=base) for t in C.QUALITY_LABELS]
    n_in = len(D.FORM_COLUMNS)
    n_out = len(C.CLEANED_NAMES)
    vals = [
        f"(SELECT count(*) FROM {input_name})",
        str(n_in),
        f"(SELECT count(*) FROM {cleaned_name})",
        str(n_out),
        f"(SELECT count(birth_date) FROM {cleaned_name})",
        f"(SELECT count(age) FROM {cleaned_name})",
    ]
    return " UNION ALL ".join(
        f"SELECT {i + 1} AS ord, {Q.sql_str(lab)} AS indicator, CAST({v} AS BIGINT) AS value"
        for i, (lab, v) in enumerate(zip(labels, vals))
    )


_QUALITY_YEAR = _quality_sql(None, "cleaned", "filtered", "raw")


@register("quality_summary", _year_sql(select=_QUALITY_YEAR))
def quality_summary(spark, sf):
    """Six quality indicators for the filtered raw export."""
    filtered = K.filter_year(form(spark, sf), YEAR)
    cleaned = K.build_cleaned(filtered, "raw", YEAR)
    return M.quality_summary(len(filtered.columns), cleaned, "raw")


_FIRST10 = " | ".join(C.CLEANED_NAMES[:10])


@register(
    "shape_summary",
    _year_sql(select=f"SELECT count(*) AS n_rows, CAST({len(C.CLEANED_NAMES)} AS BIGINT) AS n_columns, "
                     f"{Q.sql_str(_FIRST10)} AS first_columns FROM cleaned"),
)
def shape_summary(spark, sf):
    """Rows, columns and the first ten column names of the cleaned table."""
    return M.shape_summary(K.build_cleaned(K.filter_year(form(spark, sf), YEAR), "raw", YEAR))


@register(
    "multi_year_flag",
    _all_sql(select="SELECT count(DISTINCT analysis_year) AS n_years, count(DISTINCT analysis_year) > 1 AS multi_year FROM cleaned"),
)
def multi_year_flag(spark, sf):
    """More than one analysis year in the stacked table."""
    return M.multi_year(cleaned_all(spark, sf))


# ---------------------------------------------------------------------------
# Distributions and histograms
# ---------------------------------------------------------------------------

def _strip(x: str) -> str:
    return Q.strip_category(x)


@register(
    "topk_rows",
    _all_sql(
        f"prep AS (SELECT respondent_id, analysis_year, {_strip(TOPK_COLUMN)} AS {TOPK_COLUMN} FROM cleaned)",
        f"top AS (SELECT {TOPK_COLUMN}, count(*) AS n FROM prep GROUP BY ALL ORDER BY n DESC, {TOPK_COLUMN} ASC LIMIT {C.TOP_K})",
        select=f"SELECT respondent_id, analysis_year, {TOPK_COLUMN} FROM prep WHERE {TOPK_COLUMN} IN (SELECT {TOPK_COLUMN} FROM top)",
    ),
)
def topk_rows(spark, sf):
    """Rows whose campus is among the 10 most frequent."""
    rows = R.topk_rows(cleaned_all(spark, sf), TOPK_COLUMN)
    return rows.select("respondent_id", "analysis_year", TOPK_COLUMN)


@register(
    "category_distribution",
    _year_sql(
        f"cnt AS (SELECT {_strip(TOPK_COLUMN)} AS category, count(*) AS n FROM cleaned GROUP BY ALL)",
        select=(
            f"SELECT category, n, CAST(row_number() OVER (ORDER BY n DESC, category ASC) AS INTEGER) AS rank "
            f"FROM cnt QUALIFY rank <= {C.TOP_K}"
        ),
    ),
)
def category_distribution(spark, sf):
    """One-year chart data, count per top-10 campus."""
    return R.category_distribution(cleaned_year(spark, sf), TOPK_COLUMN)


@register(
    "category_by_year",
    _all_sql(
        f"py AS (SELECT {_strip(TOPK_COLUMN)} AS category, analysis_year AS year, count(*) AS n FROM cleaned GROUP BY ALL)",
        "tot AS (SELECT *, sum(n) OVER (PARTITION BY category) AS total FROM py)",
        "rk AS (SELECT *, CAST(dense_rank() OVER (ORDER BY total DESC, category ASC) AS INTEGER) AS rank FROM tot)",
        select=f"SELECT category, year, n, rank FROM rk WHERE rank <= {C.TOP_K}",
    ),
)
def category_by_year(spark, sf):
    """Top-10 campuses over all years, count per (campus, year)."""
    return R.category_by_year(cleaned_all(spark, sf), TOPK_COLUMN)


def _hist_sql(by_year: bool) -> list[str]:
    nb = str(C.HIST_MAX_BINS) if by_year else f"least({C.HIST_MAX_BINS}, greatest({C.HIST_MIN_BINS}, nd))"
    return [
        "hc AS (SELECT analysis_year AS year, age AS x, count(*) AS c FROM cleaned WHERE age IS NOT NULL GROUP BY ALL)",
        "hs AS (SELECT min(x) AS mn, max(x) AS mx, count(DISTINCT x) AS nd FROM hc)",
        "he AS (SELECT CAST(CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS DOUBLE) AS lo, "
        "CAST(CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS DOUBLE) AS hi, "
        f"CAST({nb} AS INTEGER) AS nb FROM hs)",
        "hb AS (SELECT year, CAST(least(floor((CAST(x AS DOUBLE) - lo) * nb / (hi - lo)), nb - 1) AS INTEGER) + 1 AS bin, "
        "CAST(sum(c) AS BIGINT) AS n FROM hc, he GROUP BY ALL)",
        "hg AS (SELECT year, CAST(unnest(range(1, nb + 1)) AS INTEGER) AS bin FROM (SELECT DISTINCT year FROM hc), he)",
    ]


_HIST_SELECT = (
    "SELECT g.year, g.bin, lo + (g.bin - 1) * ((hi - lo) / nb) AS bin_lo, lo + g.bin * ((hi - lo) / nb) AS bin_hi, "
    "CAST(coalesce(b.n, 0) AS BIGINT) AS n FROM hg g CROSS JOIN he LEFT JOIN hb b ON g.year = b.year AND g.bin = b.bin"
)


@register("age_histogram", _year_sql(*_hist_sql(False), select=_HIST_SELECT))
def age_histogram(spark, sf):
    """One-year age histogram, min(10, max(5, distinct ages)) bins."""
    return R.age_histogram(cleaned_year(spark, sf), by_year=False)


@register("age_histogram_by_year", _all_sql(*_hist_sql(True), select=_HIST_SELECT))
def age_histogram_by_year(spark, sf):
    """10 bins with edges common to all years, count per (bin, year)."""
    return R.age_histogram(cleaned_all(spark, sf), by_year=True)


# ---------------------------------------------------------------------------
# Report suite
# ---------------------------------------------------------------------------

def _suite_sql(input_name: str, multi: bool) -> list[str]:
    cat_keys = [k for k in C.REPORT_KEYS if k in C.REPORT_CATALOGUE]
    unions = " UNION ALL ".join(
        f"SELECT {C.REPORT_KEYS.index(k) + 1} AS ord, '{k}' AS report, "
        f"{_strip(C.LABEL_TO_NAME[C.REPORT_CATALOGUE[k]])} AS category, analysis_year AS year FROM cleaned"
        for k in cat_keys
    )
    edad_ord = C.REPORT_KEYS.index("edad") + 1
    return [
        f"sl AS ({unions})",
        "sp AS (SELECT ord, report, category, year, count(*) AS n FROM sl GROUP BY ALL)",
        "st AS (SELECT *, sum(n) OVER (PARTITION BY ord, report, category) AS total FROM sp)",
        "sr AS (SELECT *, dense_rank() OVER (PARTITION BY ord, report ORDER BY total DESC, category ASC) AS rk FROM st)",
        f"sq AS ({_quality_sql(None, 'cleaned', input_name, 'raw')})",
        *_hist_sql(multi),
        f"sh AS ({_HIST_SELECT})",
        (
            "suite AS ("
            "SELECT 0 AS ord, 'resumen_calidad' AS report, indicator AS category, CAST(NULL AS INTEGER) AS year, "
            "value AS n, CAST(ord AS INTEGER) AS rank, CAST(NULL AS DOUBLE) AS bin_lo, CAST(NULL AS DOUBLE) AS bin_hi FROM sq "
            "UNION ALL SELECT ord, report, category, CAST(year AS INTEGER), CAST(n AS BIGINT), CAST(rk AS INTEGER), "
            f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM sr WHERE rk <= {C.TOP_K} "
            f"UNION ALL SELECT {edad_ord}, 'edad', CAST(bin AS VARCHAR), CAST(year AS INTEGER), n, bin, bin_lo, bin_hi FROM sh)"
        ),
    ]


@register("report_suite", _year_sql(*_suite_sql("filtered", False), select="SELECT * FROM suite"))
def report_suite(spark, sf):
    """O44 (one year): quality table, five distributions and the age histogram."""
    filtered = K.filter_year(form(spark, sf), YEAR)
    cleaned = K.build_cleaned(filtered, "raw", YEAR)
    return R.report_suite(cleaned, input_columns=len(filtered.columns), kind="raw")


@register("report_suite_by_year", _all_sql(*_suite_sql("form", True), select="SELECT * FROM suite"))
def report_suite_by_year(spark, sf):
    """O44 (stacked exports): the same suite compared across analysis years."""
    f = form(spark, sf)
    cleaned = K.build_cleaned(f, "raw", YEAR)
    return R.report_suite(cleaned, input_columns=len(f.columns), kind="raw")


# ---------------------------------------------------------------------------
# Header tables
# ---------------------------------------------------------------------------

from formlens.functions.text import WS_RE2  # noqa: E402
from formlens.operators import headers as H  # noqa: E402
from formlens.plans.expected import FUZZY  # noqa: E402


def headers_of(spark: SparkSession, sf: str) -> DataFrame:
    return D.file_headers(spark, sf)


def _values(rows, cols):
    return D.values_sql(rows, cols)


_FH = f"fh AS ({D.file_headers_sql()})"
_HN = (
    f"hn AS (SELECT file_id, pos, header, "
    f"lower(trim(regexp_replace(strip_accents(header), '{WS_RE2}+', ' ', 'g'))) AS header_norm FROM fh)"
)
_FILES = "files AS (SELECT DISTINCT file_id FROM fh)"


def _h_sql(*ctes: str, select: str) -> str:
    return Q.with_ctes(_FH, _HN, _FILES, *ctes, select=select)


# The oracle's own lists come from the fixed configuration and are normalised in SQL.
def _norm(x: str) -> str:
    return f"lower(trim(regexp_replace(strip_accents({x}), '{WS_RE2}+', ' ', 'g')))"


def _texts(rows: list[tuple], columns: list[str], norms: dict[str, str]) -> str:
    """A table of fixed texts with normalised copies of some of its columns."""
    more = ", ".join(f"{_norm(c)} AS {n}" for c, n in norms.items())
    return f"(SELECT *, {more} FROM {_values(rows, ['v', *columns])})"


_RULE_LISTS = {"markers": C.RAW_MARKERS, "raw_mandatory": C.MANDATORY_RAW, "cleaned_min": C.MINIMUM_CLEANED}
_TARGET_LISTS = {"raw": [*C.MANDATORY_RAW, C.SUBMITTED_LABEL], "cleaned": C.CLEANED_COLUMNS}
_ALIASES = [(i, spelling, canonical) for i, (spelling, canonical) in enumerate(
    (v, c) for c, variants in C.ALIASES.items() for v in [*variants, c])]
_KINDS = [
    f"rules AS (SELECT DISTINCT rule, header_norm FROM {_texts([(r, h) for r, hs in _RULE_LISTS.items() for h in hs], ['rule', 'header'], {'header': 'header_norm'})})",
    "sizes AS (SELECT rule, count(*) AS n FROM rules GROUP BY ALL)",
    # of equal aliases the last one counts
    f"als AS (SELECT header_norm, arg_max(canonical, i) AS canonical, arg_max(resolved, i) AS resolved FROM {_texts(_ALIASES, ['i', 'spelling', 'canonical'], {'spelling': 'header_norm', 'canonical': 'resolved'})} GROUP BY ALL)",
    "pres AS (SELECT DISTINCT file_id, header_norm FROM hn)",
    "direct AS (SELECT p.file_id, r.rule, count(DISTINCT p.header_norm) AS n FROM pres p JOIN rules r ON r.header_norm = p.header_norm GROUP BY ALL)",
    "resolved AS (SELECT DISTINCT p.file_id, coalesce(x.resolved, p.header_norm) AS header_norm FROM pres p LEFT JOIN als x ON x.header_norm = p.header_norm)",
    "via AS (SELECT r.file_id, 'cleaned_alias' AS rule, count(DISTINCT r.header_norm) AS n FROM resolved r "
    "JOIN rules q ON q.header_norm = r.header_norm AND q.rule = 'cleaned_min' GROUP BY ALL)",
    "cnt AS (SELECT * FROM direct UNION ALL SELECT * FROM via)",
    "kc AS (SELECT f.file_id, "
    "CAST(coalesce(max(n) FILTER (WHERE rule = 'markers'), 0) AS BIGINT) AS n_markers, "
    "CAST(coalesce(max(n) FILTER (WHERE rule = 'raw_mandatory'), 0) AS BIGINT) AS n_raw_mandatory, "
    "CAST(coalesce(max(n) FILTER (WHERE rule = 'cleaned_min'), 0) AS BIGINT) AS n_cleaned_min, "
    "CAST(coalesce(max(n) FILTER (WHERE rule = 'cleaned_alias'), 0) AS BIGINT) AS n_cleaned_alias "
    "FROM files f LEFT JOIN cnt c ON c.file_id = f.file_id GROUP BY f.file_id)",
    "kinds AS (SELECT file_id, CASE "
    "WHEN n_markers = (SELECT n FROM sizes WHERE rule = 'markers') THEN 'raw' "
    "WHEN n_raw_mandatory = (SELECT n FROM sizes WHERE rule = 'raw_mandatory') THEN 'raw' "
    "WHEN n_cleaned_min = (SELECT n FROM sizes WHERE rule = 'cleaned_min') THEN 'cleaned' "
    "WHEN n_cleaned_alias = (SELECT n FROM sizes WHERE rule = 'cleaned_min') THEN 'cleaned' ELSE 'unknown' END AS kind, "
    "n_markers, n_raw_mandatory, n_cleaned_min, n_cleaned_alias FROM kc)",
]

_CAND = _KINDS + [
    "tgt AS (SELECT file_id, kind AS target FROM kinds WHERE kind IN ('raw', 'cleaned'))",
    "th AS (SELECT h.file_id, h.pos, h.header, h.header_norm, t.target FROM hn h JOIN tgt t ON t.file_id = h.file_id)",
    f"ex AS (SELECT target, header_norm, arg_max(name, i) AS canonical FROM {_texts([(t, i, h) for t, hs in _TARGET_LISTS.items() for i, h in enumerate(hs)], ['target', 'i', 'name'], {'name': 'header_norm'})} GROUP BY ALL)",
    "dim AS (SELECT target, header_norm, canonical, 'exact' AS layer FROM ex UNION ALL "
    "SELECT e.target, a.header_norm, a.canonical, 'alias' FROM als a JOIN ex e ON e.canonical = a.canonical "
    "WHERE NOT EXISTS (SELECT 1 FROM ex x WHERE x.target = e.target AND x.header_norm = a.header_norm))",
    f"fz AS (SELECT * FROM {_values(FUZZY, ['z', 'target', 'header_norm', 'canonical', 'score', 'unsafe'])})",
    "cand AS (SELECT th.file_id, th.pos, th.header, th.header_norm, th.target, "
    "coalesce(d.canonical, z.canonical) AS canonical, "
    "CASE WHEN d.canonical IS NOT NULL THEN d.layer WHEN z.canonical IS NOT NULL THEN 'fuzzy' END AS layer, "
    "CASE WHEN d.canonical IS NULL THEN z.score END AS score, d.canonical IS NULL AND coalesce(z.unsafe, FALSE) AS unsafe "
    "FROM th LEFT JOIN dim d ON d.target = th.target AND d.header_norm = th.header_norm "
    "LEFT JOIN fz z ON z.target = th.target AND z.header_norm = th.header_norm)",
]


def _plan_sql(mode: str) -> str:
    if mode == "safe":
        blocked = "unsafe"
        order = "CASE WHEN lay2 = 'fuzzy' THEN 1 ELSE 0 END, pos"
    else:
        blocked = "FALSE"
        order = "pos"
    return _h_sql(
        *_CAND,
        f"c2 AS (SELECT *, CASE WHEN {blocked} THEN NULL ELSE canonical END AS can2, "
        f"CASE WHEN {blocked} THEN NULL ELSE layer END AS lay2 FROM cand)",
        f"rk AS (SELECT *, CASE WHEN can2 IS NOT NULL THEN row_number() OVER (PARTITION BY file_id, can2 ORDER BY {order}) END AS claim FROM c2)",
        select=(
            "SELECT file_id, pos, header, CASE WHEN claim = 1 THEN can2 END AS canonical, "
            "CASE WHEN claim = 1 THEN lay2 END AS layer, "
            "CASE WHEN can2 IS NULL THEN 'unmatched' WHEN claim <> 1 THEN 'conflict' "
            "WHEN can2 = header THEN 'unchanged' ELSE 'renamed' END AS status FROM rk"
        ),
    )


@register("header_normalise", _h_sql(select="SELECT file_id, pos, header, header_norm FROM hn"))
def header_normalise(spark, sf):
    """Normalised header names (NFKD, no marks, collapsed spaces, lower case)."""
    return H.normalise_headers(headers_of(spark, sf))


@register(
    "header_catalogue",
    _h_sql(select="SELECT file_id, pos, header, count(*) OVER (PARTITION BY file_id) AS n_columns FROM fh"),
)
def header_catalogue(spark, sf):
    """Headers with position and the column count of their export."""
    return H.header_catalogue(headers_of(spark, sf))


@register(
    "header_drop_unnamed",
    _h_sql(select="SELECT file_id, pos, header FROM fh WHERE NOT regexp_full_match(header, '(Unnamed:.*|_c\\d+)')"),
)
def header_drop_unnamed(spark, sf):
    """Header lists without empty-header columns."""
    return H.drop_unnamed(headers_of(spark, sf))


_DIFF = [
    "act AS (SELECT file_id, header_norm, CAST(min(pos) AS INTEGER) AS first_pos, arg_max(header, pos) AS spelling FROM hn GROUP BY ALL)",
    # of headers that are equal when normalised, the first gives the order and the last the spelling
    f"expn AS (SELECT * FROM {_texts([(s, i, h) for s, hs in C.EXPECTED_SCHEMAS.items() for i, h in enumerate(hs)], ['schema', 'i', 'name'], {'name': 'expected_norm'})})",
    "expd AS (SELECT schema, row_number() OVER (PARTITION BY schema ORDER BY min(i)) AS ord, arg_max(name, i) AS expected, expected_norm FROM expn GROUP BY schema, expected_norm)",
    "diff AS ("
    "SELECT f.file_id, e.schema, CASE WHEN a.header_norm IS NULL THEN 'missing' ELSE 'match' END AS status, "
    "CAST(e.ord AS INTEGER) AS ord, e.expected AS header "
    "FROM files f CROSS JOIN expd e LEFT JOIN act a ON a.file_id = f.file_id AND a.header_norm = e.expected_norm "
    "UNION ALL SELECT a.file_id, s.schema, 'extra', a.first_pos, a.spelling FROM act a "
    "CROSS JOIN (SELECT DISTINCT schema FROM expd) s "
    "WHERE NOT EXISTS (SELECT 1 FROM expd e WHERE e.schema = s.schema AND e.expected_norm = a.header_norm))",
]


@register("schema_diff", _h_sql(*_DIFF, select="SELECT * FROM diff"))
def schema_diff(spark, sf):
    """Matched, missing and extra headers per export and schema."""
    return H.schema_diff(headers_of(spark, sf))


@register(
    "schema_conformance",
    _h_sql(
        *_DIFF,
        select=(
            "SELECT file_id, schema, count(*) FILTER (WHERE status = 'match') AS n_matched, "
            "count(*) FILTER (WHERE status = 'missing') AS n_missing, "
            "count(*) FILTER (WHERE status = 'extra') AS n_extra, "
            "(SELECT count(*) FROM expd e WHERE e.schema = diff.schema) AS n_expected "
            "FROM diff GROUP BY file_id, schema"
        ),
    ),
)
def schema_conformance(spark, sf):
    """Conformance counts per export against the raw and minimum cleaned schemas."""
    return H.schema_conformance(headers_of(spark, sf))


@register("file_kind", _h_sql(*_KINDS, select="SELECT * FROM kinds"))
def file_kind(spark, sf):
    """Raw, cleaned or unknown per export."""
    return H.file_kinds(headers_of(spark, sf))


@register("header_exact", _h_sql(*_CAND, select="SELECT file_id, pos, header, canonical FROM cand WHERE layer = 'exact'"))
def header_exact(spark, sf):
    """Headers equal (normalised) to an expected name."""
    c = H.candidates(headers_of(spark, sf))
    return c.where(F.col("layer") == "exact").select("file_id", "pos", "header", "canonical")


@register("header_alias", _h_sql(*_CAND, select="SELECT file_id, pos, header, canonical FROM cand WHERE layer = 'alias'"))
def header_alias(spark, sf):
    """Headers resolved through the alias dictionary."""
    c = H.candidates(headers_of(spark, sf))
    return c.where(F.col("layer") == "alias").select("file_id", "pos", "header", "canonical")


@register(
    "header_fuzzy",
    _h_sql(*_CAND, select="SELECT file_id, pos, header, canonical, score FROM cand WHERE layer = 'fuzzy'"),
)
def header_fuzzy(spark, sf):
    """Fuzzy candidates (difflib ratio >= 0.60) for the remaining headers."""
    c = H.candidates(headers_of(spark, sf))
    return c.where(F.col("layer") == "fuzzy").select("file_id", "pos", "header", "canonical", "score")


@register("header_plan", _plan_sql("safe"))
def header_plan(spark, sf):
    """One-to-one rename plan, exact and alias claims first."""
    return H.header_plan(headers_of(spark, sf), "safe")


@register("header_plan_greedy", _plan_sql("greedy"))
def header_plan_greedy(spark, sf):
    """O16/O17 in file order, as a column-by-column loop assigns names."""
    return H.header_plan(headers_of(spark, sf), "greedy")


_RAW_FILES = "rawf AS (SELECT file_id FROM kinds WHERE kind = 'raw')"


def _raw_headers(spark, sf) -> DataFrame:
    return H.by_file(headers_of(spark, sf)).where(F.col("kind") == "raw")


@register(
    "header_positions",
    _h_sql(
        *_KINDS, _RAW_FILES,
        f"exp63 AS (SELECT * FROM {_values(list(enumerate(C.RAW_COLUMNS, start=1)), ['e', 'pos', 'expected'])})",
        "pd AS (SELECT h.file_id, h.pos, e.expected, h.header AS actual FROM fh h JOIN rawf r ON r.file_id = h.file_id "
        "JOIN exp63 e ON e.pos = h.pos WHERE h.header <> e.expected)",
        select="SELECT file_id, pos, expected, actual FROM pd QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY pos) <= 5",
    ),
)
def header_positions(spark, sf):
    """First five position differences of raw exports against the exact order."""
    return H.position_differences(_raw_headers(spark, sf))


_REQ = f"req AS (SELECT * FROM {_values(list(enumerate(C.MANDATORY_RAW, start=1)), ['q', 'ord', 'header'])})"


@register(
    "required_missing",
    _h_sql(
        *_KINDS, _RAW_FILES, _REQ,
        select=(
            "SELECT f.file_id, CAST(r.ord AS INTEGER) AS ord, r.header FROM rawf f CROSS JOIN req r "
            "WHERE NOT EXISTS (SELECT 1 FROM fh h WHERE h.file_id = f.file_id AND h.header = r.header)"
        ),
    ),
)
def required_missing(spark, sf):
    """Mandatory raw headers (exact names) missing from raw exports."""
    return H.required_missing(_raw_headers(spark, sf))


@register(
    "extra_columns",
    _h_sql(
        *_KINDS, _RAW_FILES, _REQ,
        select="SELECT h.file_id, h.pos, h.header FROM fh h JOIN rawf f ON f.file_id = h.file_id WHERE h.header NOT IN (SELECT header FROM req)",
    ),
)
def extra_columns(spark, sf):
    """Columns of raw exports outside the mandatory list."""
    return H.extra_columns(_raw_headers(spark, sf))


def _findings_sql() -> str:
    known = list(dict.fromkeys(C.MINIMUM_CLEANED + C.OPTIONAL_CLEANED + [C.YEAR_LABEL]))
    lists = {
        "mand": list(enumerate(C.MANDATORY_RAW, start=1)),
        "mini": list(enumerate(C.MINIMUM_CLEANED, start=1)),
        "opt": list(enumerate(C.OPTIONAL_CLEANED, start=1)),
        "known": list(enumerate(known, start=1)),
    }
    ctes = [f"{k} AS (SELECT * FROM {_values(v, ['v', 'ord', 'header'])})" for k, v in lists.items()]

    def miss(kind, lst, sev, name):
        return (
            f"SELECT f.file_id, f.kind, '{sev}' AS severity, '{name}' AS finding, CAST(r.ord AS INTEGER) AS ord, r.header "
            f"FROM kinds f CROSS JOIN {lst} r WHERE f.kind = '{kind}' AND NOT EXISTS "
            f"(SELECT 1 FROM fh h WHERE h.file_id = f.file_id AND h.header = r.header)"
        )

    def extra(kind, lst, sev, name):
        return (
            f"SELECT h.file_id, f.kind, '{sev}', '{name}', h.pos, h.header FROM fh h JOIN kinds f ON f.file_id = h.file_id "
            f"WHERE f.kind = '{kind}' AND h.header NOT IN (SELECT header FROM {lst})"
        )

    body = " UNION ALL ".join([
        miss("raw", "mand", "error", "missing_mandatory"),
        extra("raw", "mand", "warning", "extra_column"),
        miss("cleaned", "mini", "error", "missing_minimum"),
        miss("cleaned", "opt", "notice", "missing_optional"),
        extra("cleaned", "known", "info", "unknown_column"),
    ])
    return _h_sql(*_KINDS, *ctes, select=body)


@register("schema_findings", _findings_sql())
def schema_findings(spark, sf):
    """Error, warning, notice and info findings per export."""
    return H.schema_findings(headers_of(spark, sf))


# ---------------------------------------------------------------------------
# Scans and sinks
# ---------------------------------------------------------------------------

from formlens.session import shared_path  # noqa: E402
from formlens.sources import commit, read_cleaned, read_exports, read_rejected, read_store, store_report, write_cleaned  # noqa: E402

_CLEANED_ALL_SELECT = "SELECT * FROM cleaned"


@register("csv_scan_union", _all_sql(select=_CLEANED_ALL_SELECT))
def csv_scan_union(spark, sf):
    """O1-O3: exports written as CSV in two header layouts, scanned back with
    header discovery, harmonised per layout, stacked and cleaned."""
    base = shared_path(spark, "exports")
    dirs = D.write_form_exports(form(spark, sf), base)
    rows, _plan = read_exports(spark, dirs, keep=["respondent_id", "file_id"])
    out = K.build_cleaned(rows, "raw", YEAR, file_col="file_id", keep=["respondent_id", "file_id"])
    return out.withColumns({
        "respondent_id": F.col("respondent_id").cast("bigint"),
        "file_id": F.col("file_id").cast("bigint"),
    })


@register("cleaned_sink_roundtrip", _all_sql(select=_CLEANED_ALL_SELECT))
def cleaned_sink_roundtrip(spark, sf):
    """The stacked cleaned table written partitioned by year and read back."""
    path = write_cleaned(cleaned_all(spark, sf), shared_path(spark, "cleaned"))
    return read_cleaned(spark, path)


@register("stream_intake", _all_sql(select=_CLEANED_ALL_SELECT))
def stream_intake(spark, sf):
    """O1-O4 incrementally: exports picked up by a file stream and cleaned per micro-batch."""
    from formlens.streaming import read_intake, start_intake

    base = shared_path(spark, "stream")
    D.write_form_exports(form(spark, sf), f"{base}/inbox")
    q = start_intake(spark, f"{base}/inbox/*", f"{base}/sink", f"{base}/checkpoint", YEAR,
                     keep=["respondent_id", "file_id"], filter_by_year=False)
    q.awaitTermination()
    out = read_intake(spark, f"{base}/sink")
    return out.select(*[c for c in ["respondent_id", "file_id", *C.CLEANED_NAMES]]).withColumns({
        "respondent_id": F.col("respondent_id").cast("bigint"),
        "file_id": F.col("file_id").cast("bigint"),
    })


@register("intake_year", _year_sql(select="SELECT * FROM cleaned"))
def intake_year(spark, sf):
    """CSV exports in two layouts -> detect, harmonise, validate, filter, build."""
    from formlens.plans.intake import run_intake

    base = shared_path(spark, "intake")
    dirs = D.write_form_exports(form(spark, sf), base)
    res = run_intake(spark, dirs, YEAR, keep=["respondent_id"])
    return res.cleaned.withColumn("respondent_id", F.col("respondent_id").cast("bigint"))


@register("cleaned_csv_roundtrip", _all_sql(select=_CLEANED_ALL_SELECT))
def cleaned_csv_roundtrip(spark, sf):
    """O4 + O12 + O34 (cleaned branch): the stacked cleaned table written as a
    labelled CSV export, detected as ``cleaned``, harmonised and rebuilt."""
    from formlens.plans.intake import run_intake

    path = shared_path(spark, "cleaned-csv")
    write_cleaned(cleaned_all(spark, sf), path, fmt="csv", labels=True)
    res = run_intake(spark, path, YEAR, keep=["respondent_id", "file_id"])
    return res.cleaned.withColumns({
        "respondent_id": F.col("respondent_id").cast("bigint"),
        "file_id": F.col("file_id").cast("bigint"),
    })


@register(
    "year_mismatch",
    Q.with_ctes(
        _FORM, Q.years_cte("form", "ym"),
        select=f"SELECT file_id, analysis_year, {YEAR} AS configured_year FROM ym WHERE analysis_year <> {YEAR}",
    ),
)
def year_mismatch(spark, sf):
    """Q7: exports whose derived analysis year is not the configured year."""
    return M.year_warnings(form(spark, sf), YEAR)


@register("dataframe_intake_year", _year_sql(select="SELECT * FROM cleaned"))
def dataframe_intake_year(spark, sf):
    """The documented flow on an in-memory export: detect, harmonise, filter, build."""
    from formlens.plans.intake import clean_dataframe

    res = clean_dataframe(form(spark, sf), YEAR, keep=["respondent_id"])
    return res.cleaned


# ---------------------------------------------------------------------------
# dates in all shapes
# ---------------------------------------------------------------------------

# shape number -> Spark format of the text, and the time of day (seconds) it stands for; null: not a date
_SHAPES = [
    ("dd/MM/yyyy", 0), ("d/M/yyyy H:mm", 34860), ("dd-MM-yyyy", 0), ("yyyy/MM/dd", 0), ("yyyy-MM-dd'T'HH:mm:ss", 34860 + 7),
    ("yyyy-MM-dd HH:mm:ss.SSS", 34860 + 7), ("d/M/yyyy h:mm:ss 'a. m.'", 34860 + 7), ("d/M/yyyy h:mm:ss 'p. m.'", 34860 + 7 + 43200),
    ("d/M/yy", None), ("yyyy-MM-dd HH:mm:ss", 34860 + 7), ("'31/02/'yyyy", None), ("dd/MM/yyyy HH:mm:ss", 34860 + 7),
]


@register(
    "date_shapes",
    "SELECT o_orderkey AS id, CASE CAST(o_orderkey % 12 AS INTEGER) "
    + " ".join(f"WHEN {i} THEN " + ("NULL" if sec is None else f"CAST(o_orderdate AS DATE) + to_seconds({sec})") for i, (_, sec) in enumerate(_SHAPES))
    + " END AS parsed FROM orders",
)
def date_shapes(spark, sf):
    """Every accepted shape, written from typed dates and parsed back."""
    at = F.col("o_orderdate").cast("date").cast("timestamp_ntz") + F.expr("INTERVAL '0 09:41:07' DAY TO SECOND")
    text = F.lit(None).cast("string")
    for i, (fmt, _) in enumerate(_SHAPES):
        text = F.when(F.col("o_orderkey") % len(_SHAPES) == i, F.date_format(at, fmt)).otherwise(text)
    return D.read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), parse_day_first(text).alias("parsed"))


# ---------------------------------------------------------------------------
# Plan outputs and the structure verdict
# ---------------------------------------------------------------------------

@register(
    "header_changes",
    Q.with_ctes(
        f"plan AS ({_plan_sql('safe')})",
        select="SELECT file_id, pos, header AS old, canonical AS new FROM plan WHERE status = 'renamed' "
               "UNION ALL SELECT file_id, pos, header, NULL FROM plan WHERE status IN ('unmatched', 'conflict')",
    ),
)
def header_changes(spark, sf):
    """The change log, and the headers without a target (``new`` null)."""
    plan = H.header_plan(headers_of(spark, sf))
    return H.change_log(plan).unionByName(H.unmatched_headers(plan).select("file_id", "pos", F.col("header").alias("old"), F.lit(None).cast("string").alias("new")))


@register(
    "structure_check",
    _h_sql(
        f"exp63 AS (SELECT * FROM {_values(list(enumerate(C.RAW_COLUMNS, start=1)), ['e', 'pos', 'expected'])})",
        "own AS (SELECT file_id, list(header ORDER BY pos) AS own FROM fh GROUP BY file_id)",
        "lst AS (SELECT list(expected ORDER BY pos) AS names FROM exp63)",
        "chk AS (SELECT file_id, own, names, list_filter(names, lambda x: NOT list_contains(own, x)) AS missing, "
        "list_filter(own, lambda x: NOT list_contains(names, x)) AS extra FROM own, lst)",
        select="SELECT file_id, len(own) AS n_columns, own = names AS exact, len(missing) AS n_missing, len(extra) AS n_extra, "
               "array_to_string(missing, ' | ') AS missing, array_to_string(extra, ' | ') AS extra FROM chk",
    ),
)
def structure_check(spark, sf):
    """Whether each export has exactly the 63 columns in order, and what differs."""
    return H.structure_check(headers_of(spark, sf))


# ---------------------------------------------------------------------------
# intake of awkward and mixed files, sink and metrics over several inputs
# ---------------------------------------------------------------------------

_DIRTY = ["stratum", "neighbourhood", "marital_status", "estate", "campus", "semester"]


@register(
    "intake_dirty_files",
    _all_sql(select="SELECT respondent_id, stratum, "
             f"CASE WHEN respondent_id % 5 = 4 THEN {Q.sql_str(C.FILL_VALUE)} ELSE neighbourhood END AS neighbourhood, "
             "marital_status, estate, campus, semester FROM cleaned"),
)
def intake_dirty_files(spark, sf):
    """Files with a blank first line, a line break in a header, another
    separator, names with blanks and accents, and a drifted identifier where
    the neighbourhood is missing (it must not take its place)."""
    from formlens.plans.intake import run_intake

    base = shared_path(spark, "dirty")
    f = form(spark, sf)
    part = lambda i: f.where(F.col("respondent_id") % 5 == i)
    drifted = part(4).drop("Barrio de residencia").withColumnRenamed("Dirección de residencia", "Dirección de la residencia")
    D.write_lines(part(0), f"{base}/comma/blank", before="\n")
    D.write_lines(part(1), f"{base}/comma/broken", rename={"Estado civil": "Estado\ncivil"})
    D.write_lines(part(2), f"{base}/semicolon", sep=";")
    D.write_lines(part(3), f"{base}/comma/Año 2025 (última)")
    D.write_lines(drifted, f"{base}/comma/drifted")
    out = [
        run_intake(spark, f"{base}/comma/*", YEAR, keep=["respondent_id"], filter_by_year=False, strict=False),
        run_intake(spark, f"{base}/semicolon", YEAR, keep=["respondent_id"], filter_by_year=False, options={"sep": ";"}),
    ]
    rows = out[0].cleaned.unionByName(out[1].cleaned)
    return rows.select(F.col("respondent_id").cast("bigint").alias("respondent_id"), *_DIRTY)


def _mixed(spark, sf):
    """Raw exports, cleaned exports with a year column, and cleaned ones without, by file_id."""
    from formlens.plans.intake import run_intake

    base = shared_path(spark, "mixed")
    f, c = form(spark, sf), cleaned_all(spark, sf)
    D.write_lines(f.where(F.col("file_id") % 3 == 0), f"{base}/raw")
    write_cleaned(c.where(F.col("file_id") % 3 == 1), f"{base}/with_year", fmt="csv", labels=True, partition_by=None)
    write_cleaned(c.where(F.col("file_id") % 3 == 2).drop("analysis_year"), f"{base}/without", fmt="csv", labels=True, partition_by=None)
    return run_intake(spark, f"{base}/*", YEAR, keep=["respondent_id", "file_id"], filter_by_year=False)


@register(
    "intake_mixed_layouts",
    _all_sql(select="SELECT * REPLACE (CAST(CASE WHEN file_id % 3 = 2 THEN 1998 ELSE analysis_year END AS INTEGER) AS analysis_year) FROM cleaned"),
)
def intake_mixed_layouts(spark, sf):
    """Raw and cleaned exports in one scan; files without a year column get the configured one."""
    return _mixed(spark, sf).cleaned.withColumns({n: F.col(n).cast("bigint") for n in ("respondent_id", "file_id")})


_MIXED_BASES = [(C.QUALITY_BASE_RAW, "file_id % 3 = 0", len([h for h in D.FORM_HEADERS])), (C.QUALITY_BASE_CLEANED, "file_id % 3 <> 0", len(C.CLEANED_COLUMNS))]


def _mixed_summary_sql() -> str:
    lines = [(C.QUALITY_LABELS[k].format(base=base), f"(SELECT count(*) FROM cleaned WHERE {cond})" if k == 0 else str(n))
             for base, cond, n in _MIXED_BASES for k in (0, 1)]
    lines += list(zip(C.QUALITY_LABELS[2:], ["(SELECT count(*) FROM cleaned)", str(len(C.CLEANED_NAMES)),
                                             "(SELECT count(birth_date) FROM cleaned)", "(SELECT count(age) FROM cleaned)"]))
    return " UNION ALL ".join(f"SELECT {i} AS ord, {Q.sql_str(label)} AS indicator, CAST({v} AS BIGINT) AS value" for i, (label, v) in enumerate(lines, start=1))


@register("quality_summary_mixed", _all_sql(select=_mixed_summary_sql()))
def quality_summary_mixed(spark, sf):
    """Each kind's own input rows and columns, then the result."""
    return _mixed(spark, sf).summary


@register(
    "intake_counts",
    Q.with_ctes(
        _FORM, _FILTERED,
        "fc AS (SELECT count(*) AS total, count(*) FILTER (WHERE d IS NULL) AS null_or_invalid, "
        f"count(*) FILTER (WHERE d IS NOT NULL AND NOT {Q.in_year('d', YEAR)}) AS other_year, count(*) FILTER (WHERE {Q.in_year('d', YEAR)}) AS kept "
        f"FROM (SELECT {_d_filled} AS d FROM form))",
        "lb AS (SELECT count(b) AS non_null, count(d) AS parsed, count(*) FILTER (WHERE b IS NOT NULL AND d IS NULL) AS lost "
        f"FROM (SELECT {Q.q(C.BIRTH_LABEL)} AS b, {Q.parse_day_first(Q.q(C.BIRTH_LABEL))} AS d FROM filtered))",
        select="SELECT 'filter' AS what, name, n FROM (UNPIVOT fc ON COLUMNS(*) INTO NAME name VALUE n) "
               "UNION ALL SELECT 'birth', name, n FROM (UNPIVOT lb ON COLUMNS(*) INTO NAME name VALUE n)",
    ),
)
def intake_counts(spark, sf):
    """O23, O24 in the flow: the four counts of the year filter, and the birth dates lost."""
    from formlens.plans.intake import run_intake

    base = shared_path(spark, "counts")
    res = run_intake(spark, D.write_form_exports(form(spark, sf), base), YEAR)
    long = lambda df, what, names: df.select(F.lit(what).alias("what"), F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("long").alias("n")) for n in names])))
    lost = res.date_losses.where(F.col("date_column") == C.BIRTH_LABEL)
    return long(res.year_counts, "filter", ["total", "null_or_invalid", "other_year", "kept"]).unionByName(long(lost, "birth", ["non_null", "parsed", "lost"]))


@register("sink_two_years", _all_sql(select=_CLEANED_ALL_SELECT))
def sink_two_years(spark, sf):
    """Two writes of different years to one path; the second keeps the first's."""
    path = shared_path(spark, "two-years")
    c = cleaned_all(spark, sf)
    early = F.coalesce(F.col("analysis_year"), F.lit(0)) < 1995
    write_cleaned(c.where(early), path)
    write_cleaned(c.where(~early), path)
    return read_cleaned(spark, path).select("respondent_id", "file_id", *C.CLEANED_NAMES)


@register("sink_same_year_twice", _all_sql(select=_CLEANED_ALL_SELECT))
def sink_same_year_twice(spark, sf):
    """Several exports of each year in three deliveries: an early, partial one
    of the first half, then the other half, then the first half in full, which
    replaces its own rows only."""
    store = shared_path(spark, "store")
    c = cleaned_all(spark, sf)
    half = F.col("respondent_id") % 2
    rows = c.withColumn("delivered_as", F.concat_ws("-", F.lit("export"), "file_id", half.cast("string")))
    for part in (rows.where(half == 0).where(F.col("respondent_id") % 3 == 0), rows.where(half == 1), rows.where(half == 0)):
        files = part.select(F.col("delivered_as").alias("export")).distinct().withColumns({"length": F.lit(None).cast("long"), "modified": F.lit(None).cast("timestamp")})
        commit(spark, store, part, files, export="delivered_as")
    return read_store(spark, store).select("respondent_id", "file_id", *C.CLEANED_NAMES)


def _deliveries(spark, sf, name):
    """A folder of form exports that grows: a function that adds a part of them, and one that brings the store up to date."""
    from formlens.plans.delivery import sync_exports

    base = shared_path(spark, name)
    f = form(spark, sf)
    add = lambda i, folder, change=lambda df: df: D.write_lines(change(f.where(F.col("file_id") % 3 == i)), f"{base}/in/{folder}")
    sync = lambda: sync_exports(spark, f"{base}/in/*", f"{base}/store", YEAR, keep=["respondent_id", "file_id"], filter_by_year=False, glob="part-*")
    return add, sync, f"{base}/store"


def _typed_keys(df):
    return df.withColumns({n: F.col(n).cast("bigint") for n in ("respondent_id", "file_id")})


@register(
    "intake_quarantine",
    _all_sql(select="SELECT respondent_id, estate, CAST(NULL AS VARCHAR) AS finding, CAST(NULL AS VARCHAR) AS header FROM cleaned WHERE file_id % 3 <> 1 "
                    "UNION ALL SELECT NULL, NULL, 'missing_mandatory', 'Estamento' WHERE EXISTS (SELECT 1 FROM form WHERE file_id % 3 = 1)"),
)
def intake_quarantine(spark, sf):
    """O19-O22 in a running intake: files that lack a mandatory column become dead
    letters with their findings, all others go to the store."""
    add, sync, store = _deliveries(spark, sf, "quarantine")
    add(0, "sound")
    add(1, "broken", lambda df: df.drop("Estamento"))
    add(2, "later")
    sync()
    rows = _typed_keys(read_store(spark, store)).select("respondent_id", "estate", F.lit(None).cast("string").alias("finding"), F.lit(None).cast("string").alias("header"))
    letters = read_rejected(spark, store).select("finding", "header").distinct()
    return rows.unionByName(letters, allowMissingColumns=True)


@register("intake_incremental", _all_sql(select=_CLEANED_ALL_SELECT))
def intake_incremental(spark, sf):
    """O2 again and again: each run reads only files that the store does not have; the last one none."""
    add, sync, store = _deliveries(spark, sf, "incremental")
    read = []
    for i, folder in ((0, "first"), (1, "second"), (2, "third"), (None, None)):
        if folder:
            add(i, folder)
        done = sync()
        read.append((done.listed, done.read))
    if [new for _, new in read] != [n - before for (n, _), before in zip(read, [0, *(n for n, _ in read)])]:
        raise AssertionError(f"files listed and read by each run: {read}")
    return _typed_keys(read_store(spark, store)).select("respondent_id", "file_id", *C.CLEANED_NAMES)


def _typed(df: DataFrame) -> DataFrame:
    """A later layout: upper-case headers, dates as dates, the semester as a number."""
    dates = {h: parse_day_first(col_of(h)) for h in (C.SUBMITTED_LABEL, C.FILLED_LABEL)}
    dates[C.BIRTH_LABEL] = parse_day_first(col_of(C.BIRTH_LABEL)).cast("date")
    typed = df.withColumns(dates).withColumn(C.SEMESTER_LABEL, coerce_number(col_of(C.SEMESTER_LABEL)))
    return typed.withColumnsRenamed({h: h.upper() for h in df.columns if h not in ("file_id", "respondent_id")})


@register("parquet_layouts", _year_sql(select="SELECT * FROM cleaned"))
def parquet_layouts(spark, sf):
    """O1, O3: Parquet exports in three layouts of differing columns and types, stacked and filtered by year."""
    from formlens.plans.parquet_intake import run_parquet_intake

    base = shared_path(spark, "parquet")
    f = form(spark, sf)
    part = lambda i: f.where(F.col("file_id") % 3 == i)
    part(0).write.parquet(f"{base}/text")
    _typed(part(1)).write.parquet(f"{base}/typed")
    part(2).select(*map(col_of, reversed(f.columns))).withColumn("file_id", F.col("file_id").cast("string")).write.parquet(f"{base}/other_order")
    return run_parquet_intake(spark, f"{base}/*", YEAR, keep=["respondent_id"]).cleaned


@register("report_incremental", _all_sql(*_suite_sql("form", True), select="SELECT * FROM suite WHERE ord > 0"))
def report_incremental(spark, sf):
    """O39-O44 kept up to date: the suite from the added-up counts of two deliveries."""
    add, sync, store = _deliveries(spark, sf, "reports")
    add(0, "first")
    sync()
    add(1, "second")
    add(2, "third")
    sync()
    return store_report(spark, store).where("ord > 0")


def _auto_hist_sql() -> list[str]:
    parts = _hist_sql(False)
    parts[0] = "hc AS (SELECT analysis_year AS year, age AS x, count(*) AS c FROM aged WHERE age IS NOT NULL GROUP BY ALL)"
    parts[1] = "hs AS (SELECT min(x) AS mn, max(x) AS mx, count(DISTINCT x) AS nd, (SELECT count(DISTINCT analysis_year) FROM aged) AS ny FROM hc)"
    parts[2] = parts[2].replace("CAST(least", f"CAST(CASE WHEN ny > 1 THEN {C.HIST_MAX_BINS} ELSE least").replace("nd)) AS INTEGER) AS nb", "nd)) END AS INTEGER) AS nb")
    return ["aged AS (SELECT analysis_year, CASE WHEN analysis_year = 1996 AND age < 17 THEN age END AS age FROM cleaned)", *parts]


@register("age_histogram_auto", _all_sql(*_auto_hist_sql(), select=_HIST_SELECT))
def age_histogram_auto(spark, sf):
    """By year or not is decided over all rows, also of years without any age."""
    c = cleaned_all(spark, sf).select("analysis_year", F.when((F.col("analysis_year") == 1996) & (F.col("age") < 17), F.col("age")).alias("age"))
    return R.age_histogram(c)
