"""DuckDB SQL text for the oracle side of every query.

These helpers emit the same rules as ``formlens.functions`` in DuckDB's
dialect (RE2 regexes, ``try_strptime``, ``date_diff``), so each query in
the catalogue has an independent SQL statement to be compared with.
"""

from __future__ import annotations

from formlens import config as C
from formlens.functions.dates import DMY_RE, ISO_RE
from formlens.functions.numbers import NUM_RE
from formlens.functions.text import WS_RE2
from formlens.plans.derived import sql_str, survey_form_sql


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_RE2}+|{WS_RE2}+$', '', 'g')"


def clean_category(x: str, fill: str = C.FILL_VALUE) -> str:
    return f"coalesce(nullif(trim(regexp_replace(CAST({x} AS VARCHAR), '{WS_RE2}+', ' ', 'g')), ''), {sql_str(fill)})"


def strip_category(x: str, fill: str = C.FILL_VALUE) -> str:
    return f"coalesce(nullif({strip_ws(f'CAST({x} AS VARCHAR)')}, ''), {sql_str(fill)})"


def parse_day_first(x: str) -> str:
    """The usual shapes only: what the derived form holds (other shapes: query ``date_shapes``)."""
    s = strip_ws(f"CAST({x} AS VARCHAR)")
    day = f"split_part({s}, ' ', 1)"
    tpart = f"split_part({s}, ' ', 2)"
    secs = (
        f"CASE WHEN contains({s}, ' ') THEN "
        f"TRY_CAST(split_part({tpart}, ':', 1) AS INTEGER) * 3600 + "
        f"TRY_CAST(split_part({tpart}, ':', 2) AS INTEGER) * 60 + "
        f"TRY_CAST(split_part({tpart}, ':', 3) AS INTEGER) ELSE 0 END"
    )
    date = (
        f"CASE WHEN regexp_full_match({s}, '{DMY_RE}') THEN CAST(try_strptime({day}, '%d/%m/%Y') AS DATE) "
        f"WHEN regexp_full_match({s}, '{ISO_RE}') THEN CAST(try_strptime({day}, '%Y-%m-%d') AS DATE) END"
    )
    return f"(CAST({date} AS TIMESTAMP) + to_seconds(CAST({secs} AS BIGINT)))"


def coerce_number(x: str) -> str:
    return f"CASE WHEN regexp_full_match(CAST({x} AS VARCHAR), '{NUM_RE}') THEN TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE) END"


def year_end(y: str) -> str:
    return f"make_timestamp(CAST({y} AS BIGINT), 12, 31, 0, 0, 0)"


def age_at_year_end(b: str, y: str) -> str:
    cutoff = year_end(y)
    return (
        f"CASE WHEN {b} <= {cutoff} THEN CAST(floor(floor(date_diff('microsecond', {b}, {cutoff}) / 86400000000.0) / 365.25) AS DOUBLE) END"
    )


def in_year(ts: str, year: int) -> str:
    return f"({ts} >= TIMESTAMP '{year:04d}-01-01 00:00:00' AND {ts} < TIMESTAMP '{year + 1:04d}-01-01 00:00:00')"


# ---------------------------------------------------------------------------
# CTE builders
# ---------------------------------------------------------------------------

def form_cte() -> str:
    return f"form AS (\n{survey_form_sql()}\n)"


def filtered_cte(year: int, source: str = "form", name: str = "filtered") -> str:
    d = parse_day_first(q(C.FILLED_LABEL))
    return f"{name} AS (SELECT * FROM {source} WHERE {in_year(d, year)})"


def years_cte(source: str, name: str = "years") -> str:
    y = f"year({parse_day_first(q(C.SUBMITTED_LABEL))})"
    return (
        f"{name}_counts AS (SELECT file_id, {y} AS y, count(*) AS n FROM {source} WHERE {y} IS NOT NULL GROUP BY ALL),\n"
        f"{name} AS (SELECT file_id, CAST(y AS INTEGER) AS analysis_year FROM {name}_counts "
        f"QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY n DESC, y ASC) = 1)"
    )


def cleaned_cte(source: str, year: int, name: str = "cleaned", keep: list[str] | None = None) -> str:
    """Raw-kind cleaned table over ``source`` (35 columns, internal names)."""
    keep = keep or []
    mapped = {C.LABEL_TO_NAME[clean]: raw for raw, clean in C.RAW_TO_CLEANED.items()}
    staged_cols = [f"CAST(coalesce(yy.analysis_year, {int(year)}) AS INTEGER) AS analysis_year"]
    staged_cols += [f"s.{k}" for k in keep]
    staged_cols.append(f"{parse_day_first('s.' + q(C.BIRTH_LABEL))} AS birth_date")
    body = [*[k for k in keep], "analysis_year", "birth_date",
            f"{age_at_year_end('birth_date', 'analysis_year')} AS age"]
    for n in C.CLEANED_NAMES[3:]:
        raw = mapped[n]
        if n == "semester":
            body.append(f"{coerce_number(clean_category('s_' + n))} AS {n}")
        else:
            body.append(f"{clean_category('s_' + n)} AS {n}")
        staged_cols.append(f"s.{q(raw)} AS s_{n}")
    return (
        f"{years_cte(source, name + '_years')},\n"
        f"{name}_staged AS (SELECT {', '.join(staged_cols)} FROM {source} s LEFT JOIN {name}_years yy ON s.file_id = yy.file_id),\n"
        f"{name} AS (SELECT {', '.join(body)} FROM {name}_staged)"
    )


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
