"""Header and schema operators over a header table.

Input is ``headers(file_id, pos, header)``: one row per column per export,
1-based positions.  ``by_file`` brings the headers of each export together
once (one shuffle; an export has at most a few hundred columns), with what
the configuration knows about each of them.  Every operator then works on
that row alone, so kinds, differences, plans and findings need no further
shuffle, and all of them can share one ``by_file`` table.

Python is used for header normalisation (NFKD) and for fuzzy matching, in
Arrow batches.  Both remember the distinct texts that a worker has seen.
The only broadcast is the table of known headers, which is fixed
configuration.
"""

from __future__ import annotations

import difflib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlens import config as C
from formlens.functions import normalize_header, normalize_text
from formlens.operators.common import UNNAMED_RE

# Expected header list used for harmonisation, per detected file kind: raw
# exports are matched to the mandatory headers plus the submission
# timestamp (the build reads it for the analysis year).
TARGETS = {"raw": C.MANDATORY_RAW + [C.SUBMITTED_LABEL], "cleaned": C.CLEANED_COLUMNS}

# Required sets for file-kind detection, in rule order.
KIND_RULES = {
    "markers": C.RAW_MARKERS,
    "raw_mandatory": C.MANDATORY_RAW,
    "cleaned_min": C.MINIMUM_CLEANED,
}

# A fuzzy match to a column that itself resembles an identifier needs this score.
NEAR_IDENTIFIER_CUTOFF = 0.90


# ---------------------------------------------------------------------------
# known headers (computed once from configuration)
# ---------------------------------------------------------------------------

def norm_map(headers: list[str]) -> dict[str, str]:
    """``{normalised: spelling}``: first occurrence fixes the order, last spelling wins."""
    return {normalize_text(h): h for h in headers}


ALIAS_ROWS = [(spelling, canonical) for canonical, variants in C.ALIASES.items() for spelling in (*variants, canonical)]
ALIAS_OF = {normalize_text(spelling): canonical for spelling, canonical in ALIAS_ROWS}
IDENTIFIER_NORMS = [normalize_text(h) for h in C.IDENTIFIER_RAW]

_EXPECTED = {target: norm_map(headers) for target, headers in TARGETS.items()}
_RULES = {rule: set(norm_map(headers)) for rule, headers in KIND_RULES.items()}

FACTS = "header_norm string, marker int, raw_mandatory int, cleaned_min int, resolved string, raw struct<canonical:string,layer:string>, cleaned struct<canonical:string,layer:string>"


def _claim(norm: str, target: str) -> tuple[str, str] | None:
    """Canonical name by an exact or alias match, with its layer."""
    if norm in _EXPECTED[target]:
        return _EXPECTED[target][norm], "exact"
    canonical = ALIAS_OF.get(norm)
    return (canonical, "alias") if canonical in TARGETS[target] else None


def known_headers(spark: SparkSession) -> DataFrame:
    """What the configuration knows about each normalised header (a few hundred fixed rows)."""
    norms = sorted({*ALIAS_OF, *(n for names in (*_EXPECTED.values(), *_RULES.values()) for n in names)})
    rows = []
    for n in norms:
        resolved = normalize_text(ALIAS_OF[n]) if n in ALIAS_OF else n
        rows.append((n, *(int(n in _RULES[r]) for r in KIND_RULES), resolved if resolved in _RULES["cleaned_min"] else None, _claim(n, "raw"), _claim(n, "cleaned")))
    return spark.createDataFrame(rows, FACTS)


# ---------------------------------------------------------------------------
# O6-O8
# ---------------------------------------------------------------------------

def normalise_headers(headers: DataFrame) -> DataFrame:
    """Add ``header_norm`` (strip, NFKD, no marks, collapsed spaces, lower)."""
    if "header_norm" in headers.columns:
        return headers
    return headers.withColumn("header_norm", normalize_header(F.col("header")))


def by_file(headers: DataFrame) -> DataFrame:
    """One row per export: ``file_id``, ``cells`` (position, header, normalised
    header and what is known of it, in order) and ``kind`` (O12)."""
    if "cells" in headers.columns:
        return headers
    known = F.broadcast(known_headers(headers.sparkSession))
    cell = F.struct("pos", "header", "header_norm", "marker", "raw_mandatory", "cleaned_min", "resolved", "raw", "cleaned")
    cells = normalise_headers(headers).join(known, "header_norm", "left").groupBy("file_id").agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    return cells.withColumns(_counts()).withColumn("kind", _kind())


def _norms(cells: Column, keep) -> Column:
    return F.array_distinct(F.transform(F.filter(cells, keep), lambda c: c.header_norm))


def _counts() -> dict[str, Column]:
    cells = F.col("cells")
    sized = lambda keep: F.size(_norms(cells, keep)).cast("long")
    resolved = F.array_distinct(F.transform(F.filter(cells, lambda c: c.resolved.isNotNull()), lambda c: c.resolved))
    return {
        "n_markers": sized(lambda c: c.marker == 1),
        "n_raw_mandatory": sized(lambda c: c.raw_mandatory == 1),
        "n_cleaned_min": sized(lambda c: c.cleaned_min == 1),
        "n_cleaned_alias": F.size(resolved).cast("long"),
    }


def _kind() -> Column:
    size = {rule: len(norms) for rule, norms in _RULES.items()}
    return (
        F.when(F.col("n_markers") == size["markers"], "raw")
        .when(F.col("n_raw_mandatory") == size["raw_mandatory"], "raw")
        .when(F.col("n_cleaned_min") == size["cleaned_min"], "cleaned")
        .when(F.col("n_cleaned_alias") == size["cleaned_min"], "cleaned")
        .otherwise("unknown")
    )


def header_catalogue(headers: DataFrame) -> DataFrame:
    """Every header with its 1-based position and the file's column count."""
    w = Window.partitionBy("file_id")  # at most a few hundred rows per file
    return headers.select("file_id", "pos", "header", F.count(F.lit(1)).over(w).alias("n_columns"))


def drop_unnamed(headers: DataFrame) -> DataFrame:
    """Remove empty-header columns (``Unnamed: N`` or CSV ``_cN``)."""
    return headers.where(~F.col("header").rlike(UNNAMED_RE))


# ---------------------------------------------------------------------------
# O9, O10
# ---------------------------------------------------------------------------

def _literals(rows: list[tuple], names: list[str]) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])


_SCHEMAS = {schema: norm_map(names) for schema, names in C.EXPECTED_SCHEMAS.items()}


def _places(spark: SparkSession) -> DataFrame:
    """Of each expected name, its place in each expected schema (a few hundred fixed rows)."""
    at = [{n: i for i, n in enumerate(expected, start=1)} for expected in _SCHEMAS.values()]
    norms = dict.fromkeys(n for names in at for n in names)
    return spark.createDataFrame([(n, *(names.get(n) for names in at)) for n in norms], ", ".join(["header_norm string", *(f"place{k} int" for k in range(len(at)))]))


def _compared(headers: DataFrame) -> DataFrame:
    """One row per file with three arrays for each schema ``k``: ``matched{k}`` and
    ``missing{k}``, places in the schema; ``extra{k}``, (pos, header) of other names.

    Names are looked up by one join and places by hashing, so the work of a
    file grows with its headers alone.
    """
    if "cells" in headers.columns:
        headers = headers.select("file_id", F.inline("cells")).select("file_id", "pos", "header", "header_norm")
    places = [f"place{k}" for k in range(len(_SCHEMAS))]
    named = normalise_headers(headers).join(F.broadcast(_places(headers.sparkSession)), "header_norm", "left")
    files = named.groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct("header_norm", "pos", "header", *places))).alias("c"))
    # equal names are neighbours: the first one has the position, the last one the spelling
    first = F.filter("c", lambda c, i: (i == 0) | (F.get("c", i - 1).header_norm != c.header_norm))
    last = F.filter("c", lambda c, i: (i == F.size("c") - 1) | (F.get("c", i + 1).header_norm != c.header_norm))
    files = files.select("file_id", "c", first.alias("first"))
    twice = F.size("first") < F.size("c")
    files = files.select("file_id", "first", F.when(twice, last).otherwise(F.col("first")).alias("last"))

    def against(k: int, size: int) -> list[Column]:
        known, own = F.array(*[F.lit(i) for i in range(1, size + 1)]), F.col("first")[places[k]]
        cells = F.transform("first", lambda c, i: F.struct(c[places[k]].alias("place"), c.pos.alias("pos"), F.get("last", i).header.alias("header")))
        extra = F.filter(cells, lambda c: c.place.isNull())
        return [F.array_intersect(known, own).alias(f"matched{k}"), F.array_except(known, own).alias(f"missing{k}"), extra.alias(f"extra{k}")]

    return files.select("file_id", *[c for k, expected in enumerate(_SCHEMAS.values()) for c in against(k, len(expected))])


def schema_diff(headers: DataFrame) -> DataFrame:
    """Per file and schema, matched, missing and extra headers.

    ``(file_id, schema, status, ord, header)``: matches and missing carry the
    expected spelling and order, extras the file's (last) spelling and first
    position.  Comparison is on normalised names.
    """

    def parts(k: int, schema: str, expected: dict[str, str]) -> list[Column]:
        spelled = F.array(*[F.lit(h) for h in expected.values()])
        row = lambda status, ord, header: F.struct(F.lit(schema).alias("schema"), F.lit(status).alias("status"), ord.alias("ord"), header.alias("header"))
        return [F.transform(f"matched{k}", lambda i: row("match", i, F.get(spelled, i - 1))), F.transform(f"missing{k}", lambda i: row("missing", i, F.get(spelled, i - 1))),
                F.transform(f"extra{k}", lambda c: row("extra", c.pos, c.header))]

    return _compared(headers).select("file_id", F.inline(F.concat(*[p for k, (schema, expected) in enumerate(_SCHEMAS.items()) for p in parts(k, schema, expected)])))


def schema_conformance(headers: DataFrame) -> DataFrame:
    """``matched of expected``, missing and extra counts per file and schema."""
    rows = [F.struct(F.lit(schema).alias("schema"), *[F.size(f"{a}{k}").cast("long").alias(f"n_{a}") for a in ("matched", "missing", "extra")],
                     F.lit(len(expected)).cast("long").alias("n_expected")) for k, (schema, expected) in enumerate(_SCHEMAS.items())]
    return _compared(headers).select("file_id", F.inline(F.array(*rows)))


# ---------------------------------------------------------------------------
# O11, O12
# ---------------------------------------------------------------------------

def file_kinds(headers: DataFrame) -> DataFrame:
    """``raw``, ``cleaned`` or ``unknown`` per file (first rule that holds)."""
    return by_file(headers).select("file_id", "kind", "n_markers", "n_raw_mandatory", "n_cleaned_min", "n_cleaned_alias")


# ---------------------------------------------------------------------------
# harmonisation
# ---------------------------------------------------------------------------

def _ratio(expected: str, norm: str) -> float:
    return difflib.SequenceMatcher(None, expected, norm).ratio()


@lru_cache(maxsize=100_000)
def fuzzy_best(norm: str, target: str, cutoff: float = C.FUZZY_CUTOFF) -> tuple[str | None, float | None, bool]:
    """difflib's closest expected header (n=1), its ratio, and whether it must
    not be used: an identifier is as close as that header, or that header
    resembles an identifier and the match is not a near-equal one."""
    hits = difflib.get_close_matches(norm, list(_EXPECTED[target]), n=1, cutoff=cutoff)
    if not hits:
        return None, None, False
    score = _ratio(hits[0], norm)
    unsafe = any(_ratio(i, norm) >= score for i in IDENTIFIER_NORMS) or (
        score < NEAR_IDENTIFIER_CUTOFF and any(_ratio(i, hits[0]) >= cutoff for i in IDENTIFIER_NORMS))
    return _EXPECTED[target][hits[0]], score, unsafe


def _fuzzy_frame(norms: pd.Series, targets: pd.Series) -> pd.DataFrame:
    found = [fuzzy_best(n, t) if n is not None else (None, None, None) for n, t in zip(norms, targets)]
    return pd.DataFrame(found, columns=["canonical", "score", "unsafe"]).astype({"score": "float64"})


_fuzzy_udf = F.pandas_udf(_fuzzy_frame, T.StructType([
    T.StructField("canonical", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("unsafe", T.BooleanType())]))


def candidates(headers: DataFrame) -> DataFrame:
    """Candidate canonical name per header, with its layer.

    ``(file_id, pos, header, header_norm, target, canonical, layer, score,
    unsafe)``.  Only headers without an exact or alias match are matched
    fuzzily.  Files of unknown kind have no target and are left out.
    """
    cells = by_file(headers).where(F.col("kind").isin(*TARGETS)).select("file_id", F.col("kind").alias("target"), F.inline("cells"))
    claim = F.when(F.col("target") == "raw", F.col("raw")).otherwise(F.col("cleaned"))
    claimed = cells.withColumns({"canonical": claim["canonical"], "layer": claim["layer"]})
    fuzzy = claimed.withColumn("fz", _fuzzy_udf(F.when(F.col("canonical").isNull(), F.col("header_norm")), F.col("target")))
    return fuzzy.select(
        "file_id", "pos", "header", "header_norm", "target",
        F.coalesce("canonical", "fz.canonical").alias("canonical"),
        F.when(F.col("canonical").isNotNull(), F.col("layer")).when(F.col("fz.canonical").isNotNull(), F.lit("fuzzy")).alias("layer"),
        F.col("fz.score").alias("score"),
        F.coalesce("fz.unsafe", F.lit(False)).alias("unsafe"),
    )


def header_plan(headers: DataFrame, mode: str = "safe") -> DataFrame:
    """One-to-one rename plan per file.

    ``greedy`` gives a canonical to the first claimant in file order, as a
    column-by-column loop would.  ``safe`` (default) lets exact and alias
    claims win over fuzzy ones, and drops fuzzy matches that could turn an
    identifier column into a cleaned one (see ``fuzzy_best``).
    Output ``(file_id, pos, header, canonical, layer, status)`` with status
    ``unchanged``, ``renamed``, ``unmatched`` or ``conflict``.
    """
    if mode not in ("safe", "greedy"):
        raise ValueError(f"unknown mode {mode!r}")
    cand = candidates(headers)
    order = [F.col("pos")]
    if mode == "safe":
        cand = cand.withColumns({n: F.when(~F.col("unsafe"), F.col(n)) for n in ("canonical", "layer")})
        order = [F.when(F.col("layer") == "fuzzy", 1).otherwise(0), *order]
    w = Window.partitionBy("file_id", "canonical").orderBy(*order)  # claimants of one name in one file
    ranked = cand.withColumn("claim", F.when(F.col("canonical").isNotNull(), F.row_number().over(w)))
    won = F.col("claim") == 1
    return ranked.select(
        "file_id", "pos", "header",
        F.when(won, F.col("canonical")).alias("canonical"),
        F.when(won, F.col("layer")).alias("layer"),
        F.when(F.col("canonical").isNull(), F.lit("unmatched"))
        .when(~won, F.lit("conflict"))
        .when(F.col("canonical") == F.col("header"), F.lit("unchanged"))
        .otherwise(F.lit("renamed")).alias("status"),
    )


def harmonised_headers(plan: DataFrame) -> DataFrame:
    """Header table after renaming: ``(file_id, pos, header)``."""
    return plan.select("file_id", "pos", F.coalesce("canonical", "header").alias("header"))


def change_log(plan: DataFrame) -> DataFrame:
    """(old, new) pairs that differ."""
    return plan.where(F.col("status") == "renamed").select("file_id", "pos", F.col("header").alias("old"),
                                                            F.col("canonical").alias("new"))


def unmatched_headers(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("status").isin("unmatched", "conflict")).select("file_id", "pos", "header")


# ---------------------------------------------------------------------------
# Exact checks and findings
# ---------------------------------------------------------------------------

def position_differences(headers: DataFrame, expected: list[str] | None = None, first: int = 5) -> DataFrame:
    """The first position differences against the exact raw order.

    Pairs positions like ``zip`` (up to the shorter list) and keeps the
    first ``first`` differing positions per file.
    """
    names = F.array(*[F.lit(h) for h in expected or C.RAW_COLUMNS])
    pairs = F.transform(F.filter("cells", lambda c: c.pos <= F.size(names)), lambda c: F.struct(
        c.pos.alias("pos"), F.element_at(names, c.pos).alias("expected"), c.header.alias("actual")))
    return by_file(headers).select("file_id", F.inline(F.slice(F.filter(pairs, lambda p: p.expected != p.actual), 1, first)))


def structure_check(headers: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """The verdict per file against the exact list and order.

    ``(file_id, n_columns, exact, n_missing, n_extra, missing, extra)``:
    exact names that are absent, in expected order, and names outside the
    list, in file order, joined by `` | ``.
    """
    names = F.array(*[F.lit(h) for h in expected or C.RAW_COLUMNS])
    files = by_file(headers).withColumn("own", F.transform("cells", lambda c: c.header))
    missing, extra = F.array_except(names, F.col("own")), F.filter("own", lambda h: ~F.array_contains(names, h))
    return files.select(
        "file_id", F.size("own").cast("long").alias("n_columns"), (F.col("own") == names).alias("exact"),
        F.size(missing).cast("long").alias("n_missing"), F.size(extra).cast("long").alias("n_extra"),
        F.array_join(missing, " | ").alias("missing"), F.array_join(extra, " | ").alias("extra"),
    )


def _absent(rows: Column, own: Column) -> Column:
    return F.filter(rows, lambda e: ~F.array_contains(own, e.header))


def required_missing(headers: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Required headers (exact names) absent from each file."""
    rows = _literals(list(enumerate(required or C.MANDATORY_RAW, start=1)), ["ord", "header"])
    own = F.transform("cells", lambda c: c.header)
    return by_file(headers).select("file_id", F.inline(_absent(rows, own)))


def extra_columns(headers: DataFrame, reference: list[str] | None = None) -> DataFrame:
    """Headers outside the reference list (exact names), in file order."""
    names = F.array(*[F.lit(h) for h in dict.fromkeys(reference or C.MANDATORY_RAW)])
    extra = F.filter("cells", lambda c: ~F.array_contains(names, c.header))
    return by_file(headers).select("file_id", F.inline(F.transform(extra, lambda c: F.struct(c.pos.alias("pos"), c.header.alias("header")))))


def schema_findings(headers: DataFrame) -> DataFrame:
    """Findings per file as ``(file_id, kind, severity, finding, ord, header)``.

    Raw files: ``error`` for a missing mandatory header, ``warning`` for
    every other column.  Cleaned files: ``error`` for a missing minimum
    column, ``notice`` for a missing optional one, ``info`` for unknown
    columns (left out of the output).  Exact names, as the build needs them.
    """
    own = F.transform("cells", lambda c: c.header)

    def found(severity: str, finding: str, rows: Column, place: str) -> Column:
        return F.transform(rows, lambda e: F.struct(F.lit(severity).alias("severity"), F.lit(finding).alias("finding"), e[place].alias("ord"), e.header.alias("header")))

    def missing(severity: str, finding: str, names: list[str]) -> Column:
        return found(severity, finding, _absent(_literals(list(enumerate(names, start=1)), ["ord", "header"]), own), "ord")

    def outside(severity: str, finding: str, names: list[str]) -> Column:
        known = F.array(*[F.lit(h) for h in dict.fromkeys(names)])
        return found(severity, finding, F.filter("cells", lambda c: ~F.array_contains(known, c.header)), "pos")

    raw = F.concat(missing("error", "missing_mandatory", C.MANDATORY_RAW), outside("warning", "extra_column", C.MANDATORY_RAW))
    cleaned = F.concat(
        missing("error", "missing_minimum", C.MINIMUM_CLEANED), missing("notice", "missing_optional", C.OPTIONAL_CLEANED),
        outside("info", "unknown_column", [*C.MINIMUM_CLEANED, *C.OPTIONAL_CLEANED, C.YEAR_LABEL]))
    return by_file(headers).where(F.col("kind").isin("raw", "cleaned")).select("file_id", "kind", F.inline(F.when(F.col("kind") == "raw", raw).otherwise(cleaned)))
