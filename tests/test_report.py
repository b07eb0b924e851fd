"""Distributions and histograms (O38-O44, SURVEY Q13-Q15)."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from formlens.operators import report as R


def cats(spark, pairs):
    return spark.createDataFrame(pairs, "campus string, analysis_year int, age double, birth_date timestamp_ntz")


def test_top_k_ties_by_name(spark):
    rows = []
    for i, name in enumerate("ABCDEFGHIJKL"):
        rows += [(name, 2025, None, None)] * (5 if i < 9 else 2)
    rows += [(None, 2025, None, None)] * 2 + [("  ", 2025, None, None)]
    top = R.category_distribution(cats(spark, rows), "campus").orderBy("rank").collect()
    assert [r["category"] for r in top][:9] == list("ABCDEFGHI")
    # rank 10: 'J', 'K', 'L' have 2; 'Sin dato' has 3 (null and blank fill)
    assert top[9]["category"] == "Sin dato" and len(top) == 10


def test_topk_rows_semi_join(spark):
    rows = [(c, 2025, None, None) for c in "AAABBC"]
    got = R.topk_rows(cats(spark, rows), "campus", k=2).count()
    assert got == 5


def test_category_by_year_absent_pairs(spark):
    rows = [("A", 2024, None, None), ("A", 2025, None, None), ("B", 2025, None, None)]
    got = {(r["category"], r["year"], r["n"]) for r in R.category_by_year(cats(spark, rows), "campus").collect()}
    assert got == {("A", 2024, 1), ("A", 2025, 1), ("B", 2025, 1)}


def numpy_hist(values, bins):
    counts, edges = np.histogram(values, bins=bins)
    return counts.tolist(), edges


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=90), min_size=1, max_size=60))
def test_histogram_matches_numpy(spark, ages):
    df = cats(spark, [("A", 2025, float(a), None) for a in ages])
    got = R.age_histogram(df, by_year=False).orderBy("bin").collect()
    bins = min(10, max(5, len(set(ages))))
    counts, edges = numpy_hist(ages, bins)
    assert [r["n"] for r in got] == counts
    assert np.allclose([r["bin_lo"] for r in got], edges[:-1])


def test_histogram_by_year_common_edges(spark):
    rows = [("A", 2024, float(a), None) for a in (18, 20, 30)] + [("A", 2025, float(a), None) for a in (40, 60)]
    got = R.age_histogram(cats(spark, rows), by_year=True).collect()
    assert len(got) == 20 and sum(r["n"] for r in got) == 5
    edges = {(r["bin"], r["bin_lo"]) for r in got}
    assert len(edges) == 10  # same edges for both years


def test_histogram_one_distinct_age_widens(spark):
    got = R.age_histogram(cats(spark, [("A", 2025, 20.0, None)] * 3), by_year=False).orderBy("bin").collect()
    counts, edges = numpy_hist([20] * 3, 5)
    assert [r["n"] for r in got] == counts and got[0]["bin_lo"] == edges[0] == 19.5


def test_report_suite_shape(spark):
    import datetime as dt

    from formlens import config as C

    names = [C.LABEL_TO_NAME[C.REPORT_CATALOGUE[k]] for k in C.REPORT_CATALOGUE]
    rows = [tuple(["v%d" % (i % 3)] * len(names)) + (2025, float(20 + i), dt.datetime(2000, 1, 1)) for i in range(12)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + ", analysis_year int, age double, birth_date timestamp_ntz")
    out = R.report_suite(df, input_columns=40, keys=["edad", "sede", "nope"])
    reports = {r["report"] for r in out.collect()}
    assert reports == {"resumen_calidad", "edad", "sede"}
    q = {r["category"]: r["n"] for r in out.where("report = 'resumen_calidad'").collect()}
    assert q["Columnas en base raw filtrada"] == 40 and q["Registros con edad calculada o válida"] == 12
    assert {r["ord"] for r in out.where("report = 'edad'").collect()} == {1}


def test_empty_inputs(spark):
    from formlens import config as C

    names = [C.LABEL_TO_NAME[C.REPORT_CATALOGUE[k]] for k in C.REPORT_CATALOGUE]
    schema = ", ".join(f"{n} string" for n in names) + ", analysis_year int, age double, birth_date timestamp_ntz"
    empty = spark.createDataFrame([], schema)
    assert R.age_histogram(empty).count() == 0
    suite = R.report_suite(empty, input_columns=10)
    q = {r["category"]: r["n"] for r in suite.collect()}
    assert len(q) == 6 and q["Filas en base raw filtrada"] == 0
    no_ages = spark.createDataFrame([tuple(["a"] * len(names)) + (2025, None, None)], schema)
    assert R.age_histogram(no_ages).count() == 0
    assert {r["report"] for r in R.report_suite(no_ages).collect()} == set(C.REPORT_CATALOGUE)
