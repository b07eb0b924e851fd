"""Header operators (O6-O22, SURVEY Q1, Q2, Q17)."""

import difflib
import random

import pytest

from formlens import config as C
from formlens.functions import normalize_text
from formlens.operators import headers as H


def table(spark, files):
    rows = [(fid, i, h) for fid, hs in files.items() for i, h in enumerate(hs, start=1)]
    return spark.createDataFrame(rows, "file_id bigint, pos int, header string")


def kinds_of(spark, files):
    return {r["file_id"]: r["kind"] for r in H.file_kinds(table(spark, files)).collect()}


def test_normalise_matches_python(spark):
    hs = C.RAW_COLUMNS[:10] + ["  ESTRATO  SOCIOECONÓMICO ", "ﬁcha"]
    got = {r["header"]: r["header_norm"] for r in H.normalise_headers(table(spark, {1: hs})).collect()}
    assert got == {h: normalize_text(h) for h in hs}


def test_file_kind_rules(spark):
    files = {
        1: C.RAW_COLUMNS,
        2: C.RAW_MARKERS + ["x"],                          # markers alone are enough
        3: C.CLEANED_COLUMNS,
        4: [h for h in C.CLEANED_COLUMNS if h not in C.OPTIONAL_CLEANED],
        5: ["Estrato", "Departamento"] + [h for h in C.MINIMUM_CLEANED if h not in
                                          ("Estrato socioeconómico", "Departamento de nacimiento")],
        6: ["ID", "Nombre"],
        7: [h for h in C.MANDATORY_RAW if h != "Estamento"],  # raw without markers, one missing
    }
    assert kinds_of(spark, files) == {1: "raw", 2: "raw", 3: "cleaned", 4: "cleaned", 5: "cleaned",
                                      6: "unknown", 7: "unknown"}


def test_file_kind_invariant_under_order_case_accents(spark):
    rnd = random.Random(7)
    base = list(C.CLEANED_COLUMNS)
    shuffled = base[:]
    rnd.shuffle(shuffled)
    files = {1: base, 2: shuffled, 3: [h.upper() for h in base], 4: [normalize_text(h) for h in base]}
    assert set(kinds_of(spark, files).values()) == {"cleaned"}


def test_plan_is_one_to_one(spark):
    files = {1: C.RAW_COLUMNS, 2: [h.upper() for h in C.CLEANED_COLUMNS] + ["Estrato"]}
    plan = H.header_plan(table(spark, files)).collect()
    for fid in files:
        names = [r["canonical"] for r in plan if r["file_id"] == fid and r["canonical"]]
        assert len(names) == len(set(names))
    conflict = [r for r in plan if r["file_id"] == 2 and r["status"] == "conflict"]
    assert [r["header"] for r in conflict] == ["Estrato"]


def test_safe_mode_blocks_identifier_leak(spark):
    # the true neighbourhood column is missing; the address is close to it
    hs = [h for h in C.RAW_COLUMNS if h != "Barrio de residencia"]
    t = table(spark, {1: hs})
    greedy = {r["header"]: r["canonical"] for r in H.header_plan(t, "greedy").collect()}
    safe = {r["header"]: r["canonical"] for r in H.header_plan(t, "safe").collect()}
    assert greedy["Dirección de residencia"] == "Barrio de residencia"
    assert safe["Dirección de residencia"] is None


def test_greedy_lets_fuzzy_take_a_later_exact_target(spark):
    t = table(spark, {1: C.RAW_COLUMNS})
    greedy = {r["header"]: (r["canonical"], r["status"]) for r in H.header_plan(t, "greedy").collect()}
    safe = {r["header"]: (r["canonical"], r["status"]) for r in H.header_plan(t, "safe").collect()}
    assert greedy["Barrio de residencia"] == (None, "conflict")
    assert safe["Barrio de residencia"] == ("Barrio de residencia", "unchanged")


def test_fuzzy_follows_difflib_argument_order():
    cands = list(H.norm_map(C.MANDATORY_RAW + [C.SUBMITTED_LABEL]))
    word = normalize_text("¿Tienes EPS?")
    hit = difflib.get_close_matches(word, cands, n=1, cutoff=0.6)
    canonical, score, _ = H.fuzzy_best(word, "raw")
    assert hit and canonical == H.norm_map(C.MANDATORY_RAW)[hit[0]]
    sm = difflib.SequenceMatcher(None, hit[0], word)
    assert score == pytest.approx(sm.ratio())


def test_position_differences_first_five(spark):
    hs = list(C.RAW_COLUMNS)
    hs[1], hs[2] = hs[2], hs[1]
    hs[10], hs[11] = hs[11], hs[10]
    hs[20], hs[21] = hs[21], hs[20]
    got = H.position_differences(table(spark, {1: hs})).orderBy("pos").collect()
    assert [r["pos"] for r in got] == [2, 3, 11, 12, 21]


def test_findings(spark):
    files = {1: [h for h in C.RAW_COLUMNS if h != "Estamento"],
             2: [h for h in C.CLEANED_COLUMNS if h != C.BIRTH_LABEL] + ["Extra"]}
    got = {(r["file_id"], r["severity"], r["header"]) for r in H.schema_findings(table(spark, files)).collect()}
    assert (1, "error", "Estamento") in got
    assert (1, "warning", "Marca temporal") in got
    assert (2, "notice", C.BIRTH_LABEL) in got
    assert (2, "info", "Extra") in got
    assert not any(s == "error" for f, s, _ in got if f == 2)


def test_schema_diff_duplicates_keep_last_spelling(spark):
    files = {1: ["Estamento", "ESTAMENTO", "Otra"]}
    rows = H.schema_diff(table(spark, files)).where("schema = 'raw'").collect()
    extras = [(r["ord"], r["header"]) for r in rows if r["status"] == "extra"]
    assert extras == [(3, "Otra")]
    matched = [r["header"] for r in rows if r["status"] == "match"]
    assert matched == ["Estamento"]


def _drifted(header):
    """Spellings of one header: articles, order, length, case, punctuation."""
    words = header.replace("(", " ").replace(")", " ").split()
    yield from (header.upper(), header + " ", header.replace(" de ", " de la "), header.replace(" de ", " del "), header.replace(" de ", " "), header + " (actual)", "Tu " + header.lower(), " ".join(words[:5]), header.rstrip("?") + ":", header.replace("o", "0", 1))


@pytest.mark.parametrize("target", ["raw", "cleaned"])
def test_no_drifted_identifier_becomes_a_column(spark, target):
    # each target is missing in turn, so that any of them is free to be taken
    spellings = [s for h in C.IDENTIFIER_RAW for s in _drifted(h)]
    for s in spellings:
        canonical, score, unsafe = H.fuzzy_best(normalize_text(s), target)
        assert canonical is None or unsafe, (s, canonical, score)


def test_address_with_other_words_is_not_the_neighbourhood():
    for s in ("Dirección residencia", "Dirección de la residencia", "Dirección del residencia", "Direccion residencial", "Dirección donde reside"):
        canonical, _, unsafe = H.fuzzy_best(normalize_text(s), "raw")
        assert canonical is None or unsafe


def test_structure_check(spark):
    files = {1: C.RAW_COLUMNS, 2: [*C.RAW_COLUMNS[1:], "Nueva"], 3: list(reversed(C.RAW_COLUMNS))}
    got = {r["file_id"]: r for r in H.structure_check(table(spark, files)).collect()}
    assert [got[i]["exact"] for i in (1, 2, 3)] == [True, False, False]
    assert (got[2]["missing"], got[2]["extra"], got[3]["n_missing"]) == (C.RAW_COLUMNS[0], "Nueva", 0)


def test_conformance_counts_places_not_rows(spark):
    names = list(C.RAW_COLUMNS)
    headers = table(spark, {1: names, 2: [names[0], names[0].upper(), "Otro", "OTRO", *names[5:9]]})
    rows = {(r["file_id"], r["schema"]): r for r in H.schema_conformance(headers).collect()}
    for r in H.schema_diff(headers).groupBy("file_id", "schema").pivot("status", ["match", "missing", "extra"]).count().na.fill(0).collect():
        own = rows.pop((r["file_id"], r["schema"]))
        assert (own["n_matched"], own["n_missing"], own["n_extra"]) == (r["match"], r["missing"], r["extra"])
    assert not rows
    plan = H.schema_conformance(headers)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1 and "count_if" not in plan and "HashAggregate" not in plan.replace("ObjectHashAggregate", "")
