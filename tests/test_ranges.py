"""CSV records by byte ranges against Spark's whole-file reader."""

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from formlens import config as C
from formlens.plans.intake import run_intake
from formlens.sources import ranges as R
from formlens.sources.scan import CSV_OPTIONS

cells = st.text(alphabet='ab ,"\n\r;é', max_size=12)
tables = st.lists(st.lists(cells, min_size=3, max_size=3), min_size=0, max_size=12)
SCHEMA = "a string, b string, c string"


def whole_file(spark, path):
    rows = spark.read.options(**CSV_OPTIONS | {"multiLine": "true", "lineSep": "\n"}).schema(SCHEMA).csv(path)
    return sorted(tuple(r) for r in rows.select(*[F.coalesce(c, F.lit("<null>")) for c in "abc"]).collect())


def by_ranges(spark, path, size):
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "enforceSchema", "encoding")} | {"multiLine": "true"}
    rows = R.read_records(spark, [path], range_bytes=size).select(F.from_csv("record", SCHEMA, opts).alias("r")).select("r.*")
    return sorted(tuple(r) for r in rows.select(*[F.coalesce(c, F.lit("<null>")) for c in "abc"]).collect())


def text_of(rows):
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerow(["a", "b", "c"])
    w.writerows(rows)
    return out.getvalue()


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables, st.sampled_from([7, 20, 64, 10_000]))
def test_equals_the_whole_file_reader(spark, tmp_path_factory, rows, size):
    path = tmp_path_factory.mktemp("csv") / "a.csv"
    path.write_bytes(text_of(rows).encode())
    assert by_ranges(spark, str(path), size) == whole_file(spark, str(path))


def naive_state(text, sep=",", quote='"'):
    """Whether a cell is open after the text, character by character."""
    state, i = "field", 0
    while i < len(text):
        c = text[i]
        if state == "field":
            state = "quoted" if c == quote else "field" if c in (sep, "\n") else "plain"
        elif state == "plain":
            state = "field" if c in (sep, "\n") else "plain"
        elif c == quote:
            if text[i + 1 : i + 2] == quote:
                i += 1
            else:
                state = "plain"
        i += 1
    return state == "quoted"


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet='ab,"\n', max_size=60))
def test_lines_change_the_state_like_their_text(text):
    inside = False
    for line in text.split("\n"):
        inside = R.inside_after(line, inside, ",", '"')
    assert inside == naive_state(text)


@pytest.mark.parametrize("size", [16, 100, 1000, 1 << 20])
def test_records_over_many_ranges_and_open_ends(spark, tmp_path, size):
    long = "x\n" * 300 + "y,\"z\"\n" * 40
    (tmp_path / "a b%.csv").write_bytes(("﻿" + text_of([["1", long, "2"], ["3", "4", "5"], ["6", "\r\n", ""], [long, long, long]])).encode())
    (tmp_path / "open[1].csv").write_bytes(b'a,b,c\r\n1,2,3\r\n\r\n4,"5\r\n6,7\r\n' * 1 + b"8,9,0\r\n" * 20)
    (tmp_path / "plain.csv").write_bytes(b'\n \na,b,c\n' + b'in 5" of,b"b,c\n' * 50)
    rows = R.read_records(spark, [str(tmp_path)], range_bytes=size).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r["source_file"].rsplit("/", 1)[1], []).append(r["record"])
    expected = text_of([["1", long, "2"], ["3", "4", "5"], ["6", "\r\n", ""], [long, long, long]]).split("\n", 1)[1].removesuffix("\n")
    assert sorted(csv.reader(io.StringIO("\n".join(sorted(by_file["a%20b%25.csv"])), newline=""))) == sorted(csv.reader(io.StringIO(expected, newline="")))
    assert sorted(by_file["open%5B1%5D.csv"]) == ["1,2,3", '4,"5\r\n6,7\r\n' + "8,9,0\r\n" * 19 + "8,9,0\r"]
    assert by_file["plain.csv"] == ['in 5" of,b"b,c'] * 50


def test_beyond_the_broadcast_the_lines_are_put_in_order_again(spark, tmp_path, monkeypatch):
    path = tmp_path / "a.csv"
    path.write_text(text_of([[str(i), "p\nq\n" * (i % 5), f'"{i}"'] for i in range(60)]))
    want = whole_file(spark, str(path))
    monkeypatch.setattr(R, "BROADCAST_RANGES", -1)
    assert by_ranges(spark, str(path), 50) == want


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    row = ["01/02/2025" if h == C.FILLED_LABEL else "two\nlines" if h == "Estamento" else "v" for h in C.RAW_COLUMNS]
    with open(tmp_path / "a.csv", "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(C.RAW_COLUMNS)
        w.writerows([row] * 2000)
    size = (tmp_path / "a.csv").stat().st_size
    monkeypatch.setattr(R.read_records, "__defaults__", (",", '"', "UTF-8", size // 6))
    assert R.read_records(spark, [str(tmp_path)]).rdd.getNumPartitions() >= 6
    res = run_intake(spark, str(tmp_path), 2025)
    assert res.cleaned.where("estate = 'two lines'").count() == 2000
    assert run_intake(spark, str(tmp_path), 2025, multi_line="whole").cleaned.exceptAll(res.cleaned).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='ab,"\ré ', max_size=16), st.sampled_from([",", ";", "|"]))
def test_closed_form_says_what_inside_after_says(line, sep):
    line = line.replace(",", sep)
    lot = R.pa.RecordBatch.from_arrays([R.pa.array([line.encode()])], names=["value"])
    assert bool(len(R._open_lines(lot, R._closed_form(sep, '"', "UTF-8")))) == R.inside_after(line, False, sep, '"')


def batch_of(lines):
    n = len(lines)
    columns = [["f"] * n, [0] * n, [True] * n, [line.encode() for line in lines], [False] * n]
    return R.pa.RecordBatch.from_arrays([R.pa.array(c) for c in columns], names=["source_file", "block", "single", "value", "inside"])


def test_lines_with_closed_quotes_pass_as_arrays(monkeypatch):
    lines = ["a,b", *['1,"x, y"'] * 500, '2,"open', 'and, shut"', "", *['3,"z"'] * 40, 'stray,"q"z"', '4,"last']
    stepped = []
    inside_after = R.inside_after
    monkeypatch.setattr(R, "inside_after", lambda line, *a: stepped.append(line) or inside_after(line, *a))
    out = [r for b in R._cut(",", '"', "UTF-8")(iter([batch_of(lines)])) for r in b.column("record").to_pylist()]
    assert out == [*lines[1:501], '2,"open\nand, shut"', *lines[504:544], 'stray,"q"z"', '4,"last']
    assert len(stepped) < 10


def test_states_step_only_through_lines_that_leave_a_cell_open(spark, tmp_path):
    text = "a,b\n" + '1,"x, y"\n' * 300 + '2,"open\nand, shut"\n' + '3,"z"\n' * 50
    path = tmp_path / "a.csv"
    path.write_text(text)
    for size in (64, 500, 1500):
        assert by_ranges(spark, str(path), size) == sorted((*r, "<null>") for r in list(csv.reader(io.StringIO(text)))[1:])
