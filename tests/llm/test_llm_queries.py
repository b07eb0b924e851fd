"""Queries with SQL against DuckDB, and the others' rows and columns, on the smallest tables."""

import os

import duckdb
import pytest
from conftest import SF_SMALL
from test_oracle import digest

from formlens.llm import queries as Q

CONTRACT = {
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_license": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op4_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op9_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "documents pages benchmark labels conversations embeddings".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SF_SMALL)
    result = duck.execute(Q.ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query_returns_a_row_for_each_document(spark, duck, name):
    rows = Q.QUERIES[name](spark, SF_SMALL).collect()
    assert [c for c in rows[0].asDict() if c in CONTRACT[name]] == CONTRACT[name]
    ids = [r["doc_id"] for r in rows]
    want = [r[0] for r in duck.execute("SELECT doc_id FROM documents").fetchall()]
    assert sorted(set(ids)) == sorted(want) and (name == "op4_packing" or len(ids) == len(want))


def test_every_operator_has_a_query():
    assert sorted({int(n[2:].split("_")[0]) for n in Q.QUERIES}) == list(range(1, 14))
