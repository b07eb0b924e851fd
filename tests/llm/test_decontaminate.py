import random

import pytest
from test_llm_helpers import docs_frame, random_texts, words

from formlens.llm import decontaminate as D


def brute(docs, items, window):
    out = []
    for _, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            v = words(t)
            size = min(window, len(v))
            for i in range(len(v) - size + 1 if size else 0):
                for j in range(len(w) - size + 1):
                    if w[j : j + size] == v[i : i + size]:
                        hit.update(range(j, j + size))
                        ids.update([str(item)] if item is not None else [])
        out.append((len(w), len(hit), sorted(ids)))
    return out


@pytest.mark.parametrize("seed,blocks", [(1, 1 << 20), (2, 1 << 20), (3, 60)])
def test_equals_brute_force(spark, seed, blocks):
    r = random.Random(seed)
    texts = random_texts(seed, 30, 120, 5) + [None, "", "?!", "A b", "É é É"]
    items = [(i, t) for i, t in enumerate(random_texts(seed + 10, 6, 9, 5) + ["b a", "é", None, ""])] + [(None, texts[0][:40]), (3, "a b")]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])]
    r.shuffle(rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = D.decontaminate(docs_frame(spark, rows), benchmark, window=4, block_bytes=blocks)
    assert [c for c in out.columns if c == "n_words"] == ["n_words"] and "score" in out.columns
    got = sorted((x.doc_id, x.n_words, x.n_hit, tuple(x["items"]), x.contaminated) for x in out.collect())
    want = sorted((d, a, b, tuple(c), b > 0) for (d, _), (a, b, c) in zip(rows, brute(rows, items, 4)))
    assert got == want


def test_spans_are_runs_of_hit_words(spark):
    out = D.decontaminate(docs_frame(spark, [(1, "x a b c y a b c d z")]), spark.createDataFrame([(7, "a b c d")], "item_id long, text string"), window=3).first()
    assert [(s.start, s.stop) for s in out.spans] == [(1, 4), (5, 9)] and out["items"] == ["7"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(docs_frame(spark, [(1, "a b")]), none).first().contaminated is False
    assert D.decontaminate(docs_frame(spark, []), none).count() == 0


def test_very_long_text_and_deep_bucket(spark):
    text = "a b " * 60_000 + "q w e"
    items = spark.createDataFrame([(i, f"w{i} a b a b") for i in range(50)] + [(99, "b q w e")], "item_id long, text string")
    row = D.decontaminate(docs_frame(spark, [(1, text)]), items, window=4).first()
    assert row.n_words == 120_003 and row.n_hit == 120_003 and len(row["items"]) == 51
