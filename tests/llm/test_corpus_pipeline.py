import random
from collections import defaultdict

import corpus_pipeline as P
import numpy as np
import test_decontaminate
import test_near_dedup
import test_suffix_dedup
import tokenizers

from formlens.llm.common import tokenizer_path, written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _key string, kept boolean"


def corpus():
    r = random.Random(11)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(800)]
    text = lambda n: " ".join(r.choices(words, k=n))
    texts = [text(r.randint(5, 120)) for _ in range(50)]
    texts += [texts[3], texts[4] + " x", texts[5].replace(" ", "  ")]  # copies
    shared = text(60)
    texts += [f"{text(20)} {shared} {text(15)}" for _ in range(5)]  # a passage that repeats
    item = text(14)
    texts += [f"{text(10)} {item} {text(10)}", None, "", "123 !?", "é" + shared + "ß"]
    rows = [(i, t, "xx", "s", len(t or ""), 0.5, "own", None) for i, t in enumerate(texts)]
    return rows + [rows[0], (None, text(30), None, None, None, None, None, None)], [(1, item), (2, None)]


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, sf = docs.columns, str(tmp_path)

    def step(name, docs):
        out = written(dict(P.STAGES)[name](spark, docs, sf), name)
        assert out.columns == columns and dict(out.dtypes) == dict(docs.dtypes)
        assert {(r["score"], r["_key"]) for r in out.select("score", "_key").collect()} <= {(0.5, "own"), (None, None)}
        return out, sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in out.collect()), key=str)

    key = lambda rows: sorted(((d is None, d or 0, t) for d, t in rows), key=str)
    # language: texts without a letter go
    docs, got = step("language_id", docs)
    want = [(r[0], r[1]) for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert got == key(want)
    # near-duplicates, of repeated rows one
    docs, got = step("near_dedup", docs)
    numbered = [(1 << 40 if d is None else d, t) for d, t in dict.fromkeys(want)]
    kept = {d for d, _, _, k in test_near_dedup.brute(numbered, 5) if k}
    want = [(d if d != 1 << 40 else None, t) for d, t in numbered if d in kept]
    assert got == key(want) and len(want) < len(numbered)
    # repeated passages; nothing left goes
    docs, got = step("suffix_dedup", docs)
    numbered = [(1 << 40 if d is None else d, t) for d, t in want]
    cut = test_suffix_dedup.brute(numbered)
    assert any(n for _, n, _ in cut.values())
    want = [(d if d != 1 << 40 else None, cut[d][2].decode("utf-8", "ignore")) for d, _ in numbered if cut[d][2]]
    assert [g[:2] for g in got] == [w[:2] for w in key(want)]
    assert [g[2].encode() for g in got] == [w[2].encode() for w in key(want)]
    assert all(r["n_chars"] in (None, len(r["text"])) for r in docs.collect())
    # benchmark passages
    docs, got = step("decontaminate", docs)
    hits = test_decontaminate.brute(want, items, 10)
    want = [w for w, (_, n, _) in zip(want, hits) if not n]
    assert got == key(want) and any(n for _, n, _ in hits)
    # packing: every token once, in place
    packed = P.pack(spark, docs, sf).collect()
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    assert sum(r["length"] for r in packed) == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in want)
    bins = defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all(np.cumsum([0, *(n for _, n in sorted(b))])[:-1].tolist() == [o for o, _ in sorted(b)] for b in bins.values())


def test_run_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_one_of_a_group_without_telling_ids(spark):
    text = lambda p, end: " ".join(f"{p}{w}" for w in range(100)) + end
    rows = [(None, text("a", "")), (None, text("a", " x")), (7, text("b", "")), (7, text("b", " x")), (7, text("c", "")), (None, text("d", "")), (9, text("d", " x")), (None, "")]
    docs = spark.createDataFrame(rows + rows[4:5], "doc_id long, text string")
    got = sorted(((r["doc_id"], (r["text"] or " ")[0]) for r in P.near_dedup(spark, docs, "").collect()), key=str)
    assert got == sorted([(None, "a"), (7, "b"), (7, "c"), (9, "d"), (None, " ")], key=str)
