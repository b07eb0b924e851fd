"""Weights, scores and ranks against a brute-force version over whole tables."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_helpers import random_texts, words

from formlens.llm import resample as R


def features(text, run):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, run + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, run=1, buckets=R.BUCKETS, seed=R.SEED, min_words=R.MIN_WORDS, percent=R.PERCENT):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for table, total in ((docs, s), (target, t)):
        for _, text in table:
            for f in features(text, run):
                total[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        found = features(text, run)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(words(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return rows, able[: len(able) * percent // 100]


@pytest.mark.parametrize("run, percent", [(1, 10), (3, 37), (2, 100)])
def test_equals_brute_force(spark, run, percent):
    docs = list(enumerate(random_texts(run, 300, words=60, vocabulary=80)))
    docs += [(1000, None), (1001, ""), (1002, "!!"), (1003, "É " * 30), (1004, "word " * 30_000)]
    target = list(enumerate(random_texts(99, 20, words=30, vocabulary=80)))
    rows, first = brute(docs, target, run, percent=percent)
    frame = spark.createDataFrame([(*d, "mine", 7) for d in docs], "doc_id long, text string, rank string, order int").repartition(7)
    out = R.resample(frame, spark.createDataFrame(target, "item_id long, text string"), max_run=run, percent=percent)
    assert out.columns == ["doc_id", "order", "n_words", "n_features", "weight", "score", "rank"]
    got = out.collect()
    assert sorted(tuple(r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score")) for r in got) == sorted(rows)
    ranked = sorted((r["rank"], r["doc_id"]) for r in got if r["rank"] is not None)
    assert ranked == [(i, r[0]) for i, r in enumerate(first, 1)]
    assert {r["order"] for r in got} == {7}


def test_ties_repeated_rows_and_null_ids(spark):
    same = "one two three " * 10
    docs = [(5, same)] * 40 + [(None, same)] * 30 + [(i, same) for i in range(30)]
    target = spark.createDataFrame([(1, "one four")], "item_id long, text string")
    out = R.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), target, percent=50).collect()
    rows, first = brute(docs, [(1, "one four")], percent=50)
    assert len(out) == 100
    ranked = sorted(((r["rank"], r["doc_id"]) for r in out if r["rank"] is not None), key=lambda x: x[0])
    assert ranked == [(i, r[0]) for i, r in enumerate(first, 1)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 25), (2, None)], "doc_id long, text string")
    target = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert R.resample(docs.where("false"), target).count() == 0
    assert {r["doc_id"]: r["rank"] for r in R.resample(docs, target.where("false"), percent=100).collect()} == {1: 1, 2: None}
    assert [r["rank"] for r in R.resample(docs, target, percent=0).collect()] == [None, None]


@pytest.mark.parametrize("values", [[3], [5, 5, 5, 5], list(range(-50, 50)), [-(1 << 62), 0, 0, 1 << 62], [7] * 60 + [8] * 3 + [-4] * 9])
def test_bisection_finds_every_order_statistic(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v long").cache()
    ordered = sorted(values)
    for wanted in sorted({1, 2, len(values) // 2, len(values)} - {0}):
        if wanted <= len(values):
            value = ordered[wanted - 1]
            assert R.smallest_reaching(rows, "v", wanted) == (value, sum(x < value for x in values))
    rows.unpersist()


def test_shuffles_bucket_counts_and_drawn_rows_only(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("alpha beta gamma").alias("text"))
    counts = R.bucket_counts(docs)
    assert counts.sum() == 6000 and (counts > 0).sum() == 3
    assert np.array_equal(R.gains(counts, counts), np.zeros(R.BUCKETS))
