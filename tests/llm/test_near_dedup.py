import random

import numpy as np
import pyarrow as pa
import pytest
from test_llm_helpers import docs_frame, lower_ascii

from formlens.llm import near_dedup as N
from formlens.llm.graph import components


def sets(text, size):
    import re

    w = re.findall("[^\x20\x09-\x0d]+", lower_ascii(text))
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def brute(rows, size):
    shingles = [sets(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(shingles):
        for j in range(i):
            b = shingles[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest[root(i)] = min(smallest.get(root(i), d), d)
    return sorted((d, len(s), smallest[root(i)], d == smallest[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, shingles)))


def corpus(seed, n=60):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        base = [f"w{r.randint(0, 400)}" for _ in range(r.randint(3, 120))]
        rows.append(" ".join(base))
        for _ in range(r.choice([0, 0, 1, 2, 5])):
            copy = list(base)
            for _ in range(r.randint(0, 1 + len(base) // 25)):
                copy[r.randrange(len(copy))] = f"x{r.randint(0, 400)}"
            rows.append(" ".join(copy))
    # a crowd of alike texts, and texts that share one line
    base = [f"c{i}" for i in range(150)]
    for _ in range(80):
        copy = list(base)
        copy[r.randrange(150)] = f"y{r.randint(0, 9999)}"
        rows.append(" ".join(copy))
    line = " ".join(f"l{i}" for i in range(30))
    rows += [line + " " + " ".join(f"z{r.randint(0, 9999)}" for _ in range(r.randint(5, 40))) for _ in range(60)]
    rows += ["", None, "  \n", "a", "A", "a b", "a b c", "a b c d", "a b c d e"]
    r.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,limit", [(1, 4_000_000), (2, 2_000)])
def test_equals_brute_force(spark, seed, limit):
    rows = corpus(seed)
    rows.append(rows[5])  # a repeated row
    out = N.near_duplicates(docs_frame(spark, rows), shingle=4, cluster_shingles=limit)
    assert sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in out.collect()) == brute(rows, 4)


def test_empty_and_null_ids(spark):
    assert N.near_duplicates(docs_frame(spark, [])).count() == 0
    text = " ".join(f"w{i}" for i in range(50))
    got = {(x.doc_id, x.component_id) for x in N.near_duplicates(docs_frame(spark, [(None, text), (4, text), (9, "other words here")])).collect()}
    assert got == {(None, 4), (4, 4), (9, 9)}
    assert N.near_duplicates(docs_frame(spark, [(1, None), (2, "")])).where("kept").count() == 2


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block,limit", [(20_000, 4_000_000), (400, 300_000)])
def test_star_of_edits_equals_brute_force(spark, monkeypatch, block, limit):
    monkeypatch.setattr(N, "BLOCK_NODES", block, raising=False)
    # edits are like their original, not like each other; some are too far from it
    rng, base, edits = np.random.default_rng(4), 500, 1100
    keeps = np.ones((2 * (edits + 1), base), dtype=np.float32)
    for i, k in enumerate(keeps):
        if i % (edits + 1):
            k[rng.choice(base, 49 if i % 10 else 60, replace=False)] = 0
    rows = [(i + 1, " ".join(f"g{i // (edits + 1)}w{w}" if x else f"d{i}w{w}" for w, x in enumerate(k))) for i, k in enumerate(keeps)]
    want = {}
    for g in range(2):
        part = keeps[g * (edits + 1) : (g + 1) * (edits + 1)]
        shared = part @ part.T
        link, label = 100 * shared >= 80 * (2 * base - shared), np.arange(edits + 1)
        np.fill_diagonal(link, True)
        while True:
            least = np.where(link, label, edits + 1).min(axis=1)
            if (least == label).all():
                break
            label = least
        want |= {g * (edits + 1) + i + 1: g * (edits + 1) + x + 1 for i, x in enumerate(label)}
    assert 500 < sum(x == 1 for x in want.values()) < 1101
    got = {x.doc_id: x.component_id for x in N.near_duplicates(docs_frame(spark, rows), shingle=1, cluster_shingles=limit).collect()}
    assert len(got) == len(want) and sum(got[d] != x for d, x in want.items()) == 0


@pytest.mark.parametrize("pairs,per_part", [(1, 250_000), (5, 250_000), (1, 1), (5, 3)])
def test_few_documents_and_many_partitions(spark, monkeypatch, pairs, per_part):
    monkeypatch.setattr(N, "ROWS_PER_PART", per_part)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = [(10 * p + c, " ".join(f"p{p}w{w}" for w in range(100)) + " end" * c) for p in range(pairs) for c in range(2)]
        out = N.near_duplicates(docs_frame(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {x.doc_id: x.component_id for x in out} == {d: d // 10 * 10 for d, _ in rows}


def test_a_full_partition_of_the_forest_takes_little_memory():
    import tracemalloc

    n = N.ROWS_PER_PART
    rng = np.random.default_rng(1)
    values = np.sort(rng.integers(0, 1 << 32, n, dtype=np.uint64)).astype(">u4")
    rows = pa.table({
        "tree": pa.array(np.zeros(n, np.int32)), "sorted": pa.array([v.tobytes() * N.MAX_DEPTH for v in values], pa.binary()), "node": pa.array(np.arange(n)),
        "n": pa.array(np.full(n, 50)), "label": pa.array(np.arange(n)), "bits": pa.array([b"x" * (N.VALUES // 8)] * n, pa.binary())})
    tracemalloc.start()
    N._near(rows, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
