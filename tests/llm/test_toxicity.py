import random

from pyspark.sql import functions as F
from test_llm_helpers import docs_frame

from formlens.llm import toxicity as T


def corpus(seed, n=300):
    r = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "ing", "tion", "ble"]
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    rows = []
    for i in range(n):
        w = [word() for _ in range(r.randint(10, 200))]
        if i % 4 == 0:
            for _ in range(4):
                w.insert(r.randrange(len(w)), r.choice(["zugwump", "blockhead", "quisling"]))
        rows.append((i, " ".join(w)))
    return rows


def test_held_out_accuracy_and_edges(spark):
    rows = corpus(1)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(None, 1), (7, None), (5000, 1)], "doc_id long, toxic int")
    docs = docs_frame(spark, rows + [(900, None), (901, ""), (902, "x " * 50_000), (0, rows[0][1])])
    model = T.fit(docs, labels, F.col("doc_id") % 5 != 0)
    out = T.score(docs, model).collect()
    assert len(out) == len(rows) + 4 and all(0 <= x.score <= 1 for x in out)
    got = {x.doc_id: x.score >= T.THRESHOLD for x in out}
    test = [i for i, _ in rows if i % 5 == 0]
    assert sum(got[i] == (i % 4 == 0) for i in test) >= 0.9 * len(test)
    assert not got[900] and not got[901] and not got[902]


def test_without_labels(spark):
    docs = docs_frame(spark, [(1, "a b")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert T.score(docs, T.fit(docs, none, F.lit(True))).first().score == 0.0
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert T.score(docs, T.fit(docs, one, F.lit(True))).first().score == 1.0
    assert T.score(docs_frame(spark, []), T.fit(docs, none, F.lit(True))).count() == 0
