import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm_helpers import docs_frame

from formlens.llm import quality as Q


def brute(text):
    w = re.findall("[^\x20\x09-\x0d]+", text)
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text), dup, len(hit)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t#é|", max_size=80))
def test_statistics_equal_brute_force(text):
    assert Q.describe(text)[:5] == brute(text)


def test_learned_list_separates_and_column_agrees(spark):
    r = np.random.default_rng(1)
    good = [(i, " ".join(f"w{r.integers(1000)}" for _ in range(60))) for i in range(60)]
    bad = [(100 + i, " ".join(f"w{r.integers(1000)}#$" for _ in range(60))) for i in range(30)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 0), (5000, 1), (3, None)], "doc_id long, quality int")
    docs = docs_frame(spark, good + bad + [(900, None), (901, ""), (902, "short text"), (903, "a b c d e " * 8000)])
    rules = Q.fit(docs, labels)
    assert rules
    got = {x.doc_id: x for x in Q.judge(docs, rules).collect()}
    assert all(got[i].kept for i, _ in good) and not any(got[i].kept for i, _ in bad)
    assert all(got[i].base_failed and not got[i].kept for i in (900, 901, 902, 903))


def test_no_labels_keeps_what_passes(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = docs_frame(spark, [(1, " ".join(f"w{i}" for i in range(20)))])
    assert Q.fit(docs, none) == []
    assert Q.judge(docs, []).first().kept is True
    assert Q.judge(docs_frame(spark, []), []).count() == 0
