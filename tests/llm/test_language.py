import random

import pyarrow as pa
from pyspark.sql import functions as F
from test_llm_helpers import docs_frame

from formlens.llm import language as L

SYLLABLES = {"xx": ["ka", "to", "mi"], "yy": ["stra", "cht", "ung"], "zz": ["éa", "ou", "ère"]}


def text(lang, r, n):
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 4))) for _ in range(n))


def phrases(doc, sample):
    """Greedy cross-parsing by plain substring search."""
    count, i = 1, 0
    while i < len(doc):
        j = i + 1
        while j <= len(doc) and doc[i:j] in sample:
            j += 1
        if j > len(doc):
            break
        count += 1
        i = j - 1 if j - 1 > i else i + 1
    return count


def test_automaton_counts_phrases():
    r = random.Random(3)
    for _ in range(50):
        sample = "".join(r.choices("abc", k=30))
        doc = "".join(r.choices("abc", k=60))
        size = 6
        parser = L._parser([ord(c) - 97 + 3 for c in sample], size)
        state, count = 0, 1
        for c in doc:
            v = int(parser[state + ord(c) - 97 + 3])
            count += v & 1
            state = v >> 1
        assert count == phrases(doc, sample)


def test_held_out_accuracy_and_edges(spark):
    r = random.Random(5)
    rows = [(i, text(lang, r, r.randint(5, 80)), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    long = (1000, text("yy", r, 30_000), None)
    odd = [(1001, None, "xx"), (1002, "", "xx"), (1003, "123 !?", "xx"), (1004, "字 字", None), (0, rows[0][1], "xx"), long]
    docs = docs_frame(spark, rows + odd)
    out = L.identify(docs, (F.col("doc_id") % 7 != 0) & (F.col("doc_id") < 1000))
    got = {x.doc_id: x for x in out.collect()}
    assert out.count() == len(rows) + len(odd)
    test = [x for x in rows if x[0] % 7 == 0]
    assert sum(got[i].lang_pred == lang for i, _, lang in test) >= 0.95 * len(test)
    assert got[1000].lang_pred == "yy" and all(0 <= x.score <= 1 for x in got.values())
    assert [got[i].lang_pred for i in (1001, 1002, 1003)] == ["und"] * 3
    assert got[1004].lang_pred in SYLLABLES


def test_nothing_to_learn_from(spark):
    out = L.identify(docs_frame(spark, [(1, "abc", None)]), F.lit(True)).first()
    assert (out.lang_pred, out.score) == ("und", 0.0)
    assert L.identify(docs_frame(spark, []), F.lit(True)).count() == 0


def test_languages_of_many_letters():
    r = random.Random(9)
    common = [chr(0x3A0 + i) for i in range(400) if chr(0x3A0 + i).isalpha() and len(chr(0x3A0 + i).lower()) == 1]
    rare = [chr(0x4E00 + i) for i in range(800)]
    words = {lang: ["".join(p) for p in zip(r.sample(rare, 800), r.sample(rare, 800))] for lang in ("ja", "zh")}
    make = {lang: lambda n, w=w: "".join(r.choices(w, k=n)) for lang, w in words.items()}
    model = L.train({"xx": ["".join(r.choices(common, k=29_000))], **{lang: [m(7_000)] for lang, m in make.items()}})
    want = ["ja", "zh"] * 20
    texts = [make[lang](r.randint(20, 600)) for lang in want] + ["\u0e01\u0e02", common[0] * 9]
    names, scores = (x.to_pylist() for x in L._judge(model)(pa.RecordBatch.from_pydict({"text": texts})))
    assert names[:40] == want and names[41] == "xx" and all(0 <= s <= 1 for s in scores)
    # the list gives what a table of all symbols gives
    size, sample = 4, [r.randint(3, 40) for _ in range(300)]
    (flat, keys, values), whole = L._parsers(sample, size), L._parser(sample, 46)
    state = other = 0
    for c in [r.randint(3, 45) for _ in range(2000)]:
        v = int(flat[state + c]) if c < size else int(L._by_list(keys, values, L.np.array([state // size]), L.np.array([c]))[0])
        w = int(whole[other + c])
        state, other = v >> 1, w >> 1
        assert (v & 1, state // size) == (w & 1, other // 46)


def test_sample_chars_is_obeyed(spark, monkeypatch):
    docs = docs_frame(spark, [(i, "ab" * 500, "xx") for i in range(100)])
    seen, train = [], L.train
    monkeypatch.setattr(L, "train", lambda texts, chars: seen.append(sum(map(len, texts["xx"]))) or train(texts, chars))
    for chars in (5_000, 30_000, 60_000):
        L.identify(docs, F.lit(True), sample_chars=chars)
    assert seen == [5_000, 30_000, 60_000]
