import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm_helpers import docs_frame

from formlens.llm import suffix_dedup as S
from formlens.llm.runindex import RunIndex


def later_windows(strings, size):
    seen, out = set(), []
    for k, s in enumerate(strings):
        for i in range(len(s) - size + 1):
            if s[i : i + size] in seen:
                out.append((k, i))
            seen.add(s[i : i + size])
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8), st.integers(2, 9))
def test_index_equals_brute_force(strings, size):
    string, at = RunIndex(strings).repeats(size)
    assert list(zip(string.tolist(), at.tolist())) == later_windows(strings, size)


def brute(rows, size=100):
    """Removed bytes of each document; equal rows are one document."""
    seen, out = set(), {}
    for d, t in sorted({(d, t or "") for d, t in rows}):
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if b[i : i + size] in seen:
                gone[i : i + size] = b"\1" * size
            seen.add(b[i : i + size])
        out[d] = (len(b), sum(gone), bytes(c for c, g in zip(b, gone) if not g))
    return out


def corpus(seed):
    r = random.Random(seed)
    passage = lambda n: "".join(r.choices("abcdefgh é\n", k=n))
    shared = [passage(r.randint(90, 400)) for _ in range(6)]
    texts = []
    for _ in range(60):
        texts.append("".join(r.choice([passage(r.randint(0, 200)), r.choice(shared), r.choice(shared)[r.randint(0, 60) :]]) for _ in range(r.randint(0, 6))))
    texts += ["ab" * 400, "x" * 500, "x" * 99, "x" * 100, passage(30) * 20, texts[3], texts[4] + texts[5], "", None, "é" * 150]
    r.shuffle(texts)
    return [(i * 2, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,hot,index", [(1, 2_000, 2 << 20), (2, 1, 3_000), (3, 4, 500)])
def test_equals_brute_force(spark, seed, hot, index):
    rows = corpus(seed)
    want = brute(rows)
    rows.append(rows[7])  # a repeated row
    out = S.remove_repeats(docs_frame(spark, rows).repartition(5), hot_texts=hot, index_bytes=index, bucket_bytes=4_000).collect()
    assert len(out) == len(rows)
    for x in out:
        assert (x.n_bytes, x.n_removed, bytes(x.kept_bytes)) == want[x.doc_id], x.doc_id
        assert sum(s.stop - s.start for s in x.spans) == x.n_removed
        assert all(a.stop < b.start for a, b in zip(x.spans, x.spans[1:]))
        assert x.kept == "own kept"


def test_empty_null_ids_and_cut_characters(spark):
    assert S.remove_repeats(docs_frame(spark, [])).count() == 0
    body = "".join(random.Random(1).choices("abcdefgh", k=200))
    out = {x.doc_id: x for x in S.remove_repeats(docs_frame(spark, [(None, body), (5, body), (6, "é" + "ß" * 200)])).collect()}
    assert (out[5].n_removed, out[None].n_removed) == (0, 200)
    assert "\ufffd" not in out[6].kept_text


def test_long_text(spark):
    r = random.Random(2)
    body = "".join(r.choices("abcdefghijklmnop ", k=3_000_000))
    out = {x.doc_id: x.n_removed for x in S.remove_repeats(docs_frame(spark, [(1, body), (2, "q" + body[1000:2000] + "z")])).select("doc_id", "n_removed").collect()}
    assert out == {1: 0, 2: 1000}
