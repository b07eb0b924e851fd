import random
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from test_llm_helpers import docs_frame

from formlens.llm import packing as P
from formlens.llm.common import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


def test_plan_places_every_piece_once_and_fills_bins():
    r = random.Random(4)
    for _ in range(100):
        capacity = r.choice([6, 20, 64])
        counts = {n: r.randint(1, 30) for n in r.sample(range(1, capacity + 1), r.randint(1, capacity))}
        kinds = P.plan(counts, capacity)
        placed = defaultdict(int)
        for number, content in kinds:
            assert sum(n * t for n, t in content) <= capacity
            assert sum(t for n, t in content if 3 * n > capacity) <= 2
            for n, t in content:
                placed[n] += number * t
        assert placed == counts
        used, least = sum(k for k, _ in kinds), -(-sum(n * c for n, c in counts.items()) // capacity)
        assert used <= 1.25 * least + sum(c for n, c in counts.items() if 2 * n > capacity) + 1


TEXTS = ["Hello, World! it's 2024", "don't  \t STOP\n\nnow", "Émile Zola’s naïve café", "<|endoftext|> x<|startoftext|>", "éa  b　c", "日本語 text", "a" * 5000, "x!!y??1234z", "", None, "'s 't", "ŒuvreÀß ª²", "\x1c\x85 q"]


def test_chunked_ids_equal_whole_text():
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    own = P.ChunkTokenizer(tokenizer_path())
    texts = [t or "" for t in TEXTS] + [" ".join(t or "" for t in TEXTS)]
    for text, ids in zip(texts, own(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_ids_of_any_mix_of_characters(monkeypatch):
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    own = P.ChunkTokenizer(tokenizer_path())
    r = random.Random(3)
    marks = list("abcXYZ09 \n\t\r ''|!?.-_{}~éÉÀÞþßÿ×÷œ’日Ω\u0301\u0308\u00a0\u0085\u200d\x0b\x1c\x00\x7f")
    pool = marks + ["<|endoftext|>", "'S", "don't", "the", "İ", "😀"]
    for k in range(60):
        if k == 40:
            monkeypatch.setattr(P, "CACHE_WORDS", 10)  # forgets all the time
        texts = ["".join(r.choices(pool, k=r.choice([0, 1, 2, 8, 60]))) for _ in range(r.randint(0, 20))]
        given = pa.array(["before é", *(t or r.choice([t, None]) for t in texts), "after'"], r.choice([pa.string(), pa.large_string()]))
        found = own(given.slice(1, len(texts)))
        assert len(found) == len(texts)
        for text, ids in zip(texts, found):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_work_follows_the_length_of_a_word():
    own = P.ChunkTokenizer(tokenizer_path())
    own(["warm up"])
    began = time.process_time()
    assert len(own(["a" * 100_000])[0]) >= 4
    assert time.process_time() - began < 10  # before: grew with the square, 9.5 s for 30,000 letters


def test_pieces_and_places(spark):
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    r = random.Random(1)
    texts = TEXTS + [" ".join(r.choices(["alpha", "beta", "gamma."], k=r.randint(1, 60))) for _ in range(40)]
    docs = docs_frame(spark, [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]).repartition(3)
    rows = P.pack_documents(docs, tokenizer_path(), capacity=32, with_ids=True).collect()
    by, bins = defaultdict(list), defaultdict(list)
    for x in rows:
        by[x.doc_id].append(x)
        bins[x.sequence_id].append((x.offset, x.length))
        assert x.score == "own score"
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        want = sorted((s // 32, s, ids[s : s + 32]) for s in range(0, len(ids), 32)) * (2 if i == 3 else 1)
        assert sorted((x.piece, x.start, x.ids) for x in by[i]) == sorted(want)
        assert all(x.ids_crc32 == zlib.crc32(np.array(x.ids, "<u4").tobytes()) for x in by[i])
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 32
    assert P.pack_documents(docs_frame(spark, []), tokenizer_path()).count() == 0
