import random
import re

import pytest
from test_llm_helpers import docs_frame, words

from formlens.llm import license as L


def brute(text):
    w = words(text)
    places = [(i, label) for phrase, label in L.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    joined = " " + "".join(x + " " for x in w)
    hits = []
    for n, (label, keyword, pattern, priority, score) in enumerate(L.rules()):
        if keyword in joined:
            hits += [(m.start(), m.end(), priority, n, label, score) for m in re.finditer(f"(?<= )(?:{pattern})(?= )", joined)]

    def covered(h):
        return any(g[0] <= h[0] and g[1] >= h[1] and (g[2], g[1] - g[0], -g[3]) > (h[2], h[1] - h[0], -h[3]) for g in hits)

    kept = [h for h in hits if not covered(h)]
    starts = sorted(i for i, _ in places)
    base = sorted({x for _, x in places})
    return (len(w), len(places), starts[0] if starts else None, starts[-1] if starts else None, base, sorted({*base, *(h[4] for h in kept)}), max((h[5] for h in kept), default=0.0))


TEXTS = [
    None, "", "?!", "mit license", "MIT License!", "The MIT\nLicense and the mit-license", "gnu general public licenses", "GNU General Public License, version 3 or later",
    "SPDX-License-Identifier: Apache-2.0", "Licensed under CC BY-NC 4.0.", "cc by cc by cc by", "Released under the terms of the Mozilla Public License v2.0", "summit license mit licensee",
    "GNU Affero General Public License and GNU General Public License", "All rights reserved. Copyright (c) 2020", "É mit license É", "creative commons attribution share alike 4 0", "gnu general public license " * 3,
]


def test_equals_brute_force(spark):
    r = random.Random(1)
    phrases = [p for p, _ in L.BASE] + ["licensed under the", "apache license 2 0", "cc by sa", "spdx license identifier mit", "x", "é", "bsd 3 clause license"]
    texts = TEXTS + [" ".join(r.choices(phrases, k=r.randint(0, 8))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    out = L.scan(docs_frame(spark, rows)).collect()
    assert len(out) == len(rows)
    for x in out:
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.labels, pytest.approx(x.score)) == brute(texts[x.doc_id]), texts[x.doc_id]
        assert x.kept == "own kept"


def test_every_rule_matches_in_both_engines():
    assert len(L.rules()) > 200
    for _, keyword, pattern, priority, score in L.rules():
        re.compile(pattern)
        assert priority in (1, 2, 3, 4) and 0 < score <= 1 and keyword


def test_gate_admits_every_keyword_text():
    for label, name, _, _ in L.LICENSES:
        plain = re.sub(r"\(\?:([^|)]*)[^)]*\)\??", r"\1", name).replace("\\d+", "2").replace(" ?", " ").replace("?", "")
        assert re.search(L.GATE, f" {plain} ") or label in ("llama",), plain


def test_long_text_and_empty_table(spark):
    text = "word " * 50_000 + "mit license " * 50
    x = L.scan(docs_frame(spark, [(1, text)])).first()
    assert (x.n_base, x.first_word, x.last_word) == (50, 50_000, 50_098)
    assert L.scan(docs_frame(spark, [])).count() == 0
