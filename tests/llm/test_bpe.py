"""Token ids against the tokenizers library, and texts against what was encoded."""

import random

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm_helpers import docs_frame
from tokenizers import Tokenizer

from formlens.llm import bpe
from formlens.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
VOCABULARY = bpe.Vocabulary(PATH)
LIBRARY = Tokenizer.from_file(PATH)


def ids(raw):
    return [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def naive_merge(word):
    """The leftmost pair of the lowest rank, found by looking at all pairs each time."""
    symbols = [VOCABULARY.byte_ids[b] for b in word]
    while True:
        ranks = [VOCABULARY.rank.get(a << 32 | b, bpe.NO_MERGE) for a, b in zip(symbols, symbols[1:])]
        if not ranks or min(ranks) == bpe.NO_MERGE:
            return symbols
        at = ranks.index(min(ranks))
        symbols[at : at + 2] = [VOCABULARY.merged[ranks[at]]]


ODD = ["<|endoftext|>", "<|endoftext", "'s", "'LL", "\u0085", "\x1c", "​", " ", "  \n ", "\U00012550", "՘", "🙂", "👍🏽", "ÀÉ", "中文", "́", "٣", "²", "\0", "\n\0"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(ODD)), max_size=12))
def test_ids_equal_the_library(parts):
    text = "".join(parts)
    raw = bpe.Encoder(VOCABULARY)([text])[0]
    assert ids(raw) == library_ids(text)
    assert b"".join(VOCABULARY.bytes_of[i] for i in ids(raw)).decode() == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abeinrst éß🙂", min_size=1, max_size=40), min_size=1, max_size=20))
def test_forest_and_single_tree_equal_merging_step_by_step(words):
    raw = [w.encode() for w in words]
    want = [naive_merge(w) for w in raw]
    assert [ids(VOCABULARY.merge(w)) for w in raw] == want
    assert [ids(x) for x in VOCABULARY.merge_forest(raw)] == want


def test_marks_are_the_letters_that_the_library_does_not_know():
    from tokenizers import pre_tokenizers

    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for start in range(0, 0x34000, 97):  # a hundredth of the code points
        c = chr(start)
        if 0xD800 <= start < 0xE000:
            continue
        text = f"a{c}a 1{c}1 .{c}. {c}{c}x"
        assert [text[a:b] for _, (a, b) in cut(text)] == bpe.pretokens(text), hex(start)
    for first, last in regex.findall("(.)(?:-(.))?", bpe.MARKS):
        for c in (first, last or first):
            assert [f".{c}"] == bpe.pretokens(f".{c}")


def test_pretokens_longer_than_any_memory():
    r = random.Random(5)
    encoder = bpe.Encoder(VOCABULARY)
    for text in ["a" * 100_000, "ab" * 40_000, "".join(r.choices("abcdefgh", k=50_000)), "é" * 30_000, " " * 70_000, "x" * 64, "x" * 65, "é" * 32, "é" * 33]:
        assert ids(encoder([text])[0]) == library_ids(text)
        assert all(len(w.encode()) <= bpe.LONG_WORD for w in encoder.known)


def test_forgets_and_still_encodes(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    encoder = bpe.Encoder(VOCABULARY)
    for text in ["one two three four", "five<|endoftext|> six", "", "one two<|endoftext|>"]:
        assert ids(encoder([text])[0]) == library_ids(text)


def test_rows_and_edge_cases(spark):
    texts = [None, "", " ", "Hello world", "Hello world", "a<|endoftext|>b", "x" * 20_000, "naïve Ünï 中文 🙂"]
    docs = docs_frame(spark, [(i if i else None, t) for i, t in enumerate(texts)]).withColumnRenamed("lang", "ids")
    out = bpe.decode(bpe.encode(docs, PATH), PATH, text="kept")
    assert out.columns == ["doc_id", "text", "score", "n_words", "ids", "kept"]
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == library_ids(r["text"] or "")
        assert r["kept"] == (r["text"] or "") == LIBRARY.decode(r["ids"], skip_special_tokens=False)
        assert r["score"] == "own score"
    assert bpe.decode(bpe.encode(docs.where("false"), PATH), PATH).count() == 0


def test_decode_odd_ids(spark):
    rows = spark.createDataFrame([(1, [50256, None, -1, 99_999, 15496]), (2, None), (3, []), (4, [254])], "k int, ids array<int>")
    got = {r["k"]: r["decoded"] for r in bpe.decode(rows, PATH).collect()}
    assert got == {1: "<|endoftext|>Hello", 2: "", 3: "", 4: LIBRARY.decode([254], skip_special_tokens=False)}


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Vocabulary(tokenizer_path("word_bpe_49k.json"))
