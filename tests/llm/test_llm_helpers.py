"""Brute-force counterparts, shared by the tests of this folder."""

import random
import re
import string

SCHEMA = "doc_id long, text string, lang string, score string, kept string, n_words string"


def docs_frame(spark, rows):
    """Documents with columns whose names clash with what operators add; rows: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "own score", "own kept", None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def random_texts(seed, n, words=40, vocabulary=12):
    r = random.Random(seed)
    pool = ["".join(r.choices(string.ascii_lowercase, k=r.randint(1, 5))) for _ in range(vocabulary)]
    return [" ".join(r.choices(pool, k=r.randint(0, words))) for _ in range(n)]


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower_ascii(text))


def test_words_lower_only_ascii():
    assert words("Ab-É 9x") == ["ab", "É", "9x"]
