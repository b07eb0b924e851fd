"""URL rules and block lists by Bloom filter cascades.

A rule is a host and a path prefix; it fits the host and its subdomains.  The
keys of a url are its host's suffixes at dots, each with the url's path cut to
every length that a rule's path has; a rule fits if its own key is among them.

A cascade answers membership exactly for all keys of the corpus.  Level 0 is a
Bloom filter of the listed keys; level 1 encodes the corpus's other keys that
pass level 0 by mistake, level 2 the listed keys that pass level 1, and so on
until none is left.  A key that a level does not have is decided there.  The
corpus's keys are made distinct and hashed once, in a written table; each
level is one pass over what passed the level before, and its bits are
aggregated before they reach the driver.  Judging a url then needs no join.

Size: level 0 takes about 1.5 bytes a listed key and more with the logarithm
of the corpus's keys; the later levels together about as much.  Only filters up to
``MAX_FILTER_BYTES`` are broadcast; for longer lists ``listed_among`` decides
by an equi-join instead.

Edge cases: a null url, or one without ``://``, has an empty host and path and
no keys; an empty list lists nothing; repeated keys and rows change nothing.
Of several fitting rules the longest (host and path together) wins, then the
longer host.  Input columns named like the new ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, emit, written

MAX_FILTER_BYTES = 32 << 20
ALLOW, BLOCK = "allow", "block"


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url."""
    rest = (url or "").partition("://")[2]
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    host = rest[: min(ends)] if ends else rest
    path = rest[len(host) :]
    ends = [i for i in map(path.find, "?#") if i >= 0]
    return host.encode().lower().decode(), path[: min(ends)] if ends else path


def url_keys(url: str | None, lengths: list[int]) -> list[str]:
    """All keys that a rule fitting the url may have, longest first."""
    host, path = split_url(url)
    labels = host.split(".")
    suffixes = [".".join(labels[i:]) for i in range(len(labels))] if host else []
    keys = [(len(s) + n, len(s), s + path[:n]) for s in suffixes for n in lengths if len(path) >= n]
    return [k for _, _, k in sorted(keys, reverse=True)]


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h"), F.xxhash64(key, key).alias("g")]


def _wrapped(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _hash(key: str) -> tuple[int, int]:
    """The same as ``_hashes``, as signed 64-bit numbers."""
    raw = key.encode()
    h = xxhash.xxh64_intdigest(raw, seed=42)
    g = xxhash.xxh64_intdigest(raw, seed=h)
    return _wrapped(h), _wrapped(g)


class Level(NamedTuple):
    """A Bloom filter; its depth in the cascade makes its hashes differ from other levels'."""

    depth: int
    bits: int
    hashes: int
    words: np.ndarray  # 64 bits each

    @staticmethod
    def sized(depth: int, keys: int, wrong: float) -> Level:
        """For ``keys`` keys, so that another passes with probability ``wrong``."""
        bits = max(64, math.ceil(-keys * math.log(wrong) / math.log(2) ** 2 / 64) * 64)
        return Level(depth, bits, max(1, round(-math.log2(wrong))), np.zeros(bits // 64, dtype=np.int64))

    def fill(self, keys: DataFrame) -> Level:
        """Sets the bits of all keys: a row for each 64 bits reaches the driver."""
        places = [F.pmod(F.xxhash64("h", "g", F.lit(self.depth * 64 + i)), F.lit(self.bits)) for i in range(self.hashes)]
        bits = keys.select(F.explode(F.array(*places)).alias("p"))
        words = bits.groupBy(F.floor(F.col("p") / 64).cast("long").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 AS int))")).alias("v"))
        for row in words.toLocalIterator():
            self.words[row["w"]] = row["v"]
        return self


def _has(level: tuple, h: int, g: int) -> bool:
    """Whether a filter has a key, by the same hashes as ``Level.fill``."""
    depth, bits, hashes, words = level
    x = h & 0xFFFFFFFFFFFFFFFF
    x = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed=42)
    x = xxhash.xxh64_intdigest((g & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "little"), seed=x)
    for i in range(hashes):
        p = _wrapped(xxhash.xxh64_intdigest((depth * 64 + i).to_bytes(4, "little"), seed=x)) % bits
        if not (int(words[p >> 6]) >> (p & 63)) & 1:
            return False
    return True


#: The filters in order, as plain tuples (they are broadcast).
Cascade = list[tuple]


def contains(cascade: Cascade, key: str) -> bool:
    h, g = _hash(key)
    for level in cascade:
        if not _has(level, h, g):
            return level[0] % 2 == 1
    return len(cascade) % 2 == 1


def build(universe: DataFrame, listed: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> Cascade | None:
    """The cascade of ``listed`` (column ``key``) over ``universe`` (distinct
    ``key``, ``h``, ``g``); None if it would be larger than ``max_bytes``."""
    spark = universe.sparkSession
    yes = written(listed.select("key").where("key is not null").distinct().select("key", *_hashes(F.col("key"))), "listed")
    no = universe.join(yes.select("key"), "key", "left_anti").select("h", "g")
    n, others = yes.count(), universe.count()
    yes = yes.select("h", "g")
    if not n:
        return []
    wrong = min(0.5, max(n, 1) * math.sqrt(0.5) / max(others, 1))
    levels: list[Level] = []
    while True:
        level = Level.sized(len(levels), n, wrong if not levels else 0.5)
        if (level.bits + sum(x.bits for x in levels)) // 8 > max_bytes:
            return None
        levels.append(level.fill(yes))
        shared = spark.sparkContext.broadcast(tuple(levels[-1]))

        def passed(batches, shared=shared):
            for batch in batches:
                keep = [_has(shared.value, h, g) for h, g in zip(batch.column("h").to_pylist(), batch.column("g").to_pylist())]
                yield batch.filter(pa.array(keep, pa.bool_()))

        no = written(no.mapInArrow(passed, "h long, g long"), "cascade")
        n = no.count()
        if not n:
            return [tuple(x) for x in levels]
        yes, no = no, yes  # the next level encodes what passed by mistake


def listed_among(keys: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows of ``keys`` whose ``key`` is listed, by an equi-join: for lists beyond the filters' bound."""
    return keys.join(listed.select("key").distinct(), "key", "left_semi")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], blocked: DataFrame) -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule`` (the longest that fits, or
    null) and ``verdict``: the rule's, else block if the host or a domain above
    it is in ``blocked`` (column ``key``), else allow.

    ``rules``: (verdict, host, path) of a short, fixed rule set.
    """
    spark = pages.sparkSession
    lengths = sorted({len(path) for _, _, path in rules} | {0})
    urls = pages.select("url")
    found = emit(urls, "key string", lambda: lambda b: {"key": pa.array([k for u in set(b.column("url").to_pylist()) for k in url_keys(u, lengths)], pa.string())}, "url")
    universe = written(found.distinct().select("key", *_hashes(F.col("key"))), "keys")
    by_verdict = {v: spark.createDataFrame([(h + p,) for w, h, p in rules if w == v], "key string") for v in (ALLOW, BLOCK)}
    cascades = {v: build(universe, keys) for v, keys in by_verdict.items()}
    hosts = build(universe, blocked)
    if hosts is None:  # too long a list for the filters: only those of its keys that the corpus has
        hosts = build(universe, listed_among(universe, blocked))
    if hosts is None:
        raise ValueError("the corpus has more blocked keys than the filters' bound; raise MAX_FILTER_BYTES or split the pages")
    shared = spark.sparkContext.broadcast((cascades, hosts))
    return add_columns(pages, "host string, path string, rule string, verdict string", lambda: _verdicts(*shared.value, lengths), "url")


def _verdicts(cascades: dict[str, Cascade], hosts: Cascade, lengths: list[int]) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    known: dict[str, str | None] = {}  # answers for keys seen in this task

    def answer(key: str) -> str | None:
        if key not in known:
            if len(known) > 500_000:
                known.clear()
            known[key] = next((v for v, c in cascades.items() if contains(c, key)), None)
        return known[key]

    def verdicts(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = []
        for url in batch.column("url").to_pylist():
            keys = url_keys(url, lengths)
            rule = next((k for k in keys if answer(k)), None)
            verdict = answer(rule) if rule is not None else BLOCK if any(contains(hosts, k) for k in url_keys(url, [0])) else ALLOW
            rows.append((*split_url(url), rule, verdict))
        return [pa.array([r[i] for r in rows], pa.string()) for i in range(4)]

    return verdicts
