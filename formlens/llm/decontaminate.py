"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The test strings are windows of consecutive words.  Words become small
integers (0: a word that no benchmark item has), so a text is an integer
sequence.  Blocks of two words index a shift table, which says how far a
window can be moved without missing a test string; where the shift is 0, the
hash of the window's last words selects a bucket of test strings and the words
are compared one by one.  Many stretches of text advance at once, each by its
own shift.

Size: what is broadcast is one block of the benchmark, of about
``block_bytes`` of text.  A larger benchmark is split by item hash and the
blocks pass over the documents one after another, the result of each written
to the shared folder.

Edge cases: null or wordless texts have no words and no hits; an item without
words has no window; an item with a null id marks words but is not listed;
repeated items or documents count row by row; a benchmark without rows hits
nothing.  Input columns named like the new ones are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, text_bytes, without, written

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8: the same as not (00-2F, 3A-60, 7B-7F)
COLUMNS = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,stop:int>>, contaminated boolean"
LANE = 512  # window ends that one stretch covers
WINDOW_WORDS = 10
BLOCK_BYTES = 8 << 20


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text; ``bytes.lower`` changes A-Z only."""
    return WORD.findall(text.lower())


class WuManber:
    """Search for test strings of one length, given as rows of word numbers (from 1)."""

    def __init__(self, rows: np.ndarray, bits: int = 18):
        self.rows, self.m = rows, rows.shape[1]
        self.block = min(2, self.m)
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, self.m - self.block + 1, dtype=np.int64)
        for end in range(self.block - 1, self.m):
            np.minimum.at(self.shift, self._block(rows[:, : end + 1].T), self.m - 1 - end)
        self.suffix = min(4, self.m)
        keys = self._suffix(rows.T)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def _block(self, columns: np.ndarray) -> np.ndarray:
        """Hash of the last block; ``columns``: one row per word place."""
        h = columns[-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        if self.block == 2:
            h += columns[-2].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((h >> np.uint64(29)) & self.mask).astype(np.int64)

    def _suffix(self, columns: np.ndarray) -> np.ndarray:
        h = np.zeros(columns.shape[1], dtype=np.uint64)
        for k in range(1, self.suffix + 1):
            h = (h ^ columns[-k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        return h

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the occurrences in ``text``, and the rows that occur there."""
        n, m = len(text), self.m
        ends, found = [], []
        pos = np.arange(m - 1, n, LANE)
        stop = np.minimum(pos + LANE, n)
        while len(pos):
            step = self.shift[self._block(np.stack([text[pos - k] for k in range(self.block - 1, -1, -1)]))]
            at = pos[step == 0]
            if len(at):
                key = self._suffix(np.stack([text[at - k] for k in range(self.suffix - 1, -1, -1)]))
                low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
                while len(at := at[live := low < high]):
                    low, high = low[live], high[live]
                    row = self.order[low]
                    same = (self.rows[row] == text[at[:, None] - np.arange(m - 1, -1, -1)]).all(axis=1)
                    ends.append(at[same])
                    found.append(row[same])
                    low = low + 1
            pos = pos + np.maximum(step, 1)
            live = pos < stop
            pos, stop = pos[live], stop[live]
        return (np.concatenate(ends), np.concatenate(found)) if ends else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def compile_block(items: list[tuple[str | None, str | None]], window: int) -> dict:
    """Word numbers, and for each length the distinct test strings with the items that have them."""
    vocabulary: dict[bytes, int] = {}
    by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words((text or "").encode())]
        size = min(window, len(ids))
        for i in range(len(ids) - size + 1 if size else 0):
            by_length.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), set()).update([item] if item is not None else [])
    return {"vocabulary": vocabulary, "lengths": {m: (np.array(list(p), dtype=np.int32), [sorted(s) for s in p.values()]) for m, p in by_length.items()}}


def _runs(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": int(a), "stop": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def _marker(block: dict, merge: bool):
    """What marks a slab of documents with the test strings of one block."""
    number = block["vocabulary"].get
    searches = [(WuManber(rows), items) for rows, items in block["lengths"].values()]
    types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.bool_()]

    def mark(batch: pa.RecordBatch) -> list[pa.Array]:
        sequences = [np.array([number(w, 0) for w in words(t)], dtype=np.int32) for t in text_bytes(batch)]
        gap = np.zeros(1, dtype=np.int32)  # an unknown word: nothing matches across two documents
        starts = np.cumsum([0, *(len(s) + 1 for s in sequences)])
        text = np.concatenate([x for s in sequences for x in (s, gap)]) if sequences else gap
        edges = np.zeros(len(text) + 1, dtype=np.int32)
        items: dict[int, set[str]] = {}
        for search, names in searches:
            ends, rows = search.find(text)
            np.add.at(edges, ends - search.m + 1, 1)
            np.add.at(edges, ends + 1, -1)
            for d, r in set(zip((np.searchsorted(starts, ends, "right") - 1).tolist(), rows.tolist())):
                items.setdefault(d, set()).update(names[r])
        hit = np.cumsum(edges[:-1]) > 0
        if merge:
            for d, (spans, old) in enumerate(zip(batch.column("_spans").to_pylist(), batch.column("_items").to_pylist())):
                for s in spans:
                    hit[starts[d] + s["start"] : starts[d] + s["stop"]] = True
                items.setdefault(d, set()).update(old)
        total = np.concatenate([[0], np.cumsum(hit)])
        n_hit = (total[starts[1:]] - total[starts[:-1]]).tolist()
        spans = [_runs(hit[a : b - 1]) if n else [] for n, a, b in zip(n_hit, starts[:-1], starts[1:])]
        columns = ([len(s) for s in sequences], n_hit, [sorted(items.get(d, ())) for d in range(len(sequences))], spans, [n > 0 for n in n_hit])
        return [pa.array(c, type=t) for c, t in zip(columns, types)]

    return mark


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit`` (words inside any test string that
    occurs), ``items`` (ids, as strings, of the items with occurring test
    strings, sorted), ``spans`` (runs of hit words, from 0, stop excluded) and
    ``contaminated``."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    out = without(docs, ["n_words", "n_hit", "items", "spans", "contaminated", "_spans", "_items"])
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        shared = spark.sparkContext.broadcast(compile_block([tuple(r) for r in part], window))
        if b:
            out = without(written(out, "decontaminate").withColumnsRenamed({"spans": "_spans", "items": "_items"}), ["n_words", "n_hit", "contaminated"])
        out = add_columns(out, COLUMNS, lambda shared=shared, merge=b > 0: _marker(shared.value, merge))
    return without(out, ["_spans", "_items"])
