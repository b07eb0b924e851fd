r"""Byte-level BPE: token ids of texts, and texts of token ids.

A text is cut at the vocabulary's special tokens, then into pretokens (words
with the blank before them, numbers, marks, white space).  Within a pretoken,
a segment tree holds the merge rank of each adjacent pair of symbols, or
``NO_MERGE``, at the place of its left symbol; an inner node holds the least
rank below it.  The root tells the lowest rank, and going down to the left
wherever the left child has it leads to its first place.  A merge joins two
symbols, which changes the leaves of three pairs at most, each with a
logarithmic update towards the root.  It ends when the root is ``NO_MERGE``.
So a pretoken of n bytes takes n log n steps, however long it is.  The trees
of short pretokens are rows of one array, which take their steps together.

A task remembers the ids of ``CACHE_WORDS`` short pretokens; nothing is
shuffled or broadcast, and the vocabulary is read from ``path`` in each task.

Edge cases: a null or empty text has no ids; null ids, and ids without a
token, decode to nothing, a null or empty list to the empty text; bytes that
are no UTF-8 decode to U+FFFD; repeated rows are encoded row by row; a table
without rows gives one without rows; of a very long text, a task holds the
text, its pretokens and its ids, and some 60 bytes for each byte of its
longest pretoken.  Columns that have an output's name give way, all others
pass through.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .common import add_columns, text_bytes, without

NO_MERGE = (1 << 31) - 1
CACHE_WORDS = 500_000  # some 100 MB
LONG_WORD = 64  # bytes; longer pretokens have a tree of their own and are not remembered
FOREST = 20_000  # trees in one array
DECODED_ROWS = 1000  # whose texts are made at once

# The pretokens of byte-level vocabularies.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Code points that are letters or numbers only since later versions of Unicode than
# the vocabulary's library knows; to it they are marks.
MARKS = (
    "՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱꭬-꭭"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    "\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    "\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    "\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters for themselves, the others in order from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def pretokens(text: str) -> list[str]:
    """The pretokens of a text, in order; joined, they are the text."""
    if text.isascii() or max(text) < MARKS[0] or not _MARK.search(text):
        return _PRETOKEN.findall(text)
    as_mark = _MARK.sub("§", text)  # same length, so places stay
    return [text[m.start() : m.end()] for m in _PRETOKEN.finditer(as_mark)]


_PRETOKEN = regex.compile(PRETOKEN)
_MARK = re.compile(f"[{MARKS}]")
_SPECIAL = "\n\0"  # marks the key of a special token: no pretoken has a mark after white space


class Vocabulary:
    """A byte-level vocabulary file: tokens, merges in order of rank, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        letters = byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        ids = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.byte_ids = [ids.get(letters[b], -1) for b in range(256)]
        #: (left id, right id) as one number: rank; and by rank the id of the merged token
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (a, b) in enumerate(pairs):
            self.rank[ids[a] << 32 | ids[b]] = rank
            self.merged.append(ids[a + b])
        keys = np.array(list(self.rank), dtype=np.int64)
        self.rank_of = np.append(np.argsort(keys), NO_MERGE).astype(np.int32)
        self.pairs = np.append(keys[self.rank_of[:-1]], np.iinfo(np.int64).max)
        self.merged_of = np.array(self.merged, dtype=np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] or ()}
        odd = [t["content"] for t in spec["added_tokens"] or () if t["lstrip"] or t["rstrip"] or t["single_word"]]
        pre = spec.get("pre_tokenizer") or {}
        if -1 in self.byte_ids or odd or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        names = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        #: bytes of a token by its id, empty where there is none
        self.bytes_of = [self._bytes(names.get(i, ""), byte_of) for i in range(max(names) + 1)]

    @staticmethod
    def _bytes(token: str, byte_of: dict[str, int]) -> bytes:
        return bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``NO_MERGE`` where there is none (or no symbol, -1)."""
        pair = left.astype(np.int64) << 32 | right
        found = np.searchsorted(self.pairs, pair)
        return np.where((right >= 0) & (self.pairs[found] == pair), self.rank_of[found], NO_MERGE)

    def merge(self, word: bytes) -> bytes:
        """Ids of one pretoken: the leftmost pair of the lowest rank is merged until none can be."""
        symbols = array("i", [self.byte_ids[b] for b in word])
        n = len(symbols)
        rank, merged = self.rank.get, self.merged
        size = 1 << (n - 1).bit_length()  # leaves: n - 1 pairs and one without a pair, to a power of two
        tree = array("i", [NO_MERGE]) * (2 * size)
        for i in range(n - 1):
            tree[size + i] = rank(symbols[i] << 32 | symbols[i + 1], NO_MERGE)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        while (low := tree[1]) != NO_MERGE:
            node = 1
            while node < size:
                node *= 2
                if tree[node] != low:
                    node += 1
            at = node - size
            gone = after[at]
            nxt, prev = after[gone], before[at]
            symbols[at], symbols[gone], after[at] = merged[low], -1, nxt
            changed = [(gone, NO_MERGE), (at, NO_MERGE)]
            if nxt < n:
                before[nxt] = at
                changed[1] = (at, rank(symbols[at] << 32 | symbols[nxt], NO_MERGE))
            if prev >= 0:
                changed.append((prev, rank(symbols[prev] << 32 | symbols[at], NO_MERGE)))
            for place, value in changed:
                node = size + place
                tree[node] = value
                while node > 1:
                    value = min(tree[node], tree[node ^ 1])
                    node >>= 1
                    if tree[node] == value:
                        break
                    tree[node] = value
        return np.array([s for s in symbols if s >= 0], dtype="<i4").tobytes()

    def merge_forest(self, words: list[bytes]) -> list[bytes]:
        """``merge`` of many pretokens of like length: row r of each array is the tree of ``words[r]``."""
        count, longest = len(words), max(map(len, words))
        size = 1 << (longest - 1).bit_length()
        levels = size.bit_length() - 1
        symbols = np.full((count, size + 2), -1, dtype=np.int32)  # the last two: no symbol
        lengths = np.array([len(w) for w in words])
        symbols[:, :size][np.arange(size) < lengths[:, None]] = np.array(self.byte_ids, dtype=np.int32)[np.frombuffer(b"".join(words), dtype=np.uint8)]
        tree = np.full((count, 2 * size), NO_MERGE, dtype=np.int32)
        tree[:, size:] = self.ranks(symbols[:, :size], symbols[:, 1 : size + 1])
        for level in range(levels - 1, -1, -1):
            nodes = np.arange(1 << level, 2 << level)
            tree[:, nodes] = np.minimum(tree[:, 2 * nodes], tree[:, 2 * nodes + 1])
        after = np.minimum(np.tile(np.arange(1, size + 3, dtype=np.int32), (count, 1)), lengths[:, None].astype(np.int32))
        after[after == lengths[:, None]] = size  # no next symbol
        before = np.tile(np.arange(-1, size + 1, dtype=np.int32), (count, 1))
        rows = np.flatnonzero(tree[:, 1] != NO_MERGE)
        while len(rows):
            low = tree[rows, 1]
            node = np.ones(len(rows), dtype=np.int64)
            for _ in range(levels):
                node *= 2
                node += tree[rows, node] != low
            at = node - size
            gone = after[rows, at]
            nxt, prev = after[rows, gone], before[rows, at]
            new = self.merged_of[low]
            symbols[rows, at], symbols[rows, gone], after[rows, at], before[rows, nxt] = new, -1, nxt, at
            none = np.full(len(rows), NO_MERGE, dtype=np.int32)
            first = prev < 0
            value = np.concatenate([none, self.ranks(new, symbols[rows, nxt]), np.where(first, none, self.ranks(symbols[rows, prev], new))])
            # the last leaf never has a pair, so it stands for those that are not there
            node = size + np.concatenate([gone, at, np.where(first, size - 1, prev)])
            three = np.concatenate([rows, rows, rows])
            tree[three, node] = value
            for _ in range(levels):
                node >>= 1
                tree[three, node] = np.minimum(tree[three, 2 * node], tree[three, 2 * node + 1])
            rows = rows[tree[rows, 1] != NO_MERGE]
        left = symbols >= 0
        raw = symbols[left].astype("<i4").tobytes()
        ends = np.cumsum(4 * left.sum(axis=1)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, with a memory of short pretokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.special = {_SPECIAL + t: np.int32(i).tobytes() for t, i in vocabulary.special.items()}
        self.known: dict[str, bytes] = dict(self.special)
        longest_first = sorted(filter(None, vocabulary.special), key=lambda t: (-len(t), t))
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None

    def _learn(self, words: set[str]) -> None:
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            raw = w.encode()
            if len(raw) > LONG_WORD:
                self.known[w] = self.vocabulary.merge(raw)
            else:
                by_size.setdefault((len(raw) - 1).bit_length(), []).append((w, raw))
        for like in by_size.values():
            for k in range(0, len(like), FOREST):
                part = like[k : k + FOREST]
                self.known.update(zip((w for w, _ in part), self.vocabulary.merge_forest([raw for _, raw in part])))

    def __call__(self, texts: list[str]) -> list[bytes]:
        special, known = self.special, self.known
        if len(known) > CACHE_WORDS:
            known.clear()
            known.update(special)
        cut = []
        for text in texts:
            if self.cut is None or not self.cut.search(text):
                cut.append(pretokens(text))
            else:
                parts = self.cut.split(text)  # at odd places the special tokens
                cut.append([w for i, p in enumerate(parts) for w in ([_SPECIAL + p] if i % 2 else pretokens(p))])
        new = set().union(*cut).difference(known)
        self._learn(new)
        ids = [b"".join(map(known.__getitem__, words)) for words in cut]
        for w in new:
            if len(w) > LONG_WORD // 4:  # as many bytes at most as LONG_WORD
                del known[w]
        return ids


def encode(docs: DataFrame, path: str, column: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` plus the column ``ids`` (array of int): the token ids of the whole
    text.  ``path`` names a byte-level vocabulary file that every task can read."""

    def make():
        encoder = Encoder(Vocabulary(path))

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            found = encoder([t.decode("utf-8", "replace") for t in text_bytes(batch, column)])
            ends = np.cumsum([0, *(len(f) // 4 for f in found)]).astype("<i4")
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), dtype="<i4")))]

        return compute

    return add_columns(docs, f"`{ids}` array<int>", make, column)


def _as_text(raw: pa.Array) -> pa.Array:
    try:
        return raw.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:  # some bytes are no UTF-8
        return pa.array([t.decode("utf-8", "replace") for t in raw.to_pylist()], pa.string())


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` plus the column ``text``: the text of the token ids in column ``ids``,
    special tokens included."""
    base = without(rows, [text])
    schema = StructType.fromDDL(f"`{text}` string")
    schema = StructType(base.schema.fields + schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Vocabulary(path).bytes_of
        joined = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        size_of = np.array([*map(len, tokens), 0])  # the last: no such token
        start_of = np.cumsum(size_of) - size_of
        for batch in batches:
            for k in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(k, DECODED_ROWS)
                lists = part.column(ids)
                found = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
                found = np.where((found >= 0) & (found < len(tokens)), found, len(tokens))
                sizes = size_of[found]
                ends = np.cumsum(sizes)
                # byte i of the output is byte i - (start of its token there) of the token
                text_bytes = joined[np.repeat(start_of[found] - (ends - sizes), sizes) + np.arange(sizes.sum())]
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                cuts = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
                whole = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(text_bytes)])
                yield pa.RecordBatch.from_arrays([*part.columns, _as_text(whole)], names=schema.names)

    return base.mapInArrow(run, schema)
