"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton is built of labelled text.  A text is
parsed greedily into the longest pieces that occur in that text; the language
that needs the fewest phrases for each character wins (Ziv-Merhav
cross-parsing).  Characters are lower-cased, and what is not a letter counts
as a blank.  A task parses many stretches of text at once, one character of
each at a time, over a table of transitions.  Every letter of the training
texts has a symbol; transitions by the ``DENSE_LETTERS`` commonest are a table,
those by others a sorted list.

Training reads a bounded sample: for each language the ``sample_docs`` rows
that come first by a hash of id and text, those of up to ``SHORT_CHARS``
characters before longer ones, until ``sample_chars`` characters are reached.
The automata that are broadcast are bounded by that, whatever the corpus.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text if there is nothing to learn from.  Ties go to the name that
comes first.  Repeated rows are judged row by row.  Input columns named like
the new ones are replaced.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import add_columns

COLUMNS = "lang_pred string, score double"
UNDETERMINED = "und"
LANE = 512  # characters of one stretch
SAMPLE_DOCS = 200
SAMPLE_CHARS = 30_000
SHORT_CHARS = 4_000
DENSE_LETTERS = 200
SYMBOL_BITS = 21
OTHER, PAD, BLANK = 0, 1, 2  # symbols: a letter that no training text has, none, not a letter; letters follow


def _automaton(symbols: list[int], size: int) -> tuple[np.ndarray, dict[int, int]]:
    """Transitions of the suffix automaton: a row for each state, -1 where there
    is none; those by symbols from ``size`` on by state and symbol."""
    links, lengths, moves = [-1], [0], [{}]
    last = 0
    for s in symbols:
        new = len(moves)
        moves.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = new
            p = links[p]
        if p >= 0:
            q = moves[p][s]
            if lengths[q] == lengths[p] + 1:
                links[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                links.append(links[q])
                lengths.append(lengths[p] + 1)
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = clone
                    p = links[p]
                links[q] = links[new] = clone
        last = new
    table = np.full((len(moves), size), -1, dtype=np.int32)
    rare = {}
    for state, out in enumerate(moves):
        for s, to in out.items():
            if s < size:
                table[state, s] = to
            else:
                rare[state << SYMBOL_BITS | s] = to
    return table, rare


def _parser(symbols: list[int], size: int) -> np.ndarray:
    """A flat table: next state times ``size``, times 2, plus 1 where a phrase ends."""
    return _parsers(symbols, size)[0]


def _parsers(symbols: list[int], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The flat table of symbols below ``size``, then sorted keys (state and
    symbol) and values of the transitions by others."""
    table, rare = _automaton(symbols, size)
    start = np.where(table[0] >= 0, table[0], 0)  # a phrase that ends makes its next character start one
    value = np.where(table >= 0, table.astype(np.int64) * 2 * size, start.astype(np.int64) * 2 * size + 1)
    value[:, PAD] = np.arange(len(table)) * 2 * size
    kind = np.int32 if len(table) * 2 * size < 1 << 31 else np.int64
    keys = np.array([*sorted(rare), np.iinfo(np.int64).max], dtype=np.int64)
    values = np.array([*(rare[k] * 2 * size for k in keys[:-1].tolist()), 1], dtype=kind)
    return value.astype(kind).ravel(), keys, values


def _by_list(keys: np.ndarray, values: np.ndarray, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The values of transitions that the flat table doesn't hold."""
    wanted = states.astype(np.int64) << SYMBOL_BITS | symbols
    at, start = np.searchsorted(keys, wanted), np.searchsorted(keys, symbols)
    return np.where(keys[at] == wanted, values[at], np.where(keys[start] == symbols, values[start] | 1, 1))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)


def train(texts: dict[str, list[str]], sample_chars: int = SAMPLE_CHARS) -> dict:
    """The model: a symbol for each code point, and a parser for each language."""
    letters = Counter(c for ts in texts.values() for t in ts for c in t.lower() if c.isalpha())
    alphabet = [c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))]
    symbol = np.full(0x110000, BLANK, dtype=np.min_scalar_type(len(alphabet) + 3))
    symbol[[c for c in range(0x110000) if chr(c).isalpha()]] = OTHER
    for i, c in enumerate(alphabet):
        symbol[ord(c)] = i + 3
    size = min(len(alphabet), DENSE_LETTERS) + 3
    parsers = {}
    for lang in sorted(texts):
        joined, total = [], 0
        for t in texts[lang]:
            if total >= sample_chars:
                break
            joined.append(_squeeze(symbol[_codes(t)]))
            total += len(joined[-1])
        parsers[lang] = _parsers(np.concatenate([x for j in joined for x in (j, np.array([BLANK], np.uint8))]).tolist(), size)
    return {"symbol": symbol, "size": size, "parsers": parsers}


def _squeeze(symbols: np.ndarray) -> np.ndarray:
    """Runs of blanks as one."""
    if not len(symbols):
        return symbols
    keep = symbols != BLANK
    keep[1:] |= symbols[:-1] != BLANK
    return symbols[keep]


def _judge(model: dict):
    langs = list(model["parsers"])

    def judge(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = [_squeeze(model["symbol"][_codes(t or "")]) for t in batch.column("text").to_pylist()]
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        lanes = -(-lengths // LANE)
        first = np.concatenate([[0], np.cumsum(lanes)])
        grid = np.full(int(first[-1]) * LANE, PAD, dtype=model["symbol"].dtype)
        for t, f in zip(texts, first):
            grid[f * LANE : f * LANE + len(t)] = t
        grid = np.ascontiguousarray(grid.reshape(-1, LANE).T)
        rare = [np.flatnonzero(column >= model["size"]) for column in grid]
        symbols = [column[r].astype(np.int64) for column, r in zip(grid, rare)]
        grid[grid >= model["size"]] = OTHER
        owner = np.repeat(np.arange(len(texts)), lanes)
        cost = np.zeros((len(langs), len(texts)))
        for k, lang in enumerate(langs):
            (parser, keys, values), state = model["parsers"][lang], np.zeros(grid.shape[1], dtype=np.int32)
            phrases = np.ones(grid.shape[1], dtype=np.int64)
            for column, r, s in zip(grid, rare, symbols):
                value = parser[state + column]
                if len(r):
                    value[r] = _by_list(keys, values, state[r] // model["size"], s)
                phrases += value & 1
                state = value >> 1
            cost[k] = np.bincount(owner, weights=phrases, minlength=len(texts)) / np.maximum(lengths, 1)
        has_letter = np.array([bool(len(t)) and bool(((t != BLANK) & (t != PAD)).any()) for t in texts], dtype=bool)
        names, scores = [], []
        for d in range(len(texts)):
            if not has_letter[d] or not langs:
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            order = np.argsort(cost[:, d], kind="stable")
            names.append(langs[order[0]])
            scores.append(float(1 - cost[order[0], d] / cost[order[1], d]) if len(langs) > 1 else 1.0)
        return [pa.array(names, type=pa.string()), pa.array(scores, type=pa.float64())]

    return judge


def sample(docs: DataFrame, train_on: Column, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Texts by language: at most ``sample_docs`` rows each, collected in the order they are used.

    Spark cuts every partition to that many rows a language before it shuffles them.
    """
    rows = docs.where(train_on & F.col("lang").isNotNull() & (F.length(F.trim("text")) > 0)).select(
        "lang", "text", (F.length("text") > SHORT_CHARS).alias("long"), F.xxhash64("doc_id", "text").alias("h"))
    order = Window.partitionBy("lang").orderBy("long", "h", "text")
    out: dict[str, list[str]] = {}
    for lang, text, _, _ in rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample_docs).orderBy("lang", "n").select("lang", "text", "long", "n").toLocalIterator():
        if sum(map(len, out.setdefault(lang, []))) < sample_chars:
            out[lang].append(text)
    return out


def identify(docs: DataFrame, train_on: Column, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (0 to 1: how much cheaper the
    winner parses the text than the next language).  Only rows where
    ``train_on`` holds are learned from; the prediction sees nothing but text."""
    model = train(sample(docs, train_on, sample_docs, sample_chars), sample_chars)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, COLUMNS, lambda: _judge(shared.value))
