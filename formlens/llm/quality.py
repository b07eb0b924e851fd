"""Quality rules as a learned decision list.

Statistics of every text are computed in one pass.  From labelled rows,
sequential covering learns an ordered list of rules, each a conjunction of
thresholds that picks out bad texts: a rule is grown on two thirds of the rows
by information gain, pruned on the rest, and the rows that it covers are taken
away before the next one is learned.  The list becomes one ordered Spark
conditional expression over the statistics.

Learning takes a bounded sample of the labelled rows, the ``sample_rows`` that
come first by a hash of their id.  Everything else covers all rows and whole
texts.

Edge cases: a null or empty text has no words and fails the base rule; rows
with a null label are not learned from; without labels of both kinds the list
is empty and keeps every text that passes the base rule.  Repeated rows are
judged row by row.  Input columns named like the new ones are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns

WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOL = re.compile("[#*$%&|<>]")
STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "n_lines long, n_upper long, n_letters long, n_marks long, n_distinct_words long")
WINDOW_WORDS = 5
SAMPLE_ROWS = 20_000
MIN_PRECISION = 0.7
MAX_RULES = 20
MAX_CONDITIONS = 4


def _repeated(ids: np.ndarray, size: int) -> int:
    """Words inside a window of ``size`` words that the text has twice or more."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    key = ids
    for k in range(1, size):  # number the windows of k + 1 words by those of k and the next word
        key = np.unique(key[: len(ids) - k] * len(ids) + ids[k:], return_inverse=True)[1]
    again = np.bincount(key)[key] > 1
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    edges[:n] += again
    edges[size:] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())


def describe(text: str) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``STATS``."""
    words = WORD.findall(text)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    joined = "".join(words)
    upper, letters, marks = (len(p.findall(joined)) for p in _CLASSES)
    return (len(words), len(joined), len(SYMBOL.findall(text)), len(lines) - len(set(lines)), _repeated(ids, WINDOW_WORDS),
            len(lines), upper, letters, marks, len(number))


#: Capital letters, letters, and exclamation or question marks.
_CLASSES = [re.compile(p) for p in ("[A-ZÀ-ÖØ-Þ]", r"[^\W\d_]", "[!?]")]


def _compute():
    types = [pa.int64()] * len(STATS.split(","))

    def stats(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = [describe(t or "") for t in batch.column("text").to_pylist()]
        return [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)]

    return stats


def text_stats(docs: DataFrame) -> DataFrame:
    """``docs`` plus the statistics of each whole text."""
    return add_columns(docs, STATS, _compute)


def _ratio(top: str, bottom: str) -> Column:
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def features() -> dict[str, Column]:
    """What rules may test: Spark expressions over the statistics."""
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": _ratio("word_chars", "n_words"),
        "symbols": _ratio("n_symbols", "word_chars"),
        "dup_lines": _ratio("n_dup_lines", "n_lines"),
        "repeats": _ratio("n_repeat_words", "n_words"),
        "line_words": _ratio("n_words", "n_lines"),
        "upper": _ratio("n_upper", "n_letters"),
        "letters": _ratio("n_letters", "word_chars"),
        "marks": _ratio("n_marks", "n_words"),
        "distinct": _ratio("n_distinct_words", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.above else x[self.feature] < self.threshold

    def column(self, columns: dict[str, Column]) -> Column:
        c = columns[self.feature]
        return c >= self.threshold if self.above else c < self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], rows: int) -> np.ndarray:
    out = np.ones(rows, dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _best(x: dict[str, np.ndarray], bad: np.ndarray, live: np.ndarray) -> tuple[float, Condition | None]:
    """The condition with the largest information gain among the rows that the rule still covers."""
    p0, n0 = int(bad[live].sum()), int((~bad)[live].sum())
    if not p0 or not n0:
        return 0.0, None
    base = np.log2(p0 / (p0 + n0))
    best: tuple[float, Condition | None] = (0.0, None)
    for name, values in x.items():
        v, y = values[live], bad[live]
        order = np.argsort(v, kind="stable")
        v, y = v[order], y[order]
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1  # thresholds lie between different values
        if not len(cut):
            continue
        below = np.concatenate([[0], np.cumsum(y)])[cut]
        for above, p, n in ((False, below, cut - below), (True, p0 - below, (len(v) - cut) - (p0 - below))):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), Condition(name, above, float((v[cut[k] - 1] + v[cut[k]]) / 2)))
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = MIN_PRECISION) -> list[Rule]:
    """Sequential covering: ordered rules, each for bad rows; the last default is to keep."""
    rules: list[Rule] = []
    rows = len(bad)
    left = np.ones(rows, dtype=bool)
    grow_part = np.arange(rows) % 3 != 2
    while len(rules) < MAX_RULES and bad[left].any():
        rule: Rule = ()
        live = left & grow_part
        while len(rule) < MAX_CONDITIONS:
            gain, condition = _best(x, bad, live)
            if condition is None:
                break
            rule += (condition,)
            live &= condition.holds(x)
        prune = left & ~grow_part

        def worth(r: Rule) -> tuple[float, int]:
            hit = _covers(r, x, rows) & prune
            p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
            return ((p - n) / (p + n) if p + n else -1.0, -len(r))

        if not rule:
            break
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=worth)
        hit = _covers(rule, x, rows) & left
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        if not p or p < min_precision * (p + n) or p < 3:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def as_column(rules: list[Rule]) -> Column:
    """The number of the first rule that fires (from 0), or null."""
    columns = features()
    out = F.lit(None).cast("int")
    for k in range(len(rules) - 1, -1, -1):
        fires = F.lit(True)
        for c in rules[k]:
            fires &= c.column(columns)
        out = F.when(fires, F.lit(k)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The decision list, learned from a bounded sample of the labelled rows."""
    # labels are few rows of a fixed bound here, so they may be broadcast to the documents
    chosen = labels.select(F.col("doc_id").alias("_id"), "quality").where("_id is not null and quality is not null").orderBy(F.xxhash64("_id"), "_id", "quality").limit(sample_rows)
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    columns = features()
    rows = text_stats(labelled).select("doc_id", (F.col("quality") == 0).alias("bad"), *[c.alias(n) for n, c in columns.items()])
    # rows of repeated ids may exceed the bound; the sample is cut to it again
    got = rows.orderBy(F.xxhash64("doc_id"), *rows.columns).limit(sample_rows).toPandas()
    return learn({n: got[n].to_numpy(dtype=float) for n in columns}, got["bad"].to_numpy(dtype=bool))


def base_failed() -> Column:
    """Fewer than 10 words, or more than a fifth of them repeated."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` plus statistics, ``base_failed``, ``rule`` (the first that fires) and ``kept``."""
    out = text_stats(docs).withColumn("base_failed", base_failed()).withColumn("rule", as_column(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
