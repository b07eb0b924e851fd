"""Toxicity by compression distance with zstandard dictionaries.

Two dictionaries are made from labelled text: the ordinary one of the words
that most ordinary texts have, the toxic one of the same words and, besides,
the passages by which toxic texts differ.  Every window of a text is
compressed with either; where the toxic dictionary makes it shorter, the window
resembles toxic text.  The distances of a text's windows, short and long ones,
are summed up in a few figures (means, largest, shares above thresholds), and
a logistic model calibrates them to the share of toxic texts.

Learning takes a bounded sample of the labelled rows: of each label the rows
that come first by a hash of their id, ``sample_toxic`` and
``sample_ordinary`` at most, among texts of up to ``SAMPLE_CHARS`` characters.
Two thirds make the dictionaries, the rest calibrates.  Scoring covers all
windows of all texts.

Edge cases: null or empty texts have no windows and get the score of a text
without any distance; without labels of both kinds the score is the share of
toxic labels (0 without labels); a row with several labels counts with each.
Repeated rows are scored row by row.  Input columns named like the new ones
are replaced.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, text_bytes

SAMPLE_TOXIC = 1_500
SAMPLE_ORDINARY = 3_000
SAMPLE_CHARS = 20_000
GRAM = 6  # bytes; also the shortest match of the compressor
ODDS = 8.0  # how much commoner a gram must be in toxic texts
SUPPORT = 4  # toxic texts that must have it
COMMON_BYTES, TOXIC_BYTES = 1_500, 6_000
SHORT, LONG = 4, 64  # words of a window
THRESHOLD = 0.3


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def _joined(text: bytes) -> bytes:
    return b" " + b" ".join(words(text)) + b" "


def _grams(text: bytes) -> set[bytes]:
    return {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and of the toxic dictionary; what is commonest stands last, where matches cost least."""
    counts = Counter(w for t in ordinary for w in set(words(t)))
    common, size = [], 0
    for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if size + len(w) + 1 > COMMON_BYTES:
            break
        common.append(b" " + w)
        size += len(w) + 1
    base = b"".join(reversed(common)) + b" "
    texts = [_joined(t) for t in toxic]
    inside = Counter(g for t in texts for g in _grams(t))
    inside = {g: c for g, c in inside.items() if c >= SUPPORT}
    outside = Counter(g for t in ordinary for g in _grams(_joined(t)) if g in inside)
    telling = {g for g, c in inside.items() if (c + 0.5) / (len(toxic) + 1) >= ODDS * (outside[g] + 0.5) / (len(ordinary) + 1)}
    passages: Counter[bytes] = Counter()
    for t in texts:
        own, first = set(), None
        for i in range(len(t) - GRAM + 2):
            if t[i : i + GRAM] in telling:
                first = i if first is None else first
            elif first is not None:
                own.add(t[first : i + GRAM - 1])
                first = None
        passages.update(own)
    parts, size, covered = [], 0, set()
    for p, _ in sorted(passages.items(), key=lambda x: (-x[1], -len(x[0]), x[0])):
        grams = _grams(p)
        if grams <= covered:
            continue
        if size + len(p) + 1 > TOXIC_BYTES:
            break
        covered |= grams
        parts.append(p)
        size += len(p) + 1
    return base, base + b"".join(p + b"\n" for p in reversed(parts))


class Distances:
    """How much shorter windows get by the toxic dictionary, as figures of a text."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.pairs = [(size, self._compressor(ordinary, strategy), self._compressor(toxic, strategy)) for size, strategy in ((SHORT, zstandard.STRATEGY_GREEDY), (LONG, zstandard.STRATEGY_DFAST))]

    @staticmethod
    def _compressor(content: bytes, strategy: int):
        parameters = zstandard.ZstdCompressionParameters(
            window_log=17, chain_log=14, hash_log=15, search_log=3, min_match=GRAM, target_length=0, strategy=strategy, write_content_size=0, write_checksum=0, write_dict_id=0)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters).compress

    def __call__(self, text: bytes) -> list[float]:
        own, out = words(text), []
        for size, ordinary, toxic in self.pairs:
            windows = [b" " + b" ".join(own[i : i + size]) + b" " for i in range(0, len(own), size)]
            d = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows] or [0], dtype=float)
            out += [d.mean(), np.log1p(np.clip(d, 0, None).sum()), d.max(), np.sqrt((d >= 2).mean()), np.sqrt((d >= 4).mean())]
        return out


def _calibrate(x: np.ndarray, y: np.ndarray, share: float) -> dict:
    """Logistic weights by Newton steps, with a small penalty; the intercept is
    moved from the sample's share of toxic rows to that of all labels."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), 1.0)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    w[0] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return {"mean": mean, "scale": scale, "weights": w}


def fit(docs: DataFrame, labels: DataFrame, train_on: Column, sample_toxic: int = SAMPLE_TOXIC, sample_ordinary: int = SAMPLE_ORDINARY) -> dict:
    """Dictionaries and calibration from labelled rows (``toxic`` 0 or 1) where ``train_on`` holds."""
    marks = labels.where(F.col("toxic").isin(0, 1)).select(F.col("doc_id").alias("_id"), "toxic").where(F.col("_id").isNotNull())
    sizes = docs.where(train_on).where(F.length("text") <= SAMPLE_CHARS).select("doc_id").join(marks, F.col("doc_id") == F.col("_id"))
    counts = {r["toxic"]: r["n"] for r in sizes.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return {"share": 1.0 if counts.get(1) else 0.0}
    chosen = None
    for value, n in ((1, sample_toxic), (0, sample_ordinary)):
        part = sizes.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select(F.col("doc_id").alias("_id"), "toxic")
        chosen = part if chosen is None else chosen.unionByName(part)
    # the sample has a fixed bound, so it may be broadcast
    rows = docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text").join(F.broadcast(chosen.distinct()), F.col("doc_id") == F.col("_id"))
    rows = rows.select("doc_id", F.encode("text", "utf-8").alias("text"), "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic", "text").limit(sample_toxic + sample_ordinary).collect()
    by = {v: [bytes(r["text"]) for r in rows if r["toxic"] == v] for v in (0, 1)}
    making = {v: [t for i, t in enumerate(ts) if i % 3 != 2 or len(ts) < 6] for v, ts in by.items()}
    rest = {v: [t for i, t in enumerate(ts) if i % 3 == 2 or len(ts) < 6] for v, ts in by.items()}
    ordinary, toxic = dictionaries(making[1], making[0])
    distances = Distances(ordinary, toxic)
    x = np.array([distances(t) for v in (0, 1) for t in rest[v]])
    y = np.array([v for v in (0, 1) for _ in rest[v]], dtype=float)
    return {"ordinary": ordinary, "toxic": toxic} | _calibrate(x, y, counts[1] / (counts[0] + counts[1]))


def _scorer(model: dict):
    distances = Distances(model["ordinary"], model["toxic"]) if "weights" in model else None

    def score(batch: pa.RecordBatch) -> list[pa.Array]:
        if distances is None:
            return [pa.array([model["share"]] * batch.num_rows, pa.float64())]
        x = np.array([distances(t) for t in text_bytes(batch)]).reshape(batch.num_rows, -1)
        z = np.clip((x - model["mean"]) / model["scale"] @ model["weights"][1:] + model["weights"][0], -30, 30)
        return [pa.array(1 / (1 + np.exp(-z)), pa.float64())]

    return score


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` plus ``score``, the calibrated probability that the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, "score double", lambda: _scorer(shared.value))
