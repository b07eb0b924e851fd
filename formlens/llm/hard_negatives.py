"""Hard negatives of anchors by exact scores from Kronecker-packed products.

Vector components become integers.  Of some thousand candidates, the j-th
components, biased to be non-negative, are the fields of one wide integer, far
enough apart that no sum reaches the next field.  An anchor's j-th component,
biased likewise, is multiplied with the j-th wide integer, once for all
candidates; the fields of the sum over j, less what the biases brought in,
are the exact inner products.

Candidates lie in partitions of bounded size, written once.  Anchors are a
query set that comes in blocks of bounded size, each broadcast to all
partitions.  A block takes two jobs over the candidates: the first finds the
anchors' positives (first ``positives`` other rows of the same label), the
second, per anchor and positive, the first ``negatives`` rows of other labels
whose score lies between ``low`` and ``high`` percent of the positive's.  A
task keeps that many rows for each anchor or pair, so what is shuffled does
not grow with a partition's rows or with ties.  Every candidate meets every
anchor: the work is their product, exactly once.

Edge cases: rows with a null id, label, vector or component, or a component
that is not finite (also after scaling), take no part; a shorter vector counts
as if zeros followed; equal scores go by the smaller id; a row's "others" are
the rows with another id; repeated rows count one by one, also as anchors;
components of any size are handled, but scores beyond the range of long count as
its limits; an
anchor without positives, or a positive without negatives, has no rows; an
empty table, or one without anchors, gives none.  Only the named columns are
read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, written

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
SCALE = 256
PART_ROWS = 1 << 16  # candidates in a partition
LEAST_PART_ROWS = 512  # in the partitions of a small table
PACKED = 4096  # candidates in one wide integer
BLOCK_COMPONENTS = 1 << 18  # of the anchors of a block (4096 anchors of 64 components)

LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1
EXACT = 1 << 62  # sums below it are computed in 64 bits


def integers(vectors: list[list[float]], scale: float, dims: int) -> np.ndarray:
    """floor(scale * x) of each component, with zeros up to ``dims``; Python integers where 64 bits may not do."""
    q = np.zeros((len(vectors), dims))
    for row, v in zip(q, vectors):
        row[: len(v)] = v
    q = np.floor(scale * q)
    if not q.size or np.abs(q).max() < 1 << 30:
        return q.astype(np.int64)
    return np.array([[int(x) for x in row] for row in q], dtype=object).reshape(q.shape)


class Packed:
    """Candidates whose scores with anchors come from wide integers."""

    def __init__(self, candidates: np.ndarray, anchors: np.ndarray):
        """``candidates`` and ``anchors`` have as many columns; anchors only state their range."""
        self.n, self.dims = candidates.shape
        self.bias = int(candidates.min()) if candidates.size else 0
        self.anchor_bias = int(anchors.min()) if anchors.size else 0
        fields = candidates - self.bias
        top = [int(abs(x).max()) if x.size else 0 for x in (candidates, anchors)]
        spread = [int(x.max()) - b if x.size else 0 for x, b in ((candidates, self.bias), (anchors, self.anchor_bias))]
        self.small = 4 * self.dims * (top[0] + 1) * (top[1] + 1) < EXACT
        bits = (max(self.dims * spread[1], 1) * spread[0]).bit_length()
        self.width = next(w for w in (1, 2, 4, 8, -(-bits // 8)) if 8 * w >= bits)  # bytes of a field
        self.wide = [self._pack(fields[:, j]) for j in range(self.dims)]
        self.sums = fields.sum(axis=1)

    def _pack(self, column: np.ndarray) -> int:
        if self.width <= 8:
            return int.from_bytes(column.astype(f"<u{self.width}").tobytes(), "little")
        return int.from_bytes(b"".join(int(x).to_bytes(self.width, "little") for x in column), "little")

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Inner products of an anchor with all candidates, within the range of long."""
        factors = [int(a) - self.anchor_bias for a in anchor]
        total = sum(f * w for f, w in zip(factors, self.wide) if f)
        raw = total.to_bytes(self.n * self.width, "little")
        if self.width <= 8:
            fields = np.frombuffer(raw, f"<u{self.width}").astype(np.int64 if self.small else object)
        else:
            fields = np.array([int.from_bytes(raw[i : i + self.width], "little") for i in range(0, len(raw), self.width)], dtype=object)
        # (f + anchor_bias)(c + bias), summed over the components
        exact = fields + self.anchor_bias * self.sums + self.bias * (sum(factors) + self.dims * self.anchor_bias)
        return exact if self.small else np.array([min(max(int(x), LONG_MIN), LONG_MAX) for x in exact], dtype=np.int64)


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> list[int]:
    """Places of the first ``k`` by higher score, then smaller id; time is linear also with many ties."""
    at = np.arange(len(scores))
    if len(scores) > k:
        bound = np.partition(scores, -k)[-k]
        above, tied = at[scores > bound], at[scores == bound]
        need = k - len(above)
        if len(tied) > need:
            last = np.partition(ids[tied], need - 1)[need - 1]
            tied = np.concatenate([tied[ids[tied] < last], tied[ids[tied] == last]])[:need]
        at = np.concatenate([above, tied])
    return sorted(at.tolist(), key=lambda i: (-scores[i], ids[i]))


class Candidates:
    """The rows of a partition, packed for a block of anchors."""

    def __init__(self, batches: Iterator[pa.RecordBatch], block: dict, scale: float):
        table = pa.Table.from_batches(batches)
        vectors = table["vector"].to_pylist()
        dims = max([block["dims"], *map(len, vectors)])
        self.ids = np.array(table["id"].to_pylist(), dtype=np.int64)
        number = {label: i for i, label in enumerate(dict.fromkeys(table["label"].to_pylist()))}
        self.labels = np.array([number[x] for x in table["label"].to_pylist()], dtype=np.int64)
        self.number = number
        self.anchors = integers(block["vectors"], scale, dims)
        self.parts = [Packed(integers(vectors[i : i + PACKED], scale, dims), self.anchors) for i in range(0, len(vectors), PACKED)]

    def scores(self, a: int) -> np.ndarray:
        return np.concatenate([p.scores(self.anchors[a]) for p in self.parts])


def _positives(shared: Broadcast, scale: float, k: int):
    """For each anchor the first ``k`` other rows of its label in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        block, out = shared.value, []
        if batches:
            # rows of a label lie together, so only those are packed that an anchor asks for
            table = pa.Table.from_batches(batches)
            by_label: dict[str, list[int]] = {}
            for i, label in enumerate(table["label"].to_pylist()):
                by_label.setdefault(label, []).append(i)
            asked: dict[str, list[int]] = {}
            for a, label in enumerate(block["labels"]):
                asked.setdefault(label, []).append(a)
            for label in by_label.keys() & asked.keys():
                same = {"dims": block["dims"], "vectors": [block["vectors"][a] for a in asked[label]]}
                own = Candidates(table.take(by_label[label]).to_batches(), same, scale)
                for number, a in enumerate(asked[label]):
                    scores = own.scores(number)
                    other = np.flatnonzero(own.ids != block["ids"][a])
                    for i in first(scores[other], own.ids[other], k):
                        out.append((block["rows"][a], int(scores[other[i]]), int(own.ids[other[i]])))
        yield _batch(out, ["anchor", "score", "id"])

    return run


def _negatives(shared: Broadcast, scale: float, k: int, low: int, high: int):
    """For each anchor and positive the first ``k`` rows of other labels, with scores in bounds, in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        block, out = shared.value, []
        if batches:
            own = Candidates(batches, block, scale)
            for a, positives in enumerate(block["positives"]):
                if not positives:
                    continue
                others = np.flatnonzero(own.labels != own.number.get(block["labels"][a], -1))
                scores, ids = own.scores(a)[others], own.ids[others]
                for p, (score, _) in enumerate(positives):
                    fit = np.flatnonzero((scores >= -(-low * score // 100)) & (scores <= high * score // 100))
                    for i in first(scores[fit], ids[fit], k):
                        out.append((block["rows"][a], p, int(scores[fit[i]]), int(ids[fit[i]])))
        yield _batch(out, ["anchor", "positive", "score", "id"])

    return run


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _first_rows(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each key by score and id, with their ``rank``."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= k)


def _stored(rows: DataFrame, is_anchor: Column, vector: str, id_col: str, label: str, scale: float) -> DataFrame:
    """Rows that take part, in partitions of bounded size: ``id``, ``label``, ``vector``, ``anchor``, ``row``."""
    picked = rows.select(
        quoted(id_col).cast("long").alias("id"), quoted(label).cast("string").alias("label"), quoted(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(scale * x.cast("double")) < float("inf")))
    valid = picked.where("id is not null and label is not null and vector is not null").where(finite)
    n = valid.count()
    least = min(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_PART_ROWS))
    parts = max(1, least, -(-n // PART_ROWS))
    return written(valid.repartition(parts).withColumn("row", F.monotonically_increasing_id()), "vectors")


def _blocks(anchors: DataFrame) -> Iterator[dict]:
    """The anchors in blocks, each of ``BLOCK_COMPONENTS`` components at most (or one anchor)."""
    dims = anchors.agg(F.max(F.size("vector"))).first()[0]
    if dims is None:
        return
    size, last = max(1, BLOCK_COMPONENTS // max(dims, 1)), -1
    while rows := anchors.where(F.col("row") > last).orderBy("row").limit(size).collect():
        last = rows[-1]["row"]
        yield {
            "dims": dims, "rows": [r["row"] for r in rows], "ids": [r["id"] for r in rows], "labels": [r["label"] for r in rows],
            "vectors": [list(r["vector"]) for r in rows],
        }


def mine(rows: DataFrame, is_anchor: Column, vector: str = "embedding", id_col: str = "vec_id", label: str = "label", scale: float = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score`` and ``negative_score`` of the hard negatives of each
    anchor (a row for which ``is_anchor`` holds) and positive."""
    spark = rows.sparkSession
    stored = _stored(rows, is_anchor, vector, id_col, label, scale)
    candidates = stored.select("id", "label", "vector")
    anchors = written(stored.where("anchor").select("row", "id", "label", "vector"), "anchors")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = spark.createDataFrame([], schema)
    for block in _blocks(anchors):
        shared = spark.sparkContext.broadcast(block)
        near = candidates.mapInArrow(_positives(shared, scale, positives), "anchor long, score long, id long")
        found: dict[int, list[tuple[int, int]]] = {}
        for r in _first_rows(near, ["anchor"], positives).orderBy("anchor", "rank").collect():  # a block's anchors times positives
            found.setdefault(r["anchor"], []).append((r["score"], r["id"]))
        shared.unpersist()
        block["positives"] = [found.get(row, []) for row in block["rows"]]
        shared = spark.sparkContext.broadcast(block)
        hard = candidates.mapInArrow(_negatives(shared, scale, negatives, low, high), "anchor long, positive long, score long, id long")
        ranked = _first_rows(hard, ["anchor", "positive"], negatives)
        # a pair's ids and positive score, as a small table beside the block's result
        pairs = spark.createDataFrame(
            [(row, p, aid, pid, score) for row, aid, own in zip(block["rows"], block["ids"], block["positives"]) for p, (score, pid) in enumerate(own)],
            "anchor long, positive long, anchor_id long, positive_id long, positive_score long")
        named = ranked.join(pairs, ["anchor", "positive"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = out.unionByName(written(named, "negatives"))
        shared.unpersist()
    return out
