"""Importance resampling towards a target distribution.

Texts are lower-cased (A-Z only) and cut into words; features are all runs of
1 to ``max_run`` consecutive words, hashed into ``buckets``.  A bucket's gain
tells how much commoner it is in the target than in the documents, in
thousandths of a natural logarithm.  A document's weight is the mean gain of
its features, its score the weight plus Gumbel noise from a hash of its id,
so the highest scores are a sample without replacement in proportion to
exp(weight / 1000).

1. Bucket counts: each task adds its rows into one array and emits its
   non-zero entries, so what is shuffled does not grow with a task's rows.
2. The gains, ``buckets`` numbers, are an array in each task; scores are
   looked up and added in it.  Rows, without their texts, are written with
   score and row number.
3. The cutoff by bisection over numbers: each job counts the rows up to
   several thresholds exactly, first over the scores, then over the ids of
   rows tied there, then over the row numbers of rows tied by both.  No row
   leaves its partition and nothing is sorted.
4. Only drawn rows are partitioned by ranges of (score, id, row) and numbered:
   a rank is the place in its partition plus the sizes of those before it.

Edge cases: a null or empty text, or one without a word, has no features and
weight 0; equal scores go by the smaller id, a null id after all others (it
is hashed as the empty text); repeated rows are drawn one by one, tied ones
in the order in which they were written; without documents there are no rows,
without a target text all gains come from the added ones alone.  A very long
text is one slab of its task.  Input columns that have an output's name give
way, all others but the text pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import UPPER, add_columns, quoted, slabs, text_bytes, without, written

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
PROBES = 15  # thresholds counted in one job: four halvings
CACHE_WORDS = 500_000  # whose hashes a task remembers

_FOLD = bytes(c + 32 if chr(c) in UPPER else c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256))
#: In this order, ascending; the last tells all rows apart.
KEYS = ["order", "id", "row"]
OUTPUT = ["n_words", "n_features", "weight", "score", "rank"]


class Features:
    """Bucket numbers of a text's runs of words."""

    def __init__(self, max_run: int, buckets: int):
        self.max_run, self.buckets, self.known = max_run, buckets, {}

    def __call__(self, text: bytes) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of each feature."""
        words = text.translate(_FOLD).split()
        features, known, buckets = list(words), self.known, self.buckets
        for n in range(2, self.max_run + 1):
            features += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(features).difference(known):
            known[w] = zlib.crc32(w) % buckets
        return len(words), np.fromiter(map(known.__getitem__, features), dtype=np.int64, count=len(features))


def bucket_counts(texts: DataFrame, max_run: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of column ``text`` fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(max_run, buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for slab in slabs(batch):
                for text in text_bytes(slab):
                    total += np.bincount(features(text)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counted.collect():  # at most one row for each bucket
        out[bucket] = n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) for each of B buckets."""
    b = len(documents)
    t, s = target.astype(np.float64), documents.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of sha256(``seed:id``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, target: DataFrame, max_run: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``docs`` without the text, plus ``n_words``, ``n_features``, ``weight`` and ``score``."""
    gain = gains(bucket_counts(docs, max_run, buckets), bucket_counts(target, max_run, buckets))

    def make():
        features = Features(max_run, buckets)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for text in text_bytes(batch):
                n_words, found = features(text)
                rows.append((n_words, len(found), int(gain[found].sum()) // len(found) if len(found) else 0))
            return [pa.array(c, pa.int64()) for c in zip(*rows)]

        return compute

    weighed = add_columns(without(docs, OUTPUT), "n_words long, n_features long, weight long", make)
    rest = [quoted(c) for c in weighed.columns if c != "text"]
    return weighed.select(*rest, (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"))


def smallest_reaching(rows: DataFrame, key: str, wanted: int) -> tuple[int, int]:
    """The least value of ``key`` (long, not null) such that at least ``wanted``
    rows have it or a smaller one, and the number of rows with smaller ones.

    The interval that holds the value shrinks to a sixteenth with each count job."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    below = 0  # rows below ``low``
    while low < high:
        span = high - low
        cuts = sorted({low + span * i // (PROBES + 1) for i in range(1, PROBES + 1)} | {low})
        inside = rows.where(F.col(key).between(low, high))
        counts = inside.agg(*[F.count_if(F.col(key) <= F.lit(c)) for c in cuts]).first()
        reached = next((i for i, n in enumerate(counts) if below + n >= wanted), None)
        if reached is None:
            below, low = below + counts[-1], cuts[-1] + 1
        else:
            high = cuts[reached]
            if reached:
                below, low = below + counts[reached - 1], cuts[reached - 1] + 1
    return low, below


def drawn(rows: DataFrame, wanted: int) -> Column:
    """Which rows are among the ``wanted`` first by ``KEYS``; there are as many."""
    cut: Column = F.lit(False)
    tied: Column = F.lit(True)
    for key in KEYS:
        value, below = smallest_reaching(rows.where(tied), key, wanted)
        cut = cut | (tied & (F.col(key) < F.lit(value)))
        tied = tied & (F.col(key) == F.lit(value))
        wanted -= below
        if rows.where(tied).count() == wanted:
            break
    return cut | tied


def ranks(rows: DataFrame) -> DataFrame:
    """``rows`` plus ``rank`` by ``KEYS``, from 1."""
    schema = StructType.fromDDL("part int, place long")
    schema = StructType(rows.schema.fields + schema.fields)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(at + 1, at + n + 1))], names=schema.names)
            at += n

    placed = written(rows.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(number, schema), "ranks")
    sizes = dict(placed.groupBy("part").count().collect())  # one row for each partition
    before = np.cumsum([0, *(sizes.get(part, 0) for part in range(max(sizes) + 1))]).tolist()
    return placed.withColumn("rank", F.element_at(F.lit(before).cast("array<long>"), F.col("part") + 1) + F.col("place"))


def resample(docs: DataFrame, target: DataFrame, max_run: int = 1, buckets: int = BUCKETS, seed: int = SEED,
             min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the text, plus ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank``: of the documents with at least ``min_words`` words,
    ``percent`` in a hundred are drawn and ranked from 1; others have no rank."""
    out = scored(docs, target, max_run, buckets, seed)
    # the document's own columns stay together, apart from the sort keys
    keyed = out.select(
        F.struct(*map(quoted, out.columns)).alias("doc"), (-F.col("score")).alias("order"),
        F.coalesce(F.col("doc_id").try_cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.monotonically_increasing_id().alias("row"))
    stored = written(keyed, "scored")
    eligible = F.col("doc.n_words") >= min_words
    wanted = stored.where(eligible).count() * percent // 100
    unranked = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return stored.select("doc.*", unranked)
    take = eligible & drawn(stored.where(eligible).select(*KEYS), wanted)
    return ranks(stored.where(take)).select("doc.*", "rank").unionByName(stored.where(~take).select("doc.*", unranked))
