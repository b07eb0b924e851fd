"""Removal of byte strings that occur earlier in the corpus, with a run-length index.

Every string of ``size`` bytes that also starts earlier (in a document with a
smaller id, or before in the same one) loses the bytes it covers.

1. A rolling hash of each ``GRAM`` bytes gives every window of ``size`` bytes
   its smallest hash; consecutive windows with the same one are a stretch.
   Equal windows have equal hashes wherever they are, so strings can only
   repeat among stretches of the same hash.  Stretches go out in packed blocks
   by hash; copies within a task are settled there, only the first goes on.
2. Where a hash meets a single stretch, nothing repeats but within it.  A
   stretch whose whole text came earlier is removed.  What is left are the few
   hashes with several different texts (the edges of repeated passages), and
   stretches that may repeat within themselves.
3. The texts of these stretches meet by hash, whole hashes together up to a
   bounded size.  Of equal texts all but the first are removed there; for the
   others, each such set builds a run-length Burrows-Wheeler index, streams matching statistics
   over it, and marks matches of ``size`` bytes or more but the first
   (``runindex``).  A hash with very many different texts is cut into single
   windows, dealt out by their content.
4. The marked intervals of a document are merged and cut out.

Whole-text equality in step 2 is by 64-bit hashes of hash and text each.

Edge cases: null texts are empty; texts shorter than ``size`` stay whole; rows
with the same id are ordered by a hash of their text, and repeated rows (same
id and text) count as one document and are treated alike; a null doc_id comes
last.  Input columns named like the new ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, emit, quoted, slabs, text_bytes, without, written
from .runindex import RunIndex

SIZE = 100
GRAM = 32
SLAB = 2 << 20  # bytes that are hashed at once
BUCKET_BYTES = 64 << 20  # of text, whose stretches meet in step 2
INDEX_BYTES = 1 << 20  # of text in one index
HOT_TEXTS = 8_000  # different texts of one hash, from which its windows go out singly
KNOWN_TEXTS = 200_000
COLUMNS = ["n_bytes", "n_removed", "spans", "kept_bytes", "kept_text"]

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
STRETCH = np.dtype([("hash", "<u8"), ("text", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("start", "<u4"), ("last", "<u4"), ("loop", "u1")])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Stretches:
    """Finds the stretches of a slab of texts."""

    def __init__(self, size: int):
        self.size, self.width = size, size - GRAM + 1
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Document number, first and last window start in it, hash, hash of the
        whole text, and whether the smallest hash comes again within the stretch."""
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        n = len(data)
        starts = np.cumsum([0, *map(len, texts)])
        counts = np.maximum(np.diff(starts) - self.size + 1, 0)  # windows of each document
        none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, bool),)
        if not counts.sum():
            return none
        if len(self.up) < n + 1:
            self.up, self.down = _powers(BASE, n + 1), _powers(INVERSE, n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * self.down[: n - GRAM + 1])
        smallest = _sliding_min(grams, self.width)
        doc = np.repeat(np.arange(len(texts)), counts)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = starts[:-1][doc] + within
        value = smallest[at]
        edge = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])]))
        last = np.concatenate([edge[1:], [len(doc)]]) - 1
        low, high = at[edge], at[last] + self.size
        whole = _mixed((sums[high] - sums[low]) * self.down[low] + (high - low).astype(np.uint64))
        # places of smallest hashes; where one comes again before its last window ends, windows of the stretch may be equal
        around = np.concatenate([np.zeros(self.width - 1, np.uint64), smallest, np.zeros(self.width - 1, np.uint64)])
        place = np.flatnonzero(grams == ~_sliding_min(~around, self.width))
        again = place[:-1][(grams[place[1:]] == grams[place[:-1]]) & (np.diff(place) <= self.width)]
        stretch = np.searchsorted(low, again, "right") - 1
        loop = np.zeros(len(edge), dtype=bool)
        loop[stretch[stretch >= 0]] = True
        return doc[edge], within[edge], within[last], value[edge], whole, loop


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, from block-wise running minima."""
    n = len(x)
    blocks = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    blocks[:n] = x
    rows = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _order(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit((1 << 63) - 1))


def _group_starts(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


MARKS = "doc long, key long, start long, stop long, hash long, hot boolean"  # hash: null for what is removed


def _marks(doc, key, start, stop, hashes=None, hot=None) -> dict[str, pa.Array]:
    n = len(doc)
    return {
        "doc": pa.array(np.asarray(doc, np.int64)), "key": pa.array(np.asarray(key, np.int64)),
        "start": pa.array(np.asarray(start, np.int64)), "stop": pa.array(np.asarray(stop, np.int64)),
        "hash": pa.nulls(n, pa.int64()) if hashes is None else pa.array(hashes.view(np.int64)),
        "hot": pa.nulls(n, pa.bool_()) if hot is None else pa.array(hot),
    }


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _settle(rows: np.ndarray, size: int, hot_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the stretches of a bucket: those to remove, those to index, and whether their hash is hot."""
    rows = rows[np.lexsort((rows["start"], rows["key"], rows["doc"], rows["text"], rows["hash"]))]
    rows = rows[_group_starts(rows["hash"], rows["text"], rows["doc"], rows["key"], rows["start"])]  # repeated rows are one document
    first = _group_starts(rows["hash"], rows["text"])
    gone, rows = rows[~first], rows[first]
    group = np.flatnonzero(_group_starts(rows["hash"]))
    texts = np.repeat(np.diff(np.concatenate([group, [len(rows)]])), np.diff(np.concatenate([group, [len(rows)]])))
    look = (texts > 1) | (rows["loop"] > 0)
    return gone, rows[look], texts[look] > hot_texts


def _stretch_blocks(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """Packed stretches by bucket of their hash; bucket -1: intervals already known to go."""

    def make():
        find, known = Stretches(size), {}

        def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            doc, start, last, value, whole, loop = find(text_bytes(batch))
            rows = np.zeros(len(doc), dtype=STRETCH)
            rows["hash"], rows["text"], rows["start"], rows["last"], rows["loop"] = value, whole, start, last, loop
            rows["doc"], rows["key"] = (batch.column(c).to_numpy()[doc] for c in ("doc", "key"))
            rows = rows[np.lexsort((rows["start"], rows["key"], rows["doc"], rows["text"], rows["hash"]))]
            rows = rows[_group_starts(rows["hash"], rows["text"], rows["doc"], rows["key"], rows["start"])]
            first = _group_starts(rows["hash"], rows["text"])
            # what repeats within a slab is likely to repeat in the next ones of this task
            place = np.flatnonzero(first)
            times = np.diff(np.concatenate([place, [len(rows)]]))
            if len(known) > KNOWN_TEXTS:
                known.clear()
            for i in place[times > 1]:
                name, own = (int(rows["hash"][i]), int(rows["text"][i])), (int(rows["doc"][i]), int(rows["key"][i]), int(rows["start"][i]))
                if known.setdefault(name, own) < own:
                    first[i] = False  # an earlier one of this task has gone out
                else:
                    known[name] = own
            gone, rows = rows[~first], rows[first]
            bucket = (rows["hash"] % np.uint64(buckets)).astype(np.int64)
            rows, bucket = rows[np.argsort(bucket, kind="stable")], np.sort(bucket)
            cuts = np.flatnonzero(_group_starts(bucket)) if len(rows) else np.zeros(0, np.int64)
            blocks = [rows[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(rows)])]
            numbers = bucket[cuts].tolist()
            if len(gone):
                blocks.append(gone.tobytes())
                numbers.append(-1)
            return {"bucket": pa.array(numbers, pa.int32()), "stretches": pa.array(blocks, pa.binary())}

        return compute

    def run(batches):
        compute = make()
        for batch in batches:
            for slab in slabs(batch, "text", SLAB):
                yield _batch(compute(slab))

    return docs.mapInArrow(run, "bucket int, stretches binary")


def _settled(blocks: DataFrame, size: int, buckets: int, hot_texts: int) -> DataFrame:
    """Rows of ``MARKS``: intervals to remove, and stretches whose text must be looked at."""

    def finish(bucket: int, parts: list[bytes]):
        rows = np.frombuffer(b"".join(parts), dtype=STRETCH)
        if bucket < 0:
            yield _batch(_marks(rows["doc"], rows["key"], rows["start"], rows["last"].astype(np.int64) + size))
            return
        gone, look, hot = _settle(rows, size, hot_texts)
        yield _batch(_marks(gone["doc"], gone["key"], gone["start"], gone["last"].astype(np.int64) + size))
        yield _batch(_marks(look["doc"], look["key"], look["start"], look["last"].astype(np.int64) + size, np.ascontiguousarray(look["hash"]), hot))

    def run(batches):
        bucket, parts = None, []
        for batch in batches:
            for b, block in zip(batch.column("bucket").to_pylist(), batch.column("stretches").to_pylist()):
                if b != bucket or b < 0 and len(parts) > 50:
                    if parts:
                        yield from finish(bucket, parts)
                    bucket, parts = b, []
                parts.append(block)
        if parts:
            yield from finish(bucket, parts)

    # intervals that are settled already may go anywhere
    spread = F.when(F.col("bucket") < 0, F.xxhash64("stretches")).otherwise(F.col("bucket").cast("long"))
    return blocks.repartition(buckets, spread).sortWithinPartitions("bucket").mapInArrow(run, MARKS)


def _strings(docs: DataFrame, look: DataFrame, size: int, buckets: int) -> DataFrame:
    """The texts of the stretches, by bucket: whole, or window by window where the hash is hot."""
    per_doc = look.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "stop", "hash", "hot")).alias("look"))

    def make():
        def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            out: dict[tuple, tuple] = {}
            rows = []
            for text, doc, key, stretches in zip(text_bytes(batch), batch.column("doc").to_pylist(), batch.column("key").to_pylist(), batch.column("look").to_pylist()):
                for s in stretches:
                    if not s["hot"]:
                        rows.append((s["hash"] % buckets, s["hash"], doc, key, s["start"], text[s["start"] : s["stop"]]))
                        continue
                    for at in range(s["start"], s["stop"] - size + 1):
                        window = text[at : at + size]
                        # of equal windows of a slab, the first and (to be marked) all others
                        out.setdefault(window, []).append((doc, key, at))
            for window, places in out.items():
                places.sort()
                name = hash_of(window)
                rows.append((name % buckets, name, *places[0], window))
                rows += [(-1, 0, doc, key, at, b"") for doc, key, at in places[1:] if (doc, key, at) != places[0]]
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return {n: pa.array(c, t) for n, c, t in zip(("bucket", "hash", "doc", "key", "start", "string"), columns, types)}

        return compute

    joined = docs.join(per_doc, ["doc", "key"])
    return emit(joined, "bucket int, hash long, doc long, key long, start long, string binary", make)


def hash_of(data: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(data) >> 1


def _indexed(strings: DataFrame, size: int, buckets: int, index_bytes: int) -> DataFrame:
    """Rows of ``MARKS`` for what the indexes find, each over whole hashes, of
    ``index_bytes`` and the last of them at most."""

    def finish(rows: list[tuple[int, int, int, bytes]]):
        # a whole string that came earlier goes, and the index holds it once
        known, copies, distinct = set(), [], []
        for r in sorted(set(rows)):
            (copies if r[3] in known else distinct).append(r)
            known.add(r[3])
        if copies:
            yield _batch(_marks([r[0] for r in copies], [r[1] for r in copies], [r[2] for r in copies], [r[2] + len(r[3]) for r in copies]))
        rows = distinct
        string, at = RunIndex([r[3] for r in rows]).repeats(size)
        if len(string):
            first = np.flatnonzero(np.concatenate([[True], (string[1:] != string[:-1]) | (at[1:] != at[:-1] + 1)]))
            last = np.concatenate([first[1:], [len(string)]]) - 1
            begin = np.array([rows[s][2] for s in string[first]])
            yield _batch(_marks([rows[s][0] for s in string[first]], [rows[s][1] for s in string[first]], begin + at[first], begin + at[last] + size))

    def run(batches):
        last, rows, total = None, [], 0
        for batch in batches:
            settled = []
            for b, name, doc, key, start, string in zip(*(batch.column(c).to_pylist() for c in ("bucket", "hash", "doc", "key", "start", "string"))):
                if b < 0:
                    settled.append((doc, key, start))
                    continue
                if name != last and total >= index_bytes:
                    yield from finish(rows)
                    rows, total = [], 0
                last = name
                total += len(string)
                rows.append((doc, key, start, string))
            if settled:
                doc, key, start = (np.array(c, np.int64) for c in zip(*settled))
                yield _batch(_marks(doc, key, start, start + size))
        if rows:
            yield from finish(rows)

    spread = F.when(F.col("bucket") < 0, F.xxhash64("doc", "key", "start")).otherwise(F.col("bucket").cast("long"))
    return strings.repartition(buckets, spread).sortWithinPartitions("hash").mapInArrow(run, MARKS)


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _cut():
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        sizes, gone, spans, kept, texts = [], [], [], [], []
        for text, marks in zip(text_bytes(batch), batch.column("_gone").to_pylist()):
            runs = merged([(m["start"], m["stop"]) for m in marks or ()])
            edges = [0, *(x for run in runs for x in run), len(text)]
            sizes.append(len(text))
            gone.append(sum(b - a for a, b in runs))
            spans.append([{"start": a, "stop": b} for a, b in runs])
            parts = [text[a:b] for a, b in zip(edges[::2], edges[1::2])]
            kept.append(b"".join(parts))
            texts.append("".join(p.decode("utf-8", "ignore") for p in parts))
        return [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary()), pa.array(texts, pa.string())]

    return compute


def remove_repeats(docs: DataFrame, size: int = SIZE, index_bytes: int = INDEX_BYTES, bucket_bytes: int = BUCKET_BYTES, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """``docs`` plus ``n_bytes``, ``n_removed``, ``spans`` (maximal removed
    byte runs, stop excluded), ``kept_bytes`` (the remaining bytes) and
    ``kept_text`` (the same without characters that were cut apart)."""
    if size < GRAM:
        raise ValueError(f"size must be at least {GRAM}")
    spark = docs.sparkSession
    docs = without(docs, [*COLUMNS, "doc", "key", "_gone"])
    keyed = docs.withColumns({"doc": _order(F.col("doc_id")), "key": F.xxhash64("text")})
    slim = keyed.select("doc", "key", "text").where(F.octet_length("text") >= size)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(least, -(-total // bucket_bytes))
    marks = written(_settled(_stretch_blocks(slim, size, buckets), size, buckets, hot_texts), "marks")
    look = marks.where("hash is not null")
    weight = look.agg(F.sum(F.when(F.col("hot"), (F.col("stop") - F.col("start") - size + 1) * size).otherwise(F.col("stop") - F.col("start")))).first()[0] or 0
    parts = max(least, -(-weight // index_bytes))
    found = written(_indexed(_strings(slim, look, size, parts), size, parts, index_bytes), "found")
    gone = marks.where("hash is null").unionByName(found).groupBy(F.col("doc").alias("_doc"), F.col("key").alias("_key")).agg(F.collect_list(F.struct("start", "stop")).alias("_gone"))
    joined = keyed.join(gone, (F.col("doc") == F.col("_doc")) & F.col("key").eqNullSafe(F.col("_key")), "left")
    out = add_columns(joined.drop("doc", "key", "_doc", "_key"), "n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept_bytes binary, kept_text string", _cut)
    return out.select(*[quoted(c) for c in docs.columns], *COLUMNS)
