"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. Each text becomes its set of word shingles, a digest of the set and a
   MinHash signature.  Equal sets are one node from here on, so copies cost
   one aggregation, not links.
2. Each tree of the forest sorts all nodes by the signature's values in an
   order of its own.  Rows are dealt out by range of (tree, order, node), so a
   region of thousands of alike documents spreads over partitions.  The first
   ``FIRST_TREES`` trees propose adjacent nodes that share ``MIN_DEPTH`` values.
   Their full sets meet by stretches of the order, at most ``PLACE_ROWS`` rows
   each, where exact intersection confirms them.  That connects most of a large
   group of copies by a link or two for each of its nodes.
3. All trees then propose pairs between different components only.  Neighbours
   by longest common prefix become candidates: a region is cut at greater
   depth until it has at most ``REGION`` nodes; all pairs within that region,
   and each pair of adjacent nodes that share ``MIN_DEPTH`` values, are taken.
   Sizes of the sets, and one bit of each signature value, rule out pairs that
   can't reach the similarity.  Regions of more than ``REGION`` nodes are noted,
   and those at the bounds of a partition, which may go on in the next one.
4. Candidates form clusters, which are small.  The full sets of a cluster meet
   in one task, where union-find confirms candidates by exact intersection
   and skips pairs already connected.  A cluster too large for that, in
   shingles or in nodes, is cut into blocks; pairs between blocks that are
   still unconnected are confirmed by joins, a few for each pair of components
   at first, then more of them.
5. What the cuts of step 3 left out: of the noted regions that links do not
   connect as a whole, all nodes are compared with all nodes of other
   components, first by sizes and bits, then, where these leave a pair, by
   the full sets.  Both run by blocks of nodes; the largest component of a
   region is not compared with itself.

So every pair that shares the first four values of a tree is compared, unless
links connect it anyway.  A pair of similarity 0.8 shares them with
probability 0.41, so 24 trees miss it with probability 3e-6; more alike pairs
less.  Its bits rule a pair of similarity 0.8 out wrongly with probability
2e-6.

Shingles are compared by 64-bit hashes.

Edge cases: a text with fewer words than a shingle is one shingle of all its
words; null, empty or wordless texts have empty sets and link with nothing;
rows with equal sets, and repeated rows, share a component; a null doc_id
counts as larger than all others.  Input columns named like the new ones are
replaced.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import add_columns, emit, release, text_bytes, without, written
from .graph import components

SHINGLE = 5
SIMILARITY = 80  # percent
TREES = 24
MIN_DEPTH = 4
MAX_DEPTH = 12
VALUES = TREES * MIN_DEPTH
REGION = 8
FIRST_TREES = 2
PLACE_ROWS = 2_000  # of a stretch of a tree's order whose sets meet in one task
CLUSTER_SHINGLES = 4_000_000  # of the sets that meet in one task
CLUSTER_NODES = 10_000  # that meet in one task
ROWS_PER_PART = 100_000  # of the forest, which a task holds as arrays
BLOCK_NODES = 20_000  # whose sizes and bits meet in one task
MEMBER_BITS = 1 << 26  # of a bitmap that is broadcast
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
KNOWN_WORDS = 200_000

_rng = np.random.Generator(np.random.PCG64(20240607))
FLIP = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32)
FACTOR = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)
#: Of each tree, the places of the signature in the order it sorts by; the first four are its own.
ORDERS = [[(MIN_DEPTH * t + j * (1 if j < MIN_DEPTH else 7)) % VALUES for j in range(MAX_DEPTH)] for t in range(TREES)]


class Shingles:
    """Sorted distinct shingles of a text, as 64-bit numbers."""

    def __init__(self, size: int):
        self.size, self.known = size, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = WORD.findall(text.lower())
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        ids = np.array([known[w] for w in words], dtype=np.uint64)
        size = min(self.size, len(ids))
        out = ids[: len(ids) - size + 1].copy()
        for k in range(1, size):
            out ^= out >> np.uint64(29)
            out *= np.uint64(0xBF58476D1CE4E5B9)
            out += ids[k : len(ids) - size + 1 + k]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(29)
        return np.unique(out) if size == self.size else out + np.uint64(size)


def _signature(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(VALUES, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(x), 4096):
        np.minimum(out, ((x[k : k + 4096, None] ^ FLIP) * FACTOR).min(axis=0), out=out)
    return out


def sketch(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` plus ``n_shingles``, ``set_key`` (a digest of the set) and ``signature``."""

    def make():
        shingles = Shingles(shingle)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            sizes, keys, signatures = [], [], []
            for text in text_bytes(batch):
                s = shingles(text)
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                signatures.append(_signature(s).tobytes() if len(s) else b"")
            return [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())]

        return compute

    return add_columns(docs, "n_shingles long, set_key binary, signature binary", make)


def _forest(nodes: DataFrame, trees: int = TREES) -> DataFrame:
    """A row for each node and tree: the values in the tree's order, and a bit of every value."""
    schema = StructType.fromDDL("tree int, sorted binary, node long, n long, label long, bits binary")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                signature = np.frombuffer(b"".join(part.column("signature").to_pylist()), dtype=np.uint32).reshape(-1, VALUES)
                bits = pa.array([b.tobytes() for b in np.packbits(signature & 1 == 1, axis=1)], pa.binary())
                for t, order in enumerate(ORDERS[:trees]):
                    values = np.ascontiguousarray(signature[:, order].astype(">u4"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), t, np.int32)), pa.array([v.tobytes() for v in values], pa.binary()), part.column("node"), part.column("n"), part.column("label"), bits], names=schema.names)

    return nodes.select("node", "n", "label", "signature").mapInArrow(run, schema)


def _dealt_forest(nodes: DataFrame, rows: int, trees: int) -> DataFrame:
    """The forest's rows, by ranges of each tree's order, sorted."""
    order = ["tree", "sorted", "node"]
    return _forest(nodes, trees).repartitionByRange(max(-(-rows * trees // ROWS_PER_PART), 1), *order).sortWithinPartitions(*order)


def _least_bits(similarity: int) -> float:
    """Of equal bits; half of those of different values agree by chance, 5.5 standard deviations are leeway."""
    agree = (1 + similarity / 100) / 2
    return VALUES * agree - 5.5 * np.sqrt(VALUES * agree * (1 - agree))


class _Rows:
    """Rows of the forest, sorted by tree and order, as arrays."""

    def __init__(self, rows: pa.Table):
        n = len(rows)
        self.values = np.frombuffer(b"".join(rows.column("sorted").to_pylist()), dtype=">u4").reshape(n, MAX_DEPTH).astype(np.uint32)
        self.bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), dtype=np.uint8).reshape(n, VALUES // 8)
        self.tree, self.node, self.size, self.label = (rows.column(c).to_numpy() for c in ("tree", "node", "n", "label"))
        self.shared = np.zeros(n, dtype=np.int64)  # values in common with the row before
        self.shared[1:] = np.cumprod(self.values[1:] == self.values[:-1], axis=1).sum(axis=1) * (self.tree[1:] == self.tree[:-1])

    def may_link(self, i: np.ndarray, j: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of rows, those of different components that sizes and bits don't rule out."""
        low, high = np.minimum(self.size[i], self.size[j]), np.maximum(self.size[i], self.size[j])
        keep = (100 * low >= similarity * high) & (self.label[i] != self.label[j])
        i, j = i[keep], j[keep]
        keep = VALUES - np.bitwise_count(self.bits[i] ^ self.bits[j]).sum(axis=1) >= _least_bits(similarity)
        return i[keep], j[keep]


def _near(rows: pa.Table, similarity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs among rows sorted by tree and order; then number and
    node of the rows in regions of which not all pairs are taken."""
    n, r = len(rows), _Rows(rows)
    shared, values = r.shared, r.values
    left, right = [np.flatnonzero(shared[1:] >= MIN_DEPTH)], [np.flatnonzero(shared[1:] >= MIN_DEPTH) + 1]
    region = np.cumsum(shared < MIN_DEPTH)
    # the first and the last region may go on in other partitions
    crowded = np.flatnonzero((np.bincount(region)[region] > REGION) | (region == region[0]) | (region == region[-1]))
    number = r.tree[crowded].astype(np.uint64)
    for k in range(MIN_DEPTH):
        number = (number ^ (number >> np.uint64(29)) ^ values[crowded, k]) * np.uint64(0xBF58476D1CE4E5B9)
    open_rows = np.ones(n, dtype=bool)
    for depth in range(MIN_DEPTH, MAX_DEPTH + 1):
        region = np.cumsum(shared < depth)
        small = open_rows & ((np.bincount(region, minlength=region[-1] + 1)[region] <= REGION) | (depth == MAX_DEPTH))
        for k in range(2, REGION):
            i = np.flatnonzero(small[:-k] & (region[:-k] == region[k:])) if k < n else np.zeros(0, np.int64)
            left.append(i)
            right.append(i + k)
        open_rows &= ~small
    i, j = r.may_link(np.concatenate(left), np.concatenate(right), similarity)
    return r.node[i], r.node[j], number.view(np.int64), r.node[crowded]


def _first_links(docs: DataFrame, nodes: DataFrame, rows: int, shingle: int, similarity: int) -> DataFrame:
    """``node`` and ``label`` by the links between adjacent nodes of the first trees."""
    schema = StructType.fromDDL("place long, a long, b long")

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            r = _Rows(pa.Table.from_batches(batches))
            j = np.flatnonzero(r.shared >= MIN_DEPTH)
            i, j = r.may_link(j - 1, j, similarity)
            place = (TaskContext.get().partitionId() << 32) + j // PLACE_ROWS
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(r.node[i]), pa.array(r.node[j])], names=schema.names)
            del batches, r
            release()

    pairs = written(_dealt_forest(nodes, rows, FIRST_TREES).mapInArrow(run, schema), "adjacent")
    ends = pairs.select("place", F.col("a").alias("node")).unionByName(pairs.select("place", F.col("b").alias("node"))).distinct()
    members = written(ends.join(nodes.select("node", "doc_id", "set_key"), "node"), "members")
    sets = _member_sets(docs, members, shingle)
    none = lambda t: F.lit(None).cast(t)
    rows = sets.select(F.col("place").alias("cluster"), F.lit(0).alias("block"), F.col("node").alias("a"), none("long").alias("b"), "shingles").unionByName(
        pairs.select(F.col("place").alias("cluster"), F.lit(0).alias("block"), "a", "b", none("binary").alias("shingles")))
    return components(_confirm_blocks(rows, similarity).select(F.col("node").alias("a"), F.col("label").alias("b")))


def candidates(nodes: DataFrame, rows: int, similarity: int = SIMILARITY) -> DataFrame:
    """Distinct pairs ``a`` < ``b`` of nodes of different ``label`` that may be
    similar enough; and, with the number of a ``region`` and without ``b``, the
    nodes ``a`` of regions of which not all pairs are among them."""
    schema = StructType.fromDDL("region long, a long, b long")

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            a, b, region, node = _near(pa.Table.from_batches(batches), similarity)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=schema.names)
            yield pa.RecordBatch.from_arrays([pa.array(region), pa.array(node), pa.nulls(len(node), pa.int64())], names=schema.names)
            del batches, a, b, region, node
            release()

    return _dealt_forest(nodes, rows, TREES).mapInArrow(run, schema).distinct()


def _similar(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    inter = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inter >= similarity * (len(a) + len(b) - inter)


class _Union:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (p := self.parent.setdefault(x, x)) != x:
            path.append(x)
            x = p
        for y in path:
            self.parent[y] = x
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def _confirm_blocks(rows: DataFrame, similarity: int) -> DataFrame:
    """Rows (cluster, block, a, b, shingles): a set where ``b`` is null, else a
    pair.  Returns each node's ``label`` within its block, by confirmed pairs."""

    def run(batches):
        key, sets, union = None, {}, _Union()

        def labels() -> pa.RecordBatch:
            nodes = list(sets)
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([union.root(x) for x in nodes], pa.int64())], names=["node", "label"])

        for batch in batches:
            for cluster, block, a, b, shingles in zip(*(batch.column(c).to_pylist() for c in ("cluster", "block", "a", "b", "shingles"))):
                if key != (cluster, block):
                    if sets:
                        yield labels()
                    key, sets, union = (cluster, block), {}, _Union()
                if b is None:
                    sets[a] = np.frombuffer(shingles, dtype=np.uint64)
                elif a in sets and b in sets and union.root(a) != union.root(b) and _similar(sets[a], sets[b], similarity):
                    union.join(a, b)
        if sets:
            yield labels()
        sets.clear()
        release()

    sorted_rows = rows.repartition("cluster", "block").sortWithinPartitions("cluster", "block", F.col("b").asc_nulls_first(), "a")
    return sorted_rows.mapInArrow(run, "node long, label long")


def _confirm_pairs(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose sets, joined to them, are similar enough."""

    def run(batches):
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("set_a", "set_b"))
            keep = [_similar(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), similarity) for x, y in zip(a, b)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _member_sets(docs: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """The members with their ``shingles``, without ``doc_id`` and ``set_key``.

    A bitmap of hashed ids, of ``MEMBER_BITS`` bits at most, tells nearly all
    other documents apart before anything is shuffled; the join decides.
    """
    spark = docs.sparkSession
    bits = min(MEMBER_BITS, 1 << (16 * members.count() + 1024).bit_length())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    words = members.select(place.alias("p")).groupBy(F.floor(F.col("p") / 64).cast("long").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 AS int))")).alias("v"))
    bitmap = np.zeros(bits // 64, dtype=np.int64)
    for row in words.toLocalIterator():
        bitmap[row["w"]] = row["v"]
    shared = spark.sparkContext.broadcast(bitmap)

    def make():
        shingles = Shingles(shingle)

        def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            at = batch.column("p").to_numpy()
            batch = batch.filter(pa.array((shared.value[at >> 6] >> (at & 63)) & 1 == 1))
            found = [shingles(t).tobytes() for t in text_bytes(batch)]
            keys = [hashlib.blake2b(s, digest_size=16).digest() for s in found]
            return {"set_key": pa.array(keys, pa.binary()), "shingles": pa.array(found, pa.binary()), "doc_id": batch.column("doc_id").cast(pa.int64())}

        return compute

    found = emit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", place.alias("p")), "doc_id long, set_key binary, shingles binary", make)
    # a row of the same id with another text is no member; equal rows do no harm later
    joined = found.join(members.withColumnsRenamed({"doc_id": "_doc", "set_key": "_key"}), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("set_key") == F.col("_key")))
    return joined.select(*[c for c in members.columns if c not in ("doc_id", "set_key")], "shingles")


def _confirm(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, similarity: int, cluster_shingles: int) -> DataFrame:
    """``node`` and ``label`` of the nodes of all candidates, by confirmed links."""
    clusters = components(pairs).withColumnRenamed("label", "cluster")
    members = nodes.join(clusters, "node")
    weights = members.groupBy("cluster").agg(F.ceil(F.greatest(F.sum("n") / cluster_shingles, F.count("*") / CLUSTER_NODES)).cast("int").alias("blocks"))
    members = written(members.join(weights, "cluster").select("cluster", "blocks", "node", "doc_id", "set_key"), "members")
    sets = written(_member_sets(docs, members, shingle), "sets")
    block = lambda node: F.pmod(F.xxhash64(node), F.col("blocks")).cast("int")
    placed = pairs.join(members.select(F.col("node").alias("a"), "cluster", "blocks"), "a").select("cluster", "a", "b", block("a").alias("block"), block("b").alias("other"))
    rows = sets.select("cluster", block("node").alias("block"), F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "shingles").unionByName(
        placed.where("block = other").select("cluster", "block", "a", "b", F.lit(None).cast("binary").alias("shingles")))
    labels = written(_confirm_blocks(rows, similarity), "confirmed")
    between = placed.where("block <> other").select("a", "b")
    if members.where("blocks > 1").isEmpty():
        return labels
    links, left = labels.select(F.col("node").alias("a"), F.col("label").alias("b")), written(between, "between")
    one, turns = Window.partitionBy("low", "high").orderBy("a", "b"), 4
    while True:
        label = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
        left = left.join(label("a"), "a").join(label("b"), "b").where("label_a <> label_b").select("a", "b", F.least("label_a", "label_b").alias("low"), F.greatest("label_a", "label_b").alias("high"))
        left = written(left.withColumn("turn", F.row_number().over(one)), "between")
        if left.isEmpty():
            return labels
        found = written(_confirm_pairs(left.where(F.col("turn") <= turns), sets, similarity), "links")
        left, turns = left.where(F.col("turn") > turns).select("a", "b"), 4 * turns
        if not found.isEmpty():
            links = links.unionByName(found)
            # nodes without any link keep themselves
            joined = components(links)
            labels = written(labels.select("node").join(joined, "node", "left").select("node", F.coalesce("label", "node").alias("label")), "confirmed")


def _compared(rows: pa.Table, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect nodes of different labels, and of different blocks if
    there are two: by sizes, bits and, if there are any, full sets."""
    node, first = np.unique(rows.column("node").to_numpy(), return_index=True)
    size = rows.column("n").to_numpy()[first]
    by_size = np.argsort(size, kind="stable")
    node, first, size = node[by_size], first[by_size], size[by_size]
    rows = rows.take(pa.array(first))
    n = len(node)
    label, block = rows.column("label").to_numpy(), rows.column("block").to_numpy()
    apart = block.min() != block.max()
    bits = np.zeros((n, 16), dtype=np.uint8)
    bits[:, : VALUES // 8] = np.frombuffer(b"".join(rows.column("bits").to_pylist()), dtype=np.uint8).reshape(n, VALUES // 8)
    bits = bits.view(np.uint64)
    differ = VALUES - _least_bits(similarity)
    ends = np.searchsorted(size, 100 * size // similarity, side="right")
    exact = "shingles" in rows.column_names
    if exact:
        known, ids = np.unique(np.frombuffer(b"".join(rows.column("shingles").to_pylist()), dtype=np.uint64), return_inverse=True)
        at, mark = np.concatenate([[0], np.cumsum(size)]), np.zeros(len(known), dtype=bool)
    root = np.unique(label, return_inverse=True)[1] if exact else np.arange(n)
    left, right = [], []
    for i in range(n):
        j = np.arange(i + 1, ends[i])
        j = j[(root[j] != root[i]) & (label[j] != label[i])]
        if apart:
            j = j[block[j] != block[i]]
        j = j[np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1) <= differ]
        if exact and len(j):
            mark[ids[at[i] : at[i + 1]]] = True
            shared = np.array([np.count_nonzero(mark[ids[at[k] : at[k + 1]]]) for k in j])
            mark[ids[at[i] : at[i + 1]]] = False
            j = j[100 * shared >= similarity * (size[i] + size[j] - shared)]
        if len(j):
            others, one = np.unique(root[j], return_index=True)
            left.append(np.full(len(one), node[i]))
            right.append(node[j[one]])
            root[np.isin(root, others)] = root[i]
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _compare(members: DataFrame, weight: str, limit: int, similarity: int) -> DataFrame:
    """Links ``a``, ``b`` between the members of a ``cluster`` that differ in
    ``label``.  Clusters above ``limit`` are cut into blocks, of which each two
    meet in a task; those of the label with most members don't meet each other."""
    of_label = members.groupBy("cluster", "label").agg(F.sum(weight).alias("w"))
    of_cluster = of_label.groupBy("cluster").agg(F.sum("w").alias("all"), F.max("w").alias("most"), F.max_by("label", F.struct("w", "label")).alias("main"))
    part = lambda w: F.ceil(w / limit).cast("int")
    whole = F.col("all") <= limit
    cuts = of_cluster.select("cluster", "main", F.when(whole, 0).otherwise(part(F.col("most"))).alias("of_main"), F.when(whole, 1).otherwise(part(F.col("all") - F.col("most"))).alias("of_rest"))
    place = F.xxhash64("node")
    is_main = (F.col("of_main") > 0) & (F.col("label") == F.col("main"))
    block = F.when(is_main, F.pmod(place, F.col("of_main"))).otherwise(F.col("of_main") + F.pmod(place, F.col("of_rest"))).cast("int")
    rows = members.join(cuts.where("of_rest > 0"), "cluster").withColumn("block", block)
    rows = rows.withColumn("other", F.explode(F.sequence(F.when(is_main, F.col("of_main")).otherwise(0), F.col("of_main") + F.col("of_rest") - 1)))
    rows = rows.select("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "label", "n", "bits", *[c for c in members.columns if c == "shingles"])

    def run(table: pa.Table) -> pa.Table:
        a, b = _compared(table, similarity)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("cluster", "low", "high").applyInArrow(run, "a long, b long")


def _with_bits(nodes: DataFrame) -> DataFrame:
    """The ``signature`` gives way to ``bits``, one of each value."""

    def run(batches):
        for batch in batches:
            signature = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype=np.uint32).reshape(-1, VALUES)
            bits = [b.tobytes() for b in np.packbits(signature & 1 == 1, axis=1)]
            yield batch.drop_columns(["signature"]).append_column("bits", pa.array(bits, pa.binary()))

    rest = nodes.drop("signature").schema
    return nodes.select(*rest.names, "signature").mapInArrow(run, StructType([*rest.fields, *StructType.fromDDL("bits binary").fields]))


def _connect(docs: DataFrame, nodes: DataFrame, crowds: DataFrame, labels: DataFrame, shingle: int, similarity: int, cluster_shingles: int) -> DataFrame:
    """``labels`` after all links within each ``region`` of ``crowds``."""
    labelled = crowds.join(labels, "node", "left").select("region", "node", F.coalesce("label", "node").alias("label"))
    unsettled = labelled.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("first"))
    unsettled = written(unsettled.where("low <> high").select("region", "first"), "unsettled")
    if unsettled.isEmpty():
        return labels
    clusters = components(crowds.join(unsettled, "region").select(F.col("node").alias("a"), F.col("first").alias("b")))
    members = clusters.withColumnRenamed("label", "cluster").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    members = written(_with_bits(members.join(nodes, "node")), "members")
    may = written(_compare(members.withColumn("one", F.lit(1)), "one", BLOCK_NODES, similarity), "may")
    if may.isEmpty():
        return labels
    members = written(members.drop("cluster").join(components(may).withColumnRenamed("label", "cluster"), "node"), "members")
    sets = written(_member_sets(docs, members, shingle), "sets")
    links = written(_compare(sets, "n", cluster_shingles, similarity), "links")
    if links.isEmpty():
        return labels
    return components(links.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, cluster_shingles: int = CLUSTER_SHINGLES, group: bool = False) -> DataFrame:
    """The columns of ``docs`` but the text, plus ``n_shingles``,
    ``component_id`` (smallest doc_id of the documents that links reach) and
    ``kept`` (it is that document); if wanted, also a number of the ``group``,
    null for texts without a word."""
    docs = without(docs, ["n_shingles", "component_id", "kept", "set_key", "signature", *(["group"] if group else [])])
    ids = written(without(sketch(docs, shingle), ["text"]), "sketch")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n_shingles", "signature"))
    nodes = ids.where("n_shingles > 0").groupBy("set_key").agg(first.alias("first"))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "set_key", F.col("first.doc_id").alias("doc_id"), F.col("first.n_shingles").alias("n"), F.col("first.signature").alias("signature")), "nodes")
    rows = nodes.count()
    first = _first_links(docs, nodes.withColumn("label", F.col("node")), rows, shingle, similarity)
    found = written(candidates(nodes.join(first, "node", "left").withColumn("label", F.coalesce("label", "node")), rows, similarity), "pairs")
    pairs, crowds = found.where("region IS NULL").select("a", "b"), found.where("region IS NOT NULL").select("region", F.col("a").alias("node"))
    labels = _confirm(docs, nodes.drop("signature"), pairs, shingle, similarity, cluster_shingles)
    labels = components(first.unionByName(labels).select(F.col("node").alias("a"), F.col("label").alias("b")))
    labels = _connect(docs, nodes, crowds, labels, shingle, similarity, cluster_shingles)
    # only sets with links to others need more than the smallest id of their own rows
    linked = labels.join(nodes.select("node", "set_key", "doc_id"), "node")
    smallest = linked.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    own = nodes.select("node", "set_key", "doc_id").join(linked.select("node", "label").join(smallest, "label").select("node", "component_id", "label"), "node", "left")
    own = own.select(F.col("set_key").alias("_key"), F.coalesce("component_id", "doc_id").alias("_component"), *([F.coalesce("label", "node").alias("group")] if group else []))
    out = ids.join(own, F.col("set_key") == F.col("_key"), "left").withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).drop("_key", "_component", "signature")
