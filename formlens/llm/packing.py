"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

A text becomes token ids with an end id after them; only documents longer than
the capacity are cut, into pieces of full capacity and a rest.  Pieces are
packed by length alone, so the plan is made from the number of pieces of each
length: at most ``capacity`` counts, whatever the size of the corpus.

* Pieces above a third of the capacity, longest first, are matched greedily:
  each takes the longest partner that fits, so at most two share a bin.
* Smaller pieces, longest first, go to the bin with the smallest gap that
  holds them; a new bin is opened only if there is none.

Bins with the same content are handled together, so a step moves thousands of
pieces.  The plan says, for ranks of pieces of one length, in which bins and
where they lie.  Each task numbers its own pieces of a length; a prefix sum
over (task, length) counts turns these into ranks, and a look-up in the plan
into places.  No group of pieces meets in one task, and the tokens themselves
are never shuffled.

Edge cases: a null or empty text is one piece with the end id alone; repeated
rows are packed row by row; without rows there are no pieces.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import slabs, without, written

CAPACITY = 2048
END_ID = 0
SLAB = 4 << 20  # bytes of text that are tokenized at once
CACHE_WORDS = 1_000_000  # that a task remembers: some 200 MB
CACHE_IDS = 16_000_000  # of remembered words: 64 MB
BLANK, LETTER, DIGIT, MARK, ODD = range(5)


def _kinds() -> bytes:
    """The kind of each UTF-8 byte, if it is part of an ASCII character or of a letter from À to ÿ.

    Chunks with other characters can't be split into runs: no accents apart from their letters, no
    apostrophes (contractions) and no bars (special tokens)."""
    kinds = np.full(256, ODD, dtype=np.uint8)
    kinds[0x21:0x7F] = MARK
    kinds[[ord(c) for c in "'|"]] = ODD
    kinds[[ord(c) for c in " \n\t\r"]] = BLANK  # where a text may be cut: the tokenizer drops all white space
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), 0xC3, *range(0x80, 0xC0)]] = LETTER
    return kinds.tobytes()


KINDS = _kinds()
PIECES = "piece int, start long, length long, ids_crc32 long, _part int, _rank long"


def _runs(raw: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of texts that lie one after the other in ``raw`` from ``starts`` on (the last
    is their end): runs of letters or marks, single digits, and whole chunks between blanks if
    they are odd.  With them, which are odd, and before which of them each text begins."""
    text = raw.tobytes()
    kind, low = np.frombuffer(bytearray(text.translate(KINDS)), np.uint8), np.frombuffer(bytearray(text.lower()), np.uint8)
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1  # byte of a letter from À to ÿ, or of × or ÷
    low[second[raw[second] <= 0x9E]] += 32
    kind[second[(raw[second] == 0x97) | (raw[second] == 0xB7)]] = ODD
    blank, begins = kind == BLANK, np.zeros(len(raw), dtype=bool)
    begins[starts[starts < len(raw)]] = True
    first = begins | (kind == DIGIT)
    first[1:] |= kind[1:] != kind[:-1]
    first &= ~blank
    odd = np.flatnonzero(kind == ODD)
    whole = np.zeros(len(raw), dtype=bool)
    if len(odd):
        stops = np.flatnonzero(blank | begins)
        k = np.unique(np.searchsorted(stops, odd, "right")) - 1  # of the chunk's blank before it, or its own first byte
        heads = stops[k] + blank[stops[k]]
        step = np.zeros(len(raw) + 1, dtype=np.int8)
        step[heads] = 1
        step[np.append(stops, len(raw))[k + 1]] -= 1
        whole = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        first[whole] = False
        first[heads] = True
        low = np.where(whole, raw, low)
    at, filled = np.flatnonzero(first), ~blank
    words, offsets = low[filled], np.flatnonzero(first[filled])
    offsets = np.append(offsets, len(words)).astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(words)])
    return runs, whole[at], np.searchsorted(at, starts)


class ChunkTokenizer:
    """Token ids of a text as little-endian 32-bit bytes.

    The tokenizer drops white space and splits what is left before it merges,
    so the ids of a text are those of its chunks between blanks, one after the
    other.  Plain chunks are split further, into runs of letters, digits and
    marks.  All texts of a call are split at once, as arrays of bytes, and each
    different word is looked up once; thousands of new ones are encoded in one
    call, in which the tokens that end a word show where each of them ends.
    Known ones are remembered.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}  # word k has the ids from ends[k] to ends[k + 1]
        self.ids, self.ends = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _learn(self, words: list[bytes], odd: np.ndarray) -> None:
        """Remembers the ids of words; odd ones are encoded one by one."""
        flags = odd.tolist()
        plain, whole = [w for w, o in zip(words, flags) if not o], [w for w, o in zip(words, flags) if o]
        new, ends = [self.ids], [self.ends]

        def add(ids: np.ndarray, cuts: np.ndarray) -> None:
            new.append(ids)
            ends.append(ends[-1][-1] + cuts)

        for k in range(0, len(plain), 10_000):
            part = plain[k : k + 10_000]
            ids = np.concatenate(self._encode([b" ".join(part[i : i + 200]) for i in range(0, len(part), 200)]))
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) != len(part):  # words without an end token: a tokenizer of another kind
                each = self._encode(part)
                ids, cuts = np.concatenate(each), np.cumsum([len(x) for x in each])
            add(ids, cuts)
        for w in whole:
            ids = self._encode([w])[0]
            add(ids, np.array([len(ids)]))
        self.ids, self.ends = np.concatenate(new), np.concatenate(ends)
        self.known.update(zip([*plain, *whole], count(len(self.known))))

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("").cast(pa.large_string())
        if not len(texts):
            return []
        _, starts, raw = texts.buffers()
        starts = np.frombuffer(starts, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(raw or b"", dtype=np.uint8)[starts[0] : starts[-1]]
        runs, odd, first = _runs(raw, starts - starts[0])
        runs = runs.dictionary_encode()
        words, at = runs.dictionary.to_pylist(), runs.indices.to_numpy()
        is_odd = np.zeros(len(words), dtype=bool)
        is_odd[at[odd]] = True
        places = list(map(self.known.get, words))
        new = [i for i, k in enumerate(places) if k is None]
        if len(self.known) + len(new) > CACHE_WORDS or len(self.ids) > CACHE_IDS:
            self._forget()
            new = range(len(words))
        if new:
            self._learn([words[i] for i in new], is_odd[new])
            for i in new:
                places[i] = self.known[words[i]]
        own = pa.Array.from_buffers(pa.large_binary(), len(self.known), [None, pa.py_buffer(4 * self.ends), pa.py_buffer(self.ids)])
        of = own.take(pa.array(places, pa.int64()))  # the ids of this call's words
        _, ends, ids = of.take(runs.indices).buffers()
        cuts = np.frombuffer(ends, dtype=np.int64)[first].tolist()
        ids = (ids or pa.py_buffer(b"")).to_pybytes()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents, written to the shared folder: columns of
    ``docs`` without the text, and ``piece``, ``start``, ``length``,
    ``ids_crc32`` (of the little-endian 32-bit ids) and, if asked for, ``ids``."""
    ddl = PIECES + (", ids array<int>" if with_ids else "")
    new = StructType.fromDDL(ddl)
    base = without(docs, [n for n in new.names])
    rest = without(base, ["text"])
    schema = StructType(rest.schema.fields + new.fields)
    others = rest.columns
    place = base.columns.index("text")
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches):
        tokenize, part, seen = ChunkTokenizer(tokenizer_path), TaskContext.get().partitionId(), {}
        for batch in batches:
            for slab in slabs(batch, limit=SLAB):
                row, piece, start, length, crc, rank, ids = [], [], [], [], [], [], []
                for d, tokens in enumerate(tokenize(slab.column(place))):
                    tokens += end
                    for k, at in enumerate(range(0, len(tokens), 4 * capacity)):
                        own = tokens[at : at + 4 * capacity]
                        n = len(own) // 4
                        row.append(d)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(n)
                        crc.append(zlib.crc32(own))
                        rank.append(seen.get(n, 0))
                        seen[n] = rank[-1] + 1
                        if with_ids:
                            ids.append(np.frombuffer(own, dtype="<u4").astype(np.int32))
                old = slab.select(others).take(pa.array(row, type=pa.int32())).columns if others else []
                new = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(row), pa.int32()), pa.array(rank, pa.int64())]
                if with_ids:
                    new.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([*old, *new], names=schema.names)

    return written(base.mapInArrow(run, schema), "pieces")


class _Bins:
    """Bins by gap; those with the same gap and content count as one kind."""

    def __init__(self):
        self.gaps: list[int] = []  # sorted, with at least one kind each
        self.kinds: dict[int, list[tuple[int, tuple]]] = {}  # gap: (number of bins, content as (length, times) pairs)

    def put(self, gap: int, number: int, content: tuple) -> None:
        if number:
            if gap not in self.kinds:
                self.kinds[gap] = []
                insort(self.gaps, gap)
            self.kinds[gap].append((number, content))

    def take(self, length: int) -> tuple[int, int, tuple] | None:
        """A kind with the smallest gap that holds ``length``."""
        k = bisect_left(self.gaps, length)
        if k == len(self.gaps):
            return None
        gap = self.gaps[k]
        number, content = self.kinds[gap].pop()
        if not self.kinds[gap]:
            del self.kinds[gap], self.gaps[k]
        return gap, number, content


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Kinds of bins: how many, and what they hold as (length, times) pairs in order."""
    left = dict(counts)
    bins = _Bins()
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        k = bisect_left(large, capacity - n + 1) - 1  # the longest partner that fits
        partner = large[k] if k >= 0 else None
        if partner == n and left[n] < 2:
            k -= 1
            partner = large[k] if k >= 0 else None
        if partner is None:
            bins.put(capacity - n, left[n], ((n, 1),))
            left[n] = 0
        elif partner == n:
            bins.put(capacity - 2 * n, left[n] // 2, ((n, 2),))
            left[n] %= 2
        else:
            number = min(left[n], left[partner])
            bins.put(capacity - n - partner, number, ((n, 1), (partner, 1)))
            left[n] -= number
            left[partner] -= number
            if not left[partner]:
                large.pop(k)
        if not left[n]:
            large.pop()
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap, number, content = bins.take(n) or (capacity, -(-left[n] // (capacity // n)), ())
            times = gap // n
            full = min(number, left[n] // times)
            bins.put(gap - times * n, full, (*content, (n, times)))
            left[n] -= full * times
            if full < number:
                if left[n]:  # the last, partly filled bin
                    bins.put(gap - left[n] * n, 1, (*content, (n, left[n])))
                    full += 1
                    left[n] = 0
                bins.put(gap, number - full, content)
    return sorted((kind for kinds in bins.kinds.values() for kind in kinds if kind[1]), key=lambda k: k[1], reverse=True)


def _places(kinds: list[tuple[int, tuple[tuple[int, int], ...]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first bin, times a bin and offset of each run of ranks."""
    used: dict[int, int] = {}
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    first_bin = 0
    for number, content in kinds:
        offset = 0
        for length, times in content:
            runs.setdefault(length, []).append((used.get(length, 0), first_bin, times, offset))
            used[length] = used.get(length, 0) + number * times
            offset += length * times
        first_bin += number
    return {n: tuple(np.array(x, dtype=np.int64) for x in zip(*r)) for n, r in runs.items()}


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces()`` plus ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    by_task = cut.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    # at most one row for each length
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places(plan(counts, capacity)))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_task.select(F.col("_part").alias("_p"), F.col("length").alias("_l"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ranked = cut.join(firsts, (F.col("_part") == F.col("_p")) & (F.col("length") == F.col("_l")))
    base = without(ranked, ["sequence_id", "offset", "_p", "_l", "_part"]).withColumn("_rank", F.col("_rank") + F.col("_first")).drop("_first")
    schema = StructType(without(base, ["_rank"]).schema.fields + StructType.fromDDL("sequence_id long, offset long").fields)

    def locate(batches):
        plan_of = places.value
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            bins, offsets = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for n in np.unique(lengths):
                own = np.flatnonzero(lengths == n)
                first, first_bin, times, offset = plan_of[int(n)]
                k = np.searchsorted(first, ranks[own], "right") - 1
                r = ranks[own] - first[k]
                bins[own] = first_bin[k] + r // times[k]
                offsets[own] = offset[k] + r % times[k] * n
            kept = [c for name, c in zip(batch.schema.names, batch.columns) if name != "_rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bins), pa.array(offsets)], names=schema.names)

    return base.mapInArrow(locate, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack all documents: a row for each piece with its place."""
    return pack(pieces(docs, tokenizer_path, capacity, with_ids), capacity)
