"""CSV records with line breaks in cells, read by byte ranges (O1).

A whole-file CSV reader gives a file to one task.  Here files are read as
lines, which Spark deals out by byte ranges.  Between two lines a reader is
either between two records or inside a quoted cell, so a range of lines maps
these two states to two states.  One job takes the maps of the ranges of files
that have more than one (a row for each range); their composition along a
file, a prefix scan, tells in which state each range begins.  Each range is then cut into
records by itself.  Files in which a record goes over the end of a range are
read once more for the parts of such records, which meet in groups of their
own: the ranges that one record spans.

The result is that of the whole-file reader for records that end with LF or
CR LF and whose quotes are escaped by doubling, stray quotes in unquoted cells
included.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formlens.operators.common import reused

RANGE_BYTES = 64 << 20
#: Ranges that begin inside a cell: up to so many, their table goes to all tasks (some 200 bytes each);
#: beyond, the lines are shuffled by range and put in order again.
BROADCAST_RANGES = 100_000
#: Lines that go to Python at once, and those that pass unchanged as an array of their own.
BATCH_LINES, RUN_LINES = 2_000, 32

WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3  # a record, or what a range has of one


def inside_after(line: str, inside: bool, sep: str, quote: str) -> bool:
    """Whether a cell is still open after a line; ``inside`` says so for its beginning."""
    at, end = 0, len(line)
    while True:
        if not inside:
            if not line.startswith(quote, at):
                at = line.find(sep, at)
                if at < 0:
                    return False
                at += len(sep)
                continue
            at += 1
        at = line.find(quote, at)
        if at < 0:
            return True
        inside = line.startswith(quote, at + 1)  # a doubled quote
        if inside:
            at += 2
            continue
        # closed, or a stray quote after which the cell goes on unquoted
        at = line.find(sep, at + 1)
        if at < 0:
            return False
        at += len(sep)
        if at > end:
            return False


def _lines(spark: SparkSession, paths: list[str], range_bytes: int) -> DataFrame:
    """``(source_file, block, single, value)``: lines as bytes, in order within a
    range; ``block`` is where it begins, ``single`` whether the file has no other."""
    # a session of its own, for settings under which ranges depend on the files alone
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(range_bytes))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_LINES))
    return own.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
        (F.col("_metadata.file_size") <= range_bytes).alias("single"), F.col("value").cast("binary").alias("value"))


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Runs of lines of one range."""
    for batch in batches:
        files, blocks = batch.column("source_file"), batch.column("block")
        at = 0
        while at < batch.num_rows:
            file, block = files[at].as_py(), blocks[at].as_py()
            same = pc.and_(pc.equal(files, file), pc.equal(blocks, block)).slice(at)
            stop = pc.index(same, False).as_py()
            run = batch.slice(at, batch.num_rows - at if stop < 0 else stop)
            at += run.num_rows
            yield file, block, run


def _texts(run: pa.RecordBatch, encoding: str) -> list[str]:
    return [v.decode(encoding, "replace") for v in run.column("value").to_pylist()]


def _strings(run: pa.RecordBatch, encoding: str) -> pa.Array:
    try:
        return run.column("value").cast(pa.string())
    except pa.ArrowInvalid:  # some bytes are no text of this encoding
        return pa.array(_texts(run, encoding))


def _with(run: pa.RecordBatch, mark: str) -> pa.Array:
    return pc.match_substring(run.column("value"), mark)


def _closed_form(sep: str, quote: str, encoding: str) -> str | None:
    """A pattern of the lines for which ``inside_after(line, False)`` is false; ``None`` if bytes don't tell."""
    if encoding.upper() not in ("UTF-8", "US-ASCII") or not all(len(c) == 1 and c.isascii() for c in (sep, quote)) or sep == quote:
        return None
    s, q = (rf"\x{ord(c):02x}" for c in (sep, quote))
    cell = f"(?:[^{q}{s}][^{s}]*|{q}(?:[^{q}]|{q}{q})*{q}(?:[^{q}{s}][^{s}]*)?)?"
    return f"^{cell}(?:{s}{cell})*$"


def _open_lines(run: pa.RecordBatch, form: str) -> np.ndarray:
    """Places of the lines that leave a cell open, if they begin outside of one."""
    return np.flatnonzero(~pc.match_substring_regex(run.column("value"), form).to_numpy(zero_copy_only=False))


def _states(lines: DataFrame, sep: str, quote: str, encoding: str) -> DataFrame:
    """``(source_file, block, from_outside, from_inside)``: the state after each range, by that before it."""

    form = _closed_form(sep, quote, encoding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[bool]] = {}
        for file, block, lot in _by_range(batches):
            states = found.setdefault((file, block), [False, True])
            lot = lot.filter(_with(lot, quote))  # others change no state
            values, n, i = lot.column("value"), lot.num_rows, 0
            opens = _open_lines(lot, form) if form else np.arange(n)
            while i < n:
                if not any(states):
                    # only a line that leaves a cell open changes this
                    at = np.searchsorted(opens, i)
                    if at == len(opens):
                        break
                    i = int(opens[at])
                text = values[i].as_py().decode(encoding, "replace").removesuffix("\r")
                after = {s: inside_after(text, s, sep, quote) for s in set(states)}
                states[:] = [after[s] for s in states]
                i += 1
        rows = [(f, b, *s) for (f, b), s in found.items()]
        columns = zip(*rows) if rows else [[]] * 4
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["source_file", "block", "from_outside", "from_inside"])

    return lines.mapInArrow(run, "source_file string, block long, from_outside boolean, from_inside boolean")


def _after_each(states: DataFrame) -> DataFrame:
    """``(source_file, block, before, after)``: whether a cell is open before and after each range."""
    so_far = Window.partitionBy("source_file").orderBy("block")
    # a range leaves the state as it was, turns it round or sets it, whatever it was before; so it is
    # what the last range that sets it says, turned round as often as ranges have done so since
    both = F.col("from_outside") == F.col("from_inside")
    turns = states.withColumn("turns", F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("long")).over(so_far))
    last = F.last(F.when(both, F.struct(F.col("from_outside").alias("state"), "turns")), ignorenulls=True).over(so_far)
    since = turns.withColumn("last", last)
    odd = (F.col("turns") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    after = since.withColumn("after", F.coalesce("last.state", F.lit(False)) != odd)
    return after.select("source_file", "block", "after", F.coalesce(F.lag("after").over(so_far), F.lit(False)).alias("before"))


def _cut(sep: str, quote: str, encoding: str):
    """Records and parts of records of each range."""
    names = ["source_file", "block", "part", "record"]
    types = [pa.string(), pa.int64(), pa.int8(), pa.string()]

    form = _closed_form(sep, quote, encoding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, single, open_lines, inside, entered, header, first_line = None, False, [], False, False, False, False

        def parts_left() -> list[tuple]:
            """What is open at the end of a range, or of a file."""
            if key is None or not open_lines:
                return []
            return [(*key, WHOLE if single else MIDDLE if entered else TAIL, "\n".join(open_lines))]

        def arrays(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for file, block, lot in _by_range(batches):
            out = []
            if (file, block) != key:
                out += parts_left()
                key, single, open_lines, inside, header = (file, block), lot.column("single")[0].as_py(), [], lot.column("inside")[0].as_py(), block == 0
                entered = inside  # the first lines belong to a record that began before
                first_line = block == 0
            values, n, i = lot.column("value"), lot.num_rows, 0
            # lines that are not records as they are
            odd = np.union1d(_open_lines(lot, form), np.flatnonzero(_with(lot, "\r").to_numpy(zero_copy_only=False))) if form else None
            while i < n:
                if form and not (open_lines or entered or header or inside):
                    at = np.searchsorted(odd, i)
                    stop = int(odd[at]) if at < len(odd) else n
                    if stop - i >= RUN_LINES:
                        if out:
                            yield arrays(out)
                            out = []
                        lines = lot.slice(i, stop - i)
                        lines = lines.filter(pc.not_equal(pc.binary_length(lines.column("value")), 0))
                        if lines.num_rows:
                            whole = pa.array(np.full(lines.num_rows, WHOLE, np.int8))
                            yield pa.RecordBatch.from_arrays([lines.column("source_file"), lines.column("block"), whole, _strings(lines, encoding)], names=names)
                        i = stop
                        continue
                text = values[i].as_py().decode(encoding, "replace")
                i += 1
                if first_line:
                    text, first_line = text.removeprefix("\ufeff"), False
                bare = text.removesuffix("\r")
                if quote in bare:
                    inside = inside_after(bare, inside, sep, quote)
                if inside:
                    open_lines.append(text)
                    continue
                record = "\n".join([*open_lines, bare]) if open_lines else bare
                open_lines = []
                if entered:
                    out.append((*key, HEAD, record))
                elif header:
                    # the first record with anything in it names the columns
                    header = not record.replace(sep, "").replace(quote, "").strip()
                elif record:
                    out.append((*key, WHOLE, record))
                entered = False
            if out:
                yield arrays(out)
        if last := parts_left():
            yield arrays(last)

    return run


def read_records(spark: SparkSession, paths: list[str], sep: str = ",", quote: str = '"', encoding: str = "UTF-8",
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(source_file, record)``: the records of CSV files, without their header records, line breaks in cells included."""
    cut = lambda lines: lines.mapInArrow(_cut(sep, quote, encoding), "source_file string, block long, part byte, record string")
    large = _paths(spark.read.format("binaryFile").load(paths).where(F.col("length") > range_bytes))
    if not large:
        return cut(_lines(spark, paths, range_bytes).withColumn("inside", F.lit(False))).select("source_file", "record")
    states = reused(_states(_lines(spark, large, range_bytes), sep, quote, encoding), "states")
    ends = _after_each(states)
    inside = reused(ends.where("before").select("source_file", "block", F.col("before").alias("inside")), "inside")
    whole = cut(_marked(_lines(spark, paths, range_bytes), inside)).where(F.col("part") == WHOLE).select("source_file", "record")
    open_files = ends.where("before or after").select("source_file").distinct()
    crossed = _paths(spark.read.format("binaryFile").load(large).withColumn("source_file", F.col("_metadata.file_path")).join(open_files, "source_file", "left_semi"))
    if not crossed:
        return whole
    parts = cut(_marked(_lines(spark, crossed, range_bytes), inside)).where(F.col("part") != WHOLE)
    # a range has one part at most that came from before, and one that goes on
    order = [F.col("block"), F.col("part") == TAIL]
    begin = F.last(F.when(F.col("part") == TAIL, F.col("block")), ignorenulls=True).over(Window.partitionBy("source_file").orderBy(*order))
    joined = reused(parts, "parts").withColumn("begin", begin).groupBy("source_file", "begin").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", order[1].alias("last"), "record"))), lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(joined.select("source_file", "record"))


def _marked(lines: DataFrame, inside: DataFrame) -> DataFrame:
    """``lines`` with ``inside``: whether their range begins inside a cell."""
    key = ["source_file", "block"]
    if inside.count() <= BROADCAST_RANGES:
        marked = lines.join(F.broadcast(inside), key, "left")
    else:
        numbered = lines.withColumn("n", F.monotonically_increasing_id())
        marked = numbered.join(inside, key, "left").repartition(*key).sortWithinPartitions(*key, "n")
    return marked.select(*key, "single", "value", F.coalesce("inside", F.lit(False)).alias("inside"))


def _paths(files: DataFrame) -> list[str]:
    """Paths of files of several ranges each, in which no character acts as a pattern."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", r[0]) for r in files.select("path").collect()]


__all__ = ["inside_after", "read_records"]
