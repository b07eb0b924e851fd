"""Chat formatting in budgeted windows, as built-in Spark functions only.

Turns of a conversation are put in order, and prefix sums of their tokens cut
it into turn-aligned spans: a turn belongs to the span in whose ``span_tokens``
its first token falls.  Each span becomes one window of formatted text: the
system turn that opens the conversation, the turns of the last
``history_tokens`` tokens before the span, then the span.  Repeated turns are
marked as such and carry no loss, so each assistant text is a target once.

Template: ``<|turn|>role<|text|>text<|end|>`` and a line feed; ``<|again|>``
opens a repeated turn.  Control strings (of this template and of other common
ones) inside roles and texts are escaped by ``%`` codes, which reverses.

A window holds at most the system turn, the history, the span's tokens and
what its last turn has beyond them; a turn is never split.

Edge cases: null texts and roles are empty; turns with the same number are
ordered by role and text, repeated rows count as turns; a null conv_id is a
conversation of its own; only a system turn that comes first is retained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN_TOKENS = 256
HISTORY_TOKENS = 64
TURN_TOKENS = 4  # what a turn's marks count
WORD = r"[^\x20\x09-\x0D]+"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("%"), F.lit("%25"))
    out = F.regexp_replace(out, r"<(?=\||/?s>|</?SYS>>|/?SYS>>)", "%3C")
    return F.regexp_replace(out, r"\[(?=/?INST\])", "%5B")


def unescape(text: Column) -> Column:
    for code, plain in (("%5B", "["), ("%3C", "<"), ("%25", "%")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _head(turn: Column) -> Column:
    return F.concat(F.when(turn.again, F.lit("<|again|>")).otherwise(F.lit("<|turn|>")), escape(turn.role), F.lit("<|text|>"))


TAIL = "<|end|>\n"


def windows(turns: DataFrame, span_tokens: int = SPAN_TOKENS, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """One row for each window: ``conv_id``, ``window``, ``text`` and ``loss``
    (character intervals of the targets, stop excluded)."""
    if history_tokens > span_tokens:
        raise ValueError("the history may not be longer than a span")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    later = Window.partitionBy("conv_id").orderBy("window").rangeBetween(1, Window.unboundedFollowing)
    rows = (
        turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tokens", F.regexp_count("text", F.lit(WORD)) + TURN_TOKENS)
        .withColumn("n", F.row_number().over(order))
        .withColumn("start", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("window", F.floor(F.col("start") / span_tokens).cast("long"))
        .withColumns({"next": F.min("window").over(later), "next_start": F.min("start").over(later)})
        .withColumn("lead", (F.col("n") == 1) & (F.col("role") == "system"))
    )
    again = (~F.col("lead")) & (F.col("next_start") - F.col("start") <= history_tokens)
    placed = F.when(F.coalesce(again, F.lit(False)), F.array(F.struct(F.col("window").alias("w"), F.lit(False).alias("again")), F.struct(F.col("next").alias("w"), F.lit(True).alias("again")))).otherwise(
        F.array(F.struct(F.col("window").alias("w"), F.lit(False).alias("again"))))
    spans = (
        rows.withColumn("p", F.explode(placed))
        .groupBy("conv_id", F.col("p.w").alias("window"))
        .agg(F.array_sort(F.collect_list(F.struct("n", F.col("p.again").alias("again"), "role", "text"))).alias("turns"))
    )
    leads = rows.where("lead").select(F.col("conv_id").alias("_conv"), F.array(F.struct("n", F.lit(True).alias("again"), "role", "text")).alias("_lead"))
    full = spans.join(leads, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    full = full.withColumn("turns", F.when((F.col("window") > 0) & F.col("_lead").isNotNull(), F.concat("_lead", "turns")).otherwise(F.col("turns")))
    full = full.withColumn("parts", F.transform("turns", lambda t: F.struct(
        _head(t).alias("head"), escape(t.text).alias("body"), ((t.role == "assistant") & ~t.again).alias("target"))))
    full = full.withColumn("starts", F.transform("parts", lambda p, i: F.aggregate(
        F.slice("parts", F.lit(1), i), F.lit(0), lambda t, q: t + F.length(q.head) + F.length(q.body) + len(TAIL))))
    loss = F.transform(F.arrays_zip("parts", "starts"), lambda z: F.struct(
        (z.starts + F.length(z.parts.head)).alias("start"), (z.starts + F.length(z.parts.head) + F.length(z.parts.body)).alias("stop"), z.parts.target.alias("target")))
    return full.select(
        "conv_id", "window",
        F.array_join(F.transform("parts", lambda p: F.concat(p.head, p.body, F.lit(TAIL))), "").alias("text"),
        F.transform(F.filter(loss, lambda s: s.target), lambda s: F.struct(s.start.alias("start"), s.stop.alias("stop"))).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Each window's ``turns`` (role, text; without repeated ones) and
    ``targets`` (texts under the loss mask), read from the formatted text alone."""
    parts = F.transform(F.filter(F.split("text", r"<\|end\|>\n", -1), lambda s: s.startswith("<|turn|>")), lambda s: F.split(F.substring(s, 9, 2147483647), r"<\|text\|>", 2))
    return formatted.select(
        "conv_id", "window", F.length("text").cast("long").alias("chars"),
        F.transform(parts, lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text"))).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s.start + 1, s.stop - s.start))).alias("targets"),
    )
