"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example's context is all turns before its reply, and only the reply is trainable.  Every example is written with its whole
context, as one row for each of its turns:

  conversation   [SYS] s [/SYS][INST] u1 [/INST] a1</s>[INST] u2 [/INST] a2</s>
  example 1      [SYS] s [/SYS][INST] u1 [/INST] a1</s>                              loss on a1
  example 2      [SYS] s [/SYS][INST] u1 [/INST] a1</s>[INST] u2 [/INST] a2</s>      loss on a2

The output grows with the square of a conversation's turns, as the method has it: a turn stands in every example whose target it
is or precedes.  These rows are made turn by turn where the turns lie, without a join, so no task holds a conversation or an example;
the copies of a turn's text stand side by side and take next to no room in a column file.  `example_texts` joins an example's rows to one text.
Turns after the last reply belong to no example; they stay once, untrained.

Texts cannot forge marks: between < or [ and the rest of a control string stands one backslash more than in the text
(`[INST]` becomes `[\\INST]`, and `[\\INST]` `[\\\\INST]`), which reading takes away again.

Null text, role: empty.  Roles other than system, user and assistant are written out in a mark of their own.  Turns of a
conversation stand by turn (nulls first), then role, then formatted text; repeated rows are turns of their own; a null conv_id is a
conversation.  Other columns are left aside, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from .shared import partition_count, small_batches, stage

# The template.  No mark holds an opening character (< or [) but at its start.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
ANY_ROLE = ("[TURN]", "[/TURN] ", "</s>")
CONTROL = r"/?s>|/?INST\]|/?SYS\]|/?TURN\]"

_ESCAPED = re.compile(rf"([<\[])\\(\\*)({CONTROL})")
_OF_ANY_ROLE = re.compile(r"\[TURN\](.*?)\[/TURN\] ", re.S)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def read_piece(piece: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    for role, (first, last) in MARKS.items():
        if piece.startswith(first):
            return role, unescaped(piece[len(first) : len(piece) - len(last)])
    head = _OF_ANY_ROLE.match(piece)
    return unescaped(head[1]), unescaped(piece[head.end() : len(piece) - len(ANY_ROLE[2])])


def _marks(role: Column) -> tuple[Column, Column]:
    first = F.concat(F.lit(ANY_ROLE[0]), escaped(role), F.lit(ANY_ROLE[1]))
    last = F.lit(ANY_ROLE[2])
    for name, (a, b) in MARKS.items():
        first, last = F.when(role == name, a).otherwise(first), F.when(role == name, b).otherwise(last)
    return first, last


def expand_targets(conversations: DataFrame) -> DataFrame:
    """A row for each turn of each example: conv_id, example (from 1; null for turns after the last reply), examples (how many the
    conversation has), position (from 1), turn, piece (the formatted turn), start (characters of the example before it), chars,
    trainable (whether this is the example's target), loss_start and loss_end (characters of the example that it trains; null for other rows).

    Turns are dealt out by ranges of (conv_id, turn), so a conversation that holds much of the table lies in many partitions.
    Places are counted within each partition and shifted by what the conversation has in earlier partitions: only the first
    conversation of a partition can have such rows, so the shifts are at most one row a partition and are broadcast.
    """
    spark = conversations.sparkSession
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), empty("role").alias("role"), empty("text").alias("text"))
    first, last = _marks(F.col("role"))
    own = escaped(F.col("text"))
    pieces = turns.select("conv_id", "turn", "role", F.concat(first, own, last).alias("piece"), F.length(first).alias("head"), F.length(last).alias("tail"), (F.col("role") == "assistant").alias("trainable"))
    order = ["turn", "role", "piece"]
    dealt = pieces.repartitionByRange(partition_count(spark), "conv_id", *order).withColumn("part", F.spark_partition_id())
    dealt = stage(dealt.withColumn("chars", F.length("piece").cast("long")), "turns")
    targets = F.sum(F.col("trainable").cast("long"))

    by_part = dealt.groupBy("conv_id", "part").agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("turns"), targets.alias("targets"))
    of_conversation = Window.partitionBy("conv_id")
    earlier = of_conversation.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"earlier_{c}") for c in ("chars", "turns", "targets")]
    shifts = by_part.select("conv_id", "part", *sums).filter("earlier_turns > 0")
    shifts = shifts.select(F.col("conv_id").alias("shifted"), F.col("part").alias("shifted_part"), "earlier_chars", "earlier_turns", "earlier_targets")
    totals = by_part.groupBy("conv_id").agg(F.sum("targets").alias("all"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    totals = totals.select(F.col("conv_id").alias("of"), "all")

    here = Window.partitionBy("conv_id", "part").orderBy(*order)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    counted = dealt.select(
        "*",
        F.row_number().over(here).cast("long").alias("place"),
        F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("offset"),
        F.coalesce(targets.over(before), F.lit(0)).alias("done"),
        targets.over(Window.partitionBy("conv_id", "part")).alias("mine"),
    )
    placed = counted.join(F.broadcast(shifts), F.col("conv_id").eqNullSafe(F.col("shifted")) & (F.col("part") == F.col("shifted_part")), "left")
    placed = placed.join(F.broadcast(totals), F.col("conv_id").eqNullSafe(F.col("of")), "left")  # at most one a partition, as shifts
    shift = lambda c: F.coalesce(F.col(f"earlier_{c}"), F.lit(0))
    start, done, every = F.col("offset") + shift("chars"), F.col("done") + shift("targets"), F.coalesce("all", "mine")
    first = placed.select(
        "conv_id",
        (F.col("place") + shift("turns")).alias("position"),
        "turn",
        "piece",
        start.alias("start"),
        "chars",
        "head",
        "tail",
        "trainable",
        every.alias("examples"),
        F.when(done < every, done + 1).alias("first"),
    )
    expanded = first.withColumn("example", F.explode_outer(F.when(F.col("first").isNotNull(), F.sequence("first", "examples"))))
    target = F.col("trainable") & (F.col("example") == F.col("first"))
    return expanded.select(
        "conv_id",
        "example",
        "examples",
        "position",
        "turn",
        "piece",
        "start",
        "chars",
        F.coalesce(target, F.lit(False)).alias("trainable"),
        F.when(target, F.col("start") + F.col("head")).alias("loss_start"),
        F.when(target, F.col("start") + F.col("chars") - F.col("tail")).alias("loss_end"),
    )


def _in_order(rows: DataFrame, order: list[str], *columns: str) -> DataFrame:
    """Rows in order within partitions, to be read as a stream: no task holds a conversation in memory.  Partitions by all of order but the last."""
    small_batches(rows.sparkSession)
    return rows.select(*order, *columns).repartition(partition_count(rows.sparkSession), *order[:-1]).sortWithinPartitions(*order)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def example_texts(examples: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_end: every example as one text, context and reply."""
    kind = examples.schema["conv_id"].dataType
    out = T.StructType([T.StructField("conv_id", kind), *[T.StructField(c, t) for c, t in (("example", T.LongType()), ("text", T.StringType()), ("loss_start", T.LongType()), ("loss_end", T.LongType()))]])
    shape = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[str] = []
        for b in batches:
            for c, example, _, piece, trainable, low, high in _rows(b):
                pieces.append(piece)
                if trainable:  # an example ends with its target
                    yield pa.RecordBatch.from_pylist([{"conv_id": c, "example": example, "text": "".join(pieces), "loss_start": low, "loss_end": high}], schema=shape)
                    pieces = []

    return _in_order(examples.filter("example is not null"), ["conv_id", "example", "position"], "piece", "trainable", "loss_start", "loss_end").mapInArrow(run, out)


class _Reading:
    """What is known of a conversation whose rows come one after another."""

    def __init__(self, conv_id: object):
        self.conv_id, self.turns, self.loss_chars = conv_id, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int, whole: bool, low: int | None, high: int | None) -> None:
        if whole:
            role, text = read_piece(piece)
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        if low is not None:
            reply = unescaped(piece[low - start : high - start])
            self.loss_chars += len(reply)
            self.loss.update(reply.encode())

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest()}


def read_turns(examples: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation, read from its examples.

    The turns are read from the last example, which holds all up to the last reply, and the rows after it; the trained texts from each
    example's own target; formatted_chars is the length of all examples and of the turns after the last reply.  The digests run along a
    conversation's rows as they come; a digest is sequential, so one conversation's is one task's work, in bounded memory.
    """
    columns = (("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()))
    out = T.StructType([T.StructField("conv_id", examples.schema["conv_id"].dataType), *[T.StructField(c, t) for c, t in columns]])
    shape = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            done = []
            for c, _, *turn in _rows(b):
                if now is None or c != now.conv_id:
                    done += [now.row()] if now else []
                    now = _Reading(c)
                now.add(*turn)
            yield pa.RecordBatch.from_pylist(done, schema=shape)
        if now:
            yield pa.RecordBatch.from_pylist([now.row()], schema=shape)

    whole = F.col("example").isNull() | (F.col("example") == F.col("examples"))
    read = examples.withColumn("whole", whole).filter("whole or trainable")
    digests = _in_order(read, ["conv_id", "position"], "piece", "start", "whole", "loss_start", "loss_end").mapInArrow(run, out)
    lengths = examples.groupBy(F.col("conv_id").alias("of")).agg(F.sum(F.length("piece").cast("long")).alias("formatted_chars"))
    return digests.join(lengths, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
