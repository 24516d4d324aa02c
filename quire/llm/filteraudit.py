"""Audit of a chain of document filters: what each filter removes in every order, by a Walsh-Hadamard transform.

Each document has a mask of the filters it fails.  Per part and label, 32 signed sums are aggregated, one for each set S of
filters: every document adds 1 if it fails an even number of filters of S, else takes 1 away.  The transform is its own
inverse up to 1/32, so the sums give back exactly how many documents have each mask.  From these cells follow all 120 orders
and the Shapley counts: a document that fails n filters is removed by each of them in 120 / n of the orders.

Null text is the empty text.  A null doc_id is neither smaller nor larger than others; repeated rows are documents of
their own, and equal ids are not smaller ones.  Labels of an id count as 1 if any of their rows says so, rows without an
id label nothing.  Null lang and the empty one are one part.  Other columns are left aside.  No documents, no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import meet_hot, stage

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def text_mask(text: Column) -> Column:
    """Filters that a text fails by itself: A (1) words, B (2) repetition, C (4) capitals, D (8) symbols."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (n < 100, 100 * distinct < 80 * n, 100 * capitals.cast("long") > 10 * F.length(text), text.rlike("[#$%&*|]"))
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, good, toxic, mask, n: documents by what they fail.

    Equal rows are counted before anything meets, so a text with many copies is a row for each id, of 32 digest bytes instead
    of the text.  Digests and their least ids meet by a shuffle, frequent ones by broadcast; labels meet by id, and rows
    without one, which find none, are spread by their digest.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("own"))
    rows = stage(rows.groupBy("digest", "doc_id", "part", "own").agg(F.count(F.lit(1)).alias("n")), "masks")
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("uses"))
    later = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    whole = meet_hot(rows, least, "digest", "uses").select("doc_id", "part", (F.col("own") + F.when(later, 16).otherwise(0)).alias("mask"), "n", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0).alias("spread"))
    says = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c)
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(says("quality"), says("toxic")).withColumn("spread", F.lit(0).cast("long"))
    found = whole.join(known, ["doc_id", "spread"], "left")
    return found.select("part", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "mask", "n")


def _sign(mask: str, chosen: str) -> str:
    return f"(1 - 2 * (bit_count({mask} & {chosen}) % 2))"


def cells(counted: DataFrame) -> DataFrame:
    """part, every, good, toxic: arrays of the documents with each mask, from the signed sums of each part and label."""
    sums = [F.sum(F.expr(f"n * {_sign('mask', str(s))}")).alias(f"s{s}") for s in range(MASKS)]
    signed = counted.groupBy("part", "good", "toxic").agg(*sums).select("part", "good", "toxic", F.array(*[f"s{s}" for s in range(MASKS)]).alias("s"))
    back = f"aggregate(sequence(0, {MASKS - 1}), 0L, (a, c) -> a + s[c] * {_sign('m', 'c')}) div {MASKS}"
    found = signed.withColumn("cell", F.expr(f"transform(sequence(0, {MASKS - 1}), m -> {back})"))
    of = lambda where, name: F.array(*[F.sum(F.when(where, F.col("cell")[m]).otherwise(0)) for m in range(MASKS)]).alias(name)
    return found.groupBy("part").agg(of(F.lit(True), "every"), of(F.col("good") == 1, "good"), of(F.col("toxic") == 1, "toxic"))


def _total(cell: str, condition: str, weight: str = "1") -> Column:
    return F.expr(f"aggregate(sequence(0, {MASKS - 1}), 0L, (a, m) -> a + if({condition}, {cell}[m] * {weight}, 0L))")


def evaluate(found: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    order = found.withColumn("filter_order", F.explode(F.lit(ORDERS))).withColumn("step", F.explode(F.lit(list(range(1, len(FILTERS) + 1)))))
    bits = "aggregate(transform(sequence(1, 5), i -> if(i < step, shiftleft(1, ascii(substr(filter_order, i, 1)) - 65), 0)), 0, (a, x) -> a + x)"
    at = order.withColumn("before", F.expr(bits)).withColumn("bit", F.expr("shiftleft(1, ascii(substr(filter_order, step, 1)) - 65)"))
    fails, first = "m & bit <> 0", "m & before = 0"
    return at.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        _total("every", f"{first} and m & bit = 0").alias("kept"),
        _total("every", f"{first} and {fails}").alias("removed"),
        _total("every", f"not ({first}) and {fails}").alias("redundant"),
        F.expr("every[bit]").alias("unique_fails"),
        _total("good", f"{first} and {fails}").alias("good_lost"),
        _total("toxic", f"{first} and {fails}").alias("toxic_lost"),
        _total("every", fails, f"({len(ORDERS)} div bit_count(m))").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley of all orders."""
    return evaluate(cells(masks(docs, labels)))
