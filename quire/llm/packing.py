"""Packing of token streams into fixed-length sequences by cutting-stock column generation.

Every document is cut into full pieces and one remainder.  The remainders' lengths, rounded up to `grain` ids, form
a histogram of at most capacity/grain classes: the only thing the driver sees, however many documents there are.
A linear program over patterns (how many pieces of each class share a sequence) is solved by column generation:
a knapsack dynamic program prices new patterns with the duals.  Rounded-down pattern counts and a best-fit packing of the
few pieces left give every class a list of slots; the pieces, ranked within their class, take the slots in order.

Ranks come from counts per (class, salt), so no class is numbered by one task even if it holds most pieces.
Null text is an empty document (its end id alone).  Repeated rows are packed each on their own.  No row is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import crc_of, stage
from .tokens import encoder

PIECES = T.StructType([T.StructField("uid", T.LongType()), T.StructField("doc_id", T.LongType())] + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")])


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the best total value within capacity and how many of each item reach it."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    w, v = sizes[order], values[order]
    fits = np.searchsorted(w, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = fits[c]
        best[c], pick[c] = best[c - 1], -1
        if k:
            total = best[c - w[:k]] + v[:k]
            j = int(total.argmax())
            if total[j] > best[c]:
                best[c], pick[c] = total[j], j
    counts, c = np.zeros(len(sizes), dtype=np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[order[pick[c]]] += 1
            c -= int(w[pick[c]])
    return float(best[capacity]), counts


def _first_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest first: each pattern is used until a class runs out, so its column holds no class that ran out before, and
    the columns, in the order their classes ran out, are triangular: a basis."""
    m = len(sizes)
    basis, x, left = np.zeros((m, m)), np.zeros(m), demand.astype(float).copy()
    open_ = np.ones(m, dtype=bool)
    by_size = np.argsort(-sizes, kind="stable")
    while open_.any():
        a, room = np.zeros(m), capacity
        for i in by_size[open_[by_size]]:
            k = min(room // int(sizes[i]), max(1, int(left[i])))
            a[i] = k
            room -= k * int(sizes[i])
        use = np.full(m, np.inf)
        use[a > 0] = left[a > 0] / a[a > 0]
        r = int(use.argmin())
        left -= a * use[r]
        basis[:, r], x[r] = a, use[r]
        open_[r] = False
        for i in np.flatnonzero(open_ & (left <= 1e-9)):
            basis[i, i], open_[i] = capacity // int(sizes[i]), False
    return basis, x


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 2e-4) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, covering the demand exactly.

    Revised simplex with column generation, from the fractional first-fit-decreasing solution; it ends when the dual bound, or
    the total size over the capacity, shows the linear program within `gap` of its optimum.  The counts are rounded down; what is left is packed best fit decreasing.
    """
    m = len(sizes)
    if not m:
        return []
    basis, x = _first_basis(sizes, demand, capacity)
    inverse = np.linalg.inv(basis)
    least = float(sizes @ demand) / capacity
    while x.sum() > least * (1 + gap):
        duals = inverse.sum(axis=0)
        value, column = knapsack(np.maximum(duals, 0), sizes, capacity)
        if value <= 1 + gap:
            break
        direction = inverse @ column
        ok = direction > 1e-9
        ratio = np.full(m, np.inf)
        ratio[ok] = x[ok] / direction[ok]
        r = int(ratio.argmin())
        step = ratio[r]
        x -= step * direction
        x[r] = step
        np.maximum(x, 0, out=x)
        basis[:, r] = column
        row = inverse[r] / direction[r]
        inverse -= np.outer(direction, row)
        inverse[r] = row
    patterns, left = [], demand.astype(np.int64).copy()
    for p in range(m):
        a = basis[:, p].astype(np.int64)
        n = int(min(np.floor(x[p] + 1e-7), (left[a > 0] // a[a > 0]).min())) if a.any() else 0
        if n > 0:
            patterns.append((a, n))
            left -= a * n
    by_size = np.argsort(-sizes, kind="stable")
    while left.any():
        a, room = np.zeros(m, dtype=np.int64), capacity
        for i in by_size:
            k = min(int(left[i]), room // int(sizes[i]))
            if k:
                a[i] = k
                room -= k * int(sizes[i])
        n = int((left[a > 0] // a[a > 0]).min())
        patterns.append((a, n))
        left -= a * n
    return patterns


def _cut(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    enc, uid = encoder(path, keeps_space=True), TaskContext.get().partitionId() << 40
    for b in batches:
        ids, sizes = enc.encode(b.column("text"), end_id)
        pieces = -(-sizes // capacity)
        where = np.repeat(np.arange(len(sizes)), pieces)
        start = (np.arange(len(where)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
        length = np.minimum(capacity, sizes[where] - start)
        at = 4 * ((np.cumsum(sizes) - sizes)[where] + start)
        raw = memoryview(ids.astype("<u4").tobytes())
        crc = [crc_of(raw[i:j]) for i, j in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(uid + np.arange(len(where))), b.column("doc_id").take(pa.array(where)), *(pa.array(v, pa.int64()) for v in (start, length, crc, sizes[where]))], names=PIECES.names)
        uid += len(where)


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece (uid, doc_id, start, length, ids_crc32, doc_tokens), staged, so each text is encoded once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.mapInArrow(lambda it: _cut(it, tokenizer_path, end_id, capacity), PIECES), "pieces")


def pack_pieces(pieces: DataFrame, capacity: int = 2048, grain: int = 4) -> DataFrame:
    """Add sequence_id and offset to pieces (uid, doc_id, start, length, ...); lengths must lie in 1..capacity."""
    spark = pieces.sparkSession
    units = capacity // grain
    sized = pieces.withColumn("cls", F.ceil(F.col("length") / grain).cast("int"))
    n = pieces.count()
    salts = max(16, n // 65536)
    sized = sized.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(salts)).cast("int"))
    cells = sized.groupBy("cls", "salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["cls"]: r["n"] for r in cells.groupBy("cls").agg(F.sum("n").alias("n")).collect()}  # at most `units` rows
    classes = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[c] for c in classes], dtype=np.int64)
    slots, taken, base = [], np.zeros(len(classes), dtype=np.int64), 0
    for a, times in cutting_stock(classes, demand.astype(float), units):
        for order, i in enumerate(np.flatnonzero(a)[::-1]):
            k = int(a[i])
            slots.append((int(classes[i]), int(taken[i]), int(taken[i] + k * times), k, base, order))
            taken[i] += k * times
        base += times
    plan = spark.createDataFrame(slots, "cls int, rank_from long, rank_to long, each long, base long, place int")  # at most units patterns of at most units classes
    first = cells.withColumn("before", F.sum("n").over(Window.partitionBy("cls").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = sized.withColumn("rank", F.row_number().over(Window.partitionBy("cls", "salt").orderBy("doc_id", "start", "uid")))
    ranked = ranked.join(first.select("cls", "salt", F.coalesce("before", F.lit(0)).alias("before")), ["cls", "salt"]).withColumn("rank", F.col("rank") - 1 + F.col("before"))
    placed = ranked.join(F.broadcast(plan), (ranked["cls"] == plan["cls"]) & (ranked["rank"] >= plan["rank_from"]) & (ranked["rank"] < plan["rank_to"]))
    j = F.col("rank") - F.col("rank_from")
    placed = placed.select(*[ranked[c] for c in pieces.columns], (F.col("base") + F.floor(j / F.col("each"))).cast("long").alias("sequence_id"), "place", (j % F.col("each")).alias("turn"))
    before = Window.partitionBy("sequence_id").orderBy("place", "turn").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("place", "turn")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048, grain: int = 4) -> DataFrame:
    """Pack the texts of docs (doc_id, text): one row per piece with its place.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.  Extra input columns are ignored.
    An empty table gives an empty result; a null doc_id stays null.
    """
    pieces = cut_pieces(docs, tokenizer_path, end_id, capacity)
    return pack_pieces(pieces, capacity, grain).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
