"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Equal vectors are one node.  Nodes are dealt to shards of about `shard_rows` by a hash of the vector.  A shard's graph starts from
random edges; two passes over its nodes follow (distance slack 1.0, then `alpha`).  In a pass, greedy beam searches from the
entry nodes propose neighbours, robust pruning keeps a candidate only if no kept neighbour is alpha times nearer to it than the node itself,
and kept edges get their reverse, pruned again where a node has too many.  Many nodes search in step, as array operations.
Pruning keeps few edges between clusters, which a greedy search cannot cross, so searches start from the nearest of many entry nodes: the
medoid, nodes chosen farthest-first, which lie in all clusters, and random ones, which lie where nodes are many.

Queries visit every shard in blocks: index and blocks stream through the same partition, index first, so a task holds one
graph and one block.  A beam search gives each query its nearest nodes of the shard, scored in double precision on the
original vectors; the nearest of all shards are kept.

Vectors that are null, zero, or that hold null or non-finite components take no part.  Vectors of different lengths have no cosine:
each length has shards of its own, and a query visits those of its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import partition_count, small_batches, stage

DEGREE = 24
BEAM = 64
SHARD_ROWS = 4096
SPREAD = 96  # entry nodes chosen farthest-first, and as many at random
BLOCK_ROWS = 512


def _norm(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(n > 0, n, 1)).astype(np.float32)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows in double precision, multiplied by a power of two that keeps their squares in range; no cosine changes by that."""
    x = x.astype(np.float64)
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0.0))
    return np.ldexp(x, -exponent[:, None])


def entry_nodes(data: np.ndarray, most: int = SPREAD) -> np.ndarray:
    """The medoid of unit vectors, then the node farthest from those chosen, again and again, then random ones."""
    chosen = [int((data @ data.mean(axis=0)).argmax())]
    nearest = data @ data[chosen[0]]
    for _ in range(min(most, len(data)) - 1):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, data @ data[chosen[-1]])
    return np.unique(np.append(chosen, np.random.default_rng(len(data)).integers(0, len(data), most)))


def beam_search(data: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes [query, beam] found nearest (−1: none) and their similarity, searched in step; data and queries are unit vectors."""
    q, n = len(queries), len(data)
    ids = np.full((q, beam), -1, dtype=np.int32)
    sims = np.full((q, beam), -np.inf, dtype=np.float32)
    open_ = np.zeros((q, beam), dtype=bool)
    met = np.zeros((q, n), dtype=bool)
    first = queries @ data[entries].T
    k = min(beam, len(entries))
    best = np.argpartition(-first, k - 1, axis=1)[:, :k]
    ids[:, :k], sims[:, :k], open_[:, :k] = entries[best], np.take_along_axis(first, best, axis=1), True
    met[:, entries] = True
    live = np.arange(q)
    while len(live):
        score = np.where(open_[live], sims[live], -np.inf)
        pick = score.argmax(axis=1)
        ok = np.isfinite(score[np.arange(len(live)), pick])
        live, pick = live[ok], pick[ok]
        if not len(live):
            break
        open_[live, pick] = False
        near = graph[ids[live, pick]]
        fresh = (near >= 0) & ~met[live[:, None], np.maximum(near, 0)]
        r, c = np.nonzero(fresh)
        met[live[r], near[r, c]] = True
        s = np.full(near.shape, -np.inf, dtype=np.float32)
        s[r, c] = np.einsum("ij,ij->i", data[near[r, c]], queries[live[r]])
        all_s = np.concatenate((sims[live], s), axis=1)
        all_i = np.concatenate((ids[live], np.where(fresh, near, -1)), axis=1)
        all_o = np.concatenate((open_[live], fresh), axis=1)
        order = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
        rows = np.arange(len(live))[:, None]
        ids[live], sims[live], open_[live] = all_i[rows, order], all_s[rows, order], all_o[rows, order]
    order = np.argsort(-sims, axis=1, kind="stable")
    rows = np.arange(q)[:, None]
    return ids[rows, order], sims[rows, order]


def robust_prune(data: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Neighbours [node, degree] (−1: none): repeatedly the nearest candidate left; those it is alpha times nearer to go."""
    b = np.arange(len(nodes))
    order = np.sort(candidates, axis=1)
    candidates = np.where(np.concatenate((np.zeros((len(b), 1), bool), order[:, 1:] == order[:, :-1]), axis=1), -1, order)
    alive = (candidates >= 0) & (candidates != nodes[:, None])
    vecs = data[np.maximum(candidates, 0)]
    far = 2 - 2 * np.einsum("bcd,bd->bc", vecs, data[nodes])
    out = np.full((len(b), degree), -1, dtype=np.int32)
    for k in range(degree):
        pick = np.where(alive, far, np.inf).argmin(axis=1)
        ok = alive[b, pick]
        if not ok.any():
            break
        out[ok, k] = candidates[ok, pick[ok]]
        between = 2 - 2 * np.einsum("bcd,bd->bc", vecs, vecs[b, pick])
        alive &= alpha * alpha * between > far  # squared distances
        alive[b, pick] = False
    return out


def build_graph(data: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = 1.2, batch: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Adjacency [node, degree] and the entry nodes of unit vectors."""
    n = len(data)
    rng = np.random.default_rng(n)
    entries = entry_nodes(data)
    if n <= degree + 1:
        return np.array([[j for j in range(n) if j != i] + [-1] * (degree - n + 1) for i in range(n)], dtype=np.int32).reshape(n, degree), entries
    graph = rng.integers(0, n, (n, degree), dtype=np.int32)
    graph[graph == np.arange(n)[:, None]] = -1
    order = rng.permutation(n)
    for slack in (1.0, alpha):
        for at in range(0, n, batch):
            nodes = order[at : at + batch]
            found, _ = beam_search(data, graph, entries, data[nodes], beam)
            graph[nodes] = robust_prune(data, nodes, np.concatenate((found, graph[nodes]), axis=1), slack, degree)
            source, target = np.repeat(nodes, degree), graph[nodes].ravel()
            keep = target >= 0
            source, target = source[keep], target[keep]
            by = np.argsort(target, kind="stable")
            source, target = source[by], target[by]
            uniq, first, count = np.unique(target, return_index=True, return_counts=True)
            width = int(count.max())
            back = np.full((len(uniq), width), -1, dtype=np.int32)
            back[np.repeat(np.arange(len(uniq)), count), np.arange(len(target)) - np.repeat(first, count)] = source
            for i in range(0, len(uniq), batch):
                graph[uniq[i : i + batch]] = robust_prune(data, uniq[i : i + batch], np.concatenate((graph[uniq[i : i + batch]], back[i : i + batch]), axis=1), slack, degree)
    return graph, entries


def usable(column: str):
    c = F.col(column).cast("array<double>")
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.col(column).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(c, lambda x: x != 0)


INDEX = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("entries", T.ArrayType(T.IntegerType())), T.StructField("vectors", T.BinaryType()), T.StructField("graph", T.BinaryType()), T.StructField("ids", T.ArrayType(T.ArrayType(T.LongType())))])


LAYOUT = "width int, base int, shards int"


def fold_vectors(rows: DataFrame, k: int, kind: str) -> DataFrame:
    """vec (the vector's bytes), width, ids: its k + 1 smallest ids, of each different vector of rows (vec_id, v)."""
    step = np.dtype(kind).itemsize

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            raw = lists.flatten().to_numpy(zero_copy_only=False).astype(kind).tobytes()
            ends = np.cumsum(lists.value_lengths().to_numpy()).tolist()
            own: dict[bytes, list[int]] = {}
            for i, s, e in zip(b.column("vec_id").to_pylist(), [0, *ends], ends, strict=False):
                own.setdefault(raw[step * s : step * e], []).append(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array([sorted(x)[: k + 1] for x in own.values()], pa.list_(pa.int64()))], names=["vec", "ids"])

    folded = rows.mapInArrow(fold, "vec binary, ids array<long>")
    nodes = folded.groupBy("vec").agg(F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))  # k + 1 ids from each batch that has the vector
    return stage(nodes.withColumn("width", (F.octet_length("vec") / step).cast("int")), "nodes")


def build_index(nodes: DataFrame, layout: DataFrame, kind: str) -> DataFrame:
    """One record per shard with vectors, graph and each node's ids."""

    def build(key: tuple, group: pa.Table) -> pa.Table:
        order = np.argsort(np.array([x[0] for x in group.column("ids").to_pylist()]), kind="stable")
        group = group.take(pa.array(order))
        vectors = b"".join(group.column("vec").to_pylist())
        graph, entries = build_graph(_norm(np.frombuffer(vectors, dtype=kind).reshape(group.num_rows, -1)))
        return pa.table([pa.array([int(key[0].as_py())], pa.int32()), pa.array([group.num_rows], pa.int32()), pa.array([entries.tolist()], pa.list_(pa.int32())), pa.array([vectors], pa.binary()), pa.array([graph.astype("<i4").tobytes()], pa.binary()), pa.array([group.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64())))], names=INDEX.names)

    dealt = nodes.join(F.broadcast(layout), "width").withColumn("shard", F.col("base") + F.pmod(F.xxhash64("vec"), F.col("shards")).cast("int"))  # layout: a row for each length
    shards = layout.agg(F.max(F.col("base") + F.col("shards"))).first()[0]
    return stage(dealt.repartition(max(partition_count(nodes.sparkSession), shards), "shard").groupBy("shard").applyInArrow(build, INDEX), "graphs")


FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])


def nearest(table: DataFrame, k: int = 5, vector: str = "embedding", query_modulus: int = 50, shard_rows: int = SHARD_ROWS, beam: int = 2 * BEAM) -> DataFrame:
    """query_id, rank, vec_id, score (cosine): the k nearest other rows of each row whose vec_id query_modulus divides.

    Rows with a null vec_id take no part.  Repeated rows (same id) count as one another's copies: an id never finds itself.  Ties go to the smaller vec_id.
    Vectors of floats are compared as floats' values, others as doubles, all in double precision.  Other columns are ignored.
    """
    spark = table.sparkSession
    single = table.schema[vector].dataType == T.ArrayType(T.FloatType(), True) or table.schema[vector].dataType == T.ArrayType(T.FloatType(), False)
    kind, of = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    rows = table.filter(usable(vector) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast(of).alias("v"))
    nodes = fold_vectors(rows, k, kind)
    widths = {r["width"]: r["n"] for r in nodes.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row for each length of vectors
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    layout, base = [], 0
    for width, n in sorted(widths.items()):
        layout.append((width, base, -(-n // shard_rows)))
        base += -(-n // shard_rows)
    layout = spark.createDataFrame(layout, LAYOUT)
    index = build_index(nodes, layout, kind)
    queries = stage(rows.filter(F.col("vec_id") % query_modulus == 0).dropDuplicates(["vec_id", "v"]), "queries")
    count = max(1, -(-queries.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(count))
    blocks = stage(queries.groupBy(F.size("v").alias("width"), block.alias("block")).agg(F.collect_list(F.struct("vec_id", "v")).alias("queries")).select("width", "queries"), "blocks")  # about BLOCK_ROWS rows a block
    asked = blocks.join(F.broadcast(layout), "width").select("queries", F.explode(F.sequence("base", F.col("base") + F.col("shards") - 1)).alias("shard"))
    stream = index.withColumn("step", F.lit(0)).unionByName(asked.withColumn("step", F.lit(1)), allowMissingColumns=True)
    stream = stream.repartition(max(partition_count(spark), base), "shard").sortWithinPartitions("shard", "step")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for b in batches:
            for at in range(b.num_rows):
                r = {c: b.column(i)[at] for i, c in enumerate(b.schema.names)}
                if r["step"].as_py() == 0:
                    n, shard = r["n"].as_py(), r["shard"].as_py()
                    raw = np.frombuffer(r["vectors"].as_py(), dtype=kind).reshape(n, -1)
                    data, graph = _norm(raw), np.frombuffer(r["graph"].as_py(), dtype="<i4").reshape(n, -1)
                    entries, ids = np.array(r["entries"].as_py(), dtype=np.int32), r["ids"].as_py()
                    exact = _scaled(raw)
                    lengths = np.sqrt((exact * exact).sum(axis=1))
                elif r["shard"].as_py() == shard:
                    qs = r["queries"].as_py()
                    q = _scaled(np.array([x["v"] for x in qs], dtype=kind))
                    found, _ = beam_search(data, graph, entries, _norm(q), beam)
                    out = []
                    for x, v, f in zip(qs, q, found, strict=True):
                        f = f[f >= 0]
                        score = (exact[f] * v).sum(axis=1) / (lengths[f] * np.sqrt((v * v).sum()))
                        hits = sorted((-s, i) for s, j in zip(score.tolist(), f.tolist(), strict=True) for i in ids[j] if i != x["vec_id"])[:k]
                        out += [(x["vec_id"], i, -s) for s, i in hits]
                    cols = list(zip(*out, strict=True)) or [[], [], []]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=FOUND.names)

    small_batches(spark)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = stream.mapInArrow(search, FOUND).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
