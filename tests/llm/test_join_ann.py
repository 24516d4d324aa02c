import itertools
import random

import numpy as np
import pytest

from quire.llm import graphann, shinglejoin
from quire.llm.shared import words_of

from .fixtures import documents, nothing


def brute(rows, size, percent):
    """component of each row by comparing all pairs of shingle sets"""
    sets = []
    for _, t in rows:
        w = words_of(t)
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(j)] = root(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d is None, d or 0, len(s), d if not s else least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("size, percent, seed", [(4, 85, 1), (5, 80, 2)])
def test_components_equal_brute_force(spark, size, percent, seed):
    docs = documents(spark, seed)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in shinglejoin.component_ids(docs, size, percent).collect()), key=str)
    assert got == brute(rows, size, percent)


def test_lists_with_dissimilar_members_and_late_items(spark, monkeypatch):
    """Chains of edits, so that hubs do not reach every member; frequent elements and every boundary."""
    monkeypatch.setattr(shinglejoin, "SAMPLE_RATE", 1)
    rng = random.Random(9)
    rows, at = [], 0
    for chain in range(6):
        w = [f"c{chain}_{i}" for i in range(90)]
        for _ in range(30):
            rows.append((at, " ".join(w)))
            at += 1
            for _ in range(2):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**9)}"
    for n in range(1, 30):
        w = [f"t{n}_{i}" for i in range(n)]
        for k in range(4):
            rows.append((at, " ".join(w[:-1] + [f"k{k}"]) if k else " ".join(w)))
            at += 1
    rng.shuffle(rows)
    want = brute(rows, 4, 85)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for boundary in (None, 0, 12, 30):
        if boundary is not None:
            monkeypatch.setattr(shinglejoin, "choose_boundary", lambda *a, **k: boundary)
        got = sorted(((False, r["doc_id"], r["n_shingles"], r["component_id"]) for r in shinglejoin.component_ids(docs).collect()), key=str)
        assert got == want


def test_sets_whose_names_clash_are_named_anew(spark, monkeypatch):
    from pyspark.sql import functions as F

    real, tried = shinglejoin.shingle_sets, []

    def clashing(docs, size, attempt=0, *keep):
        tried.append(attempt)
        out = real(docs, size, attempt, *keep)
        return out if attempt else out.withColumn("sig", F.when(F.col("sig").isNotNull(), F.lit(1).cast("long")))

    monkeypatch.setattr(shinglejoin, "shingle_sets", clashing)
    docs = spark.createDataFrame([(i, f"a b c {'d' if i < 3 else i} e") for i in range(6)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in shinglejoin.component_ids(docs).collect())
    assert got == [(0, 0), (1, 0), (2, 0), (3, 3), (4, 4), (5, 5)] and tried == [0, 1]


def test_empty_table(spark):
    assert shinglejoin.component_ids(nothing(spark)).count() == 0


def test_overlap_and_prefix_bounds():
    for n in range(1, 80):
        for m in range(n, 100 * n // 85 + 1):
            c = shinglejoin.overlap_needed(n, m, 85)
            if c <= n:
                assert 100 * c >= 85 * (n + m - c) and 100 * (c - 1) < 85 * (n + m - c + 1)
                assert shinglejoin.prefix_length(n, 85) + c > n and shinglejoin.prefix_length(m, 85) + c > m


def test_parity_is_a_lower_bound():
    rng = np.random.default_rng(4)
    for _ in range(200):
        pool = rng.integers(0, 1 << 48, 400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in "ab")
        assert shinglejoin.parity_distance(shinglejoin.parity(a), shinglejoin.parity(b)) <= len(np.setxor1d(a, b))
        assert (shinglejoin.unpack(shinglejoin.pack(a)) == a).all()


def exact_neighbours(rows, k, modulus):
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows], dtype=np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return {int(i): [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -s)) if ids[j] != i][:k] for i, s in ((ids[q], v @ v[q]) for q in np.flatnonzero(ids % modulus == 0))}


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(20, 32))
    rows = [(i, (centers[i % 20] * 0.5 + rng.normal(size=32)).astype(np.float32).tolist()) for i in range(3000)]
    rows += [(3000 + i, rows[0][1]) for i in range(300)]  # copies of one vector
    odd = [(5000, None), (5050, [0.0] * 32), (5100, [float("nan")] * 32), (5150, [float("inf")] + [1.0] * 31), (None, rows[1][1]), (5200, [1.0, 2.0])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {}
    for r in graphann.nearest(table, k=5, shard_rows=800).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = exact_neighbours(rows, 5, 50)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert [i for i, _ in got[0]] == [3000, 3001, 3002, 3003, 3004]
    for q, found in got.items():
        assert len(found) == 5 and q not in [i for i, _ in found] and found == sorted(found, key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize(("clusters", "each", "noise"), [(10, 200, 0.1), (20, 204, 0.3), (20, 204, 0.02), (300, 10, 0.05)])
def test_recall_on_tight_clusters(spark, clusters, each, noise):
    rng = np.random.default_rng(clusters)
    v = np.repeat(rng.normal(size=(clusters, 64)), each, axis=0) + noise * rng.normal(size=(clusters * each, 64))
    rows = [(i, x) for i, x in enumerate(v.astype(np.float32).tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = exact_neighbours(rows, 5, 50)
    for shard_rows in (graphann.SHARD_ROWS, 900):
        got = {(r["query_id"], r["vec_id"]) for r in graphann.nearest(table, k=5, shard_rows=shard_rows).collect()}
        assert sum((q, i) in got for q, found in want.items() for i, _ in found) >= 0.9 * 5 * len(want)


def test_few_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (50, [0.0, 1.0])], "vec_id long, embedding array<float>")
    rows = graphann.nearest(table).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in rows] == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert graphann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_lengths_are_apart_and_columns_may_clash(spark):
    rows = [(0, [1.0, 0.0], "x", 1), (1, [1.0, 0.1], "x", 1), (50, [0.0, 1.0, 0.0], "x", 1), (51, [0.0, 1.0, 1.0], "x", 1), (100, [1.0], "x", 1), (100, [1.0], "x", 1), (150, [1e200, 1e200], "x", 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard string, rank int")
    got = graphann.nearest(table).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 150), (50, 1, 51), (150, 1, 1), (150, 2, 0)]
    assert abs(got[-1]["score"] - 0.5**0.5) < 1e-12
