"""Set-similarity join on word shingles: a size-aware heavy-light join, reduced to connected components.

A document's set: distinct hashes of its n-word shingles.  Sets A and B link when 100 |A and B| >= percent * |A or B|, which
is |A and B| >= c(|A|, |B|) = ceil(percent (|A| + |B|) / (100 + percent)).

Light sets (size at most the boundary): all their c-subsets are enumerated, c being the overlap some partner size asks for; two light
sets that link share one.  Heavy sets (larger): inverted lists of their first |A| - ceil(percent |A| / 100) + 1 elements in a global order; two
sets that link share a list.  Light sets near the boundary are in the lists too, for their heavy partners.  The boundary is
that size at which the cost of subsets passes the cost of lists, from the sizes' histogram.  The order puts elements that many documents
of a fixed-rate sample hold last (most frequent last of all), others by hash; any order gives the same links.  An entry keeps its element's
position: two sets of overlap c whose first shared element is at positions i and j have |A| - i >= c and |B| - j >= c, so pairs are tried
at an element only where both hold.

Equal sets are one class.  Lists may be long where thousands of near copies share elements, so pairs are not listed outright:
 1. each list's members are paired with the list's hub (the member that has the element earliest) only; real links join components;
 2. lists whose members then lie in more than one component pair the members outside the hub's component with all others
    of other components.  Pairs inside a component cannot change the result.
Candidate pairs are thinned by exact lower bounds on the symmetric difference (parity sketches), then verified on whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import broadcast, discard, keep_only, mix64, stage, worker_cache, words_of

#: Subsets are weighed for sets up to this size; beyond, a set has thousands of them at any threshold of use.
LIGHT_MOST = 40
SAMPLE_RATE = 16
SAMPLE_LEAST = 4
MOST_FREQUENT = 1 << 17
#: Elements are 48-bit hashes.
_ITEM = np.uint64((1 << 48) - 1)
#: Bits of the filters that spare rows a shuffle; what they let through in error is joined away.
FILTER_BITS = 1 << 25
_MAX_WORDS = 150_000
_WORDS: dict[bytes, int] = worker_cache()


def overlap_needed(a: int, b: int, percent: int) -> int:
    return -(-percent * (a + b) // (100 + percent))


def _word_ids(ws: list[bytes]) -> np.ndarray:
    if len(_WORDS) > _MAX_WORDS:
        _WORDS.clear()
    for w in set(ws).difference(_WORDS):
        _WORDS[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_WORDS.__getitem__, ws), dtype=np.uint64, count=len(ws))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 48-bit hashes of the shingles; with fewer words than size, of the whole sequence; none without words."""
    ws = words_of(text)
    if not ws:
        return np.zeros(0, np.uint64)
    h = _word_ids(ws)
    n = max(1, len(h) - size + 1)
    out = np.full(n, np.uint64(min(size, len(h))))
    for k in range(min(size, len(h))):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out & _ITEM)


def pack(s: np.ndarray) -> bytes:
    """Six bytes an element, little-endian."""
    return s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def partner_overlaps(n: int, percent: int, most: int) -> list[int]:
    """The overlaps that a set of size n needs with partners of size up to `most`."""
    sizes = range(-(-percent * n // 100), min(100 * n // percent, most) + 1)
    return sorted({overlap_needed(n, m, percent) for m in sizes if overlap_needed(n, m, percent) <= min(n, m)})


def subset_keys(s: np.ndarray, need: int) -> np.ndarray:
    """A 64-bit key for every need-subset of s: its size and the sum of its elements' scrambles."""
    gone = len(s) - need
    x = mix64(s ^ np.uint64(0xD6E8FEB86659FD93))
    total = x.sum(dtype=np.uint64)
    if gone == 0:
        left = np.array([total], dtype=np.uint64)
    elif gone == 1:
        left = total - x
    else:
        idx = np.array(list(combinations(range(len(s)), gone)))
        left = total - x[idx].sum(axis=1, dtype=np.uint64)
    return mix64(left + np.array([need], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def choose_boundary(sizes: dict[int, int], percent: int, scan: float) -> int:
    """The light sets' largest size.  Costs: a subset is one row; a list entry is one row and `scan` list members met."""
    def cost(x: int) -> float:
        light = sum(n * sum(comb(s, c) for c in partner_overlaps(s, percent, x)) for s, n in sizes.items() if 0 < s <= x)
        heavy = sum(n * prefix_length(s, percent) * (1 + scan) for s, n in sizes.items() if s > percent * x // 100)
        return light + heavy
    return min(range(LIGHT_MOST + 1), key=lambda x: (cost(x), x))


def parity(s: np.ndarray) -> bytes:
    """Parity of the elements in each of about 2 |s| cells: two parities differ in at most as many bits as the sets do in elements."""
    bits = max(64, 1 << int(2 * len(s) - 1).bit_length())
    return np.packbits((np.bincount((s >> np.uint64(20)) & np.uint64(bits - 1), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _fold(p: np.ndarray, size: int) -> np.ndarray:
    while len(p) > size:
        p = p[: len(p) // 2] ^ p[len(p) // 2 :]
    return p


def parity_distance(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    return int(np.bitwise_count(_fold(x, n) ^ _fold(y, n)).sum())


SETS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("sig", T.LongType()), T.StructField("proof", T.LongType()), T.StructField("items", T.BinaryType())])


def named_sets(docs: DataFrame, size: int, *keep: str) -> DataFrame:
    """Staged shingle sets in which a name stands for one set: where two sets of one name differ in the other half of their digest, all are named anew."""
    for attempt in range(16):
        sets = stage(shingle_sets(docs, size, attempt, *keep), "sets")
        halves = sets.filter("sig is not null").groupBy("sig").agg(F.min("proof").alias("p"), F.max("proof").alias("q"))
        if not halves.filter("p <> q").limit(1).count():
            return sets
        discard(sets)
    raise RuntimeError("sets cannot be named apart by 64 bits")


def shingle_sets(docs: DataFrame, size: int, attempt: int = 0, *keep: str) -> DataFrame:
    """doc_id, n, sig (a 64-bit name of the set, null if empty), proof (64 further bits of its digest), items (sorted hashes), and the columns to keep."""
    schema = T.StructType([*SETS.fields, *(docs.schema[c] for c in keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(_WORDS)
        for b in batches:
            sets = [shingle_set(t, size) for t in b.column("text").to_pylist()]
            items = [pack(s) for s in sets]
            names = np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16, salt=salt).digest() for x in items), "<i8").reshape(-1, 2)
            empty = np.array([not x for x in items], bool)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names[:, 0], mask=empty), pa.array(names[:, 1], mask=empty), pa.array(items, pa.binary()), *b.columns[2:]], names=schema.names)

    salt = str(attempt).encode()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep).mapInArrow(run, schema)


def frequent_items(sets: DataFrame) -> np.ndarray:
    """Elements that many documents of a 1 in SAMPLE_RATE sample hold, rarest first; at most MOST_FREQUENT.  Only the order depends on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, counts = np.unique(unpack(b"".join(dict.fromkeys(b.column("items").to_pylist()))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64), pa.int64()), pa.array(counts, pa.int64())], names=["item", "n"])

    sample = sets.filter("sig is not null").filter(F.pmod(F.xxhash64(F.lit("order"), F.col("sig")), F.lit(SAMPLE_RATE)) == 0).select("items")
    found = sample.mapInArrow(run, "item long, n long").groupBy("item").agg(F.sum("n").alias("n")).filter(F.col("n") >= SAMPLE_LEAST)
    rows = found.orderBy(F.desc("n"), "item").limit(MOST_FREQUENT).toArrow()
    return rows.column("item").to_numpy().astype(np.int64)[::-1].copy().view(np.uint64)


def postings(sets: DataFrame, percent: int, boundary: int, frequent: np.ndarray) -> DataFrame:
    """key, n, sig, pos: the light sets' subset keys (pos 0) and the heavy sets' list entries with their elements' positions."""
    late = broadcast(sets.sparkSession, (np.sort(frequent), np.argsort(frequent, kind="stable")))  # at most MOST_FREQUENT elements

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of, rank_of = late.value
        for b in batches:
            keys, owner, places, done = [], [], [], set()
            sigs, sizes = b.column("sig").to_numpy(zero_copy_only=False), b.column("n").to_numpy(zero_copy_only=False)
            for i, raw in enumerate(b.column("items").to_pylist()):
                if sigs[i] in done:
                    continue
                done.add(sigs[i])
                s = unpack(raw)
                n = len(s)
                own = [subset_keys(s, c) for c in partner_overlaps(n, percent, boundary)] if n <= boundary else []
                at_pos = [np.zeros(len(k), np.int64) for k in own]
                if n > percent * boundary // 100:
                    order = mix64(s)
                    if len(keys_of):
                        at = np.minimum(np.searchsorted(keys_of, s), len(keys_of) - 1)
                        hit = keys_of[at] == s
                        lead = np.where(hit, rank_of[at].astype(np.uint64) + np.uint64(1), np.uint64(0))
                        first = np.lexsort((order, lead))[: prefix_length(n, percent)]
                    else:
                        first = np.argsort(order, kind="stable")[: prefix_length(n, percent)]
                    own.append(s[first])
                    at_pos.append(np.arange(len(first)))
                places += at_pos
                for k in own:
                    keys.append(k)
                    owner.append(np.full(len(k), i))
            where = np.concatenate(owner) if owner else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((np.concatenate(keys) if keys else np.zeros(0, np.uint64)).view(np.int64), pa.int64()), pa.array(sizes[where], pa.int64()), pa.array(sigs[where].astype(np.int64), pa.int64()), pa.array(np.concatenate(places) if places else np.zeros(0, np.int64), pa.int64())], names=["key", "n", "sig", "pos"])

    return sets.filter("sig is not null").select("n", "sig", "items").mapInArrow(run, "key long, n long, sig long, pos long")


def set_filter(keys: DataFrame, column: str) -> np.ndarray:
    """Bits set where a key of the column hashes to; FILTER_BITS bits at any input size."""
    at = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    rows = keys.select(F.shiftright(at, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64({column}), 64) as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out


def passing(df: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """The rows whose key may be in the filter."""
    shared = broadcast(df.sparkSession, bits)
    names = df.columns
    probe = df.withColumn("_at", F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            ok = (shared.value[at >> 6] >> (at & 63)) & 1
            yield b.select(names).filter(pa.array(ok.astype(bool)))

    return probe.mapInArrow(run, df.schema)


def sketch_table(sets: DataFrame) -> DataFrame:
    """sig, n, sketch of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("sig"), b.column("n"), pa.array([parity(unpack(x)) for x in b.column("items").to_pylist()], pa.binary())], names=["sig", "n", "sketch"])

    made = sets.filter("sig is not null").select("sig", "n", "items").mapInArrow(run, "sig long, n long, sketch binary")
    return made.groupBy("sig").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))


def verified(pairs: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link: parity bound first, whole sets for those that pass it."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            na, nb = b.column("na").to_pylist(), b.column("nb").to_pylist()
            near = [parity_distance(x, y) <= m + n - 2 * overlap_needed(m, n, percent) for x, y, m, n in zip(b.column("xa").to_pylist(), b.column("xb").to_pylist(), na, nb, strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(b.column("xa").to_pylist(), b.column("xb").to_pylist(), strict=True):
                s, t = unpack(x), unpack(y)
                both = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(100 * both >= percent * (len(s) + len(t) - both))
            yield b.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    def both_ends(p: DataFrame, side: DataFrame, what: str) -> DataFrame:
        for end in "ab":
            p = p.join(side.select(F.col("sig").alias(end), F.col("n").alias("n" + end), F.col(what).alias("x" + end)), end)
        return p.select("a", "b", "na", "nb", "xa", "xb")

    close = stage(both_ends(pairs, sketches, "sketch").mapInArrow(thin, "a long, b long"), "close")
    ends = close.select(F.explode(F.array("a", "b")).alias("sig"))
    have = passing(sets.filter("sig is not null").select("sig", "n", "items"), "sig", set_filter(ends, "sig"))
    have = stage(have.groupBy("sig").agg(F.first("n").alias("n"), F.first("items").alias("items")), "verify")
    links = stage(both_ends(close, have, "items").mapInArrow(exact, "a long, b long"), "links")
    discard(close, have)
    return links


def components(edges: DataFrame) -> DataFrame:
    """sig, comp of every node of edges (a, b): alternating large and small stars until no edge moves."""
    spark = edges.sparkSession
    e = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    print_of = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]
    last = e.agg(*print_of).first()
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        old, e = e, stage(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        discard(old)
        now = e.agg(*print_of).first()
        if now == last:
            break
        last = now
    return e.select(F.col("u").alias("sig"), F.col("v").alias("comp")).union(e.select(F.col("v").alias("sig"), F.col("v").alias("comp"))).distinct()


def linked_components(sets: DataFrame, percent: int) -> DataFrame:
    """sig, comp for the sets that link with another set."""
    sizes = {r["n"]: r["rows"] for r in sets.filter(F.col("n").between(1, 2 * LIGHT_MOST)).groupBy("n").agg(F.count(F.lit(1)).alias("rows")).collect()}  # at most 2 LIGHT_MOST rows
    frequent = frequent_items(sets)
    boundary = choose_boundary(sizes, percent, scan=1.0)
    every = stage(postings(sets, percent, boundary, frequent), "postings")
    keys = stage(every.groupBy("key").agg(F.min("sig").alias("s"), F.max("sig").alias("t")).filter("s <> t").select("key"), "keys")
    shared = passing(every, "key", set_filter(keys, "key")).join(keys, "key", "left_semi")
    # Sizes that can link lie in one or two neighbouring bands; a list is one key in two such bands, and a pair meets in the higher of its own.
    own_band = lambda n: F.floor(F.log(n) / F.log(F.lit(100.0 / percent))).cast("int")
    fits = lambda n, pos, m, at: ((100 + percent) * (n - pos) >= percent * (n + m)) & ((100 + percent) * (m - at) >= percent * (n + m))
    band = own_band(F.col("n"))
    members = shared.withColumn("band", F.explode(F.array(band, band + 1))).select("key", "band", "n", "sig", "pos").distinct()
    hubs = members.groupBy("key", "band").agg(F.min(F.struct("pos", "n", "sig")).alias("hub"), F.count(F.lit(1)).alias("many")).filter("many > 1").select("key", "band", F.col("hub.n").alias("hub_n"), F.col("hub.sig").alias("hub_sig"), F.col("hub.pos").alias("hub_pos"))
    members = stage(members.join(hubs, ["key", "band"]), "lists")
    discard(every, keys)
    at_hub = (F.col("sig") != F.col("hub_sig")) & fits(F.col("n"), F.col("pos"), F.col("hub_n"), F.col("hub_pos"))
    tried = stage(members.filter(at_hub).select(F.least("sig", "hub_sig").alias("a"), F.greatest("sig", "hub_sig").alias("b")).distinct(), "tried")
    sketches = stage(sketch_table(sets), "sketches")
    links = verified(tried, sets, sketches, percent)
    comps = stage(components(links), "comps")
    placed = members.join(comps, "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    placed = placed.join(comps.select(F.col("sig").alias("hub_sig"), F.col("comp").alias("hub_comp")), "hub_sig", "left").withColumn("hub_comp", F.coalesce("hub_comp", "hub_sig"))
    placed = stage(placed.select("key", "band", "n", "sig", "pos", "comp", "hub_comp"), "placed")
    discard(members, comps)
    away = placed.filter("comp <> hub_comp").select("key", "band", F.col("n").alias("n1"), F.col("sig").alias("s1"), F.col("pos").alias("p1"), F.col("comp").alias("c1"))
    others = placed.select("key", "band", F.col("n").alias("n2"), F.col("sig").alias("s2"), F.col("pos").alias("p2"), F.col("comp").alias("c2"), (F.col("comp") == F.col("hub_comp")).alias("at_hub")).filter(F.col("s2").isNotNull())
    met = fits(F.col("n1"), F.col("p1"), F.col("n2"), F.col("p2")) & (own_band(F.greatest("n1", "n2")) == F.col("band"))
    more = away.join(others, ["key", "band"]).filter((F.col("c1") != F.col("c2")) & (F.col("at_hub") | (F.col("s1") < F.col("s2"))) & met)
    more = more.select(F.least("s1", "s2").alias("a"), F.greatest("s1", "s2").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    more = stage(more, "more")
    discard(placed, tried)
    links = links.union(verified(more, sets, sketches, percent))
    discard(more, sketches)
    return components(links)


def _named(sets: DataFrame, percent: int) -> DataFrame:
    """sig, least (its smallest doc_id), comp (its component) of every set."""
    comps = linked_components(sets, percent)
    named = sets.filter("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("least"))
    return named.join(comps, "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))


def representatives(docs: DataFrame, digest: str, size: int, percent: int) -> DataFrame:
    """doc_id, digest, wordless: one text of each component, that of the least doc_id (nulls last) and then digest, and every text without words."""
    sets = named_sets(docs, size, digest)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", digest)).alias("x")
    firsts = sets.filter("sig is not null").groupBy("sig").agg(first)
    one = firsts.join(linked_components(sets, percent), "sig", "left").groupBy(F.coalesce("comp", "sig").alias("comp")).agg(F.min("x").alias("x"))
    one = one.select("x.doc_id", f"x.{digest}", F.lit(False).alias("wordless"))
    return one.union(sets.filter("sig is null").select("doc_id", digest, F.lit(True)).distinct())


def component_ids(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) of every row.

    Empty sets link with nothing, not even each other: a document without words is its own component.  Repeated rows link.  A row whose
    doc_id is null keeps a null component if no linked row has an id; it never gives its component a name.
    """
    sets = named_sets(docs, size)
    grouped = _named(sets, percent)
    names = grouped.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_sig = grouped.join(names, "comp").select("sig", "component_id")
    out = sets.filter("sig is not null").select("doc_id", "n", "sig").join(by_sig, "sig").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.union(sets.filter("sig is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
