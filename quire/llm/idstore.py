"""Content-addressed store of token-id streams.

Every text's ids are cut into chunks where a rolling hash of the last `WINDOW` ids hits a mask, so equal passages give equal
chunks wherever they stand.  A chunk is named by its digest and stored once, under that name: in the pack of its document's record if no
other document has it, else as a chunk record of its own.  A document record holds the recipe (digests and sizes in order), the
Merkle root of its digests and its pack; every file ends with a manifest record: how many documents it has and the Merkle root over their
roots.  The store's root, written last, is the Merkle root over the files' manifests.

File format: Parquet files of records in ascending doc_id order, kinds `doc`, `chunk` and `manifest`, under `records`; the store's root
under `root`; chunk bodies are zstd-compressed little-endian 16-bit ids, so an id above 65535 raises ValueError.  Reading finds every chunk of a
recipe by its digest, rebuilds the streams, and checks digests, roots and manifests: a changed, missing or added record raises ValueError.

Null text is an empty one: the end id alone.  Repeated rows are separate documents that share all chunks.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import batch_limits, crc_of, meet_hot, mix64, new_path, partition_count, small_batches, stage
from .tokens import encoder

WINDOW = 16
#: Cut where these bits of the rolling hash are 0: once in 256 ids on average.
CUT_MASK = np.uint64(0xFF << 24)
LEAST, MOST = 64, 1024
_GEAR = mix64(np.arange(1, 65537, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """Pairs are hashed level by level; an odd last node moves up as it is.  No leaves: the digest of nothing."""
    level = leaves or [digest(b"")]
    while len(level) > 1:
        level = [digest(b"".join(level[i : i + 2])) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def cut_points(ids: np.ndarray, sizes: np.ndarray) -> tuple[list[int], list[int]]:
    """Ends of the chunks of id streams (uint16) that lie in a row, each of at least one id, and how many chunks each stream has.

    The hash of a stream's first ids reaches back into the stream before, but no chunk ends among its first LEAST ids.
    """
    h = _GEAR[ids]
    for step in (1, 2, 4, 8):  # sums of 2, 4, 8 and WINDOW ids
        h[step:] += h[:-step].copy() << np.uint64(step)
    hits = np.flatnonzero((h & CUT_MASK) == 0) + 1
    stops = np.cumsum(sizes)
    bounds = np.searchsorted(hits, stops, side="left").tolist()
    hits, ends, counts, start, first = hits.tolist(), [], [], 0, 0
    for stop, last in zip(stops.tolist(), bounds, strict=True):
        before = len(ends)
        for c in hits[first:last]:
            while c - start > MOST:
                start += MOST
                ends.append(start)
            if c - start >= LEAST:
                ends.append(c)
                start = c
        while stop - start > MOST:
            start += MOST
            ends.append(start)
        if start < stop:
            ends.append(stop)
        counts.append(len(ends) - before)
        start, first = stop, last
        while first < len(hits) and hits[first] <= stop:
            first += 1
    return ends, counts


STAGED = T.StructType([T.StructField("uid", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("digests", T.ArrayType(T.BinaryType())), T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("body", T.BinaryType())])
RECORD = T.StructType([T.StructField("kind", T.StringType()), T.StructField("part", T.LongType()), T.StructField("local_start", T.LongType()), T.StructField("uid", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("digests", T.ArrayType(T.BinaryType())), T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("pack", T.ArrayType(T.BinaryType())), T.StructField("uses", T.LongType()), T.StructField("root", T.BinaryType()), T.StructField("body", T.BinaryType())])
_ARROW = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.ArrayType(T.BinaryType()): pa.list_(pa.binary()), T.ArrayType(T.IntegerType()): pa.list_(pa.int32())}


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), _ARROW[f.dataType]) for c, f in zip(columns, schema, strict=True)], names=schema.names)


def encode_chunks(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """uid, doc_id, digests and sizes of the chunks, and the compressed ids, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc, press, uid = encoder(tokenizer_path, keeps_space=False), zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 40
        for b in batches:
            ids, sizes = enc.encode(b.column("text"), end_id)
            if len(ids) and int(ids.max()) > 0xFFFF:
                raise ValueError(f"id {int(ids.max())} does not fit the store's 16 bits")
            ids = ids.astype("<u2")
            ends, counts = cut_points(ids, sizes)
            raw, starts = memoryview(ids.tobytes()), [0, *ends][: len(ends)]
            digests = pa.array([digest(raw[2 * i : 2 * j]) for i, j in zip(starts, ends, strict=True)], pa.binary())
            lists = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
            stops = (2 * np.cumsum(sizes)).tolist()
            bodies = [press.compress(raw[i:j]) for i, j in zip([0, *stops[:-1]], stops, strict=False)]
            chunk_sizes = pa.array(np.array(ends, np.int64) - np.array(starts, np.int64), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(uid + np.arange(len(sizes))), b.column("doc_id"), pa.ListArray.from_arrays(lists, digests), pa.ListArray.from_arrays(lists, chunk_sizes), pa.array(bodies, pa.binary())], names=STAGED.names)
            uid += len(sizes)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, STAGED)


def _slices(digests: list[bytes], sizes: list[int], raw: bytes) -> dict[bytes, bytes]:
    """The chunks of a body by digest."""
    ends = list(itertools.accumulate(2 * n for n in sizes))
    return {d: raw[j - 2 * n : j] for d, n, j in zip(digests, sizes, ends, strict=True)}


def _write_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a document: perhaps its sharing plan (kind 0), then its ids (kind 1)."""
    import zstandard

    press, un, part, at, roots, plan = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor(), TaskContext.get().partitionId(), 0, [], None
    for b in batches:
        rows = []
        for r in b.to_pylist():
            if r["kind"] == 0:
                plan = (r["uid"], set(r["shared"]), dict(zip(r["own"], r["own_uses"], strict=True)))
                continue
            shared, own = plan[1:] if plan and plan[0] == r["uid"] else ((), {})
            digests, sizes, raw = r["digests"], r["sizes"], r["body"]
            n, root = sum(sizes), merkle_root(digests)
            pack = digests if not shared and len(set(digests)) == len(digests) else None
            if pack is None:  # else the body is the pack as it is
                have, size = _slices(digests, sizes, un.decompress(raw)), dict(zip(digests, sizes, strict=True))
                for d, uses in own.items():
                    rows.append(("chunk", part, None, None, None, size[d], [d], [size[d]], None, uses, None, press.compress(have[d])))
                pack = [d for d in dict.fromkeys(digests) if d not in shared]
                raw = press.compress(b"".join(have[d] for d in pack))
            roots.append(root)
            rows.append(("doc", part, at, r["uid"], r["doc_id"], n, digests, sizes, pack, None, root, raw))
            at += n
        yield _batch(rows, RECORD)
    if roots:
        yield _batch([("manifest", part, None, None, None, at, None, None, None, len(roots), merkle_root(roots), None)], RECORD)


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, path: str) -> None:
    """Encode docs (doc_id, text) and write the store's files to path."""
    spark = docs.sparkSession
    staged = stage(encode_chunks(docs, tokenizer_path, end_id), "ids")
    chunks = staged.select("doc_id", "uid", F.explode(F.array_distinct("digests")).alias("digest"))
    owners = chunks.groupBy("digest").agg(F.min(F.struct("doc_id", "uid")).alias("owner"), F.count(F.lit(1)).alias("uses")).filter("uses > 1")
    owned = meet_hot(chunks, stage(owners.select("digest", F.col("owner.uid").alias("owner"), "uses"), "owners"), "digest", "uses")
    mine = F.when(F.col("owner") == F.col("uid"), F.struct("digest", "uses"))
    plan = owned.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.collect_list("digest").alias("shared"), F.sort_array(F.collect_list(mine)).alias("mine"))
    plan = plan.select("doc_id", "uid", F.lit(0).alias("kind"), "shared", F.col("mine.digest").alias("own"), F.col("mine.uses").alias("own_uses"))
    rows = staged.withColumn("kind", F.lit(1)).unionByName(plan, allowMissingColumns=True)
    ordered = rows.repartitionByRange(partition_count(spark), "doc_id", "uid").sortWithinPartitions("doc_id", "uid", "kind")
    with batch_limits(spark):
        ordered.mapInArrow(_write_records, RECORD).write.option("compression", "none").parquet(f"{path}/records")
    manifests = spark.read.schema(RECORD).parquet(f"{path}/records").filter("kind = 'manifest'").orderBy("part").select("root").collect()  # one row per file
    root = merkle_root([bytes(m["root"]) for m in manifests])
    spark.createDataFrame([(len(manifests), root)], "files long, root binary").coalesce(1).write.parquet(f"{path}/root")


def check_manifests(spark: SparkSession, path: str) -> dict[int, int]:
    """Raise ValueError unless files, documents and roots are those that were written; ids before each file."""
    records = spark.read.schema(RECORD).parquet(f"{path}/records")
    manifests = records.filter("kind = 'manifest'").select("part", "n_tokens", "uses", "root").orderBy("part").collect()  # one row per file
    said = spark.read.schema("files long, root binary").parquet(f"{path}/root").first()
    if said is None or said["files"] != len(manifests) or bytes(said["root"]) != merkle_root([bytes(m["root"]) for m in manifests]):
        raise ValueError("the store's root does not fit its files' manifests")

    def differing(key: tuple, docs: pa.Table) -> pa.Table:
        """One file's documents: as many as a partition of the writer held."""
        docs = docs.sort_by("local_start")
        root = merkle_root(docs.column("root").to_pylist())
        said = {m["part"]: (m["uses"], m["n_tokens"], bytes(m["root"])) for m in manifests}.get(key[0].as_py())
        ends = np.cumsum(docs.column("n_tokens").to_numpy())
        starts = docs.column("local_start").to_pylist()
        fits = said == (docs.num_rows, int(ends[-1]), root) and starts == [0, *ends.tolist()[:-1]]
        return pa.table([pa.array([] if fits else [key[0].as_py()], pa.int64())], names=["part"])

    docs = records.filter("kind = 'doc'").select("part", "local_start", "n_tokens", "root")
    bad = docs.groupBy("part").applyInArrow(differing, "part long").limit(5).collect()
    found = docs.select("part").distinct().count()
    if bad or found != len(manifests):
        raise ValueError(f"files {sorted(r['part'] for r in bad)}: the documents do not fit the manifest")
    return dict(zip((m["part"] for m in manifests), itertools.accumulate([0] + [m["n_tokens"] for m in manifests]), strict=False))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and ids (little-endian 32-bit) of every document.

    A digest, size, Merkle root or manifest that does not fit raises ValueError.
    """
    base = check_manifests(spark, path)
    records = spark.read.schema(RECORD).parquet(f"{path}/records")
    docs = records.filter("kind = 'doc'").select("part", "local_start", "uid", "doc_id", "digests", "sizes", "pack", "root", "body")
    away = F.array_except("digests", "pack")
    asked = docs.select("uid", F.explode(away).alias("digest"))
    chunks = records.filter("kind = 'chunk'").select(F.element_at("digests", 1).alias("digest"), "uses", F.col("body").alias("chunk"))
    fetched = meet_hot(asked, chunks, "digest", "uses").groupBy("uid").agg(F.collect_list(F.struct("digest", "chunk")).alias("fetched"))  # a document's own chunks
    alone = docs.filter(F.size(away) == 0).withColumn("fetched", F.lit(None).cast("array<struct<digest:binary,chunk:binary>>"))
    mixed = docs.filter(F.size(away) > 0).join(fetched, "uid", "left")
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        un = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for r in b.to_pylist():
                size = dict(zip(r["digests"], r["sizes"], strict=True))
                have = {x["digest"]: un.decompress(x["chunk"]) for x in r["fetched"] or ()}
                try:
                    have |= _slices(r["pack"], [size[d] for d in r["pack"]], un.decompress(r["body"]))
                    pieces = [have[d] for d in r["digests"]]
                except KeyError:
                    raise ValueError(f"document {r['doc_id']}: a chunk of its recipe is missing") from None
                if any(digest(x) != d or len(x) != 2 * size[d] for d, x in have.items()) or merkle_root(r["digests"]) != r["root"]:
                    raise ValueError(f"document {r['doc_id']}: the stored chunks do not fit its recipe")
                ids = np.frombuffer(b"".join(pieces), dtype="<u2").astype("<u4").tobytes()
                rows.append((r["doc_id"], base[r["part"]] + r["local_start"], len(ids) // 4, crc_of(ids), ids))
            yield _batch(rows, out)

    small_batches(spark)
    cols = ["part", "local_start", "doc_id", "digests", "sizes", "pack", "root", "body", "fetched"]
    return alone.select(*cols).unionByName(mixed.select(*cols)).mapInArrow(run, out)


def store_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write docs to a store in the shared folder and read it back."""
    path = new_path(docs.sparkSession, "store")
    write_store(docs, tokenizer_path, end_id, path)
    return read_store(docs.sparkSession, path)
