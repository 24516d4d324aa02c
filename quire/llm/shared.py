"""Helpers that the operators of this package share: the shared folder, staged tables, words and checksums."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
import weakref
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
_CACHES: list[dict] = []
_STAGED: dict[int, tuple] = {}
_BROADCASTS: list = []
BATCH_ROWS, BATCH_BYTES = 4000, 6 << 20
_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
#: A key is hot if it has more than this part of all rows.
HOT = 1000


def worker_cache() -> dict:
    """A cache that an operator keeps in its worker processes from task to task."""
    _CACHES.append({})
    return _CACHES[-1]


def keep_only(cache: dict | None = None) -> None:
    """Empty the other operators' caches of this worker, so that the memory of queries run one after another does not add up."""
    for c in _CACHES:
        if c is not cache:
            c.clear()
    pa.default_memory_pool().release_unused()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  Where that is unset, a local master gets a folder of its own; a cluster has none that all its machines see, so it raises ValueError."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    master = spark.sparkContext.master
    if master.split("[")[0] != "local":
        raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors share (master {master})")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="quire-")
    return _OWN[app]


def _hadoop_path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends, or earlier by `discard`."""
    path = f"{shared_dir(spark)}/quire/{label}-{uuid.uuid4().hex}"
    where, fs = _hadoop_path(spark, path)
    fs.deleteOnExit(where)
    return path


@contextlib.contextmanager
def batch_limits(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most BATCH_ROWS rows and BATCH_BYTES bytes within the block, whatever a text's length; smaller settings of the session's own stay."""
    old = {k: spark.conf.get(k, None) for k in _LIMITS}
    small_batches(spark)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def small_batches(spark: SparkSession) -> None:
    """The same limits from now on: for plans that are returned before they run."""
    for k, most in _LIMITS.items():
        now = spark.conf.get(k, None)
        if not now or not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) <= most:
            spark.conf.set(k, str(most))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage is cut and an executor's loss costs no more than its own tasks."""
    spark = df.sparkSession
    path = new_path(spark, label)
    with batch_limits(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _STAGED[id(out)] = (weakref.ref(out), path)
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, and let Spark's cleaner take the shuffle files that led to them: it works on the driver's garbage."""
    for df in staged:
        ref, path = _STAGED.pop(id(df), (None, ""))
        if ref and ref() is df:
            where, fs = _hadoop_path(df.sparkSession, path)
            fs.delete(where, True)
    gc.collect()
    staged[0].sparkSession._jvm.System.gc()


def broadcast(spark: SparkSession, value):
    """A broadcast that `release` takes off the executors once its query is over."""
    out = spark.sparkContext.broadcast(value)
    _BROADCASTS.append(out)
    return out


def release() -> None:
    """Take the broadcasts of queries that are over off the executors; one still in use is sent again."""
    while _BROADCASTS:
        _BROADCASTS.pop().unpersist()


def meet_hot(left: DataFrame, right: DataFrame, key: str, uses: str) -> DataFrame:
    """left joined with right on key, right having one row a key and, in column uses, about how many rows of left ask for it.

    Keys with more than 1/HOT of all uses, fewer than HOT of them, are broadcast, so that no task gets a hot key's rows; all others meet by a shuffle.
    """
    total = right.agg(F.sum(uses)).first()[0] or 0
    hot = right.filter(F.col(uses) * HOT > total)
    cold = right.filter(F.col(uses) * HOT <= total)
    light = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(F.broadcast(hot), key).unionByName(light.join(cold, key))


def doc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def words_of(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, as UTF-8; bytes.lower and bytes.split know ASCII only."""
    return text.encode("utf-8").lower().split() if text else []


def crc_of(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def partition_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
