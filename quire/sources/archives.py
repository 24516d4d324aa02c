"""Images inside archives, read member by member.

The directory of an archive is read first, by a task for each archive: the central directory of a zip, the headers of a plain tar, from
one to the next.  Members are then dealt out over tasks, which read theirs alone, by place and length, so neither an archive nor
several members are ever held whole.  Compressed tars have no such places: a task streams each of them from its start, a member at a time.
"""

from __future__ import annotations

import re
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Endings of images and archives.
IMAGES = r"(?i)\.(png|jpg|jpeg|tif|tiff|bmp|webp)$"
ARCHIVES = r"(?i)\.(zip|tar|tar\.gz|tgz|tar\.bz2|tbz|tbz2|tar\.xz|txz)$"
ENTRY = "archive string, member string, way string, at long, packed long, size long, crc long"
MEMBER = pa.schema([("archive", pa.string()), ("member", pa.string()), ("content", pa.binary())])
_ENTRY = pa.schema([("archive", pa.string()), ("member", pa.string()), ("way", pa.string()), ("at", pa.int64()), ("packed", pa.int64()), ("size", pa.int64()), ("crc", pa.int64())])
#: Directory entries of one batch.
BATCH = 10_000


def _open(path: str):
    """A file to be read anywhere, on any file system that workers reach by itself or through Arrow."""
    from pyarrow import fs

    local = re.match(r"(?:file:/+|/)(.*)", path)
    system, name = (fs.LocalFileSystem(), "/" + local[1]) if local else fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return system.open_input_file(name)


def _safe(archive: str, member: str) -> str:
    if member.startswith(("/", "\\")) or ".." in member.replace("\\", "/").split("/"):
        raise ValueError(f"{archive}: member {member} leaves its folder")
    return member


def _wanted(member: str) -> bool:
    parts = re.split(r"[/\\]", member)
    return bool(re.search(IMAGES, member)) and not any(p.startswith(".") or p == "__MACOSX" for p in parts)


def _zip_entries(path: str, f) -> Iterator[tuple]:
    for m in zipfile.ZipFile(f).infolist():
        if not m.is_dir() and _wanted(_safe(path, m.filename)):
            if m.flag_bits & 1:
                raise ValueError(f"{path}: member {m.filename} is encrypted")
            way = {zipfile.ZIP_STORED: "stored", zipfile.ZIP_DEFLATED: "deflated"}.get(m.compress_type, "other zip")
            yield path, m.filename, way, m.header_offset, m.compress_size, m.file_size, m.CRC


def _tar_entries(path: str, f) -> Iterator[tuple]:
    whole = path.lower().endswith(".tar")
    with tarfile.open(fileobj=f, mode="r:" if whole else "r|*") as t:
        for m in t:
            t.members.clear()  # else every header ever read is kept
            if m.isfile() and _wanted(_safe(path, m.name)):
                way = "stream" if not whole else "sparse tar" if m.issparse() else "tar"
                yield path, m.name, way, m.offset_data, m.size, m.size, None


def _entries(path: str) -> Iterator[tuple]:
    with _open(path) as f:
        yield from _zip_entries(path, f) if path.lower().endswith(".zip") else _tar_entries(path, f)


def directory(paths: DataFrame) -> DataFrame:
    """archive, member and where it lies, of the images among the regular members of archives (path); other paths give none.

    Dot files and the folders that some systems add do not count.  A member that would leave its folder, encrypted ones and archives that cannot
    be read stop the query.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                rows = []
                for row in _entries(path):
                    rows.append(row)
                    if len(rows) == BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ENTRY.types, strict=True)], schema=_ENTRY)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ENTRY.types, strict=True)], schema=_ENTRY)

    return _spread(paths, "path").mapInArrow(run, ENTRY)


def _spread(paths: DataFrame, *by: str) -> DataFrame:
    """A number of partitions that stays: a few rows may stand for much to read."""
    return paths.filter(F.col("path").rlike(ARCHIVES)).select("path").distinct().repartition(4 * paths.sparkSession.sparkContext.defaultParallelism, *by)


def _member(f, row: dict) -> bytes:
    """A member's content, from its place alone."""
    if row["way"] == "tar":
        f.seek(row["at"])
        return f.read(row["size"])
    if row["way"] == "sparse tar":
        t = tarfile.open(fileobj=f, mode="r:")
        return t.extractfile(next(m for m in t if m.offset_data == row["at"])).read()
    if row["way"] == "other zip":
        return zipfile.ZipFile(f).read(row["member"])
    f.seek(row["at"])
    name, extra = struct.unpack("<26xHH", f.read(30))
    f.seek(row["at"] + 30 + name + extra)
    raw = f.read(row["packed"])
    content = zlib.decompress(raw, -15) if row["way"] == "deflated" else raw
    if len(content) != row["size"] or zlib.crc32(content) != row["crc"]:
        raise ValueError(f"{row['archive']}: member {row['member']} is damaged")
    return content


def _one(archive: str, member: str, content: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([member]), pa.array([content], pa.binary())], schema=MEMBER)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        last, f = None, None
        for row in b.to_pylist():
            if row["archive"] != last:
                if f:
                    f.close()
                last, f = row["archive"], _open(row["archive"])
            yield _one(row["archive"], row["member"], _member(f, row))
        if f:
            f.close()


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path in b.column("path").to_pylist():
            with _open(path) as f, tarfile.open(fileobj=f, mode="r|*") as t:
                for m in t:
                    t.members.clear()
                    if m.isfile() and _wanted(_safe(path, m.name)):
                        yield _one(path, m.name, t.extractfile(m).read())


def members(paths: DataFrame) -> DataFrame:
    """archive, member, content of the images in archives (path), as `directory` finds them; a repeated member comes as often as it is stored."""
    schema = "archive string, member string, content binary"
    tasks = 4 * paths.sparkSession.sparkContext.defaultParallelism
    stream = F.col("path").rlike(r"(?i)\.(tar\.|t)(gz|bz|bz2|xz)$")
    own = directory(paths.filter(~stream)).repartition(tasks, "archive", "at").sortWithinPartitions("archive", "at")
    return own.mapInArrow(_placed, schema).unionByName(_spread(paths.filter(stream), "path").mapInArrow(_streamed, schema))
