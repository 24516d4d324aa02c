"""Scans of manifests, JSON lines, path lists, image folders and archives."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.validation import resolved
from quire.sources import archives
from quire.sources.archives import ARCHIVES, IMAGES

# Endings of lists.
LISTS = r"(?i)\.(txt|manifest|lst|tsv|csv)$"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path fits a pattern with * in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return bool(found)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line (from 1), raw of every line of one file or more; a file is read whole, so this is for manifests and reports."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line", "raw")).withColumn("line", F.col("line") + 1)


def classified(lines: DataFrame, comments: bool = False) -> DataFrame:
    """Lines (raw and more) with value (variant) and code: invalid_jsonl for no JSON, invalid_jsonl_row for no object, null for good rows; blank lines go, and those with # where comments are allowed."""
    raw = F.regexp_replace("raw", r"^\s+|\s+$", "")
    kept = lines.filter((raw != "") & ~(F.lit(comments) & raw.startswith("#")))
    value = F.try_parse_json("raw")
    code = F.when(value.isNull(), "invalid_jsonl").when(~F.schema_of_variant(value).startswith("OBJECT"), "invalid_jsonl_row")
    return kept.select(*[c for c in lines.columns if c != "raw"], value.alias("value"), code.alias("code"))


def json_lines(spark: SparkSession, path: str, comments: bool = False) -> DataFrame:
    """file, line, value, code of a file's rows, as `classified` gives them; a path without files raises FileNotFoundError."""
    if not matches(spark, path):
        raise FileNotFoundError(path)
    return classified(numbered_lines(spark, path), comments)


def strict_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line, value; the first bad row stops the query."""
    rows = json_lines(spark, path)
    bad = F.raise_error(F.concat_ws(":", "file", F.col("line").cast("string"), "code"))
    return rows.select("file", "line", F.when(F.col("code").isNull(), F.col("value")).otherwise(F.try_parse_json(bad.cast("string"))).alias("value"))


def page_manifest(spark: SparkSession, path: str) -> DataFrame:
    """line, page_id, image_path (absolute), page_number, source, checksum of a JSONL manifest; rows without id or path stop the query."""
    folder = F.regexp_extract("file", "^(.*)/[^/]*$", 1)
    get = lambda k: F.try_variant_get("value", f"$.{k}", "string")
    rows = json_lines(spark, path, comments=True).select("line", folder.alias("dir"), *[get(k).alias(k) for k in ("page_id", "image_path", "page_number", "source_system", "checksum_sha256")])
    whole = lambda c: F.when(F.coalesce(c, F.lit("")) == "", F.raise_error(F.format_string(f"line %d: no {c}", "line")).cast("string")).otherwise(F.col(c))
    image = F.when(F.col("image_path").rlike("^(/|[a-z]+:)"), F.col("image_path")).otherwise(F.concat_ws("/", "dir", "image_path"))
    return rows.select("line", whole("page_id").alias("page_id"), F.when(F.length(whole("image_path")) > 0, image).alias("image_path"), F.nullif("page_number", F.lit("")).alias("page_number"), "source_system", "checksum_sha256")


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def expanded(lines: DataFrame, expand: bool = True) -> DataFrame:
    """Lines (raw and more) as paths; blank and # lines go, $VAR (of the driver's environment) and ~ are expanded where asked."""
    kept = lines.withColumn("raw", F.regexp_replace("raw", r"^\s+|\s+$", "")).filter((F.col("raw") != "") & ~F.col("raw").startswith("#"))
    p = F.col("raw")
    if expand:
        known = {f"${k}": v for k, v in os.environ.items()} | {f"${{{k}}}": v for k, v in os.environ.items()}
        used = kept.select(F.explode(F.regexp_extract_all("raw", F.lit(r"(\$\w+|\$\{[^}]*\})"), 1)).alias("v")).distinct().collect()  # the variables that the lines name
        for name in sorted((r["v"] for r in used if r["v"] in known), key=len, reverse=True):
            p = F.replace(p, F.lit(name), F.lit(known[name]))
        p = F.when(p.rlike("^~(/|$)"), F.concat(F.lit(os.path.expanduser("~")), F.substr(p, F.lit(2)))).otherwise(p)
    return kept.withColumn("path", p).drop("raw")


def path_list(spark: SparkSession, path: str, expand: bool = True) -> DataFrame:
    """line, path, slug of a list with one path a line, as `expanded` gives them."""
    return expanded(numbered_lines(spark, path), expand).select("line", "path").withColumn("slug", stem(F.col("path")))


def require_listed(paths: DataFrame, listed: DataFrame, first: int = 20) -> DataFrame:
    """The paths, if all are among the listed ones (path); else FileNotFoundError names the first."""
    bare = F.regexp_replace("path", "^[a-z]+:/+", "/")
    lost = paths.select(bare.alias("p")).join(listed.select(bare.alias("p")).distinct(), "p", "left_anti")
    n = lost.count()
    if n:
        raise FileNotFoundError(f"{n} paths are missing, first: {[r['p'] for r in lost.orderBy('p').limit(first).collect()]}")
    return paths


def last_by_slug(paths: DataFrame) -> DataFrame:
    return paths.groupBy("slug").agg(F.max_by("path", "line").alias("path"))


def ignored(path: Column) -> Column:
    """Dot files and the folders that archives of some systems carry."""
    return F.exists(F.split(path, r"[/\\]"), lambda p: p.startswith(".") | (p == "__MACOSX"))


def listing(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """path, inside (relative to root), length of the files; contents are not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
    return f.select("path", F.regexp_replace("path", "^.*?" + root.rstrip("/").replace(".", r"\.") + "/", "").alias("inside"), "length")


def images(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    return listing(spark, root, recursive).filter(F.col("inside").rlike(IMAGES) & ~ignored(F.col("inside"))).select("path", "length")


def archive_folder(path: Column) -> Column:
    """Name of an archive's own folder: its stem and the first 12 digits of its path's sha1."""
    name = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(path, "([^/]*)$", 1)), ARCHIVES, ""), " ", "_")
    return F.concat_ws("_", F.coalesce(F.nullif(F.trim(name), F.lit("")), F.lit("archive")), F.substring(F.sha1(path.cast("binary")), 1, 12))


def staged(paths: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Distinct paths in the order of their lower case, the first max_pages where given, each of the kind it was first given as; paths (ord, path, kind)."""
    first = paths.groupBy("path").agg(F.min_by("kind", "ord").alias("kind")).orderBy(F.lower("path"), "path")
    return first if max_pages is None else first.limit(max_pages)


def image_manifest(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """path of all images below root by the lower case of their names; Spark lists no files or folders that begin with . or _."""
    name = F.lower(F.regexp_extract("path", "([^/]*)$", 1))
    return listing(spark, root, recursive).filter(F.col("inside").rlike(IMAGES)).orderBy(name, "path").select("path")


def plain(path: Column) -> Column:
    """A path without . and .. parts; local ones without their scheme, so that one file has one name."""
    scheme = F.regexp_extract(path, "^([a-z][a-z0-9]*:/+[^/]*)/", 1)
    own = F.when(path.rlike("^file:/"), F.lit("")).otherwise(scheme)
    rest = F.when(path.rlike("^file:/"), F.regexp_replace(path, "^file:/+", "/")).otherwise(F.substr(path, F.length(scheme) + 1))
    return F.concat(own, F.when(rest.startswith("/"), F.lit("/")).otherwise(F.lit("")), F.array_join(resolved(rest), "/"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path is a folder; absent ones raise."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def _entries(spark: SparkSession, lists: list[tuple[list[int], str]]) -> DataFrame:
    """place, path of the entries of lists (place, path): relative ones lie in the list's folder, and a place goes on with its line."""
    at = spark.createDataFrame(lists, "place array<long>, list string")
    lines = expanded(numbered_lines(spark, [p for _, p in lists])).withColumn("list", plain(F.col("file")))
    inside = F.concat(F.regexp_replace("list", "/[^/]*$", ""), F.lit("/"), F.col("path"))
    path = F.when(F.col("path").rlike("^(/|[a-z][a-z0-9]*:/)"), F.col("path")).otherwise(inside)
    return lines.join(F.broadcast(at), "list").select(F.concat("place", F.array(F.col("line").cast("long"))).alias("place"), plain(path).alias("path"))


def stage_inputs(spark: SparkSession, inputs: list[str], recursive: bool = True, max_pages: int | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Images of inputs (path, kind), and how many inputs of each kind there were.

    An input is an image, a folder, an archive (whose members are named archive!member) or a list of inputs, several of them parted by commas; a list is
    read once, its relative paths taken from its folder, whatever lists name each other.  Inputs that are absent or of no known kind raise.

    Lists are followed level by level: all lists of a level are read at once, and those that were read before go by an anti-join.  Only the names of lists,
    archives and folders come to the driver, which has to name them to Spark's readers; the images that lists name stay a table.
    """
    counts, parts = {"file": 0, "directory": 0, "archive": 0, "manifest": 0}, []
    given = [p.strip() for x in inputs for p in x.split(",") if p.strip()]
    if not given:
        raise ValueError("no inputs")
    kind = F.when(F.col("path").rlike(IMAGES), "file").when(F.col("path").rlike(ARCHIVES), "archive").when(F.col("path").rlike(LISTS), "manifest").otherwise("directory")
    named = spark.createDataFrame([([i], p, _is_folder(spark, p)) for i, p in enumerate(given)], "place array<long>, path string, folder boolean")
    level = named.select("place", plain(F.col("path")).alias("path"), F.when(F.col("folder"), "directory").otherwise(kind).alias("kind"))
    seen = spark.createDataFrame([], "path string")
    while True:
        images_ = level.filter("kind = 'file'")
        others = level.filter("kind <> 'file'").join(seen, "path", "left_anti").groupBy("path", "kind").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n")).collect()  # lists, archives, folders
        folders_of = [r[0] for r in images_.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]
        there = reduce(DataFrame.unionByName, (listing(spark, f, recursive=False).select("path") for f in folders_of if exists(spark, f)), spark.createDataFrame([], "path string"))
        require_listed(images_, there)
        counts["file"] += images_.count()
        parts.append(images_.select(F.col("place").alias("ord"), "path", F.lit("file").alias("kind")))
        lists, packed = [], []
        for r in others:
            if _is_folder(spark, r["path"]):
                counts["directory"] += r["n"]
                found = images(spark, r["path"], recursive).select(plain(F.col("path")).alias("path"))
            elif r["kind"] == "directory":
                raise ValueError(f"{r['path']} is no image, folder, archive or list")
            elif r["kind"] == "archive":
                counts["archive"] += r["n"]
                packed.append(r)
                continue
            else:
                counts["manifest"] += 1
                lists.append((r["place"], r["path"]))
                continue
            parts.append(found.select(F.lit(r["place"]).cast("array<long>").alias("ord"), "path", F.lit("directory").alias("kind")))
        if packed:
            at = spark.createDataFrame([(r["place"], r["path"]) for r in packed], "ord array<long>, path string")
            inside = archives.directory(at).join(F.broadcast(at.withColumnRenamed("path", "archive")), "archive")
            parts.append(inside.select("ord", F.concat_ws("!", "archive", "member").alias("path"), F.lit("archive").alias("kind")))
        if not lists:
            return staged(reduce(DataFrame.unionByName, parts), max_pages), counts
        seen = seen.unionByName(spark.createDataFrame([(p,) for _, p in lists], "path string"))
        level = _entries(spark, lists).withColumn("kind", kind)


def checksums(spark: SparkSession, root: str) -> DataFrame:
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return f.select("path", F.sha2("content", 256).alias("checksum"))


def tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True)
