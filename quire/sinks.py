"""Exports: JSON, JSON lines, tables with tabs, transcripts, review notes, one file a row.  Existing targets are refused."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Formats of the leaderboards' columns.
BOARD = {"recall": "%.6f", "line_coverage": "%.6f", "median_line_coverage": "%.6f", "area": "%.6f", "boxes": "%.3f", "score": "%.6f"}
PER_PAGE = {"base_recall": "%.6f", "line_coverage": "%.6f", "text_area": "%.6f"}
RANKING = {"score": "%.6f", "recall_gain": "%.6f", "area_gain": "%.6f"}


def _put(spark: SparkSession, value: dict, path: str, replace: bool) -> None:
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    target, part = fs_path(path), fs_path(path + ".tmp")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(part, True)
    out.write(bytearray((json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False) + "\n").encode()))
    out.close()
    if replace:
        fs.delete(target, False)
    if fs.exists(target) or not fs.rename(part, target):
        fs.delete(part, False)
        raise FileExistsError(path)


def write_json_document(spark: SparkSession, value: dict, path: str) -> None:
    """One document, keys sorted; it appears whole, by renaming."""
    _put(spark, value, path, replace=False)


def replace_json_document(spark: SparkSession, value: dict, path: str) -> None:
    """As `write_json_document`, in the place of an older document; between the two there is none for a moment."""
    _put(spark, value, path, replace=True)


def require_fresh(spark: SparkSession, path: str) -> None:
    """Refuse a folder that holds anything."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(where) and (not fs.getFileStatus(where).isDirectory() or len(fs.listStatus(where))):
        raise FileExistsError(f"{path} must be empty or absent")


def write_json_lines(df: DataFrame, path: str) -> int:
    """One object a line, keys sorted; how many."""
    df.select(*sorted(df.columns)).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return df.sparkSession.read.text(path).count()


def write_lines(rows: DataFrame, path: str) -> None:
    """One file of the lines of rows (line, value) in the order of `line`, on any file system that Spark writes; it appears whole, by renaming.

    Tasks write numbered parts of their ranges; the parts are then copied one after another as streams, so nothing holds more than a
    part's buffer, whatever the length.
    """
    spark = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop
    target, whole, parts = (hadoop.fs.Path(path + end) for end in ("", ".tmp", ".parts"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(path)
    rows.orderBy("line", "value").select("value").write.mode("overwrite").text(path + ".parts")
    out = fs.create(whole, True)
    for name in sorted(s.getPath().getName() for s in fs.listStatus(parts) if s.getPath().getName().startswith("part-")):
        part = fs.open(hadoop.fs.Path(parts, name))
        hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
        part.close()
    out.close()
    fs.delete(parts, True)
    if not fs.rename(whole, target):
        raise FileExistsError(path)


def write_tsv(df: DataFrame, path: str, formats: dict[str, str] | None = None) -> None:
    """formats: column to printf pattern, such as %.6f."""
    cols = [F.format_string(f, F.col(c).cast("double")).alias(c) if (f := (formats or {}).get(c)) else F.col(c) for c in df.columns]
    df.select(*cols).write.mode("errorifexists").csv(path, sep="\t", header=True)


def write_leaderboards(path: str, variants: DataFrame, sources: DataFrame, per_variant: DataFrame, per_source: DataFrame) -> None:
    """The four tables of a fusion run."""
    for name, df, formats in (("variant_leaderboard", variants, BOARD), ("source_leaderboard", sources, BOARD), ("per_page_variant_metrics", per_variant, PER_PAGE), ("per_page_source_metrics", per_source, PER_PAGE)):
        write_tsv(df, f"{path}/{name}.tsv", formats)


def write_transcripts(df: DataFrame, path: str) -> None:
    """Sections of all pages in order: a heading with the page's id, then its transcript; df (page_id, transcript)."""
    text = F.concat(F.lit("## "), F.col("page_id").cast("string"), F.lit("\n"), F.coalesce("transcript", F.lit("")), F.lit("\n"))
    df.orderBy("page_id").select(text.alias("value")).write.mode("errorifexists").text(path)


def review_note(title: Column, **fields: Column) -> Column:
    """Markdown with one bullet a field."""
    return F.concat_ws("\n", F.concat(F.lit("# "), title.cast("string")), F.lit(""), *[F.concat(F.lit(f"- {k}: "), F.coalesce(v.cast("string"), F.lit(""))) for k, v in fields.items()])


def write_files(df: DataFrame, root: str) -> None:
    """One file a row (path below root, value); root is a folder that all workers mount.  A file appears whole, by renaming, so a task may run again."""

    def write(rows) -> None:
        for r in rows:
            path = os.path.join(root, r["path"])
            os.makedirs(os.path.dirname(path), exist_ok=True)
            part = f"{path}.{os.getpid()}.tmp"
            with open(part, "w", encoding="utf-8") as f:
                f.write(r["value"])
            os.replace(part, path)

    df.select("path", "value").foreachPartition(write)
