"""Text assembly, tables, models in the order first seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.layout import strip


def page_text(docs: DataFrame) -> DataFrame:
    """Non-empty trimmed lines of each document joined by blank lines, their number and the characters."""
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), strip), lambda x: x != "")
    joined = F.array_join(lines, "\n\n")
    return docs.select("doc_id", F.size(lines).alias("n_lines"), F.length(joined).alias("n_chars"), F.md5(joined).alias("digest"))


def table_blocks(pages: DataFrame) -> DataFrame:
    """Inner html of all paragraph blocks joined by blank lines."""
    blocks = F.filter(F.regexp_extract_all("html", F.lit("<p>([^<]*)</p>"), 1), lambda x: x != "")
    return pages.select("page_id", F.size(blocks).alias("n_blocks"), F.array_join(blocks, "\n\n").alias("blocks"))


def ordered_union(rows: DataFrame) -> DataFrame:
    """Distinct model ids in the order they are first seen: position, model_id."""
    first = rows.groupBy("source_model").agg(F.min(F.struct("page_id", "seq")).alias("at"))
    return first.select("source_model", F.row_number().over(Window.orderBy("at")).alias("position"))  # a handful of models
