"""Layout inputs derived from the star schema: detected boxes from line items, timing rows and plans from events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.operators.sweep import tasks_for

WIDTH, HEIGHT = 2400, 3200
MODELS = ("baseline_geometry_v1", "column_detector_v1", "legal_notice_probe_v1")
FAMILIES = ("profile", "layout", "text_probe")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the star schema.  The JVM leaves methods above 8,000 bytes uncompiled, so plans that would need longer ones run operator by operator."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(at, values) -> F.Column:
    """The value at a position counted from 0."""
    return F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))


def boxes(spark: SparkSession, sf_dir: str, counted: bool = False) -> DataFrame:
    """One detection per line item, 64 true blocks a page, six models in three families; with giants, strips and degenerate boxes.

    Only the table's own columns go through the shuffle; what follows from them is made after.  counted: line items are counted first and
    pages dealt out to tasks that grow in number and not in size, for queries that do all their work where the pages lie.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("q"))
    page = F.floor(F.col("l_orderkey") / 64).cast("long")
    order = Window.partitionBy("page_id").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    g = li.select(page.alias("page_id"), "*")
    g = g.repartition(tasks_for(li), "page_id") if counted else g
    g = g.withColumn("seq", F.row_number().over(order))
    h = F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729 + F.col("l_linenumber") * 1299709
    g = g.select("page_id", "seq", "q", (F.col("l_orderkey") % 64).alias("k"), h.alias("h"))
    k, h, q = F.col("k"), F.col("h"), F.col("q")
    col, row = (k % 4) * 600, F.floor(k / 4) * 198
    by_quantity = lambda first, *pairs: [first := first.when(F.col("q") == v, e) for v, e in pairs][-1]
    giant = lambda e: F.when(q >= 50, e)
    return g.select(
        "page_id",
        "seq",
        "k",
        F.when(h % 6 == 4, "dell").when(h % 6 == 5, "mineru").otherwise("paddle").alias("source_family"),
        pick(h % 6, ("pld_v2", "pld_v3", "pld_plusL", "pvl15", "dell", "mineru25")).alias("source_model"),
        F.when(k % 16 == 0, "headline").when(k % 16 == 1, "photograph").when(k % 16 == 2, "table").when(h % 2 == 0, "article").otherwise("paragraph").alias("source_label"),
        by_quantity(giant(F.lit(50)), (1, F.lit(0)), (2, 20 + col)).otherwise(20 + col + (h % 7) * 3).cast("double").alias("x1"),
        by_quantity(giant(100 + (h % 5) * 8), (1, 10 + row), (2, F.lit(10))).otherwise(10 + row + (h % 5) * 3).cast("double").alias("y1"),
        by_quantity(giant(F.lit(2350)), (1, F.lit(2400)), (2, 100 + col), (3, 20 + col)).otherwise(560 + col - (h % 4) * 8).cast("double").alias("x2"),
        by_quantity(giant(F.lit(2600)), (1, 70 + row), (2, F.lit(3190))).otherwise(180 + row - (h % 3) * 6).cast("double").alias("y2"),
        ((h % 128).cast("double") / 128).alias("score"),
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timing rows: page, stage, model and family (of adapter rows), seconds as text with unreadable ones, status, resource class, complexity."""
    e = table(spark, sf_dir, "events")
    k, kind, i = F.regexp_extract("props", "([0-9]+)", 1).cast("long"), F.col("event_type"), F.col("event_id")
    adapter = kind.isin("click", "error", "signup")
    seconds = F.when(i % 211 == 0, "n/a").when(i % 223 == 0, "-1").when(i % 227 == 0, "NaN").when(i % 229 == 0, "").otherwise(F.col("value").cast("string"))
    return e.select(
        i.alias("ord"),
        F.col("user_id").alias("page_id"),
        F.when(kind == "view", "page_profile").when(kind == "purchase", "page_total").otherwise("model_adapter").alias("stage"),
        F.when(adapter, pick(k % 3, MODELS)).otherwise("").alias("model_id"),
        F.when(kind == "view", "profiler").when(kind == "purchase", "orchestration").otherwise(pick(k % 3, FAMILIES)).alias("family"),
        seconds.alias("seconds"),
        F.when(kind == "error", "error").when(k % 11 == 0, "skipped").otherwise("ok").alias("status"),
        F.when(k % 2 == 0, "cpu").otherwise("gpu").alias("resource_class"),
        F.when(F.col("value") > 50, "hard").when(F.col("value") > 20, "medium").otherwise("easy").alias("complexity"),
    )


def planned_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, model_id): every page of the events with every model, less a fixed fifth."""
    pages = table(spark, sf_dir, "events").select(F.col("user_id").alias("page_id")).distinct()
    every = pages.select("page_id", F.explode(F.array(*map(F.lit, MODELS))).alias("model_id"))
    return every.filter((F.col("page_id") + F.length("model_id")) % 5 != 0)
