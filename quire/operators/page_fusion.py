"""Fusion of a page's model outputs by rule, its transcript and quality counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEAST_CONFIDENCE = 0.50
LEGAL = "legal_notice_candidate"


def reading_rank(c: str = "reading_order") -> Column:
    """Reading order; null and 0 count as 9999."""
    return F.coalesce(F.nullif(F.col(c).cast("long"), F.lit(0)), F.lit(9999))


def kept_regions(regions: DataFrame) -> DataFrame:
    """Regions but texts of low confidence; other labels always stay."""
    return regions.filter(~(F.coalesce(F.col("label") == "text", F.lit(False)) & (F.col("confidence") < LEAST_CONFIDENCE)))


def fused_regions(regions: DataFrame) -> DataFrame:
    """Kept regions with fused_order from 1: by reading order, top, left, then model and region as emitted.

    regions (page_id, model_ord, region_ord, label, confidence, text, reading_order, x1, y1, ...).
    """
    order = Window.partitionBy("page_id").orderBy(reading_rank(), "y1", "x1", "model_ord", "region_ord")
    return kept_regions(regions).withColumn("fused_order", F.row_number().over(order))


def fused_pages(regions: DataFrame, outputs: DataFrame) -> DataFrame:
    """page_id, model_ids (as run), region_count, text_count, legal_count, transcript, disagreement of every page with an output.

    outputs (page_id, model_id, model_ord): the models that ran, with or without regions.  disagreement: max(0, regions - outputs) / max(1, regions).
    """
    models = outputs.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("model_ord", "model_id"))), lambda x: x["model_id"]).alias("model_ids"))
    text = F.when(F.coalesce("text", F.lit("")) != "", F.struct(reading_rank().alias("r"), "y1", "x1", "model_ord", "region_ord", "text"))
    kept = kept_regions(regions).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("region_count"),
        F.count_if(F.col("label") == "text").alias("text_count"),
        F.count_if(F.col("label") == LEGAL).alias("legal_count"),
        F.array_join(F.transform(F.array_sort(F.collect_list(text)), lambda x: x["text"]), "\n").alias("transcript"),
    )
    z = [F.coalesce(c, F.lit(0)).alias(c) for c in ("region_count", "text_count", "legal_count")]
    out = models.join(kept, "page_id", "left").select("page_id", "model_ids", *z, F.coalesce("transcript", F.lit("")).alias("transcript"))
    n = F.col("region_count")
    return out.withColumn("disagreement", F.round(F.greatest(F.lit(0), n - F.size("model_ids")) / F.greatest(F.lit(1), n), 6))
