"""Page profiles from images: size, mean luma, share of dark pixels, complexity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans.routing import complexity

#: Longest side of the sample that the statistics are taken from.
SAMPLE_SIDE = 1024
DARK = 96
STATS = "path string, width int, height int, sample_width int, sample_height int, mean_luma double, dark_share double"


def gray(pixels: np.ndarray) -> np.ndarray:
    """Luma of blue-green-red pixels [..., 1, 3 or 4] in whole numbers."""
    if pixels.shape[-1] < 3:
        return pixels[..., 0]
    b, g, r = (pixels[..., i].astype(np.uint32) for i in range(3))
    return ((19595 * r + 38470 * g + 7471 * b + 0x8000) >> 16).astype(np.uint8)


def sampled(pixels: np.ndarray, side: int = SAMPLE_SIDE) -> np.ndarray:
    """Every pixel of small pictures, else those nearest to an even grid whose longer side is `side`."""
    h, w = pixels.shape[:2]
    scale = max(h, w) / side
    if scale <= 1:
        return pixels
    pick = lambda n: np.minimum(((np.arange(max(1, round(n / scale))) + 0.5) * n / max(1, round(n / scale))).astype(int), n - 1)
    return pixels[np.ix_(pick(h), pick(w))]


def image_stats(images: DataFrame) -> DataFrame:
    """Statistics of images as Spark's image source reads them (image struct), one picture at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, h, w, channels, data in zip(b["origin"], b["height"], b["width"], b["nChannels"], b["data"]):
                small = sampled(np.frombuffer(data, np.uint8).reshape(h, w, channels))
                luma = gray(small)
                rows.append((path, w, h, luma.shape[1], luma.shape[0], round(float(luma.mean()), 4), round(float((luma < DARK).mean()), 6)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in STATS.split(", ")])

    return images.select("image.*").mapInPandas(run, STATS)


def image_profiles(spark: SparkSession, pages: DataFrame, root: str) -> DataFrame:
    """Profiles of pages (page_id, image_path, checksum) whose images lie under root; a manifest's checksum is used as it is, others are computed."""
    stats = image_stats(spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", True).load(root))
    bare = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    own = pages.withColumn("key", bare(F.col("image_path")))
    sums = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(bare(F.col("path")).alias("key"), F.sha2("content", 256).alias("computed"))
    missing = own.filter(F.coalesce("checksum", F.lit("")) == "").select("key").distinct()
    rows = own.join(stats.withColumn("key", bare(F.col("path"))).drop("path"), "key").join(sums.join(missing, "key", "left_semi"), "key", "left")
    given = F.nullif("checksum", F.lit(""))
    return rows.select(
        "page_id", "width", "height", F.round(F.col("width") / F.greatest("height", F.lit(1)), 6).alias("aspect_ratio"), "mean_luma", "dark_share",
        complexity(F.col("dark_share"), F.col("height") / F.greatest("width", F.lit(1))).alias("complexity"),
        F.coalesce(given, "computed").alias("image_sha256"), F.when(given.isNotNull(), "manifest").otherwise("computed").alias("checksum_source"), "sample_width", "sample_height",
    )
