"""Column expressions for page-layout boxes: labels, families, geometry, tokens and coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label words by class, tested as substrings in this order.
TEXT_WORDS = "text|article|paragraph|content|reference|number|footnote|caption"
TITLE_WORDS = "title|header|headline|masthead|author"
TABLE_WORDS = "table"
IMAGE_WORDS = "image|figure|photo|advert|cartoon|logo|picture"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_label(raw: Column) -> Column:
    """text, title, table, image or other: the first class one of whose words the label holds, in any case.

    The words are sought in the label as it is: only A to Z have a lower case that the words hold.
    """
    has = lambda words: F.coalesce(raw, F.lit("")).rlike(f"(?i){words}")
    return F.when(has(TEXT_WORDS), "text").when(has(TITLE_WORDS), "title").when(has(TABLE_WORDS), "table").when(has(IMAGE_WORDS), "image").otherwise("other")


def label_of(raw) -> str:
    """normalize_label of one value, for workers."""
    x = str(raw or "").strip().lower()
    for words, name in ((TEXT_WORDS, "text"), (TITLE_WORDS, "title"), (TABLE_WORDS, "table"), (IMAGE_WORDS, "image")):
        if any(w in x for w in words.split("|")):
            return name
    return "other"


def source_family(family: Column, model: Column) -> Column:
    """The given family, else that of the model's prefix, else the model itself."""
    given = F.nullif(F.coalesce(family, F.lit("")), F.lit(""))
    return F.coalesce(given, F.when(model.rlike("^(pld_|pvl15)"), "paddle").when(model.startswith("dell"), "dell").when(model.startswith("miner"), "mineru").otherwise(model))


def area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.greatest(F.lit(0.0), x2 - x1) * F.greatest(F.lit(0.0), y2 - y1)


def box_area(p: str = "") -> Column:
    return area(*(F.col(p + c) for c in ("x1", "y1", "x2", "y2")))


def intersection(a: str, b: str) -> Column:
    """Shared area of two boxes whose columns carry the prefixes a and b."""
    side = lambda c: F.greatest(F.lit(0.0), F.least(F.col(f"{a}{c}2"), F.col(f"{b}{c}2")) - F.greatest(F.col(f"{a}{c}1"), F.col(f"{b}{c}1")))
    return side("x") * side("y")


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def iou(a: str, b: str) -> Column:
    i = intersection(a, b)
    return ratio(i, box_area(a) + box_area(b) - i)


def ioa(a: str, b: str) -> Column:
    """Shared area over the area of a."""
    return ratio(intersection(a, b), box_area(a))


def degenerate() -> Column:
    return (F.col("x2") - F.col("x1") <= 1) | (F.col("y2") - F.col("y1") <= 1)


def strip_shape(width: float, height: float) -> Column:
    """wide, tall or none."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return F.when((w >= 0.65 * width) & (h <= 0.06 * height), "wide").when((h >= 0.65 * height) & (w <= 0.06 * width), "tall").otherwise("none")


def large(width: float, height: float) -> Column:
    return (box_area() >= 0.08 * width * height) | (strip_shape(width, height) != "none")


def weak_giant(width: float, height: float, support: Column) -> Column:
    share = box_area() / (width * height)
    return ((share >= 0.22) & (support < 2) & (F.coalesce("score", F.lit(0.0)) < 0.75)) | ((share >= 0.30) & (support < 3))


def line_shaped(width: float, height: float) -> Column:
    """Boxes that can serve as pseudo-lines."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return ~degenerate() & (box_area() <= 0.08 * width * height) & ~((w >= 0.90 * width) & (h <= 0.06 * height)) & ~((h >= 0.90 * height) & (w <= 0.06 * width))


def clamped(width: Column, height: Column, pad: float = 0.0) -> Column:
    """The box x1..y2, grown by pad and cut to the page, as a struct; all zeros if nothing is left."""
    x1, y1 = F.least(width, F.greatest(F.lit(0.0), F.col("x1") - pad)), F.least(height, F.greatest(F.lit(0.0), F.col("y1") - pad))
    x2, y2 = F.least(width, F.greatest(F.lit(0.0), F.col("x2") + pad)), F.least(height, F.greatest(F.lit(0.0), F.col("y2") + pad))
    some = (x2 > x1) & (y2 > y1)
    return F.struct(*[F.when(some, c).otherwise(0.0).alias(n) for c, n in ((x1, "x1"), (y1, "y1"), (x2, "x2"), (y2, "y2"))])


def unletterboxed(dw: Column, dh: Column, ratio_x: Column, ratio_y: Column) -> list[Column]:
    """Corners x1..y2 of a box found on a letterboxed picture, in the page's own pixels."""
    out = ((F.col("x1") - dw) / ratio_x, (F.col("y1") - dh) / ratio_y, (F.col("x2") - dw) / ratio_x, (F.col("y2") - dh) / ratio_y)
    return [c.alias(n) for c, n in zip(out, ("x1", "y1", "x2", "y2"), strict=True)]


def page_box(box: Column, width: Column, height: Column) -> Column:
    """Four numbers as corners on the page: width and height where they are no corners, shares of the page where all are small; cut to the page, null if empty."""
    inverted = ((box[2] <= box[0]) | (box[3] <= box[1])) & (box[2] > 0) & (box[3] > 0)
    corners = F.when(inverted, F.array(box[0], box[1], box[0] + box[2], box[1] + box[3])).otherwise(box)
    small = (F.array_max(corners) <= 1.5) & (F.array_min(corners) >= -0.1)
    scaled = F.when(small, F.array(corners[0] * width, corners[1] * height, corners[2] * width, corners[3] * height)).otherwise(corners)
    cut = lambda c, top: F.greatest(F.lit(0.0), F.least(top.cast("double"), c))
    out = F.struct(cut(scaled[0], width).alias("x1"), cut(scaled[1], height).alias("y1"), cut(scaled[2], width).alias("x2"), cut(scaled[3], height).alias("y2"))
    return F.when((out["x2"] > out["x1"]) & (out["y2"] > out["y1"]), out)


def crop_box(width: int, height: int, pad: int = 2) -> Column:
    """Whole-pixel crop with padding inside the page; null below 24 x 18."""
    x1, y1 = F.greatest(F.lit(0), F.floor("x1").cast("int") - pad), F.greatest(F.lit(0), F.floor("y1").cast("int") - pad)
    x2, y2 = F.least(F.lit(width), F.ceil("x2").cast("int") + pad), F.least(F.lit(height), F.ceil("y2").cast("int") + pad)
    return F.when((x2 - x1 >= 24) & (y2 - y1 >= 18), F.struct(x1.alias("cx1"), y1.alias("cy1"), x2.alias("cx2"), y2.alias("cy2")))


def quantized(step: float) -> list[Column]:
    """Coordinates over step, rounded half to even."""
    return [F.rint(F.col(c) / step).cast("long").alias(f"q{c}") for c in ("x1", "y1", "x2", "y2")]


def portable_id(c: Column) -> Column:
    return c.rlike(r"\A[A-Za-z0-9][A-Za-z0-9._-]{0,254}\z") & ~c.contains("..")


def safe_token(c: Column) -> Column:
    token = F.lower(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))
    return F.coalesce(F.nullif(token, F.lit("")), F.lit("unknown"))
