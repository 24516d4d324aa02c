"""Joins and measures of boxes on pages: support, line coverage, unions, recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import layout as L
from quire.operators.grid import XY, fixed, overlapping, overlaps, prefixed, solid  # noqa: F401
from quire.operators.sweep import on_raster, raster_size, raster_words, tasks_for, union_areas

CELL = 8.0
#: A grid of cells of one size, or None for cells after each page's boxes, which takes another pass over them.
Grid = dict[str, float] | None


def near(i: Column, a: Column, b: Column) -> Column:
    """Whether boxes of the areas a and b that share i support each other."""
    return (i / (a + b - i) >= 0.20) | (i / F.least(a, b) >= 0.60)


def cross_source_support(boxes: DataFrame, most: int = 3, grids: Grid = None) -> DataFrame:
    """page_id, seq, support: families (own included) with an overlapping box of the same label on the page, at most `most`.

    Pairs of one family say nothing new and go before any geometry; each other pair is tried once and counts for both.
    """
    rows = boxes.select("page_id", "norm_label", "seq", F.coalesce("source_family", F.lit("")).alias("family"), *XY)
    pairs = overlaps(rows, rows, ["page_id", "norm_label"], (F.col("a_seq") < F.col("b_seq")) & (F.col("a_family") != F.col("b_family")), grids)
    shared = pairs.withColumn("i", L.intersection("a_", "b_")).filter(near(F.col("i"), L.box_area("a_"), L.box_area("b_")))
    sides = F.array(*[F.struct(F.col(f"{p}seq").alias("seq"), F.col(f"{q}family").alias("family")) for p, q in (("a_", "b_"), ("b_", "a_"))])
    found = shared.select("page_id", F.explode(sides).alias("side")).groupBy("page_id", "side.seq").agg(F.size(F.collect_set("side.family")).alias("n"))
    return boxes.join(found, ["page_id", "seq"], "left").select("page_id", "seq", F.least(F.lit(most), 1 + F.coalesce("n", F.lit(0))).cast("int").alias("support"))


def _is_text() -> Column:
    return F.col("norm_label").isin("text", "title")


def _best_first() -> list[Column]:
    return [F.desc(F.coalesce("score", F.lit(0.0))), F.desc(L.box_area()), F.col("seq")]


def pseudo_lines(boxes: DataFrame, width: int, height: int, most: int = 120) -> DataFrame:
    """Text and title boxes shaped like lines, best first, one per quantized place, the first `most` of each page."""
    q = boxes.filter(_is_text()).filter(L.line_shaped(width, height)).select("*", *L.quantized(CELL))
    order = _best_first()
    first = q.withColumn("turn", F.row_number().over(Window.partitionBy("page_id", "qx1", "qy1", "qx2", "qy2").orderBy(*order))).filter("turn = 1")
    ranked = first.withColumn("line_ord", F.row_number().over(Window.partitionBy("page_id").orderBy(*order))).filter(F.col("line_ord") <= most)
    return ranked.select("page_id", "line_ord", "seq", *XY)


def line_places(boxes: DataFrame, width: int, height: int, most: int = 120) -> DataFrame:
    """The boxes with at, a number on their page, and line_ord, that of `pseudo_lines`, null for boxes that are none.

    For steps that need a page's lines beside its other boxes: the boxes are dealt out by page once, and everything after
    stays in that partition.
    """
    q = boxes.withColumn("fit", F.coalesce(_is_text() & L.line_shaped(width, height), F.lit(False))).select("*", *[F.when(F.col("fit"), q).alias(f"q{c}") for c, q in zip(XY, L.quantized(CELL), strict=True)])
    first = F.col("fit") & (F.row_number().over(Window.partitionBy("page_id", "fit", "qx1", "qy1", "qx2", "qy2").orderBy(*_best_first())) == 1)
    ranked = q.withColumn("first", first).withColumn("at", F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("first"), *_best_first())))
    return ranked.withColumn("line_ord", F.when(F.col("first") & (F.col("at") <= most), F.col("at"))).select(*boxes.columns, "at", "line_ord")


def line_coverage_by(boxes: DataFrame, by: Column, width: int, height: int) -> DataFrame:
    """`line_coverage` of the boxes' own lines by those boxes that meet a condition, from one pass over the boxes.

    A page has few lines, so that each covering box carries them all.
    """
    rows = line_places(boxes.withColumn("by", F.coalesce(by & solid(), F.lit(False))), width, height).filter("by or line_ord is not null")
    line = F.struct("line_ord", *[F.col(c).alias(f"a_{c}") for c in XY], F.lit(False).alias("own"))
    lines = F.collect_list(F.when(F.col("line_ord").isNotNull(), line)).over(Window.partitionBy("page_id"))
    own = F.array(line.withField("own", F.lit(True)))
    tried = F.concat(F.when(F.col("by") & F.col("page_id").isNotNull(), F.col("lines")).otherwise(F.slice("lines", 1, 0)), F.when(F.col("line_ord") != 0, own).otherwise(F.slice("lines", 1, 0)))
    pairs = rows.withColumn("lines", lines).select("page_id", *[F.col(c).alias(f"b_{c}") for c in XY], F.inline(tried)).filter(F.col("own") | overlapping("a_", "b_"))
    best = pairs.withColumn("cover", F.when(~F.col("own"), L.ioa("a_", "b_"))).groupBy("page_id", "line_ord").agg(F.max("cover").alias("best"), F.count_if(F.col("cover") >= 0.5).alias("covering"))
    return best.select("page_id", "line_ord", F.round(F.coalesce("best", F.lit(0.0)), 6).alias("best_coverage"), "covering")


def line_coverage(lines: DataFrame, boxes: DataFrame, grids: Grid = None) -> DataFrame:
    """Each line's best coverage by a box of its page, 0 without any, and the number of boxes that cover half of it."""
    pairs = overlaps(lines.select("page_id", "line_ord", *XY), boxes.select("page_id", *XY), ["page_id"], grids=grids).withColumn("cover", L.ioa("a_", "b_"))
    best = pairs.groupBy("page_id", F.col("a_line_ord").alias("line_ord")).agg(F.max("cover").alias("best"), F.count_if(F.col("cover") >= 0.5).alias("covering"))
    return lines.join(best, ["page_id", "line_ord"], "left").select("page_id", "line_ord", F.round(F.coalesce("best", F.lit(0.0)), 6).alias("best_coverage"), F.coalesce("covering", F.lit(0)).alias("covering"))


def covered_lines(boxes: DataFrame, lines: DataFrame, threshold: float = 0.5, grids: Grid = None) -> DataFrame:
    """page_id, a_line_ord, b_seq: the lines that a box of their page covers to the threshold."""
    pairs = overlaps(lines.select("page_id", "line_ord", *XY), boxes.select("page_id", "seq", *XY), ["page_id"], grids=grids)
    return pairs.filter(L.ioa("a_", "b_") >= threshold).select("page_id", "a_line_ord", "b_seq")


def line_hits(boxes: DataFrame, lines: DataFrame, threshold: float = 0.5, grids: Grid = None) -> DataFrame:
    """page_id, seq, hits: the page's lines that a box covers to the threshold."""
    hit = covered_lines(boxes, lines, threshold, grids).groupBy("page_id", F.col("b_seq").alias("seq")).agg(F.count(F.lit(1)).alias("hits"))
    return boxes.join(hit, ["page_id", "seq"], "left").select("page_id", "seq", F.coalesce("hits", F.lit(0)).alias("hits"))


def rated(boxes: DataFrame, width: int, height: int) -> DataFrame:
    """All boxes of a page (page_id and seq not null) with the hits of texts and titles and, where `fit_for_base` asks for it, their support; 0 and 1 elsewhere.

    One pass: each box carries its page's lines and those of its large texts and titles, which alone can be doubted for their
    support, so that the boxes are dealt out once and meet no others.  What is found is counted for either box of a pair.
    """
    text, share = _is_text(), L.box_area() / (width * height)
    known = boxes.filter("page_id is not null and seq is not null").withColumn("_sound", F.coalesce(solid() & ~L.degenerate(), F.lit(False)))
    doubted = F.col("_sound") & text & ((L.strip_shape(width, height) != "none") | (share >= 0.22))
    placed = line_places(known, width, height).withColumn("doubted", doubted).withColumn("family", F.coalesce("source_family", F.lit("")))
    own = F.struct(*boxes.columns)
    doubt = F.when(F.col("doubted"), F.struct(own.alias("box"), "family", "norm_label"))
    aim = F.struct(*[F.col(c).alias(f"a_{c}") for c in XY], (F.col("at") == 1).alias("first"), F.col("line_ord").isNotNull().alias("line"), doubt.alias("doubt"))
    aims = F.collect_list(F.when((F.col("at") == 1) | F.col("line_ord").isNotNull() | F.col("doubted"), aim)).over(Window.partitionBy("page_id"))
    pairs = placed.withColumn("aims", aims).select("page_id", own.alias("box"), "family", "norm_label", "_sound", text.alias("text"), *[F.col(c).alias(f"b_{c}") for c in XY], F.inline("aims"))
    near_enough = F.col("first") | F.col("_sound") & overlapping("a_", "b_")
    hit = F.col("_sound") & overlapping("a_", "b_") & F.col("text") & F.col("line") & (L.ioa("a_", "b_") >= 0.5)
    backs = F.col("_sound") & overlapping("a_", "b_") & (F.col("doubt.norm_label") == F.col("norm_label")) & (F.col("doubt.family") != F.col("family")) & near(L.intersection("a_", "b_"), L.box_area("a_"), L.box_area("b_"))
    found = pairs.filter(near_enough).withColumns({n: F.coalesce(c, F.lit(False)) for n, c in (("hit", hit), ("backs", backs))})
    mine = F.struct("box", F.col("hit").cast("int").alias("hit"), F.lit(None).cast("string").alias("family"))
    theirs = F.struct(F.col("doubt.box").alias("box"), F.lit(0).alias("hit"), "family")
    sides = F.when(~F.col("backs"), F.array(mine)).when(F.col("first") | F.col("hit"), F.array(mine, theirs)).otherwise(F.array(theirs))
    each = found.filter("first or hit or backs").select("page_id", F.inline(sides))
    n = each.groupBy("page_id", "box").agg(F.sum("hit").alias("hits"), F.count_distinct("family").alias("n"))
    return n.select("page_id", *[F.col("box")[c].alias(c) for c in boxes.columns if c != "page_id"], (1 + F.least(F.lit(2), "n")).cast("int").alias("support"), "hits")


def fit_for_base(width: int, height: int) -> Column:
    """Whether a rated box is fit to measure recall against: non-text ones; text ones that are no unsupported strip or weak giant and cover two lines."""
    bad = ((L.strip_shape(width, height) != "none") & (F.col("support") < 2)) | L.weak_giant(width, height, F.col("support")) | (F.col("hits") < 2)
    return ~L.degenerate() & (~_is_text() | ~bad)


def base_candidates(boxes: DataFrame, width: int, height: int) -> DataFrame:
    """Boxes fit to measure recall against, with their support and hits as `rated` has them."""
    return rated(boxes, width, height).filter(fit_for_base(width, height)).select(*boxes.columns, "support", "hits")


def rastered(boxes: DataFrame, width: int, height: int, *keep: str | Column) -> DataFrame:
    """The boxes' corners in cells of the page's raster, and the kept columns."""
    return boxes.select(*keep, *on_raster(*[F.col(c) for c in XY], width, height, CELL))


def union_cells(boxes: DataFrame, width: int, height: int) -> DataFrame:
    """page_id, cells, ratio: cells of the page's raster that its boxes touch; none for pages without any."""
    cells = union_areas(rastered(boxes, width, height, "page_id"), ["page_id"], tasks=tasks_for(boxes)).filter("area > 0")
    return cells.select("page_id", F.col("area").cast("long").alias("cells"), F.round(F.col("area") / raster_size(width, height, CELL), 6).alias("ratio"))


def shared_part(mine: Column, of: Column, both: Column) -> Column:
    """What a union shares with another, over the other: areas of both and of their common union; 0 if the other is empty."""
    return F.when(of > 0, (mine + of - both) / of).otherwise(0.0)


def base_recall(boxes: DataFrame, mine: Column, base: Column, width: int, height: int) -> DataFrame:
    """page_id, recall: cells that the boxes meeting `mine` share with those meeting `base` over the latter's, 0 for a base without cells; pages of either.

    A raster row's cells are bits of words, and what boxes touch together is their union by `or`: a row for each of a box's raster rows, none of them sorted.
    """
    flagged = boxes.select("*", *[F.coalesce(c, F.lit(False)).alias(n) for c, n in ((mine, "mine"), (base, "base"))]).filter("mine or base")
    words = raster_words(rastered(flagged, width, height, "page_id", "mine", "base"), width, CELL, "page_id", "mine", "base")
    masks = [c for c in words.columns if c.startswith("word")]
    rows = words.groupBy("page_id", "row").agg(*[F.coalesce(F.bit_or(F.when(F.col(p), F.col(c))), F.lit(0).cast("long")).alias(f"{p}_{c}") for c in masks for p in ("mine", "base")])
    bits = lambda parts: sum((F.bit_count(c) for c in parts), F.lit(0))
    both, of = bits(F.col(f"mine_{c}").bitwiseAND(F.col(f"base_{c}")) for c in masks), bits(F.col(f"base_{c}") for c in masks)
    cells = rows.groupBy("page_id").agg(F.sum(both).cast("double").alias("both"), F.sum(of).cast("double").alias("of"))
    return cells.select("page_id", F.round(F.when(F.col("of") > 0, F.col("both") / F.col("of")).otherwise(0.0), 6).alias("recall"))


def _last() -> Column:
    """The reading order, boxes without one (0 or null) last."""
    return F.coalesce(F.nullif(F.col("reading_order").cast("long"), F.lit(0)), F.lit(10**9))


def _fold(least_cover: float, least_iou: float) -> str:
    """SQL of a fold over items, best first: an item goes if a kept one covers least_cover of it or has least_iou with it.

    Items that only lie apart are told by comparing their ends.
    """
    inter = "greatest(0d, least(k.x2, b.x2) - greatest(k.x1, b.x1)) * greatest(0d, least(k.y2, b.y2) - greatest(k.y1, b.y1))"
    clash = f"exists(acc, k -> k.y1 < b.y2 and b.y1 < k.y2 and k.x1 < b.x2 and b.x1 < k.x2 and ({inter} >= {least_cover}D * b.area or {inter} >= {least_iou}D * (k.area + b.area - {inter})))"
    return f"aggregate(items, slice(items, 1, 0), (acc, b) -> if({clash}, acc, concat(acc, array(b))))"


def ocr_boxes(boxes: DataFrame) -> DataFrame:
    """The boxes to read: titles, small ones first, and texts, large ones first, without those that repeat kept ones; box_index numbers a page's boxes.

    Greedy selections page by page, by size, then score, then reading order: folds over each page's boxes inside the JVM; pages hold hundreds of boxes.
    boxes (page_id and seq, not null, norm_label, reading_order, score, corners); other columns ride along, so that no box has to be found again.
    """
    area, title = L.box_area(), F.col("norm_label") == "title"
    fit = boxes.filter("page_id is not null and seq is not null").filter(F.col("norm_label").isin("title", "text") & (area > 0))
    corners = [F.col(c).cast("double").alias(c) for c in XY]
    item = F.struct(F.when(title, area).otherwise(-area).alias("rank"), (-F.coalesce("score", F.lit(0.0))).alias("ns"), _last().alias("ro"), "seq", *corners, area.alias("area"), F.struct(*boxes.columns).alias("box"))
    pages = fit.groupBy("page_id", "norm_label").agg(F.sort_array(F.collect_list(item)).alias("items"))
    kept = F.when(title, F.expr(_fold(0.92, 0.85))).otherwise(F.expr(_fold(0.85, 0.75)))
    rows = pages.select("page_id", F.explode(kept).alias("kept")).select("page_id", *[F.col("kept.box")[c].alias(c) for c in boxes.columns if c != "page_id"]).select(*boxes.columns)
    number = F.row_number().over(Window.partitionBy("page_id").orderBy(_last(), "y1", "x1", F.col("norm_label").desc(), "seq"))
    return rows.withColumn("box_index", number)


def dedupe_quantized(rows: DataFrame, step: float, *keys: str) -> DataFrame:
    """The first row (by seq) of each page, keys and quantized place."""
    q = rows.select("*", *L.quantized(step))
    turn = F.row_number().over(Window.partitionBy("page_id", *keys, "qx1", "qy1", "qx2", "qy2").orderBy("seq"))
    return q.withColumn("turn", turn).filter("turn = 1").drop("turn", "qx1", "qy1", "qx2", "qy2")


def reading_order(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("reading_order", F.row_number().over(Window.partitionBy("page_id").orderBy("y1", "x1", "seq")))


def variant_members() -> dict[str, tuple[str, ...]]:
    """Variants and the models they fuse."""
    paddle = ("pld_v2", "pld_v3", "pld_plusL", "pvl15")
    return {"S1": ("pld_plusL",), "S2": ("dell",), "S3": ("mineru25",), "P1": paddle, "P2": (*paddle, "dell"), "P3": (*paddle, "mineru25"), "P4": (*paddle, "dell", "mineru25")}
