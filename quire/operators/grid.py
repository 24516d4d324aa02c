"""Overlap joins of boxes by a grid of cells, so that a page's boxes meet neighbours instead of each other.

The cells of a key (a page, or a page and label) are about as large as its boxes, and at most about as many.  A box is
copied to every cell that it touches, boxes meet in cells, and a pair that meets in several is kept where the overlap's first
corner lies.  A page with many boxes is spread over its cells, so no task gets a page's square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

XY = ("x1", "y1", "x2", "y2")


def prefixed(df: DataFrame, p: str, *keep: str) -> DataFrame:
    return df.select(*keep, *[F.col(c).alias(p + c) for c in df.columns if c not in keep])


def overlapping(a: str, b: str) -> Column:
    """Four comparisons that spare most pairs the arithmetic, those by height first: pages have more rows than columns."""
    less = [F.col(f"{p}{c}1") < F.col(f"{q}{c}2") for c in "yx" for p, q in ((a, b), (b, a))]
    return less[0] & less[1] & less[2] & less[3]


def solid() -> Column:
    """Whether a box can overlap with anything: finite and with an extent."""
    top = float("inf")
    return (F.col("x1") < F.col("x2")) & (F.col("y1") < F.col("y2")) & (F.col("x2") < top) & (F.col("y2") < top) & (F.col("x1") > -top) & (F.col("y1") > -top)


def _solid(boxes: DataFrame) -> DataFrame:
    return boxes.filter(solid())


def fixed(size: tuple[float, float]) -> dict[str, float]:
    """A grid of cells of one size, for callers that know about how large boxes are: it spares a pass over the boxes."""
    return {f"size_{c}": float(n) for c, n in zip("xy", size, strict=True)}


def _grids(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, and for either axis the cells' size and the first and last cell with boxes: one row a key."""
    out, n = [], F.sqrt(F.count(F.lit(1)))
    for c in "xy":
        extent = F.max(f"{c}2") - F.min(f"{c}1")
        out += [F.greatest(F.avg(F.col(f"{c}2") - F.col(f"{c}1")), extent / n).alias(f"size_{c}"), F.min(f"{c}1").alias(f"low_{c}"), F.max(f"{c}2").alias(f"high_{c}")]
    return boxes.groupBy(*keys).agg(*out)


def _in_cells(boxes: DataFrame, grids: DataFrame | dict[str, float], keys: list[str]) -> DataFrame:
    """A row for each cell that a box touches, cells beyond the grid's own boxes left out."""
    if isinstance(grids, dict):
        out = boxes.withColumns({c: F.lit(n) for c, n in grids.items()})
        ends = {c: (F.col(f"{c}1"), F.col(f"{c}2")) for c in "xy"}
    else:
        out = boxes.join(grids, keys).filter("x1 < high_x and x2 > low_x and y1 < high_y and y2 > low_y")
        ends = {c: (F.greatest(f"{c}1", f"low_{c}"), F.least(f"{c}2", f"high_{c}")) for c in "xy"}
    for c in "xy":
        out = out.withColumn(f"cell_{c}", F.explode(F.sequence(*[F.floor(v / F.col(f"size_{c}")) for v in ends[c]])))
    return out.drop("low_x", "low_y", "high_x", "high_y")


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], on: Column | None = None, grids: dict[str, float] | None = None) -> DataFrame:
    """keys, then a_ and b_ columns: every pair of a left and a right box of equal keys whose insides share a point, once.

    `on` (of a_ and b_ columns) is tested before any geometry.  Boxes have corners x1..y2; other columns ride along.
    grids: None for cells after each key's boxes, else `fixed`.
    """
    at = ["cell_x", "cell_y"]
    grids = _grids(_solid(right), keys) if grids is None else grids
    a, b = (prefixed(_in_cells(_solid(d), grids, keys), p, *keys, *at) for d, p in ((left, "a_"), (right, "b_")))
    pairs = a.join(b, [*keys, *at])
    pairs = pairs if on is None else pairs.filter(on)
    for c in "xy":
        corner = F.greatest(f"a_{c}1", f"b_{c}1")
        pairs = pairs.filter(F.floor(corner / F.col(f"a_size_{c}")) == F.col(f"cell_{c}"))
    return pairs.filter(overlapping("a_", "b_")).drop(*at, *[f"{p}size_{c}" for p in ("a_", "b_") for c in "xy"])


def tried(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys, tried: the pairs that meet in cells, before any test."""
    at = [*keys, "cell_x", "cell_y"]
    grids = _grids(_solid(right), keys)
    a, b = (_in_cells(_solid(d), grids, keys).groupBy(*at).agg(F.count(F.lit(1)).alias(n)) for d, n in ((left, "n"), (right, "m")))
    return a.join(b, at).groupBy(*keys).agg(F.sum(F.col("n") * F.col("m")).alias("tried"))
