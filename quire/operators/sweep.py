"""Exact areas of unions of boxes, by a sweep over the distinct horizontal edges.

Between two neighbouring edges a box covers a strip whole or not at all.  In each strip the boxes' spans are read from left to
right, each adding what lies beyond the farthest right end so far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Boxes for each task of a sweep whose boxes are counted: their strips, some 16 a box on pages of text, are sorted there.
TASK_ROWS = 50_000


def union_areas(boxes: DataFrame, keys: list[str], parts: dict[str, Column] | None = None, carry: tuple[str, ...] = (), tasks: int | None = None) -> DataFrame:
    """keys, an area for each of `parts` (conditions on the boxes that it unites; all boxes, if none are named), and the carried columns, which are constant within a key.

    Equal boxes of a key are one row, whichever parts they belong to, so the sweep grows with the places on a page and not with
    the parts that hold them.  One shuffle by the keys; edges, strips and spans follow within partitions.  Boxes without an extent cover nothing, and a
    key that has only such boxes has areas of 0.  Rows without corners carry their key and columns.

    tasks: how many the keys are dealt out to, as `tasks_for` says; by default the session's number of shuffle partitions.
    """
    parts = parts or {"area": F.lit(True)}
    solid = F.coalesce((F.col("x1") < F.col("x2")) & (F.col("y1") < F.col("y2")), F.lit(False))
    of = Window.partitionBy(*keys)
    corners, flags = ("x1", "y1", "x2", "y2"), {f"in_{name}": condition for name, condition in parts.items()}
    each = boxes.select(*keys, *carry, *[F.when(solid, F.col(c)).alias(c) for c in corners], *[condition.alias(name) for name, condition in flags.items()])
    each = each.repartition(tasks, *keys) if tasks else each
    rows = each.groupBy(*keys, *corners).agg(*[F.max(c).alias(c) for c in carry], *[F.bool_or(name).alias(name) for name in flags])
    edges = F.array_sort(F.array_distinct(F.concat(F.collect_set("y1").over(of), F.collect_set("y2").over(of))))
    edged = rows.withColumn("edges", edges).withColumn("first", F.array_position("edges", F.col("y1")))
    strips = F.when(F.col("first") > 0, F.sequence("first", F.array_position("edges", F.col("y2")) - 1))
    cut = edged.withColumn("strip", F.explode_outer(strips))
    height = F.try_element_at("edges", (F.col("strip") + 1).cast("int")) - F.try_element_at("edges", F.col("strip").cast("int"))
    cut = cut.withColumn("height", height).drop("edges", "first", "y1", "y2")
    so_far = Window.partitionBy(*keys, "strip").orderBy("x1", "x2").rowsBetween(Window.unboundedPreceding, -1)
    beyond = []
    for name in parts:
        mine = F.col(f"in_{name}")
        reached = F.max(F.when(mine, F.col("x2"))).over(so_far)
        beyond.append(F.when(mine, F.greatest(F.lit(0.0), F.col("x2") - F.greatest("x1", F.coalesce(reached, F.col("x1")))) * F.col("height")).alias(f"adds_{name}"))
    added = cut.select(*keys, *carry, *beyond)
    areas = [F.coalesce(F.sum(f"adds_{name}"), F.lit(0.0)).alias(name) for name in parts]
    return added.groupBy(*keys).agg(*areas, *[F.max(c).alias(c) for c in carry])


def tasks_for(boxes: DataFrame) -> int:
    """Tasks that sweep TASK_ROWS boxes each, so that they grow in number and not in size; counts the boxes, for inputs that are cheap to read twice."""
    return max(boxes.count() // TASK_ROWS + 1, boxes.sparkSession.sparkContext.defaultParallelism)


def on_raster(x1: Column, y1: Column, x2: Column, y2: Column, width: int, height: int, cell: float) -> list[Column]:
    """Corners in cells of the page's raster, of all cells that a box touches; cells outside the page are cut off."""
    wide, high = max(1, -(-width // int(cell))), max(1, -(-height // int(cell)))
    cut = lambda c, top: F.greatest(F.lit(0.0), F.least(F.lit(float(top)), c.cast("double")))
    return [cut(F.floor(x1 / cell), wide).alias("x1"), cut(F.floor(y1 / cell), high).alias("y1"), cut(F.ceil(x2 / cell), wide).alias("x2"), cut(F.ceil(y2 / cell), high).alias("y2")]


def raster_words(boxes: DataFrame, width: int, cell: float, *keep: str) -> DataFrame:
    """The kept columns, row, word0, word1, ...: for each row of the raster that a box (corners as `on_raster` has them) touches, its cells there as bits of 64.

    Boxes that touch no cell are one row without any.
    """
    ends, words = boxes.select(*keep, *[F.col(c).cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")]), []
    for i in range(-(-max(1, -(-width // int(cell))) // 64)):
        low, high = F.greatest(F.lit(0), F.col("x1") - 64 * i), F.least(F.lit(64), F.col("x2") - 64 * i)
        ones = F.lit(-1).cast("long")
        words.append(F.when((low < high) & (F.col("y1") < F.col("y2")), F.call_function("shiftleft", ones, low).bitwiseAND(F.call_function("shiftrightunsigned", ones, 64 - high))).otherwise(F.lit(0).cast("long")).alias(f"word{i}"))
    rows = F.when((F.col("x1") < F.col("x2")) & (F.col("y1") < F.col("y2")), F.sequence("y1", F.col("y2") - 1))
    return ends.select(*keep, *words, F.explode_outer(rows).alias("row"))


def raster_size(width: int, height: int, cell: float) -> int:
    return max(1, -(-width // int(cell))) * max(1, -(-height // int(cell)))
