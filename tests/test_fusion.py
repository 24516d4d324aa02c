import random

from pyspark.sql import functions as F

from quire.operators import fusion, grid, spatial, sweep
from quire.queries import layout
from quire.queries.base import boxes

SF = "/root/testdata/sf0.001"
BOX = "page_id string, seq int, source_family string, source_model string, norm_label string, x1 double, y1 double, x2 double, y2 double, score double, twins string"
LINE = "page_id string, line_ord int, x1 double, y1 double, x2 double, y2 double"


def fused(spark, rows, lines, w, h):
    """Corners and model of what stays of rows (label, corners, score[, family]) on one page."""
    b = spark.createDataFrame([("p", i, r[6] if len(r) > 6 else "f", r[6] if len(r) > 6 else "f", r[0], *map(float, r[1:5]), r[5], "") for i, r in enumerate(rows)], BOX)
    at = spark.createDataFrame([("p", i, *map(float, r)) for i, r in enumerate(lines)], LINE)
    sets = {"all": ("f", "g", "k")}
    got = fusion.select_boxes(fusion.prepared(b, at, w, h), sets, w, h).select("covered", "kept").collect()
    return [((k["x1"], k["y1"], k["x2"], k["y2"]), k["turn"]) for r in got for k in r["kept"]], [sorted(r["covered"]) for r in got]


def test_unsupported_strip_goes_and_large_text_shrinks_to_its_lines(spark):
    lines = [(100, 400 + 40 * i, 1900, 420 + 40 * i) for i in range(6)]
    got, covered = fused(spark, [("text", 0, 40, 2000, 160, 0.2), ("text", 80, 380, 1920, 900, 0.9)], lines, 2000, 3000)
    assert got == [((94, 394, 1906, 626), None)] and covered == [[0, 1, 2, 3, 4, 5]]


def test_giant_is_replaced(spark):
    lines = [(150, 900 + 35 * i, 2250, 920 + 35 * i) for i in range(20)]
    assert fused(spark, [("text", 50, 800, 2350, 3100, 0.4)], lines, 2400, 3200)[0] == [((144, 894, 2256, 1591), None)]


def test_a_box_of_another_family_supports(spark):
    strip, words = ("text", 0, 40, 2000, 160, 0.2), ("text", 200, 45, 900, 150, 0.1, "g")
    assert [t for _, t in fused(spark, [strip, words], [], 2000, 3000)[0]] == [1, 2]
    assert [t for _, t in fused(spark, [strip, (*words[:6], "f")], [], 2000, 3000)[0]] == [2]


def test_twins_empty_pages_and_missing_lines(spark):
    assert fused(spark, [], [(0, 0, 5, 5)], 100, 100) == ([], [])
    assert [b for b, _ in fused(spark, [("image", 0, 0, 50, 50, 0.9), ("image", 0, 0, 50, 50, None), ("image", 0, 0, 1, 50, 0.9)], [], 100, 100)[0]] == [(0, 0, 50, 50)]
    assert fused(spark, [("text", 0, 0, 90, 90, 0.9)], [], 100, 100)[0] == []


def test_a_twin_of_a_recovered_box_goes(spark):
    lines = [(100, 400 + 40 * i, 1900, 420 + 40 * i) for i in range(6)]
    got, _ = fused(spark, [("text", 80, 380, 1920, 900, 0.9), ("text", 94, 394, 1906, 626, 0.5), ("title", 94, 394, 1906, 626, 0.5)], lines, 2000, 3000)
    assert len(got) == 2 and got[0][1] is None


def test_lines_spread_over_the_parent_become_single_boxes(spark):
    got, _ = fused(spark, [("text", 0, 0, 1000, 1000, 0.4)], [(10, 100 * i + 5, 990, 100 * i + 25) for i in range(10)], 1000, 1000)
    assert len(got) == 10 and {t for _, t in got} == {None}


def test_no_boxes(spark):
    b = boxes(spark, SF).filter("false")
    lines = spark.createDataFrame([(1, 1, 0.0, 0.0, 1.0, 1.0)], "page_id long, line_ord int, x1 double, y1 double, x2 double, y2 double")
    assert fusion.fuse(b, lines, 2400, 3200).count() == 0
    assert fusion.measure(b, lines, 2400, 3200).count() == 0


def test_reading_order_and_no_python_in_the_plan(spark):
    got = layout.fused(spark, SF)
    rows = got.collect()
    for key in {(r["page_id"], r["variant"]) for r in rows}:
        own = sorted((r["reading_order"], r["y1"], r["x1"]) for r in rows if (r["page_id"], r["variant"]) == key)
        assert [o for o, _, _ in own] == list(range(1, len(own) + 1)) and [x[1:] for x in own] == sorted(x[1:] for x in own)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Python" in plan(df) or "Pandas" in plan(df) for df in (got, layout.fused_measures(spark, SF), layout.base_recall(spark, SF), layout.union_area_ratio(spark, SF)))


def test_pairs_of_the_grid_are_all_pairs_once(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        x, y = rng.uniform(-500, 1000), rng.uniform(0, 1000)
        w, h = (rng.choice([0, 3, 40, 900]) * rng.random() for _ in range(2))
        rows.append((i % 3 if i % 50 else None, i, x, y, x + w, y + h))
    rows += [(1, 400, 0.0, 0.0, float("nan"), 5.0), (1, 401, 5.0, 5.0, 2.0, 9.0), (1, 402, 10.0, 10.0, 20.0, 20.0), (1, 403, 20.0, 10.0, 30.0, 20.0), (1, 404, float("-inf"), 0.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "page long, seq int, x1 double, y1 double, x2 double, y2 double")
    meet = lambda a, b: max(a[2], b[2]) < min(a[4], b[4]) and max(a[3], b[3]) < min(a[5], b[5])
    sound = [r for r in rows if r[0] is not None and r[1] < 400]
    want = sorted((a[1], b[1]) for a in sound + rows[402:404] for b in sound + rows[402:404] if a[0] == b[0] and a[2] < a[4] and a[3] < a[5] and b[2] < b[4] and b[3] < b[5] and meet(a, b))
    for grids in (None, grid.fixed((70.0, 700.0))):
        assert sorted((r["a_seq"], r["b_seq"]) for r in grid.overlaps(df, df, ["page"], None, grids).collect()) == want


def test_a_page_of_many_boxes_tries_few_of_its_pairs(spark):
    n = 20_000
    at = spark.range(n).select(F.lit(7).alias("page_id"), (F.hash("id") % 2400).alias("x"), (F.hash(F.col("id") + n) % 3200).alias("y"), "id")
    df = at.select("page_id", F.lit("text").alias("norm_label"), F.col("id").cast("int").alias("seq"), F.when(F.col("id") % 100 == 0, "g").otherwise("f").alias("source_family"), *[F.abs(c).cast("double").alias(f"{c}1") for c in "xy"])
    df = df.withColumns({"x2": F.col("x1") + F.when(F.col("seq") % 500 == 0, 2000).otherwise(20), "y2": F.col("y1") + F.when(F.col("seq") % 500 == 0, 3000).otherwise(12)}).persist()
    assert grid.tried(df, df, ["page_id"]).first()["tried"] < 0.1 * n * n
    assert spatial.cross_source_support(df).count() == n
    df.unpersist()


def test_areas_of_unions_are_exact(spark):
    rng = random.Random(6)
    rows = [(k, t, *(x := rng.uniform(0, 9), y := rng.uniform(0, 9)), x + rng.choice([0, 0.25, 3]), y + rng.choice([0, 0.125, 4])) for k in ("a", "b", None) for t in (0, 1) for _ in range(12)]
    rows += [rows[0], ("flat", 0, 1.0, 1.0, 1.0, 2.0), ("none", 0, None, None, None, None)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "k string, t int, x1 double, y1 double, x2 double, y2 double, n int")
    got = sweep.union_areas(df, ["k"], {"zero": F.col("t") == 0, "every": F.lit(True)}, ("n",)).collect()
    assert {r["k"] for r in got} == {"a", "b", None, "flat", "none"} and {r["n"] for r in got} == {5}

    def area(own):
        xs, ys = (sorted({v for r in own for v in (r[a], r[a + 2])}) for a in (2, 3))
        inside = lambda x, y: any(r[2] <= x < r[4] and r[3] <= y < r[5] for r in own)
        return sum((b - a) * (d - c) for a, b in zip(xs, xs[1:]) for c, d in zip(ys, ys[1:]) if inside(a, c))

    for r in got:
        own = [x for x in rows if x[0] == r["k"] and x[2] is not None]
        assert abs(r["every"] - area(own)) < 1e-9 and abs(r["zero"] - area([x for x in own if x[1] == 0])) < 1e-9
