"""Steps that deal the boxes out by page once, against the general operators and plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import layout as L
from quire.operators import ocr, spatial, sweep
from quire.queries import registry

SF = "/root/testdata/sf0.001"
W, H = 2400, 3200


@pytest.fixture(scope="module")
def boxes(spark):
    """Three pages and one without a key: blocks, strips, giants, flat and endless boxes of few families."""
    rng, rows = random.Random(8), []
    for i in range(400):
        x, y = rng.randrange(0, 2000, 7), rng.randrange(0, 3000, 5)
        w, h = rng.choice([(300, 80), (300, 80), (900, 300), (1700, 60), (100, 2200), (2000, 2000), (1, 50), (0, 0)])
        rows.append((i % 3 if i % 40 else None, i, rng.choice(["text", "text", "title", "table"]), rng.choice(["a", "b", "c", "d", None]), rng.choice([0.1, 0.5, 0.9, None]), rng.choice([None, 0, i % 30]), float(x), float(y), float(x + w), float(y + h)))
    rows += [(1, 400, "text", "a", 0.5, 1, 0.0, 0.0, float("inf"), 9.0), (1, 401, "text", "b", 0.5, 1, 0.0, 0.0, 90.0, None), (4, 402, "text", "b", 0.5, 1, 0.0, 0.0, 90.0, 40.0)]
    df = spark.createDataFrame(rows, "page_id long, seq int, norm_label string, source_family string, score double, reading_order int, x1 double, y1 double, x2 double, y2 double").persist()
    yield df
    df.unpersist()


@pytest.mark.parametrize("name", ["base_candidates", "base_recall", "line_best_coverage", "transcription_report", "ocr_box_selection"])
def test_the_table_is_read_and_dealt_out_once(spark, name):
    df = registry.queries()[name](spark, SF)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["base_candidates", "base_recall", "line_best_coverage", "transcription_report", "ocr_box_selection"])
def test_tasks_grow_in_number(spark, monkeypatch, name):
    monkeypatch.setattr(sweep, "TASK_ROWS", 500)
    tasks = spark.read.parquet(f"{SF}/lineitem.parquet").count() // 500 + 1
    text = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert f", {tasks})" in text and text.count("Exchange hashpartitioning(page_id") == 1


def test_support_and_hits_of_rated_boxes(boxes):
    got = {r["seq"]: r for r in spatial.rated(boxes, W, H).collect()}
    assert set(got) == {r["seq"] for r in boxes.filter("page_id is not null").collect()}
    sound = boxes.filter(~L.degenerate())
    support = {r["seq"]: r["support"] for r in spatial.cross_source_support(sound).filter("page_id is not null").collect()}
    hits = {r["seq"]: r["hits"] for r in spatial.line_hits(sound, spatial.pseudo_lines(boxes, W, H)).filter("page_id is not null").collect()}
    share = L.box_area() / (W * H)
    doubted = sound.filter(F.col("norm_label").isin("text", "title") & ((L.strip_shape(W, H) != "none") | (share >= 0.22))).filter("page_id is not null and x2 < double('inf')")
    asked = [r["seq"] for r in doubted.collect()]
    assert len(asked) > 40 and {support[s] for s in asked} == {1, 2, 3}
    assert all(got[s]["support"] == support[s] for s in asked)
    texts = [r["seq"] for r in sound.filter("norm_label in ('text', 'title') and page_id is not null").collect()]
    assert all(got[s]["hits"] == hits[s] for s in texts) and max(hits.values()) > 5
    bad = ((L.strip_shape(W, H) != "none") & (F.col("support") < 2)) | L.weak_giant(W, H, F.col("support")) | (F.col("hits") < 2)
    whole = sound.join(spatial.cross_source_support(sound), ["page_id", "seq"]).join(spatial.line_hits(sound, spatial.pseudo_lines(boxes, W, H)), ["page_id", "seq"])
    want = whole.filter(~F.col("norm_label").isin("text", "title") | ~bad)
    assert sorted(r["seq"] for r in spatial.base_candidates(boxes, W, H).collect()) == sorted(r["seq"] for r in want.collect())


@pytest.mark.parametrize("size", [(2400, 3200), (505, 40), (9, 3200)])
def test_recall_on_the_raster_is_that_of_cells(spark, size):
    rng = random.Random(5)
    rows = [(i % 3, i % 2 == 0, rng.random() < 0.5, x := rng.uniform(-50, 600), y := rng.uniform(-50, 100), x + rng.choice([0.0, 30.0, 500.0, 3000.0]), y + rng.choice([0.0, 9.0, 70.0])) for i in range(60)]
    rows += [(7, True, False, 1.0, 1.0, 30.0, 30.0), (8, True, True, -9.0, -9.0, -1.0, -1.0), (9, False, False, 1.0, 1.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "page_id long, m boolean, b boolean, x1 double, y1 double, x2 double, y2 double")
    got = {r["page_id"]: r["recall"] for r in spatial.base_recall(df, F.col("m"), F.col("b"), *size).collect()}
    wide, high = (-(-n // 8) for n in size)

    def cells(own):
        span = lambda a, b, top: range(int(max(0, min(top, a // 8))), int(max(0, min(top, -(-b // 8)))))
        return {(x, y) for r in own for x in span(r[3], r[5], wide) for y in span(r[4], r[6], high)}

    assert set(got) == {0, 1, 2, 7, 8}
    for k, v in got.items():
        mine, base = cells([r for r in rows if r[0] == k and r[1]]), cells([r for r in rows if r[0] == k and r[2]])
        assert v == (round(len(mine & base) / len(base), 6) if base else 0.0)


def test_coverage_of_lines_by_boxes_among_them(boxes):
    by = (F.col("source_family") == "a") & ~L.degenerate()
    want = spatial.line_coverage(spatial.pseudo_lines(boxes, W, H), boxes.filter(by)).collect()
    got = spatial.line_coverage_by(boxes, by, W, H).collect()
    key = lambda r: (r["page_id"] is None, r["page_id"], r["line_ord"], r["best_coverage"], r["covering"])
    assert sorted(map(key, got)) == sorted(map(key, want)) and {r["best_coverage"] for r in got} > {0.0, 1.0}


def test_boxes_to_read_are_those_of_a_plain_loop(boxes):
    sound = boxes.filter(~L.degenerate() & F.col("y2").isNotNull())
    got = spatial.ocr_boxes(sound.withColumn("more", F.col("seq") * 2)).collect()
    assert all(r["more"] == 2 * r["seq"] for r in got)
    area, both = lambda r: (r["x2"] - r["x1"]) * (r["y2"] - r["y1"]), lambda a, b: max(0.0, min(a["x2"], b["x2"]) - max(a["x1"], b["x1"])) * max(0.0, min(a["y2"], b["y2"]) - max(a["y1"], b["y1"]))
    last, rows = lambda r: r["reading_order"] or 10**9, [r for r in sound.collect() if r["page_id"] is not None]
    for page in {r["page_id"] for r in rows}:
        kept = []
        for label, sign, cover, iou in (("title", 1, 0.92, 0.85), ("text", -1, 0.85, 0.75)):
            own = []
            for b in sorted((r for r in rows if (r["page_id"], r["norm_label"]) == (page, label)), key=lambda r: (sign * area(r), -(r["score"] or 0.0), last(r), r["seq"])):
                if not any(both(k, b) >= cover * area(b) or both(k, b) >= iou * (area(k) + area(b) - both(k, b)) for k in own):
                    own.append(b)
            kept += own
        want = sorted(kept, key=lambda r: (last(r), r["y1"], r["x1"], r["norm_label"] != "title", r["seq"]))
        assert [r["seq"] for r in sorted((g for g in got if g["page_id"] == page), key=lambda r: r["box_index"])] == [r["seq"] for r in want]


def test_a_report_of_boxes_that_carry_their_lines(spark, boxes):
    own = boxes.filter("page_id is not null and y2 is not null").withColumn("box_index", F.when(F.col("seq") % 3 != 1, F.col("seq")))
    own = own.withColumns({"has_image": F.lit(True), "has_fused": F.col("page_id") != 2, "fused": F.col("norm_label") == "text", "reading_order": F.when(F.col("box_index").isNotNull(), F.col("reading_order"))})
    line = lambda i: F.struct(i.alias("line"), F.when(i % 3 != 1, F.concat(F.lit(" l "), i.cast("string"))).alias("text"), (i * 9.0).alias("x1"), (50.0 - i * 20).alias("y1"), (i * 9.0 + F.col("seq") % 4 * 200).alias("x2"), (70.0 - i * 20).alias("y2"))
    heard = own.withColumn("heard", F.when(F.col("box_index").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("seq") % 4), line)))
    pages, read = own.select("page_id", "has_image", "has_fused").distinct(), own.filter("box_index is not null")
    lines = ocr.on_page(heard.filter("box_index is not null").select("page_id", "box_index", F.inline("heard")), ocr.crops(read, W, H))
    want, got = ocr.transcription_report(pages, own.filter("fused"), read, lines).collect(), ocr.heard_report(heard, W, H).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and any(r["transcript_chars"] > 20 for r in got)


def test_labels_in_any_case(spark):
    labels = ["Text", " \tPHOTO ", "ARTİCLE", "TıTLE", "maſthead", "Table of Content", "ta ble", "", None, "x\nFIGURE", "Headline"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(labels)], "i int, raw string")
    assert [r["n"] for r in df.select("i", L.normalize_label(F.col("raw")).alias("n")).orderBy("i").collect()] == [L.label_of(v) for v in labels]
