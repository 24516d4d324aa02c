"""Costly values are worked out once a row, and costly tables once a query: told from optimized plans, at no cost of a run."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import fusion, spatial, sweep
from quire.queries import registry

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["paddle_records", "external_records"])
def test_a_record_is_parsed_once(spark, name):
    assert plan(registry.queries()[name](spark, SF)).lower().count("parse_json") + plan(registry.queries()[name](spark, SF)).lower().count("parsejson") == 1


@pytest.mark.parametrize("name", ["valid_regions", "region_issues"])
def test_corners_of_regions_are_made_once(spark, name):
    assert plan(registry.queries()[name](spark, SF)).count("wide") == 2  # once for three corners, once for four


def test_review_reads_its_measures_once(spark):
    rows = [(p, "variant", v, float(p % 5), float(p % 3)) for p in range(30) for v in ("S1", "P2", "P4")]
    m = spark.createDataFrame(rows, "page_id long, kind string, name string, base_recall double, text_area double").repartition(3)
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.col("id").alias("ord"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    got = [r["page_id"] for r in fusion.review_pages(m.mapInArrow(count, m.schema), pages, "P2", "top20", 3).collect()]
    assert seen.value == len(rows)
    want = {r["page_id"] for r in fusion.informative(m, "P2", 3).union(fusion.delta(m, most=3)).collect()}
    assert got == sorted(want)
    assert [r["page_id"] for r in fusion.review_pages(m.filter("false"), pages, "P2", "top20", 3).collect()] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("name", ["fused_leaderboard", "fused_top_informative", "fused_top_delta"])
def test_boards_and_rankings_fuse_once(spark, name):
    text = plan(registry.queries()[name](spark, SF))
    assert text.count("aggregate(filter(items") == 1


def test_a_place_in_many_parts_is_swept_once(spark):
    rng = random.Random(3)
    rows = [("p", i % 7, float(x := rng.randrange(5)), float(y := rng.randrange(5)), x + 3.0, y + 2.0) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t int, x1 double, y1 double, x2 double, y2 double")
    parts = {f"t{i}": F.col("t") == i for i in range(7)}
    got = sweep.union_areas(df, ["k"], parts)
    for i in range(7):
        assert got.first()[f"t{i}"] == sweep.union_areas(df.filter(F.col("t") == i), ["k"]).first()["area"]
    assert "max(in_t6" in plan(got) or "bool_or(in_t6" in plan(got)


def test_the_state_of_the_fold_holds_places_instead_of_boxes(spark):
    text = plan(registry.queries()["greedy_fusion"](spark, SF))
    assert "named_struct(turns" in text and "named_struct(kept" not in text


def test_tasks_of_a_sweep_grow_in_number(spark, monkeypatch):
    rows = [(i % 50, float(i % 7), 0.0, float(i % 7 + 2), 5.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "page_id long, x1 double, y1 double, x2 double, y2 double").persist()
    want = {(r["page_id"], r["cells"]) for r in spatial.union_cells(df, 2400, 3200).collect()}
    monkeypatch.setattr(sweep, "TASK_ROWS", 20)
    got = spatial.union_cells(df, 2400, 3200)
    assert "RepartitionByExpression [page_id" in plan(got) and ", 51" in plan(got)
    assert {(r["page_id"], r["cells"]) for r in got.collect()} == want
    df.unpersist()
