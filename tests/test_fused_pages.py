"""The fused queries deal the boxes out by page once, to tasks that grow in number, and take the boxes' own lines where they lie."""

import random

import pytest

from quire.operators import fusion, spatial, sweep
from quire.queries import registry

SF = "/root/testdata/sf0.001"
W, H = 2400, 3200


@pytest.mark.parametrize("name", ["fused_leaderboard", "fused_measures", "fused_top_informative", "fused_top_delta"])
def test_measures_read_and_deal_out_the_table_once(spark, monkeypatch, name):
    monkeypatch.setattr(sweep, "TASK_ROWS", 500)
    tasks = spark.read.parquet(f"{SF}/lineitem.parquet").count() // 500 + 1
    query = registry.queries()[name](spark, SF)._jdf.queryExecution()
    assert query.optimizedPlan().toString().count("Relation [") == 1
    text = query.executedPlan().toString()
    assert text.count("Exchange hashpartitioning(page_id") == 1 and f", {tasks})" in text


def test_greedy_fusion_deals_out_to_tasks_that_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(sweep, "TASK_ROWS", 500)
    tasks = spark.read.parquet(f"{SF}/lineitem.parquet").count() // 500 + 1
    text = registry.queries()["greedy_fusion"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning(page_id" in line]
    assert dealt and all(f", {tasks})" in line for line in dealt)


def test_own_lines_are_pseudo_lines(spark):
    rng, rows = random.Random(11), []
    for i in range(500):
        x, y = rng.randrange(0, 2000, 60), rng.randrange(0, 3000, 90)
        w, h = rng.choice([(300, 80), (304, 82), (300, 80), (900, 300), (1700, 60), (100, 2200), (2000, 2000), (1, 50), (0, 0)])
        rows.append((i % 2 if i % 60 else None, i, *rng.choice([("a", "m"), ("b", "n"), (None, "o"), ("d", None)]), rng.choice(["text", "text", "title", "table", None]), rng.choice([0.1, 0.5, 0.9, None]), float(x), float(y), float(x + w), float(y + h)))
    rows += [(1, 500, "a", "m", "text", 0.5, 0.0, 0.0, float("inf"), 9.0), (1, 501, "b", "n", "text", 0.5, 0.0, 0.0, 90.0, None), (4, 502, "b", "n", "text", 0.5, 0.0, 0.0, 90.0, 40.0)]
    df = spark.createDataFrame(rows, "page_id long, seq int, source_family string, source_model string, norm_label string, score double, x1 double, y1 double, x2 double, y2 double").persist()
    sets = {"all": ("m", "n", "o"), "one": ("m",)}
    got, want = ({(r["page_id"], r["name"]): r for r in fusion.select_boxes(fusion.prepared(df, lines, W, H), sets, W, H).drop("items").collect()} for lines in (None, spatial.pseudo_lines(df, W, H)))
    assert set(got) == set(want) and len(got) == 8
    assert all(got[k]["kept"] == want[k]["kept"] and got[k]["covered"] == want[k]["covered"] for k in want)
    assert any(k["turn"] is None for r in got.values() for k in r["kept"]) and any(len(r["covered"]) > 64 for r in got.values())
    df.unpersist()
