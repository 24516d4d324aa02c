import json
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.plans import batching, resume


def test_failing_batches_are_halved_until_bad_rows_stand_alone():
    asked = []

    def model(b):
        asked.append(len(b))
        if b["id"].isin([3, 700]).any():
            raise RuntimeError("bad page")
        return [x * 2 for x in b["id"]]

    got = batching._outcomes(pd.DataFrame({"id": range(1024)}), model)
    assert [i for i, o in enumerate(got) if o[0] == "error"] == [3, 700] and got[3][1:3] == ("RuntimeError", "bad page")
    assert all(o[3] == str(2 * i) for i, o in enumerate(got) if o[0] == "ok")
    assert sum(o[4] for o in got) == len(asked) <= 1 + 2 * 2 * math.log2(1024)
    short = batching._outcomes(pd.DataFrame({"id": [1, 2]}), lambda b: [])
    assert [o[:3] for o in short] == [("error", "ValueError", "0 results for 1 pages")] * 2
    assert batching._outcomes(pd.DataFrame({"id": []}), model) == []


def test_batches_of_a_table(spark):
    rows = spark.createDataFrame([(i, None if i == 9 else "a", "x") for i in range(40)], "id long, text string, status string").repartition(3)
    got = {r["id"]: (r["status"], r["result"]) for r in batching.run_batched(rows, lambda b: [len(t) for t in b["text"]], "id", 8).collect()}
    assert got == {i: ("error", None) if i == 9 else ("ok", "1") for i in range(40)}
    assert batching.run_batched(rows.filter("false"), lambda b: [], "id").count() == 0


def test_a_run_that_was_killed_goes_on_and_writes_each_page_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    manifest = lambda name, ids: (tmp_path / "in" / name).write_text("".join(json.dumps({"page_id": i}) + "\n" for i in ids))
    manifest("1.json", ["a", "b", "a", None])
    manifest("2.json", ["b", "c"])
    manifest("3.json", ["d"])
    out, marks, worked = f"{tmp_path}/out", f"{tmp_path}/marks", []

    def work(pages, stop=None, after=False):
        worked.append(sorted(r["page_id"] for r in pages.collect()))
        result = pages.select("page_id", F.length("page_id").alias("n"))
        if stop in worked[-1]:
            if after:  # written, not recorded
                result.write.mode("append").parquet(out)
            raise RuntimeError("killed")
        return result

    go = lambda **how: resume.run_manifests(spark, f"{tmp_path}/in", out, marks, lambda p: work(p, **how), "page_id string", files_at_once=1)
    with pytest.raises(Exception, match="killed"):
        go(stop="c")
    with pytest.raises(Exception, match="killed"):
        go(stop="c", after=True)
    go()
    manifest("4.json", ["a", "e"])
    go()
    assert sorted(r["page_id"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d", "e"]
    assert worked.count(["c"]) == 2 and worked[-1] == ["e"] and sum(w == ["a", "b"] for w in worked) == 1
