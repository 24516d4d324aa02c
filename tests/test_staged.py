import json

import pytest
from pyspark.sql import functions as F

from quire import cli
from quire.plans import staged
from quire.plans.stages import Stage, ordered, progress, run_stages, tables_of


def test_order_subset_and_refusals():
    nothing = lambda read: {}
    graph = [Stage("c", nothing, ("a", "b")), Stage("a", nothing), Stage("b", nothing, ("a",)), Stage("d", nothing, ("c",), enabled=False)]
    assert [s.name for s in ordered(graph)] == ["a", "b", "c"]
    assert [s.name for s in ordered(graph, ["c", "a", "d"])] == ["a", "c"]
    with pytest.raises(ValueError, match=r"unknown stages \['x', 'y'\]"):
        ordered(graph, ["y", "a", "x"])
    with pytest.raises(ValueError, match="twice"):
        ordered([*graph, Stage("a", nothing)])
    with pytest.raises(ValueError, match="read each other"):
        ordered([Stage("a", nothing, ("b",)), Stage("b", nothing, ("a",))])
    with pytest.raises(ValueError, match=r"unknown stages \['z'\]"):
        ordered([Stage("a", nothing, ("z",))])


def test_finished_stages_are_left_alone_until_something_they_depend_on_changes(spark, tmp_path):
    ran, root = [], f"{tmp_path}/stages"

    def graph(step=1, broken=None, off=()):
        def work(name, make):
            def go(read):
                ran.append(name)
                if broken == name:
                    raise RuntimeError("killed")
                return {"t": make(read)}

            return go

        def few(made):
            if made["t"].count() < 2:
                raise ValueError("too few rows")

        return [
            Stage("sum", work("sum", lambda r: r["twice"]["t"].agg(F.sum("id").alias("s"))), ("twice", "other")),
            Stage("twice", work("twice", lambda r: r["base"]["t"].select((F.col("id") * 2).alias("id"))), ("base",)),
            Stage("base", work("base", lambda r: spark.range(0, 10, step)), settings={"step": step}, check=few),
            Stage("other", work("other", lambda r: spark.range(1)), enabled="other" not in off),
        ]

    first = run_stages(spark, graph(), root)
    assert sorted(ran) == ["base", "other", "sum", "twice"] and {r["stage"]: r["rows"] for r in first} == {"base": {"t": 10}, "other": {"t": 1}, "twice": {"t": 10}, "sum": {"t": 1}}
    assert tables_of(spark, root, "sum")["t"].first()["s"] == 90
    ran.clear()
    assert {r["outcome"] for r in run_stages(spark, graph(), root)} == {"finished before"} and not ran
    run_stages(spark, graph(), root, ["twice"], resume=False)
    assert ran == ["twice"] and {p["stage"]: p["state"] for p in progress(spark, graph(), root)} == {"base": "finished", "twice": "finished", "other": "finished", "sum": "stale"}
    ran.clear()
    with pytest.raises(RuntimeError, match="killed"):
        run_stages(spark, graph(5, "twice"), root)
    assert ran[-1] == "twice" and tables_of(spark, root, "base")["t"].count() == 2
    ran.clear()
    run_stages(spark, graph(5), root)
    assert len([p for p in (tmp_path / "stages/sum").iterdir() if p.is_dir()]) == 1
    assert ran == ["twice", "sum"] and tables_of(spark, root, "sum")["t"].first()["s"] == 10
    with pytest.raises(ValueError, match="too few rows"):
        run_stages(spark, graph(10), root, ["base"])
    assert tables_of(spark, root, "base")["t"].count() == 2
    with pytest.raises(FileNotFoundError, match=r"\['other', 'twice'\]"):
        run_stages(spark, graph(), f"{root}/new", ["sum"])
    with pytest.raises(FileNotFoundError):
        tables_of(spark, f"{root}/new", "sum")
    assert {p["state"] for p in progress(spark, graph(off=("other",)), f"{root}/new")} == {"waiting", "disabled"}


@pytest.fixture
def project(tmp_path):
    """Three pages with stored results of five models, one page without any of the last."""
    (tmp_path / "img").mkdir()
    for n in "abc":
        (tmp_path / "img" / f"{n}.png").write_bytes(b"x")
    (tmp_path / "list.txt").write_text("# pages\n" + "".join(f"{tmp_path}/img/{n}.png\n" for n in "abc"))
    models = {"paddle_layout/v2": "coordinate", "paddle_layout/plus": "coordinate", "paddle_vl15/vl": "layout", "dell/d": "bbox_xyxy", "mineru/m": "bbox_xyxy"}
    for at, key in models.items():
        for n in "abc":
            if (at, n) == ("mineru/m", "c"):
                continue
            boxes = [{"label": "text", ("coordinate" if key == "layout" else key): [100, 100 + 60 * i, 900, 140 + 60 * i], "score": 0.9, "text": "t"} for i in range(4)]
            p = tmp_path / "run/outputs/sources" / at / n
            p.mkdir(parents=True)
            (p / "layout_boxes.normalized.json").write_text(json.dumps({"layout_det_res": {"boxes": boxes}} if key == "layout" else {"boxes": boxes}))
    config = {
        "manifest_path": "$QUIRE_AT/list.txt", "run_root": "runs", "paddle_layout_variants": [{"variant_id": "v2", "model_name": "pld_v2"}, {"variant_id": "plus", "model_name": "pld_plusL", "threshold": "0.5"}],
        "paddle_vl15": {"variant_id": "vl"}, "dell": {"variant_id": "d"}, "mineru": {"variant_id": "m"}, "transcription": {"labels": "Text, title"},
    }
    (tmp_path / "c.json").write_text(json.dumps(config))
    return tmp_path


def test_configuration(spark, project, monkeypatch):
    monkeypatch.setenv("QUIRE_AT", str(project))
    c = staged.resolved(spark, f"{project}/c.json")
    assert (c["manifest_path"], c["run_root"], c["fusion"]["recommended_variant"], c["review"]["top_k_informative"]) == (f"{project}/list.txt", f"{project}/runs", "P4", 20)
    assert c["paddle_layout_variants"][1]["threshold"] == 0.5 and c["transcription"]["labels"] == ("text", "title") and c["dell"]["enabled"]
    (project / "again.json").write_text(json.dumps(c))
    assert json.loads(json.dumps(staged.resolved(spark, f"{project}/again.json"))) == json.loads(json.dumps(c))
    bad = {"none": {}, "number": {"manifest_path": "m", "run_root": "r", "fusion": {"line_cover_threshold": "x"}}, "shape": {"manifest_path": "m", "run_root": "r", "dell": ["x"]}}
    for name, value in bad.items():
        (project / f"{name}.json").write_text(json.dumps(value))
        with pytest.raises(ValueError):
            staged.resolved(spark, f"{project}/{name}.json")
    here, own = project / "here", project / "conf" / "deep"
    for folder, names in ((here, ("src/x.py", "y.py")), (own, ("src/x.py", "y.py")), (project / "conf", ("z.py",))):
        for n in names:
            (folder / n).parent.mkdir(parents=True, exist_ok=True)
            (folder / n).write_text("")
    monkeypatch.chdir(here)
    path = lambda p: staged.found_path(spark, p, str(own))
    assert [path(p) for p in ("src/x.py", "y.py", "z.py", "src/none.py", "/a/b", "")] == [f"{here}/src/x.py", f"{own}/y.py", f"{project}/conf/z.py", "src/none.py", "/a/b", ""]


def test_a_whole_staged_run(spark, project, monkeypatch, capsys):
    monkeypatch.setenv("QUIRE_AT", str(project))
    config, run_dir = f"{project}/c.json", f"{project}/run"
    with pytest.raises(ValueError, match="unknown stages"):
        staged.run(spark, config, run_dir, ["fusion", "paint"])
    with pytest.raises(FileNotFoundError, match="neither chosen nor finished"):
        staged.run(spark, config, run_dir, ["review", "transcription"])
    first = staged.run(spark, config, run_dir, ["paddle_layout", "paddle_vl15", "dell", "mineru", "fusion"])
    assert [s["outcome"] for s in first["stages"]] == ["ran"] * 5 and first["stages"][-1]["stage"] == "fusion"
    made = tables_of(spark, f"{run_dir}/stages", "fusion")
    assert {(r["model"], r["page_id"]) for r in made["statuses"].filter("status = 'missing'").collect()} == {("mineru25", "c")}
    per = {(r["page_id"], r["variant"]): r["count"] for r in made["boxes"].groupBy("page_id", "variant").count().collect()}
    assert per == {(n, v): 4 for n in "abc" for v in ("P2", "P3", "P4") if (n, v) != ("c", "P3")}  # strips of text stay where two families have them
    # A reader of the crops leaves its results beside them; one crop's file has a further part to its name.
    for name, text in (("crop_0001_res.json", "first"), ("crop_0002_0_res.json", "second"), ("crop_0003_res.json", "")):
        p = project / "run/outputs/transcription/P4/a"
        p.mkdir(parents=True, exist_ok=True)
        (p / name).write_text(json.dumps({"res": {"rec_texts": [text], "rec_polys": [[[5, 5], [300, 5], [300, 30], [5, 30]]], "rec_scores": [0.9]}}))
    assert cli.main(["run", config, "--run-dir", run_dir]) == 0
    said = {s["stage"]: s["outcome"] for s in json.loads(capsys.readouterr().out)["stages"]}
    assert said.pop("review") == said.pop("transcription") == "ran" and set(said.values()) == {"finished before"}
    review, read = tables_of(spark, f"{run_dir}/stages", "review"), tables_of(spark, f"{run_dir}/stages", "transcription")
    assert review["variants"].count() == 7 and review["pages"].count() == 3 and review["top_delta"].count() == 3
    assert {r["page_id"]: r["text"] for r in read["texts"].collect()} == {"a": "first\n\nsecond", "b": "", "c": ""}
    assert {r["page_id"]: (r["status"], r["ocr_box_count"], r["ocr_line_count"]) for r in read["report"].collect()} == {"a": ("ok", 4, 2), "b": ("ok", 4, 0), "c": ("ok", 4, 0)}
    assert cli.main(["run-status", run_dir]) == 0
    state = json.loads(capsys.readouterr().out)
    assert state["total_pages"] == 3 and {s["state"] for s in state["stages"]} == {"finished"}
    # Results that come later are taken up by the stages that read them, and by no other.
    late = project / "run/outputs/transcription/P4/b/crop_0004_res.json"
    late.parent.mkdir()
    late.write_text(json.dumps({"rec_texts": ["late"], "rec_polys": [[[5, 5], [300, 5], [300, 30], [5, 30]]]}))
    assert {s["stage"] for s in staged.status(spark, run_dir)["stages"] if s["state"] == "stale"} == {"transcription"}
    assert [s["stage"] for s in staged.run(spark, config, run_dir)["stages"] if s["outcome"] == "ran"] == ["transcription"]
    assert tables_of(spark, f"{run_dir}/stages", "transcription")["texts"].filter("page_id = 'b'").first()["text"] == "late"


def test_pages_of_a_list_are_those_of_its_last_state(spark, project):
    (project / "x").mkdir()
    (project / "x/a.png").write_bytes(b"y")
    (project / "list.txt").write_text(f"{project}/img/a.png\n{project}/img/b.png\n{project}/x/a.png\n")
    assert {tuple(r) for r in staged.pages_of(spark, f"{project}/list.txt").collect()} == {("a", f"{project}/x/a.png", 3), ("b", f"{project}/img/b.png", 2)}
    (project / "list.txt").write_text(f"{project}/img/a.png\n{project}/img/none.png\n")
    with pytest.raises(FileNotFoundError, match="1 paths are missing"):
        staged.pages_of(spark, f"{project}/list.txt")
    (project / "list.txt").write_text("# none\n")
    with pytest.raises(ValueError, match="names no images"):
        staged.pages_of(spark, f"{project}/list.txt")
