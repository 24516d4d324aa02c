import json
import struct
import sys
import zlib

import pytest
from pyspark.sql import functions as F

from quire import cli, run
from quire.plans import profile, routing
from quire.sources import results

ADAPTER = """
import json, sys
page, width, out = sys.argv[1], int(sys.argv[2]), sys.argv[3]
if page == "hard":
    sys.exit("no luck")
json.dump({"page_id": page, "regions": [{"bbox_xyxy": [1, 2, width, 40], "label": "text", "confidence": 0.9, "text": "from the command", "reading_order": 2}]}, open(out, "w"))
"""


def png(path, width, height, dark):
    """A gray picture whose first `dark` rows are black."""
    rows = b"".join(b"\0" + (b"\0" if y < dark else b"\xff") * width for y in range(height))
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b""))


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    (root / "img").mkdir()
    for name, size in {"easy": (320, 320, 0), "medium": (320, 480, 80), "hard": (320, 640, 640), "large": (1500, 2048, 512)}.items():
        png(root / "img" / f"{name}.png", *size)
    rows = [{"page_id": n, "image_path": f"img/{n}.png", "page_number": i} for i, n in enumerate(("easy", "medium", "hard"), 1)]
    (root / "m.jsonl").write_text("# pages\n" + "\n".join(map(json.dumps, rows)) + "\n")
    (root / "config.json").write_text(json.dumps({"command_adapters": [{"model_id": "mine", "profiles": ["full"], "complexities": ["medium", "hard"], "command": [sys.executable, "-c", ADAPTER.replace("{", "{{").replace("}", "}}"), "{page_id}", "{width}", "{output_path}"]}]}))
    return root


def test_profiles_of_images(spark, inputs):
    pages = spark.createDataFrame([(n, f"{inputs}/img/{n}.png", "abc" if n == "large" else "") for n in ("easy", "medium", "hard", "large")], "page_id string, image_path string, checksum string")
    got = {r["page_id"]: r for r in profile.image_profiles(spark, pages, f"{inputs}/img").collect()}
    assert {k: r["complexity"] for k, r in got.items()} == {"easy": "easy", "medium": "medium", "hard": "hard", "large": "hard"}
    assert (got["medium"]["dark_share"], got["medium"]["mean_luma"], got["medium"]["aspect_ratio"]) == (0.166667, 212.5, 0.666667)
    assert (got["large"]["sample_height"], got["large"]["sample_width"], got["large"]["image_sha256"], got["large"]["checksum_source"]) == (1024, 750, "abc", "manifest")
    assert got["easy"]["checksum_source"] == "computed" and len(got["easy"]["image_sha256"]) == 64


@pytest.fixture(scope="module")
def finished(spark, inputs, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("run") / "r1")
    return at, run.canary(spark, f"{inputs}/m.jsonl", at, "full", f"{inputs}/config.json")


def test_a_run_from_manifest_to_reports(spark, finished):
    at, performance = finished
    assert (performance["pages_completed"], performance["adapter_invocations_planned"], performance["adapter_errors"], performance["errors"]) == (3, 11, 1, 1)
    fused = json.load(open(f"{at}/outputs/fused_pages/medium.json"))
    assert fused["model_ids"] == ["baseline_geometry_v1", "column_detector_v1", "legal_notice_probe_v1", "mine"] and "from the command" in fused["transcript"]
    assert open(f"{at}/outputs/transcripts/medium.txt").read() == fused["transcript"] + "\n"
    summary = json.load(open(f"{at}/reports/performance_summary.json"))
    assert summary["coverage"]["planned_invocations"] == 11 and summary["coverage"]["failed_invocations"] == 1 and summary["by_model"]["mine"]["failed"] == 1 and summary["by_model"]["mine"]["family"] == "external"
    with pytest.raises(FileExistsError):
        run.prepare(spark, f"{at}/manifests/parse_input.jsonl", at)


def test_validation_of_a_run(spark, finished):
    at, _ = finished
    report, issues = run.validate(spark, at)
    assert [i["code"] for i in issues] == ["run_has_errors"], issues
    assert report["counts"]["model_outputs"] == 10 and report["counts"]["fused_pages"] == 3 and report["runtime_status_counts"] == {"ok": 10}


@pytest.mark.parametrize("damage, codes", [("transcript", {"missing_transcript_file", "transcript_count_mismatch"}), ("models", {"empty_model_plan", "summary_model_ids_mismatch", "model_plan_resource_mismatch"}), ("summary", {"performance_summary_row_mismatch", "output_path_outside_run", "invalid_json", "invalid_jsonl"})])
def test_damage_is_noticed(spark, finished, tmp_path, damage, codes):
    import shutil

    at = f"{tmp_path}/r2"
    shutil.copytree(finished[0], at, ignore=shutil.ignore_patterns("*.crc"))
    if damage == "transcript":
        (tmp_path / "r2/outputs/transcripts/easy.txt").unlink()
    elif damage == "models":
        p = tmp_path / "r2/manifests/model_plan.jsonl"
        p.write_text("\n".join(json.dumps(json.loads(x) | {"models": []}) for x in p.read_text().splitlines()))
    else:
        for name, change in (("reports/performance_summary.json", {"raw_rows": 1}), ("summary.json", {"outputs": {"model_plan": "/etc/passwd"}})):
            p = tmp_path / "r2" / name
            p.write_text(json.dumps(json.loads(p.read_text()) | change))
        (tmp_path / "r2/provenance.json").write_text("{")
        with (tmp_path / "r2/errors.jsonl").open("a") as f:
            f.write("nope\n")
    _, issues = run.validate(spark, at)
    assert codes <= {i["code"] for i in issues}


def test_configuration_and_routing(spark):
    full = routing.adapters_for("full")
    assert [a.model_id for a in full] == ["baseline_geometry_v1", "column_detector_v1", "legal_notice_probe_v1"] and len(routing.adapters_for("baseline")) == 1
    with pytest.raises(ValueError, match="no adapters"):
        routing.adapters_for("none")
    one = {"model_id": "x", "profiles": "full", "command": ["a"]}
    for wrong in ({"model_id": "a/b"}, {"command": []}, {"complexities": ["odd"]}, {"timeout_seconds": -1}, {"profiles": []}):
        with pytest.raises(ValueError):
            routing.config_of({"command_adapters": [one | wrong]})
    with pytest.raises(ValueError, match="more than once"):
        routing.adapters_for("full", routing.config_of({"command_adapters": [one, one]}))
    assert [a.model_id for a in routing.adapters_for("full", routing.config_of({"include_builtin_adapters": "no", "command_adapters": [one]}))] == ["x"]
    only_hard = routing.config_of({"include_builtin_adapters": False, "command_adapters": [one | {"complexities": ["hard"]}]})
    with pytest.raises(Exception, match="no adapter fits page p1"):
        routing.route(spark.createDataFrame([("p1", "easy")], "page_id string, complexity string"), routing.adapters_for("full", only_hard)).collect()


def stored(root):
    record = {"source_family": "paddle", "source_model": "pld_v2", "source_label": "text", "norm_label": "text", "score": 0.9, "text": "old words"}
    for source, variant, family in (("paddle_layout", "pld_v2", "paddle"), ("dell", "dell", "dell")):
        for slug in ("easy", "hard"):
            p = root / "outputs/sources" / source / variant / slug
            p.mkdir(parents=True)
            boxes = [record | {"source_family": family, "source_model": variant, "bbox_xyxy": [10, 10 + 40 * i, 300, 30 + 40 * i], "reading_order": i} for i in range(5)]
            (p / "layout_boxes.normalized.json").write_text(json.dumps({"slug": slug, "boxes": boxes}))


def test_older_runs_are_imported_and_fused(spark, inputs, tmp_path):
    stored(tmp_path / "old")
    config = run.import_run(spark, f"{tmp_path}/old")
    assert [a["model_id"] for a in config["import_adapters"]] == ["legacy_dell_dell", "legacy_paddle_layout_pld_v2"]
    (tmp_path / "c.json").write_text(json.dumps(config))
    performance = run.canary(spark, f"{inputs}/m.jsonl", f"{tmp_path}/new", "legacy_import", f"{tmp_path}/c.json")
    assert (performance["errors"], performance["pages_completed"]) == (0, 3)
    assert json.load(open(f"{tmp_path}/new/outputs/model_outputs/legacy_dell_dell/medium.json"))["runtime"]["status"] == "skipped"
    assert run.validate(spark, f"{tmp_path}/new")[0]["status"] == "ok"
    with pytest.raises(ValueError):
        run.import_run(spark, f"{tmp_path}/none")
    summary = run.fuse_stored(spark, f"{tmp_path}/old", 320, 640)
    assert summary["recommended_variant"] == "P4" and summary["pages"] == 2
    board = spark.read.csv(f"{tmp_path}/old/outputs/fusion/variant_leaderboard.tsv", sep="\t", header=True)
    assert board.count() == 7 and board.filter("name = 'P4'").first()["boxes"] == "5.000"


def test_result_readers(spark, tmp_path):
    box = {"coordinate": [0, 0, 9, 9], "label": "title", "score": None, "order": 3}
    for name, value in (("a/r.json", {"res": {"boxes": [box, {"coordinate": [5, 5, 1, 1]}]}}), ("b/r.json", {"boxes": [box]}), ("c/v.json", {"layout_det_res": {"boxes": [box]}, "parsing_res_list": [{"block_label": "Table", "block_content": " <t> "}, {"block_label": "text", "block_content": "x"}, {"block_label": "table", "block_content": "u"}]})):
        p = tmp_path / name
        p.parent.mkdir()
        p.write_text(json.dumps(value))
    got = results.layout_results(spark, f"{tmp_path}/*/r.json", "m").collect()
    assert sorted((r["slug"], r["norm_label"], r["score"], r["reading_order"]) for r in got) == [("a", "title", 0.0, 3), ("b", "title", 0.0, 3)]
    assert results.parser_results(spark, f"{tmp_path}/c/v.json", "m").count() == 1
    assert results.parser_tables(spark, f"{tmp_path}/c/v.json").first()["tables"] == "<t>\n\nu"
    slugs = spark.createDataFrame([("a",), ("b",), ("z",)], "slug string")
    report = spark.createDataFrame([("z", "oom")], "slug string, status string")
    with pytest.raises(ValueError, match="0 of 2"):
        results.external_results(spark, f"{tmp_path}/*/r.json", slugs, report, "dell", "d")
    _, status = results.external_results(spark, f"{tmp_path}/*/r.json", slugs, report, "dell", "d", 0)
    assert sorted(map(tuple, status.collect())) == [("a", "ok"), ("b", "ok"), ("z", "oom")]
    nested = {"pages": [{"type": "Title", "content": [{"bbox": [0.1, 0.1, 0.5, 0.2], "score": 0.5}, {"bbox": [0.1, 0.1, 0.5, 0.2]}, {"polygon": [[10, 10], [90, 10], [90, 40]], "label": "body", "md": "words"}, {"rect": {"left": 1, "top": 2, "right": 500, "bottom": 9}}]}]}
    rows = results.nested_results(spark.createDataFrame([("s", 100, 200, json.dumps(nested)), ("t", 1, 1, "{")], "slug string, width int, height int, payload string")).collect()
    assert [(r["source_label"], r["x1"], r["y1"], r["x2"], r["y2"], r["text"]) for r in rows] == [("Title", 10.0, 20.0, 50.0, 40.0, None), ("body", 10.0, 10.0, 90.0, 40.0, "words"), ("Title", 1.0, 2.0, 100.0, 9.0, None)]


def test_commands(spark, inputs, finished, tmp_path, capsys):
    (tmp_path / "bad.jsonl").write_text('{"page_id":"p1","image_path":"a.png"}\n{"page_id":"p1","image_path":"a.png"}\nnope\n')
    assert cli.main(["validate-manifest", f"{tmp_path}/bad.jsonl", "--images", f"{inputs}/img"]) == 1
    out = capsys.readouterr().out
    assert "duplicate_page_id" in out and "invalid_jsonl" in out and "missing_image_file" in out and out.startswith("status: error")
    assert cli.main(["validate-manifest", f"{inputs}/m.jsonl", "--json"]) == 0
    assert cli.main(["validate-run", finished[0], "--json"]) == 1
    assert cli.main(["plan", f"{inputs}/m.jsonl", f"{tmp_path}/p", "--profile", "baseline"]) == 0
    assert cli.main(["summarize-performance", finished[0]]) == 0
    (tmp_path / "l.txt").write_text("/i/easy.png\n/i/none.png\n")
    capsys.readouterr()
    assert cli.main(["status", f"{tmp_path}/l.txt", f"{finished[0]}/outputs", "--missing", "5"]) == 0
    assert '"stage":"fused_pages","done":1,"total":2' in capsys.readouterr().out
    (tmp_path / "scan").mkdir()
    (tmp_path / "scan" / "x.pem").write_text("k")
    assert cli.main(["safety-scan", f"{tmp_path}/scan"]) == 1
    assert cli.main(["make-manifest", f"{inputs}/img", f"{tmp_path}/made.txt"]) == 0 and len(open(f"{tmp_path}/made.txt").read().split()) == 4
    assert cli.main(["stage-inputs", f"{inputs}/img", f"{tmp_path}/staged.txt", "--max-pages", "2"]) == 0 and len(open(f"{tmp_path}/staged.txt").read().split()) == 2


def test_transcript_of_every_line(spark):
    from quire.operators import ocr

    payload = {"res": [{"rec_texts": [" a ", "", "b"], "dt_polys": [[[0, 0], [9, 0], [9, 5]], [[0, 0], [9, 9]], [0, 20, 9, 25]]}, {"pages": {"text": "c", "poly": [[0, 10], [5, 15]], "score": "x"}}, {"text": "a", "bbox": [1, 0, 9, 5]}]}
    deep = "[" * 900 + json.dumps({"rec_texts": ["d", "e"], "rec_scores": [0.5], "polys": [[1, 1, 2, 2], [2, 1, 1, 2]], "text": "é", "poly": "?", "bbox": [[1, "2"], [3, 4], [float("inf"), 0], ["x", 1], [5]]}) + "]" * 900
    rows = spark.createDataFrame([("k", json.dumps(payload)), ("n", None), ("x", "{"), ("deep", deep), ("deeper", "[" * 99999), ("s", '"a"')], "key string, payload string")
    got = [tuple(r) for r in ocr.result_lines(rows).orderBy("key", "line").collect()]
    assert got == [("deep", 1, "d", 0.5, 1.0, 1.0, 2.0, 2.0), ("k", 1, "a", None, 0.0, 0.0, 9.0, 5.0), ("k", 2, "c", None, 0.0, 10.0, 5.0, 15.0), ("k", 3, "b", None, 0.0, 20.0, 9.0, 25.0)]


def test_payloads_nested_deep_do_not_end_the_job(spark):
    from quire.sources import legacy

    nest = lambda n, x: '{"res": ' * n + json.dumps(x) + "}" * n
    box = {"boxes": [{"bbox": [0, 0, 5, 5]}]}
    rows = spark.createDataFrame([("a", nest(50, box)), ("b", nest(1500, box)), ("c", nest(90_000, box)), ("d", json.dumps(box))], "page_id string, payload string")
    assert {r["page_id"] for r in legacy.legacy_regions(rows).collect()} >= {"a", "d"}
    got = {r["page_id"]: (r["status"], r["emitted"]) for r in legacy.legacy_outcome(rows).collect()}
    assert got["a"] == got["d"] == ("ok", 1) and got["b"] in (("ok", 1), ("error", 0)) and got["c"] == ("error", 0)
