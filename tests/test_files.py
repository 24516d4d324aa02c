import io
import json
import os
import sys
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from quire import adapters, sinks
from quire.operators import validation
from quire.sources import archives, files, legacy


@pytest.fixture
def root(tmp_path):
    for name in ("a.png", "b/c.JPG", "b/.d.png", "__MACOSX/e.png", "f.txt"):
        p = tmp_path / "in" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x" + name.encode())
    return tmp_path


def tar_of(names):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w:gz") as t:
        for n in names:
            i = tarfile.TarInfo(n)
            i.size = 2
            t.addfile(i, io.BytesIO(b"ab"))
    return raw.getvalue()


def test_json_lines(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('# note\n{"page_id":"p1","image_path":"x/a.png","page_number":""}\n\nnope\n[1]\n')
    rows = files.json_lines(spark, str(tmp_path / "m.jsonl"), comments=True).orderBy("line").collect()
    assert [(r["line"], r["code"]) for r in rows] == [(2, None), (4, "invalid_jsonl"), (5, "invalid_jsonl_row")]
    with pytest.raises(Exception, match="invalid_jsonl"):
        files.strict_json_lines(spark, str(tmp_path / "m.jsonl")).select(F.to_json("value")).collect()
    (tmp_path / "n.jsonl").write_text('{"page_id":"p1","image_path":"x/a.png","page_number":""}\n')
    r = files.page_manifest(spark, str(tmp_path / "n.jsonl")).first()
    assert r["image_path"].endswith(f"{tmp_path.name}/x/a.png") and r["page_number"] is None
    (tmp_path / "n.jsonl").write_text('{"page_id":"p1"}\n')
    with pytest.raises(Exception, match="no image_path"):
        files.page_manifest(spark, str(tmp_path / "n.jsonl")).collect()


def test_path_lists(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("QUIRE_T", "/t")
    (tmp_path / "l.txt").write_text("# c\n\n /x/a.png \n/y/a.png\n")
    rows = files.path_list(spark, str(tmp_path / "l.txt"))
    assert [tuple(r) for r in rows.orderBy("line").collect()] == [(3, "/x/a.png", "a"), (4, "/y/a.png", "a")]
    assert files.last_by_slug(rows).collect()[0]["path"] == "/y/a.png"


def test_listing_archives_and_staging(spark, root):
    got = files.images(spark, str(root / "in"))
    assert sorted(os.path.basename(r["path"]) for r in got.collect()) == ["a.png", "c.JPG"]
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("q/w.png", b"ab")
        f.writestr("._w.png", b"ab")
    (root / "A b.tar.gz").write_bytes(tar_of(["p/a.png", "p/._a.png", "__MACOSX/a.png", "r.txt"]))
    (root / "z.zip").write_bytes(z.getvalue())
    rows = spark.createDataFrame([(f"{root}/A b.tar.gz",), (f"file://{root}/z.zip",), (f"{root}/none.txt",)], "path string")
    assert sorted((r["archive"].rsplit("/", 1)[1], r["member"], bytes(r["content"])) for r in archives.members(rows).collect()) == [("A b.tar.gz", "p/a.png", b"ab"), ("z.zip", "q/w.png", b"ab")]
    assert rows.select(files.archive_folder(F.col("path"))).first()[0].startswith("a_b_")
    (root / "x.tgz").write_bytes(tar_of(["../a.png"]))
    with pytest.raises(Exception, match="leaves its folder"):
        archives.members(spark.createDataFrame([(f"{root}/x.tgz",)], "path string")).collect()
    paths = spark.createDataFrame([(0, "/B", "file"), (1, "/a", "dir"), (2, "/a", "file")], "ord int, path string, kind string")
    assert [r["kind"] for r in files.staged(paths).collect()] == ["dir", "file"]
    assert [r["path"] for r in files.staged(paths).collect()] == ["/a", "/B"]
    assert files.staged(paths, 1).count() == 1


@pytest.mark.parametrize("shape, want", [
    ({"x1": 1, "y1": "2", "x2": 3, "y2": 4}, (1, 2, 3, 4)), ({"left": 1, "top": 2, "width": 3, "height": 4}, (1, 2, 4, 6)), ([[0, 0], [10, 1], [9, 20], [1, 19]], (0, 0, 10, 20)),
    ([0, 0, 5, 1, 5, 6, 0, 6], (0, 0, 5, 6)), ([5, 5, 1, 1], None), ([1, 2, "x", 4], None), (None, None), ([1, 2, 3], None), ([1, 2, float("inf"), 4], None),
])
def test_box_shapes(shape, want):
    assert legacy.corners(shape) == want


def test_legacy_payloads(spark):
    rows = [("p1", json.dumps({"res": {"boxes": [{"coordinate": [0, 0, 2, 2], "score": None}, {"bbox": [3, 3, 1, 1]}]}})), ("p2", json.dumps({"pages": [{"slug": "p2", "blocks": [{"bbox": [0, 0, 1, 1], "prob": 7}]}, {"slug": "x", "blocks": [{"bbox": [0, 0, 9, 9]}]}]})), ("p3", None), ("p4", "nope")]
    docs = spark.createDataFrame(rows, "page_id string, payload string")
    found = legacy.legacy_regions(docs)
    assert sorted((r["page_id"], r["x2"], r["confidence"]) for r in found.collect()) == [("p1", 2.0, 0.5), ("p2", 1.0, 1.0)]
    assert {r["page_id"]: (r["status"], r["observed"], r["skipped"]) for r in legacy.legacy_outcome(docs).collect()} == {"p1": ("ok", 2, 1), "p2": ("ok", 1, 0), "p3": ("skipped", 0, 0), "p4": ("error", 0, 0)}


def test_commands(spark):
    pages = spark.createDataFrame([("p1", "a"), ("p2", "b")], "page_id string, image_path string")
    code = "import sys, json; sys.exit('bad page') if sys.argv[1] == 'p2' else print(json.dumps({'page_id': 'p1', 'regions': []}))"
    got = {r["page_id"]: r for r in adapters.run_command(pages, adapters.Command("m", (sys.executable, "-c", code.replace("{", "{{").replace("}", "}}"), "{page_id}"))).collect()}
    assert got["p1"]["status"] == "ok" and got["p2"]["status"] == "error" and "bad page" in got["p2"]["error"]
    slow = adapters.run_command(pages.limit(1), adapters.Command("m", ("sleep", "5"), timeout=0.2)).first()
    assert (slow["status"], slow["error_type"]) == ("error", "TimeoutExpired")


def test_command_placeholders_output_file_and_folder(spark, tmp_path):
    pages = spark.createDataFrame([("p1", "/a/b.c.png", 7)], "page_id string, image_path string, page_number int")
    code = "import json, os, sys; json.dump(dict(page_id=sys.argv[1], seen=sys.argv[2:], cwd=os.getcwd()), open(sys.argv[3], 'w'))"
    argv = (sys.executable, "-c", code, "{page_id}", "{image_stem}|{image_name}|{image_dir}|{page_number}|{model_id}|{run_dir}|{width}", "{output_path}")
    r = adapters.run_command(pages, adapters.Command("m", argv, cwd=str(tmp_path)), {"run_dir": "/r"}).first()
    assert r["status"] == "ok" and json.loads(r["payload"])["seen"][0] == "b.c|b.c.png|/a|7|m|/r|" and json.loads(r["payload"])["cwd"] == str(tmp_path)
    wrong = adapters.run_command(pages, adapters.Command("m", ("echo", '{{"page_id": "x"}}'))).first()
    assert (wrong["status"], wrong["error_type"]) == ("error", "ValueError")


def test_progress(spark):
    made = spark.createDataFrame([("ocr", "a"), ("ocr", "x")], "stage string, slug string")
    r = validation.stage_progress(spark.createDataFrame([("a",), ("b",), ("c",)], "slug string"), made).first()
    assert (r["done"], r["total"], r["percent"], r["missing"]) == (1, 3, 33.33, ["b", "c"])


def test_tables_are_counted_by_one_query(spark):
    executions = lambda: spark._jsparkSession.sharedState().statusStore().executionsCount()
    before = executions()
    assert validation.row_counts(a=spark.range(7), b=spark.range(3).filter("id > 5"), c=spark.range(4).select("id").distinct()) == {"a": 7, "b": 0, "c": 4}
    assert executions() - before == 1


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("p1", "t", 0.5)], "page_id string, transcript string, score double")
    assert sinks.write_json_lines(df, str(tmp_path / "j")) == 1
    sinks.write_tsv(df, str(tmp_path / "t"), {"score": "%.3f"})
    sinks.write_transcripts(df, str(tmp_path / "x"))
    with pytest.raises(Exception, match="already exists"):
        sinks.write_tsv(df, str(tmp_path / "t"))
    assert files.tsv(spark, str(tmp_path / "t")).first()["score"] == "0.500"
    assert df.select(sinks.review_note(F.col("page_id"), score=F.col("score"))).first()[0] == "# p1\n\n- score: 0.5"
    sinks.write_json_document(spark, {"b": 1, "a": "é"}, str(tmp_path / "d.json"))
    assert (tmp_path / "d.json").read_text() == '{\n  "a": "é",\n  "b": 1\n}\n'
    with pytest.raises(FileExistsError):
        sinks.write_json_document(spark, {}, str(tmp_path / "d.json"))
    with pytest.raises(FileExistsError):
        sinks.require_fresh(spark, str(tmp_path))


def test_staging_of_mixed_inputs(spark, root):
    (root / "in" / "z.tar.gz").write_bytes(tar_of(["p/q.png", "p/._q.png"]))
    (root / "list.txt").write_text("# images\nin/a.png\nin/z.tar.gz\nlist.txt\n")
    got, counts = files.stage_inputs(spark, [f"{root}/in, {root}/list.txt", f"{root}/list.txt"])
    assert sorted(r["path"].removeprefix(str(root)) for r in got.collect()) == sorted(["/in/a.png", next(f"/in/{p.relative_to(root / 'in')}" for p in (root / "in").rglob("c.JPG")), "/in/z.tar.gz!p/q.png"])
    assert {r["path"].rsplit("/", 1)[1]: r["kind"] for r in got.collect()} == {"a.png": "directory", "c.JPG": "directory", "q.png": "archive"}
    assert counts == {"file": 1, "directory": 1, "archive": 1, "manifest": 1}
    assert files.stage_inputs(spark, [f"{root}/in"], max_pages=1)[0].count() == 1
    with pytest.raises(FileNotFoundError):
        files.stage_inputs(spark, [f"{root}/none.png"])
    (root / "list.md").write_text("x")
    with pytest.raises(ValueError):
        files.stage_inputs(spark, [f"{root}/list.md"])
    with pytest.raises(FileNotFoundError, match="1 paths"):
        files.require_listed(spark.createDataFrame([("/no/a.png",)], "path string"), files.listing(spark, f"{root}/in"))
    assert [os.path.basename(r["path"]) for r in files.image_manifest(spark, f"{root}/in").collect()] == ["a.png", "c.JPG"]


def test_lists_that_name_each_other_are_read_once(spark, tmp_path):
    (tmp_path / "d/e").mkdir(parents=True)
    for n in range(30):
        (tmp_path / f"d/{n}.png").write_bytes(b"x")
    text = {"top.txt": "d/left.lst\nd/right.csv\n", "d/left.lst": "e/deep.txt\n0.png\n../top.txt\n", "d/right.csv": "./e/../e/deep.txt\n1.png\n0.png\n", "d/e/deep.txt": "".join(f"../{n}.png\n" for n in range(2, 30)) + "../../d/left.lst\n"}
    for name, lines in text.items():
        (tmp_path / name).write_text(lines)
    got, counts = files.stage_inputs(spark, [f"{tmp_path}/top.txt"])
    assert sorted(r["path"] for r in got.collect()) == sorted(f"{tmp_path}/d/{n}.png" for n in range(30))
    assert counts == {"file": 31, "directory": 0, "archive": 0, "manifest": 4}
    (tmp_path / "d/e/deep.txt").write_text("../31.png\n")
    with pytest.raises(FileNotFoundError, match="31.png"):
        files.stage_inputs(spark, [f"{tmp_path}/top.txt"])


def test_members_are_read_by_their_places(spark, tmp_path):
    body = {f"p/{n}.png": os.urandom(1000 + n) * (1 + n % 3) for n in range(40)} | {"p/empty.png": b"", "p/repeat.png": b"1"}
    with zipfile.ZipFile(tmp_path / "z.ZIP", "w") as f:
        for n, (name, raw) in enumerate(body.items()):
            f.writestr(name, raw, [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2][n % 3])
    for name, mode in (("t.tar", "w:"), ("t.tar.xz", "w:xz")):
        with tarfile.open(tmp_path / name, mode) as t:
            for member, raw in [*body.items(), ("p/repeat.png", b"2"), ("notes.txt", b"x")]:
                info = tarfile.TarInfo(member)
                info.size = len(raw)
                t.addfile(info, io.BytesIO(raw))
            link = tarfile.TarInfo("p/link.png")
            link.type, link.linkname = tarfile.SYMTYPE, "0.png"
            t.addfile(link)
    paths = spark.createDataFrame([(f"{tmp_path}/{n}",) for n in ("z.ZIP", "t.tar", "t.tar.xz", "t.tar")], "path string")
    got = sorted((r["archive"].rsplit("/", 1)[1], r["member"], bytes(r["content"])) for r in archives.members(paths).collect())
    twice = [*body.items(), ("p/repeat.png", b"2")]
    assert got == sorted([("z.ZIP", *x) for x in body.items()] + [(a, *x) for a in ("t.tar", "t.tar.xz") for x in twice])
    entries = archives.directory(paths)
    assert {r["way"] for r in entries.collect()} == {"stored", "deflated", "other zip", "tar", "stream"}
    assert entries.filter("archive like '%t.tar'").count() == len(twice) and archives.members(paths.filter("false")).count() == 0
    raw = bytearray((tmp_path / "z.ZIP").read_bytes())
    raw[100] ^= 255
    (tmp_path / "bad.zip").write_bytes(raw)
    with pytest.raises(Exception, match="is damaged"):
        archives.members(spark.createDataFrame([(f"{tmp_path}/bad.zip",)], "path string")).collect()


def test_lines_are_one_file_in_order_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(200_000, numPartitions=7).select((-F.col("id")).alias("line"), F.concat(F.lit("é"), F.col("id").cast("string")).alias("value"), F.lit(1).alias("part"))
    sinks.write_lines(rows, f"{tmp_path}/a/x.jsonl")
    assert (tmp_path / "a/x.jsonl").read_text() == "".join(f"é{i}\n" for i in range(199_999, -1, -1))
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.endswith(".crc")] == ["x.jsonl"]
    with pytest.raises(FileExistsError):
        sinks.write_lines(rows, f"{tmp_path}/a/x.jsonl")
    sinks.write_lines(rows.filter("false"), f"file:{tmp_path}/b.jsonl")
    assert (tmp_path / "b.jsonl").read_text() == ""
