"""The staged run: results of the layout models, their fusion, rankings for review and transcripts, from one configuration document."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import adapters, sinks
from quire.operators import fusion as Z
from quire.operators import ocr as O
from quire.operators import spatial as S
from quire.plans.stages import Stage, Tables, progress, run_stages
from quire.sources import files, results

# The models whose results are fused, by stage, with what counts where the configuration says nothing.
VARIANTS = {"pld_v2_thr03": "pld_v2", "pld_v3_thr03": "pld_v3", "pld_plusL_thr03": "pld_plusL"}
SOURCES = {"paddle_vl15": ("pvl15_docparser_v15", "pvl15", "paddle"), "dell": ("dell_c0005_i010", "dell", "dell"), "mineru": ("mineru25", "mineru25", "mineru")}
REPO_FOLDERS = ("src/", "scripts/", "torch/", "docs/", "configs/")
RECOMMENDED = "P4"
LABELS = ("text", "title")
DONE = ("ok", "resume")


def _text(v) -> str:
    return os.path.expandvars(str(v))


def _labels(v) -> tuple[str, ...]:
    """Names in lower case, from a list or parted by commas; none are the usual ones."""
    names = v if isinstance(v, list) else str(v).split(",")
    return tuple(x for x in (str(n).strip().lower() for n in names) if x) or LABELS


def _words(v) -> tuple[str, ...]:
    return tuple(map(str, v))


@dataclass(frozen=True)
class Setting:
    """How a value is read, and what counts without one; searched: a path that is looked for as `found_path` says."""

    read: Callable
    default: object
    searched: bool = False


def _source_settings(variant: str) -> dict[str, Setting]:
    return {"enabled": Setting(bool, True), "variant_id": Setting(str, variant), "command": Setting(_words, ()), "cwd": Setting(str, "", searched=True), "timeout_sec": Setting(int, 3600), "min_nonempty_pages": Setting(int, 1), "max_pages": Setting(int, 0)}


#: Sections of the document; "" is its top.
SETTINGS = {
    "": {"run_name": Setting(str, "run"), "resume": Setting(bool, True), "page_width": Setting(int, 1000), "page_height": Setting(int, 1400)},
    "fusion": {"line_cover_threshold": Setting(float, 0.5), "recommended_variant": Setting(str, RECOMMENDED)},
    "review": {"mode": Setting(str, "all"), "top_k_informative": Setting(int, 20), "top_k_miner_delta": Setting(int, 20)},
    "transcription": {"enabled": Setting(bool, True), "variant": Setting(str, ""), "labels": Setting(_labels, LABELS), "min_overlap": Setting(float, 0.30), "max_pages": Setting(int, 0)},
    **{stage: _source_settings(variant) for stage, (variant, _, _) in SOURCES.items()},
}
LAYOUT_VARIANT = {"model_name": Setting(str, ""), "threshold": Setting(float, 0.30), "timeout_sec": Setting(int, 2700), "command": Setting(_words, ())}


def found_path(spark: SparkSession, raw: str, folder: str) -> str:
    """A configured path as it is used: absolute ones as they stand, others from the first folder that has them.

    Those are the configuration's folder, the one above it and the working folder; for the folders of a checkout the working folder is
    asked first and the configuration's own last.  A path found nowhere stays relative.
    """
    path = os.path.expanduser(_text(raw))
    if not path or path.startswith("/") or ":" in path.split("/", 1)[0]:
        return path
    own, above, here = folder, folder.rsplit("/", 1)[0] if "/" in folder else folder, os.getcwd()
    tried = (here, above, own) if path.replace("\\", "/").startswith(REPO_FOLDERS) else (own, above, here)
    return next((at for at in (f"{f}/{path}" for f in tried) if files.exists(spark, at)), path)


def _section(spark: SparkSession, raw, settings: dict[str, Setting], folder: str, at: str) -> dict:
    if not isinstance(raw, dict):
        raise ValueError(f"{at or 'the configuration'} must be an object")
    out = {}
    for name, s in settings.items():
        try:
            value = s.default if raw.get(name) is None else s.read(raw[name])
        except (TypeError, ValueError) as e:
            raise ValueError(f"{at}.{name} cannot be read: {e}") from e
        out[name] = found_path(spark, value, folder) if s.searched else value
    return out


def resolved(spark: SparkSession, path: str) -> dict:
    """The whole configuration that a document stands for, defaults and paths filled in; it can be written as JSON and read again.

    manifest_path and run_root must be given; they are taken from the document's folder, $VAR and ~ replaced.
    """
    raw = json.loads(spark.read.text(path, wholetext=True).first()[0])
    folder = path.rsplit("/", 1)[0] if "/" in path else "."
    out = _section(spark, raw, SETTINGS[""], folder, "")
    for name in ("manifest_path", "run_root"):
        given = os.path.expanduser(_text(raw.get(name) or "").strip())
        if not given:
            raise ValueError(f"{name} is missing")
        out[name] = given if given.startswith("/") or ":" in given.split("/", 1)[0] else f"{folder}/{given}"
    for name, settings in SETTINGS.items():
        if name:
            out[name] = _section(spark, raw.get(name) or {}, settings, folder, name)
    variants = raw.get("paddle_layout_variants") or [{"variant_id": v, "model_name": m} for v, m in VARIANTS.items()]
    out["paddle_layout_variants"] = [{"variant_id": str(v["variant_id"])} | _section(spark, v, LAYOUT_VARIANT, folder, f"paddle_layout_variants[{i}]") for i, v in enumerate(variants)]
    return out


def pages_of(spark: SparkSession, manifest: str) -> DataFrame:
    """page_id (the file's stem; the last line of each counts), image_path, ord of the images that a list names; lost ones and an empty list raise."""
    listed = files.path_list(spark, manifest)
    if listed.isEmpty():
        raise ValueError(f"{manifest} names no images")
    folders = [r[0] for r in listed.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]  # folders, not images
    there = reduce(DataFrame.unionByName, (files.listing(spark, f, recursive=False).select("path") for f in folders if files.exists(spark, f)), spark.createDataFrame([], "path string"))
    files.require_listed(listed, there)
    pages = listed.groupBy("slug").agg(F.max_by("path", "line").alias("image_path"), F.max("line").alias("ord"))
    return pages.withColumnRenamed("slug", "page_id")


def stored_state(spark: SparkSession, pattern: str) -> str:
    """Tells one state of the files that fit a pattern from another, by their names, lengths and times; they are listed, not read."""
    if not files.matches(spark, pattern):
        return "none"
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    found = spark.read.format("binaryFile").load(pattern).agg(F.count(F.lit(1)).alias("n"), F.sum(each).alias("state")).first()
    return f"{found['n']} {found['state']}"


def model_pages(spark: SparkSession, pages: DataFrame, run_dir: str, stage: str, variant: str, model: str, family: str, command: tuple[str, ...] = (), timeout: int = 3600, cwd: str = "", max_pages: int = 0) -> DataFrame:
    """page_id, variant, model, family, status, error, payload of a model's every page (the first max_pages by ord, if above 0).

    With a command, the workers run it for each page; else stored documents are read, outputs/sources/stage/variant/page_id/*.json
    below run_dir, and pages without one are missing.
    """
    own = pages.orderBy("ord").limit(max_pages) if max_pages > 0 else pages
    if command:
        done = adapters.run_command(own, adapters.Command(variant, command, timeout, cwd=cwd), {"run_dir": run_dir})
        said = done.select("page_id", "status", "error", "payload")
    else:
        root = f"{run_dir}/outputs/sources/{stage}/{variant}"
        stored = spark.createDataFrame([], "page_id string, payload string")
        if files.matches(spark, f"{root}/*/*.json"):
            at = F.col("_metadata.file_path")
            read = spark.read.text(f"{root}/*/*.json", wholetext=True).select(F.element_at(F.split(at, "/"), -2).alias("page_id"), at.alias("file"), F.col("value").alias("payload"))
            boxes = F.col("file").endswith("layout_boxes.normalized.json")
            stored = read.groupBy("page_id").agg(F.min_by("payload", F.struct(~boxes, F.col("file"))).alias("payload"))
        said = own.select("page_id").join(stored, "page_id", "left").select("page_id", F.when(F.col("payload").isNull(), "missing").otherwise("ok").alias("status"), F.lit(None).cast("string").alias("error"), "payload")
    return said.select("page_id", *[F.lit(v).alias(n) for n, v in (("variant", variant), ("model", model), ("family", family))], "status", "error", "payload")


def boxes_of(model_pages_: DataFrame) -> DataFrame:
    """Boxes of all models' pages: records under boxes, res or layout_det_res; place numbers a model's records on a page."""
    value = F.try_parse_json("payload")
    lists = [F.try_variant_get(value, p, "array<variant>") for p in ("$.res.boxes", "$.layout_det_res.boxes", "$.boxes")]
    each = model_pages_.select(F.col("page_id").alias("slug"), "model", "family", F.posexplode(F.coalesce(*lists)).alias("place", "record"))
    paddle = results.paddle_boxes(each.filter("family = 'paddle'"), "")
    other = results.external_boxes(each.filter("family <> 'paddle'"), "", "")
    both = paddle.unionByName(other).withColumns({"source_family": F.col("family"), "source_model": F.col("model"), "page_id": F.col("slug")})
    return both.select("page_id", "place", "source_family", "source_model", "norm_label", *S.XY, "score", "text")


def _boxes(made: Tables) -> Tables:
    return {"boxes": boxes_of(made["pages"])}


def _nonempty(least: int, model: str) -> Callable[[Tables], None]:
    def check(made: Tables) -> None:
        ok = made["pages"].filter(F.col("status").isin(*DONE)).count()
        results.require_nonempty(ok, made["boxes"].select("page_id").distinct().count(), least, model)

    return check


def stages_of(spark: SparkSession, config: dict, run_dir: str) -> list[Stage]:
    """The seven stages of a configuration: a stage for each source, fusion of all sources, review and transcription of the fusion.

    The state of the manifest and of stored results is among a stage's settings, so that it runs again when they change.
    """
    w, h, fusing, reviewing, reading = config["page_width"], config["page_height"], config["fusion"], config["review"], config["transcription"]
    manifest = config["manifest_path"]
    pages = lambda: pages_of(spark, manifest)
    stored = lambda below: stored_state(spark, f"{run_dir}/outputs/{below}")
    listed = [manifest, stored_state(spark, manifest)]

    def layout(_: dict) -> Tables:
        each = [model_pages(spark, pages(), run_dir, "paddle_layout", v["variant_id"], v["model_name"] or v["variant_id"], "paddle", tuple(v["command"]), v["timeout_sec"]) for v in config["paddle_layout_variants"]]
        return {"pages": reduce(DataFrame.unionByName, each)}

    def source(name: str) -> Stage:
        own, (_, model, family) = config[name], SOURCES[name]
        work = lambda _: {"pages": model_pages(spark, pages(), run_dir, name, own["variant_id"], model, family, tuple(own["command"]), own["timeout_sec"], own["cwd"], own["max_pages"])}
        return Stage(name, work, settings=own | {"manifest": listed, "stored": stored(f"sources/{name}/{own['variant_id']}/*/*.json") if own["enabled"] else ""}, enabled=own["enabled"], then=_boxes, check=_nonempty(own["min_nonempty_pages"], model) if name != "paddle_vl15" else None)

    def fuse(read: dict[str, Tables]) -> Tables:
        together = lambda name: reduce(DataFrame.unionByName, (tables[name] for tables in read.values()))
        seq = F.row_number().over(Z.Window.partitionBy("page_id").orderBy("source_model", "place"))
        return {"raw": together("boxes").withColumn("seq", seq).drop("place"), "statuses": together("pages").select("page_id", "variant", "model", "status", "error")}

    def fused(made: Tables) -> Tables:
        boxes, cover = made["raw"], fusing["line_cover_threshold"]
        lines, best = S.pseudo_lines(boxes, w, h), Z.best_singles(boxes, S.variant_members()["P1"], w, h)
        return {"measures": Z.measure(boxes, lines, w, h, cover), "boxes": Z.as_variants(Z.fuse(boxes, lines, w, h, cover), best)}

    def chosen(tables: Tables) -> str:
        return Z.recommended(tables["measures"], fusing["recommended_variant"]).first()["recommended"] or fusing["recommended_variant"]

    def review(read: dict[str, Tables]) -> Tables:
        m, variant = read["fusion"]["measures"], chosen(read["fusion"])
        order = Z.review_pages(m, pages(), variant, reviewing["mode"], reviewing["top_k_informative"])
        return {"variants": Z.variant_board(m), "sources": Z.source_board(m), "top_informative": Z.informative(m, variant, reviewing["top_k_informative"]), "top_delta": Z.delta(m, most=reviewing["top_k_miner_delta"]), "pages": order}

    def transcribe(read: dict[str, Tables]) -> Tables:
        variant = reading["variant"] or chosen(read["fusion"])
        own_boxes = read["fusion"]["boxes"].filter(F.col("variant") == variant)
        sound = O.ordered_boxes(own_boxes.withColumn("seq", F.col("reading_order")), reading["labels"])
        crops = O.crops(S.ocr_boxes(sound), w, h).withColumn("stem", F.format_string("crop_%04d", "box_index"))
        at, root = F.col("_metadata.file_path"), f"{run_dir}/outputs/transcription/{variant}"
        stored = spark.createDataFrame([], "page_id string, name string, payload string")
        if files.matches(spark, f"{root}/*/crop_*_res.json"):
            stored = spark.read.text(f"{root}/*/crop_*_res.json", wholetext=True).select(F.element_at(F.split(at, "/"), -2).alias("page_id"), F.element_at(F.split(at, "/"), -1).alias("name"), F.col("value").alias("payload"))
        stem = F.regexp_extract("name", r"^(crop_[0-9]+)", 1)
        best = stored.withColumn("stem", stem).groupBy("page_id", "stem").agg(F.min_by("payload", F.struct(F.col("name") != F.concat(stem, F.lit("_res.json")), F.col("name"))).alias("payload"))
        key = F.to_json(F.struct("page_id", "box_index"))
        heard = O.result_lines(crops.join(best, ["page_id", "stem"]).select(key.alias("key"), "payload"))
        of = F.from_json("key", "page_id string, box_index int")
        lines = O.on_page(heard.withColumn("of", of).select("of.*", "line", "text", *S.XY), crops, reading["min_overlap"])
        own = pages()
        own = own.orderBy("ord").limit(reading["max_pages"]) if reading["max_pages"] > 0 else own
        known = own.select("page_id", F.lit(True).alias("has_image")).join(own_boxes.select("page_id").distinct().withColumn("f", F.lit(True)), "page_id", "left").select("page_id", "has_image", F.coalesce("f", F.lit(False)).alias("has_fused"))
        return {"crops": crops, "texts": O.page_texts(O.box_texts(crops, lines)).join(own.select("page_id"), "page_id", "left_semi"), "report": O.transcription_report(known, sound, crops, lines)}

    sources = ("paddle_layout", *SOURCES)
    shared = {"width": w, "height": h, "manifest": listed}
    return [
        Stage("paddle_layout", layout, settings={"variants": config["paddle_layout_variants"], "manifest": listed, "stored": stored("sources/paddle_layout/*/*/*.json")}, then=_boxes),
        *map(source, SOURCES),
        Stage("fusion", fuse, sources, fusing | shared, then=fused),
        Stage("review", review, ("fusion",), reviewing | shared),
        Stage("transcription", transcribe, ("fusion",), reading | shared | {"stored": stored("transcription/*/*/crop_*_res.json")}, reading["enabled"]),
    ]


def run(spark: SparkSession, config_path: str, run_dir: str | None = None, chosen: list[str] | None = None) -> dict:
    """Run the chosen stages of a configuration (all, if None) below run_dir, run_root/run_name if not given; the resolved configuration is kept beside them."""
    config = resolved(spark, config_path)
    run_dir = (run_dir or f"{config['run_root']}/{config['run_name']}").rstrip("/")
    report = run_stages(spark, stages_of(spark, config, run_dir), f"{run_dir}/stages", chosen, config["resume"])
    sinks.replace_json_document(spark, config, f"{run_dir}/manifests/config.resolved.json")
    return {"run_dir": run_dir, "stages": report}


def status(spark: SparkSession, run_dir: str) -> dict:
    """What a run has done by its own configuration, kept beside it: each stage's state, and of each source's pages the counts by status."""
    run_dir = run_dir.rstrip("/")
    config = resolved(spark, f"{run_dir}/manifests/config.resolved.json")
    return {"run_dir": run_dir, "total_pages": pages_of(spark, config["manifest_path"]).count(), "stages": progress(spark, stages_of(spark, config, run_dir), f"{run_dir}/stages")}
