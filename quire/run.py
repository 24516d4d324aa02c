"""Whole runs: planning, the run of a plan's models with fusion and reports, validation of a run's folder, fusion of stored results.

A run's folder holds documents and lists as JSON and one file for each page's result, so that it can be read without Spark; the work in between
is done on tables.
"""

from __future__ import annotations

import json
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import adapters, sinks
from quire.functions import layout as L
from quire.operators import checks as C
from quire.operators import fusion as Z
from quire.operators import page_fusion as G
from quire.operators import performance as P
from quire.operators import run_checks as R
from quire.operators import spatial as S
from quire.operators import validation as V
from quire.plans import profile as I
from quire.plans import routing as O
from quire.sources import bundle as B
from quire.sources import files, legacy, results

STAGES = ("fusion", "review")
TIMING = ("page_id", "stage", "model_id", "family", "seconds", "status", "resource_class", "profile_name", "estimated_complexity")


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A manifest's rows with image paths taken from its folder, and the issues of reading it."""
    lines = files.json_lines(spark, path, comments=True)
    folder = path.rsplit("/", 1)[0] if "/" in path else "."
    rows = B.manifest_rows(lines.filter("code is null"))
    absolute = F.when(F.col("image_path").rlike("^(/|[a-z]+:)") | (F.col("image_path") == ""), F.col("image_path")).otherwise(F.concat(F.lit(folder + "/"), F.col("image_path")))
    faults = C.issues(lines.filter("code is not null"), [C.when(F.col("code") == c, c, F.concat_ws(" ", F.lit("line"), F.col("line").cast("string"))) for c in ("invalid_jsonl", "invalid_jsonl_row")], page=None)
    return rows.withColumn("image_path", absolute), faults


def manifest_report(spark: SparkSession, path: str, images: str | None = None, require_files: bool = False, require_checksums: bool = False, verify_checksums: bool = False, strict: bool = False) -> tuple[dict, list[dict]]:
    """status and counts of a manifest, and its issues; images: the folder below which its images lie, its own if not given."""
    rows, faults = read_manifest(spark, path)
    root = images or (path.rsplit("/", 1)[0] if "/" in path else ".")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.*").load(root).filter(F.col("path").rlike(files.IMAGES))
    bare = F.regexp_replace("path", "^[a-z]+:/+", "/").alias("image_path")
    known = found.select(bare, (F.sha2("content", 256) if verify_checksums else F.lit(None).cast("string")).alias("checksum"))
    rows = rows.withColumn("image_path", F.regexp_replace("image_path", "^[a-z]+:/+", "/"))
    issues = C.together(C.manifest_issues(rows, known, require_files, require_checksums, verify_checksums), faults)
    safe = F.when(L.portable_id(C.text("page_id")), C.text("page_id"))
    there = known.select("image_path").distinct().withColumn("there", F.lit(True))
    counts = rows.join(there, "image_path", "left").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(safe).alias("unique_page_ids"), F.count("there").alias("rows_with_files"), F.count_if(C.text("checksum") != "").alias("rows_with_checksums"),
        F.count_distinct(F.when((F.col("source_kind") == "object") & (C.text("source_system") != ""), C.text("source_system"))).alias("source_systems"),
    ).first().asDict()
    roll = V.issue_rollup(issues, strict).first()
    counts |= {"errors": roll["errors"], "warnings": roll["warnings"]}
    return {"contract": "parse-input-manifest-validation-v1", "status": roll["status"], "manifest_path": path, "counts": counts}, [r.asDict() for r in issues.orderBy(*issues.columns).limit(1000).collect()]  # a report shows 50


def prepare(spark: SparkSession, manifest: str, run_dir: str, profile: str = "adaptive", config: str | None = None, images: str | None = None) -> dict:
    """Check the manifest, profile its pages, route them; write the plan into a fresh run_dir.  Tables and adapters of the plan."""
    run_dir = run_dir.rstrip("/")
    sinks.require_fresh(spark, run_dir)
    report, issues = manifest_report(spark, manifest, images, require_files=True, verify_checksums=True)
    sinks.write_json_document(spark, report | {"issues": issues}, f"{run_dir}/reports/input_manifest_validation.json")
    if report["status"] == "error":
        raise ValueError(f"the manifest has errors: {run_dir}/reports/input_manifest_validation.json")
    rows, _ = read_manifest(spark, manifest)
    pages = rows.select("line", "page_id", "image_path", "issue_id", F.expr("try_cast(page_number as int)").alias("page_number"), "checksum")
    chosen = O.adapters_for(profile, O.load_config(spark, config))
    root = images or (manifest.rsplit("/", 1)[0] if "/" in manifest else ".")
    profiles = I.image_profiles(spark, pages, root).persist()
    plan = O.route(profiles, chosen).persist()
    n = {(r["kind"], r["name"]): r["n"] for r in O.plan_summary(plan).collect()}  # models, classes and complexities
    models = [a.model_id for a in chosen if ("model", a.model_id) in n]
    of = lambda kind: {k: v for (what, k), v in sorted(n.items()) if what == kind}
    summary = {
        "contract": R.PLAN_SUMMARY_CONTRACT, "profile_name": profile, "pages_planned": n["pages", ""], "adapter_invocations_planned": n["invocations", ""], "model_ids": models,
        "resource_classes": sorted(of("resource_class")), "complexity_counts": of("complexity"), "resource_class_invocation_counts": of("resource_class"),
        "models": {a.model_id: {"family": a.family, "resource_class": a.resource_class, "complexities": list(a.complexities), "pages_planned": n["model", a.model_id]} for a in chosen if a.model_id in models},
    }
    embedded = profiles.select("page_id", F.struct(F.col("page_id"), "width", "height", "aspect_ratio", "mean_luma", F.col("dark_share").alias("dark_pixel_share"), F.col("complexity").alias("estimated_complexity")).alias("profile"))
    rows_ = O.plan_rows(plan, profile).join(embedded, "page_id").join(pages.select("page_id", "line"), "page_id")
    sinks.write_lines(pages.select("line", F.to_json(F.struct("page_id", "image_path", "issue_id", "page_number", F.col("checksum").alias("checksum_sha256"))).alias("value")), f"{run_dir}/manifests/parse_input.jsonl")
    sinks.write_lines(rows_.select("line", F.to_json(F.struct(*sorted(c for c in rows_.columns if c != "line"))).alias("value")), f"{run_dir}/manifests/model_plan.jsonl")
    sinks.write_json_document(spark, summary, f"{run_dir}/reports/plan_summary.json")
    return {"pages": pages, "profiles": profiles, "plan": plan, "adapters": chosen, "summary": summary, "report": report}


def canary(spark: SparkSession, manifest: str, run_dir: str, profile: str = "adaptive", config: str | None = None, images: str | None = None) -> dict:
    """Plan and run: built-in models as columns, commands in the workers; fuse pages, write results and reports.  The headline figures."""
    began, run_dir = time.monotonic(), run_dir.rstrip("/")
    p = prepare(spark, manifest, run_dir, profile, config, images)
    plan, pages = p["plan"], p["pages"].join(p["profiles"].select("page_id", "width", "height"), "page_id")
    sized = plan.join(p["profiles"].select("page_id", F.col("width").alias("w"), F.col("height").alias("h")), "page_id")
    builtin = O.builtin_regions(sized.select("page_id", "w", "h", "complexity").distinct()).join(plan.select("page_id", "model_id"), ["page_id", "model_id"], "left_semi")
    region = F.struct("region_id", F.array(*[F.col(c).cast("double") for c in S.XY]).alias("bbox_xyxy"), "label", "confidence", F.col("model_id").alias("source_model"), "text", "reading_order", F.array("model_id").alias("provenance"))
    made = builtin.groupBy("page_id", "model_id").agg(F.array_sort(F.collect_list(region)).alias("regions"))
    outcomes = [made.select("page_id", "model_id", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error"), F.to_json(F.struct("page_id", "model_id", "regions")).alias("payload"), F.lit(0.0).alias("seconds"))]
    context = {"manifest_dir": manifest.rsplit("/", 1)[0], "run_dir": run_dir}
    for a in p["adapters"]:
        if a.command:
            own = pages.join(plan.filter(F.col("model_id") == a.model_id).select("page_id"), "page_id", "left_semi")
            outcomes.append(adapters.run_command(own, a.command, context))
        elif a.imports:
            outcomes.append(_imported(spark, pages.join(plan.filter(F.col("model_id") == a.model_id).select("page_id"), "page_id", "left_semi"), a))
    run = reduce(DataFrame.unionByName, outcomes).join(plan.drop("complexity"), ["page_id", "model_id"]).persist()
    read = B.output_regions(run).persist()
    bad = read.filter("error is not null").select("page_id", "model_id", F.col("error_type").alias("et"), F.col("error").alias("er"))
    run = run.join(bad, ["page_id", "model_id"], "left").select(*[c for c in run.columns if c not in ("status", "error_type", "error")], F.when(F.col("er").isNotNull(), "error").otherwise(F.col("status")).alias("status"), F.coalesce("et", "error_type").alias("error_type"), F.coalesce("er", "error").alias("error"))
    ok = run.filter("status <> 'error'")
    regions = read.filter("error is null").join(ok.select("page_id", "model_id", F.col("ord").alias("model_ord")), ["page_id", "model_id"])
    fused = G.fused_pages(regions, ok.select("page_id", "model_id", F.col("ord").alias("model_ord"))).persist()
    _write_outputs(run_dir, ok, regions, fused, run)
    timings, errors = _timings(p, run, fused, profile)
    sinks.write_lines(timings.select("line", F.to_json(F.struct(*TIMING)).alias("value")), f"{run_dir}/reports/performance.jsonl")
    sinks.write_lines(errors.select("line", F.to_json(F.struct("scope", "page_id", "stage", "model_id", "status", "error_type", "error")).alias("value")), f"{run_dir}/errors.jsonl")
    scope = {r["scope"]: r["n"] for r in errors.groupBy("scope").agg(F.count(F.lit(1)).alias("n")).collect()}
    seconds, completed, attempted = round(time.monotonic() - began, 6), fused.count(), p["summary"]["pages_planned"]
    observed = run.count()
    performance = {
        "seconds_total": seconds, "pages_attempted": attempted, "pages_completed": completed, "pages_per_minute": round(completed / seconds * 60, 6) if seconds else 0, "pages_failed": scope.get("page", 0),
        "adapter_invocations_planned": p["summary"]["adapter_invocations_planned"], "adapter_invocations_observed": observed, "adapter_errors": scope.get("adapter", 0), "errors": sum(scope.values()),
    }
    provenance = {"contract_version": "parser-bagging-v2", "model_plan_contract": O.CONTRACT, "performance_contract": R.PERFORMANCE_CONTRACT, "bagging_config": config or "", "input_manifest_validation_status": p["report"]["status"]}
    outputs = {"model_plan": "manifests/model_plan.jsonl", "plan_summary": "reports/plan_summary.json", "model_outputs": "outputs/model_outputs", "fused_pages": "outputs/fused_pages", "transcripts": "outputs/transcripts", "performance_summary": "reports/performance_summary.json"}
    summary = {"run_id": run_dir.rsplit("/", 1)[-1], "run_dir": run_dir, "input_manifest": manifest, "profile": profile, "page_count": attempted, "model_ids": p["summary"]["model_ids"], "outputs": outputs, "performance": performance, "provenance": provenance}
    for name, value in (("summary.json", summary), ("reports/performance.json", performance), ("provenance.json", provenance)):
        sinks.write_json_document(spark, value, f"{run_dir}/{name}")
    sinks.write_json_document(spark, performance_report(spark, run_dir), f"{run_dir}/reports/performance_summary.json")
    return performance


def _imported(spark: SparkSession, pages: DataFrame, a: O.Adapter) -> DataFrame:
    """Outcomes from an older run's stored results, found by the image's name; absent ones are skipped or, where they must be there, errors."""
    folder, name = a.imports["pattern"].split("/{image_stem}/")
    stored = B._each(spark, f"{folder}/*/{name}", folder, [B._at(-2).alias("stem")], "stem string, value string")
    own = pages.select("page_id", files.stem(F.col("image_path")).alias("stem")).join(stored, "stem", "left").select("page_id", F.col("value").alias("payload")).persist()
    r = legacy.legacy_regions(own, a.model_id, a.imports.get("source_family", ""))
    region = F.struct("region", "region_id", F.array(*S.XY).alias("bbox_xyxy"), "label", "confidence", "source_model", "text", "reading_order", "provenance")
    made = r.groupBy("page_id", "model_id").agg(F.transform(F.array_sort(F.collect_list(region)), lambda x: x.dropFields("region")).alias("regions"))
    state = legacy.legacy_outcome(own, a.model_id).join(made, ["page_id", "model_id"], "left")
    lost = F.lit(not a.imports.get("allow_missing", True)) & (F.col("status") == "skipped")
    payload = F.when(F.col("regions").isNull(), F.to_json(F.struct("page_id", "model_id"))).otherwise(F.to_json(F.struct("page_id", "model_id", "regions")))
    return state.select("page_id", "model_id", F.when(lost, "error").otherwise(F.col("status")).alias("status"), F.when(lost, "FileNotFoundError").otherwise(F.col("error")).alias("error_type"), F.when(lost, "no stored result").otherwise(F.col("error")).alias("error"), payload.alias("payload"), F.lit(0.0).alias("seconds"))


def _write_outputs(run_dir: str, ok: DataFrame, regions: DataFrame, fused: DataFrame, run: DataFrame) -> None:
    """One file for each output, fused page, transcript and review note."""
    region = F.struct("region_ord", "region_id", F.array(*S.XY).alias("bbox_xyxy"), "label", "confidence", "source_model", "text", "reading_order", "provenance")
    per = regions.groupBy("page_id", "model_id").agg(F.transform(F.array_sort(F.collect_list(region)), lambda r: r.dropFields("region_ord")).alias("regions"))
    runtime = F.struct("seconds", "resource_class", "status")
    out = ok.join(per, ["page_id", "model_id"], "left").withColumn("regions", F.coalesce("regions", F.from_json(F.lit("[]"), per.schema["regions"].dataType)))
    sinks.write_files(out.select(F.concat_ws("/", F.lit("model_outputs"), "model_id", F.concat("page_id", F.lit(".json"))).alias("path"), F.to_json(F.struct("page_id", "model_id", "regions", runtime.alias("runtime"))).alias("value")), f"{run_dir}/outputs")
    ordered = F.struct("fused_order", "region_id", F.array(*S.XY).alias("bbox_xyxy"), "label", "confidence", "source_model", "text", "reading_order")
    kept = G.fused_regions(regions).groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(ordered)), lambda r: r.dropFields("fused_order")).alias("regions"))
    whole = fused.join(kept, "page_id", "left").withColumn("regions", F.coalesce("regions", F.from_json(F.lit("[]"), kept.schema["regions"].dataType)))
    quality = F.struct("region_count", F.col("text_count").alias("text_region_count"), F.col("legal_count").alias("legal_notice_candidate_count"))
    document = F.to_json(F.struct("page_id", "model_ids", "transcript", "regions", F.col("disagreement").alias("disagreement_score"), quality.alias("quality")))
    sinks.write_files(whole.select(F.concat(F.lit("fused_pages/"), "page_id", F.lit(".json")).alias("path"), document.alias("value")), f"{run_dir}/outputs")
    sinks.write_files(fused.select(F.concat(F.lit("transcripts/"), "page_id", F.lit(".txt")).alias("path"), F.concat("transcript", F.lit("\n")).alias("value")), f"{run_dir}/outputs")
    work = run.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "model_id"))), lambda m: m["model_id"]), ", ").alias("planned"), F.count_if(F.col("status") == "error").alias("failed"))
    note = sinks.review_note(F.col("page_id"), **{"planned models": F.col("planned"), "completed models": F.array_join("model_ids", ", "), "regions": F.col("region_count"), "disagreement_score": F.col("disagreement"), "adapter_errors": F.col("failed")})
    sinks.write_files(fused.join(work, "page_id").select(F.concat("page_id", F.lit(".md")).alias("path"), F.concat(note, F.lit("\n")).alias("value")), f"{run_dir}/review")


def _timings(p: dict, run: DataFrame, fused: DataFrame, profile: str) -> tuple[DataFrame, DataFrame]:
    """Timing and error rows in page order.  Models are timed where they run; work on tables is timed as a whole, so its rows have 0 seconds."""
    page = p["profiles"].select("page_id", "complexity").join(p["pages"].select("page_id", F.col("line").alias("page_line")), "page_id")
    done = fused.select("page_id").withColumn("done", F.lit(True))
    total = run.groupBy("page_id").agg(F.sum("seconds").alias("seconds"), F.when(F.min("resource_class") == F.max("resource_class"), F.min("resource_class")).otherwise("mixed").alias("resource_class"))
    row = lambda d, at, stage, model, family, seconds, status, cls: d.select("page_line", F.lit(at).alias("at"), "page_id", F.lit(stage).alias("stage"), model.alias("model_id"), family.alias("family"), seconds.alias("seconds"), status.alias("status"), cls.alias("resource_class"), F.lit(profile).alias("profile_name"), F.col("complexity").alias("estimated_complexity"))
    none, zero, ok, cpu = F.lit(""), F.lit(0.0), F.lit("ok"), F.lit("cpu")
    parts = [
        row(page, 0, "page_profile", none, F.lit("profiler"), zero, ok, cpu),
        row(run.join(page, "page_id"), 1, P.ADAPTER, F.col("model_id"), F.col("family"), F.col("seconds"), F.col("status"), F.col("resource_class")),
        row(page.join(done, "page_id"), 2, "fusion", none, F.lit("fusion"), zero, ok, cpu),
        row(page.join(total, "page_id").join(done, "page_id", "left"), 3, "page_total", none, F.lit("orchestration"), F.col("seconds"), F.when(F.col("done"), "ok").otherwise("error"), F.col("resource_class")),
    ]
    timings = reduce(DataFrame.unionByName, parts).withColumn("line", F.struct("page_line", "at", "model_id"))
    lost = page.join(done, "page_id", "left_anti").select("page_line", F.lit("page").alias("scope"), "page_id", F.lit("fusion").alias("stage"), F.lit("").alias("model_id"), F.lit("error").alias("status"), F.lit("NoSuccessfulAdapters").alias("error_type"), F.lit("all planned model adapters failed").alias("error"))
    failed = run.filter("status = 'error'").join(page, "page_id").select("page_line", F.lit("adapter").alias("scope"), "page_id", F.lit(P.ADAPTER).alias("stage"), "model_id", "status", "error_type", "error")
    return timings, failed.unionByName(lost).withColumn("line", F.struct("page_line", "scope", "model_id"))


def performance_report(spark: SparkSession, run_dir: str) -> dict:
    """The performance summary of a run's folder, rebuilt from its timing rows and plan."""
    b = B.load_run(spark, run_dir)
    rows, plan = B.timing_rows(b.tables["timings"]), B.plan_rows(b.tables["plan"])
    planned = C.planned_models(plan)
    head, summary = b.documents["performance"] or {}, b.documents["summary"] or {}
    cover = P.coverage(planned, rows).first().asDict()
    names = {"planned": "planned_invocations", "observed": "observed_invocations", "successful": "successful_invocations", "failed": "failed_invocations", "missing": "missing_invocations", "unexpected": "unexpected_invocations", "coverage_ratio": "coverage_ratio"}
    samples = [r.asDict() for r in P.pair_samples(planned, rows).collect()]
    groups: dict[str, dict] = {k: {} for k in ("stage", "model", "model_family", "resource_class", "page_complexity")}
    for r in P.timing_breakdowns(rows).orderBy("breakdown", "value").collect():  # a row for each stage, model, family, class and complexity
        groups[r["breakdown"]][r["value"]] = {k: v for k, v in r.asDict().items() if k not in ("breakdown", "value")}
    for r in P.with_model_metadata(rows, planned.withColumn("ord", F.struct("line", "pos"))).collect():
        groups["model"][r["model_id"]] |= {"family": r["family"], "resource_class": r["resource_class"]}
    wall, completed = float(head.get("seconds_total") or 0), int(head.get("pages_completed") or 0)
    of = lambda kind: [{"page_id": x["page_id"], "model_id": x["model_id"]} for x in samples if x["kind"] == kind]
    return {
        "contract": R.PERFORMANCE_CONTRACT, "run_id": str(summary.get("run_id") or run_dir.rstrip("/").rsplit("/", 1)[-1]), "run_dir": run_dir, "profile": str(summary.get("profile") or ""), "wall_time_seconds": round(wall, 6),
        "pages_attempted": int(head.get("pages_attempted") or 0), "pages_completed": completed, "pages_failed": int(head.get("pages_failed") or 0), "pages_per_minute_wall": round(completed / wall * 60, 6) if wall > 0 else 0.0,
        "raw_rows": rows.count(), "coverage": {names[k]: v for k, v in cover.items()} | {"missing_sample": of("missing"), "unexpected_sample": of("unexpected")},
        **{f"by_{k}": v for k, v in groups.items()}, "slowest_rows": [r.asDict() for r in P.slowest(rows).collect()],
    }


def validate(spark: SparkSession, run_dir: str, strict: bool = False) -> tuple[dict, list[dict]]:
    """status and counters of a run's folder, and its issues."""
    run_dir = run_dir.rstrip("/")
    b = B.load_run(spark, run_dir)
    d = b.documents
    summary = d["summary"] if isinstance(d["summary"], dict) else None
    if summary is None:
        return {"status": "error", "run_dir": run_dir, "counts": {"errors": 1, "warnings": 0}}, [{"level": "error", "code": code, "page_id": "", "model_id": "", "detail": path} for code, path in b.faults if path == "summary.json"]
    performance = summary.get("performance") if isinstance(summary.get("performance"), dict) else {}
    profile, models = str(summary.get("profile") or ""), [str(m) for m in summary.get("model_ids") or [] if str(m)]
    pages = B.manifest_rows(b.tables["manifest"]).filter("page_id <> ''").select("page_id").persist()
    plan = B.plan_rows(b.tables["plan"])
    planned = C.planned_models(plan).join(pages, "page_id", "left_semi").persist()
    errors, timings = B.error_rows(b.tables["errors"]).persist(), B.timing_rows(b.tables["timings"]).persist()
    lost = errors.filter("scope = 'page' and page_id <> ''").select("page_id").distinct()
    failed = errors.filter("scope = 'adapter' and page_id <> '' and model_id <> ''").select("page_id", "model_id").distinct()
    completed = pages.join(lost, "page_id", "left_anti")
    own = timings.filter(F.col("stage") == P.ADAPTER)
    outputs, fused = b.tables["outputs"].persist(), b.tables["fused"].persist()
    wanted = planned.join(failed, ["page_id", "model_id"], "left_anti")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "model_id"))), lambda m: m["model_id"])
    expected = completed.distinct().join(wanted.groupBy("page_id").agg(ordered.alias("model_ids")), "page_id", "left").withColumn("model_ids", F.coalesce("model_ids", F.array().cast("array<string>")))
    pairs = R.pair_counts(planned, own, failed).persist()
    first = V.row_counts(
        page_count=pages, pages_completed=completed, pages_failed=lost, adapter_invocations_planned=planned, adapter_invocations_observed=own, adapter_errors=errors.filter("scope = 'adapter'"), errors=errors, performance_rows=timings,
    )
    counted = {k: n for k, n in first.items() if k != "performance_rows"}
    counted["pages_attempted"] = counted["page_count"]
    whole = lambda v: v if isinstance(v, int) and not isinstance(v, bool) else None
    said = {k: whole(performance.get(k)) for k in R.HEADLINE} | {"page_count": whole(summary.get("page_count"))}
    one = lambda row: spark.createDataFrame([tuple(row[k] for k in R.HEADLINE)], ", ".join(f"{k} long" for k in R.HEADLINE))
    there, rows = fused.select("page_id"), _report_row(d, summary, performance, profile, models, counted, pairs.first(), first["performance_rows"])
    regions = C.together(C.region_issues(B.regions_at(outputs.join(wanted, ["page_id", "model_id"], "left_semi"), "page_id", "model_id")), C.region_issues(B.regions_at(fused.join(expected, "page_id", "left_semi"), "page_id").withColumn("model_id", F.lit(""))))
    paths = spark.createDataFrame([(k, str(v)) for k, v in (summary.get("outputs") or {}).items()] or [("", "")], "name string, path string")
    issues = C.together(
        spark.createDataFrame([("error", code, "", "", path) for code, path in b.faults], C.ISSUE),
        V.path_issues(paths, run_dir if run_dir.startswith("/") else "/" + run_dir).select("level", "code", F.lit("").alias("page_id"), F.lit("").alias("model_id"), "detail"),
        C.model_plan_issues(plan, pages, profile, models), R.headline_issues(one(said), one(counted)), R.coverage_issues(pairs), C.timing_row_issues(timings, pages),
        R.report_issues(spark.createDataFrame([tuple(rows.values())], _REPORT)), C.model_output_issues(wanted.select("page_id", "model_id"), B.output_rows(outputs)), R.artifact_issues(planned, failed, outputs),
        C.fused_page_issues(expected, B.fused_rows(fused), b.tables["transcripts"]), R.page_artifact_issues(completed, there, b.tables["transcripts"]), regions,
    ).persist()
    roll = V.issue_rollup(issues, strict).first()
    kept = lambda docs, *k: C.valid_regions(B.regions_at(docs, *k))
    fused_pages = there.join(expected, "page_id", "left_semi")
    more = V.row_counts(
        model_plan_rows=plan, model_outputs=outputs.join(planned, ["page_id", "model_id"], "left_semi"), model_regions=kept(outputs.join(wanted, ["page_id", "model_id"], "left_semi"), "page_id"), fused_pages=fused_pages,
        fused_regions=kept(fused.join(expected, "page_id", "left_semi"), "page_id"), transcripts=b.tables["transcripts"].join(fused_pages, "page_id", "left_semi"),
    )
    statuses = B.output_rows(outputs).join(wanted, ["page_id", "model_id"], "left_semi").groupBy(F.coalesce(F.nullif("status", F.lit("")), F.lit("unknown")).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    counts = {
        "pages_manifest": counted["page_count"], "pages_completed": counted["pages_completed"], "pages_failed": counted["pages_failed"], "adapter_invocations_planned": counted["adapter_invocations_planned"], "models": len(models), **more,
        "performance_rows": first["performance_rows"], "page_errors": counted["pages_failed"], "adapter_errors": counted["adapter_errors"], "execution_errors": counted["errors"], "errors": roll["errors"], "warnings": roll["warnings"],
    }
    report = {"status": roll["status"], "run_dir": run_dir, "counts": counts, "runtime_status_counts": {r["status"]: r["n"] for r in statuses.orderBy("status").collect()}}
    return report, [r.asDict() for r in issues.orderBy(*issues.columns).limit(1000).collect()]  # a report shows 50


_REPORT = (
    "has_performance boolean, performance_fits boolean, has_plan boolean, plan_contract string, plan_profile string, plan_pages long, plan_planned long, plan_models array<string>, has_timing boolean, timing_contract string, raw_rows long, "
    "cover_planned long, cover_observed long, cover_missing long, cover_unexpected long, has_provenance boolean, provenance_fits boolean, has_manifest boolean, manifest_status string, "
    "own_profile string, own_pages long, own_planned long, own_models array<string>, own_raw_rows long, own_observed long, own_missing long, own_unexpected long"
)


def _report_row(d: dict, summary: dict, performance: dict, profile: str, models: list[str], counted: dict, pairs, raw_rows: int) -> dict:
    """The reports' statements beside what the run holds, as run_checks.report_issues takes them."""
    of = lambda k: d[k] if isinstance(d[k], dict) else {}
    whole = lambda v: v if isinstance(v, int) and not isinstance(v, bool) else None
    text = lambda v: v if isinstance(v, str) else None
    plan, timing = of("plan_summary"), of("performance_summary")
    cover = timing.get("coverage") if isinstance(timing.get("coverage"), dict) else {}
    named = plan.get("model_ids")
    return {
        "has_performance": isinstance(d["performance"], dict), "performance_fits": d["performance"] == performance, "has_plan": isinstance(d["plan_summary"], dict), "plan_contract": text(plan.get("contract")), "plan_profile": text(plan.get("profile_name")),
        "plan_pages": whole(plan.get("pages_planned")), "plan_planned": whole(plan.get("adapter_invocations_planned")), "plan_models": [str(m) for m in named] if isinstance(named, list) else None,
        "has_timing": isinstance(d["performance_summary"], dict), "timing_contract": text(timing.get("contract")), "raw_rows": whole(timing.get("raw_rows")),
        **{f"cover_{k}": whole(cover.get(f"{k}_invocations")) for k in ("planned", "observed", "missing", "unexpected")},
        "has_provenance": isinstance(d["provenance"], dict), "provenance_fits": d["provenance"] == summary.get("provenance"), "has_manifest": isinstance(d["manifest_report"], dict), "manifest_status": text(of("manifest_report").get("status")),
        "own_profile": profile, "own_pages": counted["page_count"], "own_planned": counted["adapter_invocations_planned"], "own_models": models, "own_raw_rows": raw_rows, "own_observed": pairs["observed"], "own_missing": pairs["missing"], "own_unexpected": pairs["unexpected"],
    }


def fuse_stored(spark: SparkSession, run_dir: str, width: int, height: int, wanted: str = "P4", threshold: float = 0.5, top: int = 20) -> dict:
    """Fuse an older run's stored results (pages of one size): the four tables of measures, both rankings, and the variant to use."""
    run_dir = run_dir.rstrip("/")
    raw = results.normalized_boxes(spark, f"{run_dir}/outputs/sources")
    order = Z.Window.partitionBy("page_id").orderBy("source_root", "variant", "seq")
    b = raw.withColumn("place", F.row_number().over(order)).select("page_id", F.col("place").alias("seq"), "source_family", "source_model", "norm_label", *S.XY, "score").persist()
    m = Z.measure(b, S.pseudo_lines(b, width, height), width, height, threshold).persist()
    out = f"{run_dir}/outputs/fusion"
    sinks.write_leaderboards(out, Z.variant_board(m), Z.source_board(m), Z.per_page(m, "variant"), Z.per_page(m, "source"))
    chosen = Z.recommended(m, wanted).first()
    for name, rows in (("top_informative", Z.informative(m, chosen["recommended"] or wanted, top)), ("top_delta", Z.delta(m, most=top))):
        sinks.write_tsv(rows.orderBy("rank"), f"{run_dir}/review/{name}/ranking.tsv", sinks.RANKING)
    summary = {"best_variant_by_score": chosen["best_by_score"], "recommended_variant": chosen["recommended"], "preferred_recommended_variant": wanted, "pages": m.select("page_id").distinct().count()}
    sinks.write_json_document(spark, summary, f"{out}/summary.json")
    m.unpersist()
    b.unpersist()
    return summary


def import_run(spark: SparkSession, run_dir: str, roots: tuple[str, ...] = tuple(legacy.ROOTS), profile: str = "legacy_import", allow_missing: bool = True) -> dict:
    """The configuration that imports an older run's stored results."""
    at = f"{run_dir.rstrip('/')}/outputs/sources"
    listed = files.listing(spark, at).select("path") if files.exists(spark, at) else spark.createDataFrame([], "path string")
    found = [r.asDict() for r in legacy.legacy_sources(listed, roots).orderBy("source_root", "variant").collect()]  # variants of a run
    return legacy.import_config(found, run_dir.rstrip("/"), profile, allow_missing)


def as_json(value: dict) -> str:
    return json.dumps(value, indent=2, sort_keys=True, default=str)
