"""Command line: python -m quire.cli COMMAND ...; each prints a report, and ends with 1 where a check found errors."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import run, sinks
from quire.operators import run_checks, validation
from quire.plans import staged
from quire.sources import files


def status(spark: SparkSession, manifest: str, root: str, missing: int = 10) -> DataFrame:
    """Artifacts lie under root as stage/slug.ext or stage/slug/file."""
    inside = F.split("inside", "/")
    made = files.listing(spark, root).select(F.element_at(inside, 1).alias("stage"), files.stem(F.element_at(inside, 2)).alias("slug"))
    return validation.stage_progress(files.path_list(spark, manifest), made, missing)


def safety_scan(spark: SparkSession, root: str) -> DataFrame:
    every = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    inside = F.regexp_replace("path", "^.*?" + root.rstrip("/").replace(".", r"\.") + "/", "")
    return validation.file_findings(every.select(inside.alias("path"), "length", "content")).orderBy("path", "finding")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quire")
    sub = parser.add_subparsers(dest="name", required=True)

    def add(name: str, *given: str, options: tuple = (), flags: tuple[str, ...] = ()) -> None:
        p = sub.add_parser(name)
        for a in given:
            p.add_argument(a)
        for o, default in options:
            p.add_argument(o, default=default, type=type(default) if default is not None else str)
        for f in flags:
            p.add_argument(f, action="store_true")

    add("validate-manifest", "manifest", options=(("--images", None), ("--output-json", None)), flags=("--json", "--require-files", "--require-checksums", "--verify-checksums", "--strict"))
    add("validate-run", "run_dir", options=(("--output-json", None),), flags=("--json", "--strict"))
    add("plan", "manifest", "run_dir", options=(("--profile", "adaptive"), ("--config", None), ("--images", None)))
    add("canary", "manifest", "run_dir", options=(("--profile", "adaptive"), ("--config", None), ("--images", None)))
    add("summarize-performance", "run_dir", options=(("--output-json", None),))
    add("run", "config", options=(("--run-dir", None), ("--stages", None)))
    add("run-status", "run_dir")
    add("status", "manifest", "root", options=(("--missing", 10),))
    add("fuse", "run_dir", "width", "height", options=(("--wanted", "P4"),))
    add("import-config", "run_dir", options=(("--profile", "legacy_import"), ("--output-json", None)), flags=("--strict-missing",))
    add("stage-inputs", "inputs", "output", options=(("--max-pages", 0),), flags=("--recursive",))
    add("make-manifest", "root", "output", flags=("--recursive",))
    add("safety-scan", "root")
    return parser


def _rows(df: DataFrame) -> int:
    found = 0
    for line in df.toJSON().toLocalIterator():
        print(line)
        found += 1
    return found


def _report(spark: SparkSession, report: dict, issues: list[dict], args: argparse.Namespace, where: str) -> int:
    whole = report | {"issues": issues}
    if args.output_json:
        sinks.write_json_document(spark, whole, args.output_json)
    print(run.as_json(whole) if args.json else run_checks.report_text(report["status"], where, report["counts"], issues), end="")
    return int(report["status"] == "error" or args.strict and report["status"] != "ok")


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("quire").getOrCreate()
    if args.name == "validate-manifest":
        return _report(spark, *run.manifest_report(spark, args.manifest, args.images, args.require_files, args.require_checksums, args.verify_checksums, args.strict), args, args.manifest)
    if args.name == "validate-run":
        return _report(spark, *run.validate(spark, args.run_dir, args.strict), args, args.run_dir)
    if args.name in ("plan", "canary"):
        if args.name == "plan":
            print(run.as_json(run.prepare(spark, args.manifest, args.run_dir, args.profile, args.config, args.images)["summary"]))
            return 0
        performance = run.canary(spark, args.manifest, args.run_dir, args.profile, args.config, args.images)
        print(run.as_json(performance))
        return int(performance["errors"] > 0)
    if args.name in ("summarize-performance", "import-config"):
        value = run.performance_report(spark, args.run_dir) if args.name == "summarize-performance" else run.import_run(spark, args.run_dir, profile=args.profile, allow_missing=not args.strict_missing)
        if args.output_json:
            sinks.write_json_document(spark, value, args.output_json)
        print(run.as_json(value))
        return 0
    if args.name == "run":
        print(run.as_json(staged.run(spark, args.config, args.run_dir, [x.strip() for x in args.stages.split(",")] if args.stages else None)))
        return 0
    if args.name == "run-status":
        print(run.as_json(staged.status(spark, args.run_dir)))
        return 0
    if args.name == "fuse":
        print(run.as_json(run.fuse_stored(spark, args.run_dir, int(args.width), int(args.height), args.wanted)))
        return 0
    if args.name in ("stage-inputs", "make-manifest"):
        if args.name == "make-manifest":
            paths, counts = files.image_manifest(spark, args.root, args.recursive), {}
        else:
            paths, counts = files.stage_inputs(spark, [args.inputs], args.recursive, args.max_pages or None)
        value = "".join(r["path"] + os.linesep for r in paths.select("path").toLocalIterator())
        with open(args.output, "w", encoding="utf-8") as f:
            f.write(value)
        print(run.as_json(counts | {"images": value.count(os.linesep)}))
        return 0
    return int(_rows(status(spark, args.manifest, args.root, args.missing) if args.name == "status" else safety_scan(spark, args.root)) > 0 and args.name == "safety-scan")


if __name__ == "__main__":
    raise SystemExit(main())
