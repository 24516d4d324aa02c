"""Checks of single records of a run: manifest rows, regions, model outputs, fused pages, plan rows, timing rows.

Every check gives issue rows (level, code, page_id, model_id, detail).  Inputs are typed columns; quire.sources.bundle reads them from files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import layout as L

PLAN_CONTRACT = "parser-model-plan-v1"
COMPLEXITIES = ("easy", "medium", "hard")
ISSUE = "level string, code string, page_id string, model_id string, detail string"


def text(c: str | Column) -> Column:
    """Trimmed; null as empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(L.strip(c.cast("string")), F.lit(""))


def number(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double")


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def when(condition: Column, code: str, detail: Column | str = "", level: str | Column = "error") -> Column:
    """The issue where the condition holds, else null."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x.cast("string")
    return F.when(condition, F.struct(lit(level).alias("level"), F.lit(code).alias("code"), lit(detail).alias("detail")))


def issues(rows: DataFrame, found: list[Column] | Column, page: str | None = "page_id", model: str | None = None) -> DataFrame:
    """A row for every check of `found` (or of one array of them) that holds for a row."""
    ident = lambda c: (F.coalesce(F.col(c).cast("string"), F.lit("")) if c else F.lit(""))
    each = rows.select(ident(page).alias("page_id"), ident(model).alias("model_id"), F.explode(F.array_compact(found if isinstance(found, Column) else F.array(*found))).alias("i"))
    return each.select("i.level", "i.code", "page_id", "model_id", "i.detail")


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def manifest_issues(rows: DataFrame, files: DataFrame | None = None, require_files: bool = False, require_checksums: bool = False, verify_checksums: bool = False) -> DataFrame:
    """Issues of manifest rows (line, page_id, image_path, page_number, number_is_text, checksum, source_kind, source_system, metadata_kind).

    files (image_path, checksum): the files that exist.  *_kind: object, other, or null where absent.  Of repeated safe ids the first
    line stands and the others are issues.
    """
    r = rows.withColumns({"page_id": text("page_id"), "image_path": text("image_path"), "checksum": text("checksum")})
    safe = L.portable_id(F.col("page_id"))
    first = r.filter(safe).groupBy("page_id").agg(F.min("line").alias("first_line"))
    r = r.join(first, "page_id", "left")
    if files is None:
        r = r.withColumn("there", F.lit(None).cast("boolean")).withColumn("actual", F.lit(None).cast("string"))
    else:
        known = files.groupBy("image_path").agg(F.first("checksum").alias("actual")).withColumn("there", F.lit(True))
        r = r.join(known, "image_path", "left").withColumn("there", F.coalesce("there", F.lit(False)))
    there, sums = F.coalesce("there", F.lit(True)), F.col("checksum") != ""
    hexed = F.col("checksum").rlike(r"\A[0-9a-fA-F]{64}\z")
    whole = ~F.coalesce("number_is_text", F.lit(True)) | text("page_number").rlike(r"\A[+-]?[0-9]+\z")
    found = [
        when(F.col("page_id") == "", "missing_page_id"),
        when((F.col("page_id") != "") & ~safe, "invalid_page_id"),
        when(safe & (F.col("line") > F.col("first_line")), "duplicate_page_id"),
        when(F.col("image_path") == "", "missing_image_path"),
        when((F.col("image_path") != "") & ~there, "missing_image_file", F.col("image_path"), "error" if require_files else "warning"),
        when((F.coalesce(F.col("page_number").cast("string"), F.lit("")) != "") & ~whole, "invalid_page_number"),
        when(sums & ~hexed, "invalid_checksum"),
        when(F.lit(verify_checksums) & sums & hexed & there & (F.lower("actual") != F.lower("checksum")), "checksum_mismatch"),
        when(F.lit(require_checksums) & ~sums, "missing_checksum"),
        when(F.col("source_kind") == "other", "invalid_source"),
        when((F.col("source_kind") == "object") & (text("source_system") == ""), "missing_source_system", "", "warning"),
        when(F.col("metadata_kind") == "other", "invalid_metadata"),
    ]
    none = rows.agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
    return together(issues(r, found), issues(none, [when(F.lit(True), "empty_manifest")], page=None))


def read_region() -> Column:
    """What the checks look at, as an array of one struct: a lambda over it reads every value once, where a plain column would be worked out anew at each use."""
    numbers = F.transform("coords", lambda x: x.try_cast("double"))
    return F.array(F.struct("is_object", numbers.alias("n"), text("label").alias("label"), F.col("confidence").isNotNull().alias("rated"), F.col("confidence").try_cast("double").alias("score")))


def region_checks(r: Column) -> list[Column]:
    """Checks of a region as read_region gives it."""
    at = lambda i: F.get(r["n"], F.lit(i))
    is_object, four = r["is_object"], F.coalesce(F.size(r["n"]) == 4, F.lit(False))
    numeric = reduce(lambda a, b: a & b, [at(i).isNotNull() for i in range(4)])
    sound = reduce(lambda a, b: a & b, [finite(at(i)) for i in range(4)]) & (at(2) > at(0)) & (at(3) > at(1))
    return [
        when(~is_object, "invalid_region"),
        when(is_object & ~four, "invalid_bbox", "no four numbers"),
        when(is_object & four & ~numeric, "invalid_bbox", "not numeric"),
        when(is_object & four & numeric & ~sound, "invalid_bbox", "degenerate or not finite"),
        when(is_object & (r["label"] == ""), "missing_region_label"),
        when(is_object & r["rated"] & ~(finite(r["score"]) & r["score"].between(0.0, 1.0)), "invalid_confidence"),
    ]


def region_issues(regions: DataFrame) -> DataFrame:
    """Issues of regions (page_id, model_id, region, is_object, coords, label, confidence), the region's number as detail after the reason."""
    named = lambda c: F.when(c.isNotNull(), F.struct(c["level"].alias("level"), c["code"].alias("code"), F.concat_ws(" ", F.col("region").cast("string"), F.nullif(c["detail"], F.lit(""))).alias("detail")))
    found = F.transform(read_region(), lambda r: F.array(*[named(c) for c in region_checks(r)]))
    return issues(regions, F.get(found, F.lit(0)), model="model_id")


def valid_regions(regions: DataFrame) -> DataFrame:
    """The regions without issues."""
    return regions.filter(~F.exists(read_region(), lambda r: reduce(lambda a, b: a | b, [c.isNotNull() for c in region_checks(r)])))


def model_output_issues(expected: DataFrame, outputs: DataFrame) -> DataFrame:
    """Issues of the expected outputs (page_id, model_id) against those found.

    outputs (page_id, model_id, said_page, said_model, has_runtime, status, resource_class, seconds, has_regions); an absent one is a missing file.
    """
    r = expected.join(outputs.withColumn("there", F.lit(True)), ["page_id", "model_id"], "left")
    there, runs = F.col("there").isNotNull(), F.coalesce("has_runtime", F.lit(False))
    status, seconds = text("status"), number("seconds")
    found = [
        when(~there, "missing_file"),
        when(there & ~F.coalesce("said_page", F.lit("")).eqNullSafe(F.col("page_id").cast("string")), "model_output_page_mismatch"),
        when(there & ~F.coalesce("said_model", F.lit("")).eqNullSafe(F.col("model_id")), "model_output_model_mismatch"),
        when(there & ~runs, "missing_runtime"),
        when(there & runs & (status == ""), "missing_runtime_status"),
        when(there & runs & (status != "") & ~status.isin("ok", "skipped"), "invalid_runtime_status"),
        when(there & runs & (text("resource_class") == ""), "missing_runtime_resource_class"),
        when(there & runs & ~(finite(seconds) & (seconds >= 0)), "invalid_runtime_seconds"),
        when(there & ~F.coalesce("has_regions", F.lit(False)), "invalid_regions"),
    ]
    return issues(r, found, model="model_id")


def fused_page_issues(expected: DataFrame, fused: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Issues of the pages expected to be fused (page_id, model_ids in plan order).

    fused (page_id, said_page, said_models array, transcript null if no string, has_regions), transcripts (page_id, written): a transcript's file
    holds it and a line end, or line ends after it.
    """
    r = expected.join(fused.withColumn("there", F.lit(True)), "page_id", "left").join(transcripts, "page_id", "left")
    there, said = F.col("there").isNotNull(), F.coalesce("transcript", F.lit(""))
    same = (F.col("written") == F.concat(said, F.lit("\n"))) | (F.regexp_replace("written", r"\n+\z", "") == said)
    found = [
        when(~there, "missing_file"),
        when(there & ~F.coalesce("said_page", F.lit("")).eqNullSafe(F.col("page_id").cast("string")), "fused_page_mismatch"),
        when(there & ~F.col("said_models").eqNullSafe(F.col("model_ids")), "fused_model_ids_mismatch"),
        when(there & F.col("transcript").isNull(), "invalid_transcript"),
        when(there & F.col("written").isNull(), "missing_transcript_file"),
        when(there & F.col("written").isNotNull() & ~same, "transcript_mismatch"),
        when(there & ~F.coalesce("has_regions", F.lit(False)), "invalid_fused_regions"),
    ]
    return issues(r, found)


def first_plan_rows(plan: DataFrame) -> DataFrame:
    """Plan rows with an id, trimmed, and whether each is its page's first."""
    r = plan.withColumn("page_id", text("page_id")).filter("page_id <> ''")
    first = r.groupBy("page_id").agg(F.min("line").alias("first_line"))
    return r.join(first, "page_id").withColumn("is_first", F.col("line") == F.col("first_line")).drop("first_line")


def rated_models(plan: DataFrame) -> DataFrame:
    """line, page_id, pos, model_id, family, resource_class, is_object, fault (null, or the planned model's issue) of the first rows' models."""
    each = first_plan_rows(plan).filter("is_first").select("line", "page_id", F.posexplode("models").alias("pos", "m")).select("line", "page_id", "pos", "m.*")
    named = each.withColumns({c: text(c) for c in ("model_id", "family", "resource_class")})
    whole = F.col("is_object") & (F.col("model_id") != "") & (F.col("family") != "") & (F.col("resource_class") != "")
    safe = whole & L.portable_id(F.col("model_id"))
    first = named.filter(safe).groupBy("line", "model_id").agg(F.min("pos").alias("first_pos"))
    fault = F.when(~whole, "invalid_planned_model").when(~safe, "invalid_planned_model_id").when(F.col("pos") > F.col("first_pos"), "duplicate_planned_model")
    return named.join(first, ["line", "model_id"], "left").withColumn("fault", fault).drop("first_pos")


def planned_models(plan: DataFrame) -> DataFrame:
    """page_id, model_id, pos, line of the sound planned models."""
    return rated_models(plan).filter("fault is null").select("page_id", "model_id", "pos", "line", "family", "resource_class")


def model_plan_issues(plan: DataFrame, pages: DataFrame, profile: str, summary_models: list[str]) -> DataFrame:
    """Issues of plan rows against the manifest's pages (page_id), the run's profile and the models its summary names.

    plan (line, page_id, contract, profile_name, complexity, has_profile, profile_page, profile_complexity, models array of
    (is_object, model_id, family, resource_class) or null, resource_classes array, routing_reason).  A page's first row counts; the models
    named must be those planned, in the order first seen.
    """
    known = pages.select(text("page_id").alias("page_id")).distinct()
    r = first_plan_rows(plan).join(known.withColumn("known", F.lit(True)), "page_id", "left")
    rated = rated_models(plan)
    classes = rated.filter("fault is null").groupBy("line").agg(F.sort_array(F.collect_set("resource_class")).alias("own_classes"))
    r = r.join(classes, "line", "left").withColumn("own_classes", F.coalesce("own_classes", F.array().cast("array<string>")))
    first, complexity = F.col("is_first"), F.coalesce("complexity", F.lit(""))
    profiled = F.coalesce("has_profile", F.lit(False))
    embedded = (F.coalesce("profile_page", F.lit("")) == F.col("page_id")) & (F.coalesce("profile_complexity", F.lit("")) == complexity)
    found = [
        when(~first, "duplicate_model_plan_page"),
        when(first & F.col("known").isNull(), "unknown_model_plan_page"),
        when(first & ~F.col("contract").eqNullSafe(PLAN_CONTRACT), "invalid_model_plan_contract"),
        when(first & (F.coalesce("profile_name", F.lit("")) != profile), "model_plan_profile_mismatch", "profile_name"),
        when(first & ~complexity.isin(*COMPLEXITIES), "invalid_page_complexity"),
        when(first & ~profiled, "missing_page_profile"),
        when(first & profiled & ~embedded, "model_plan_profile_mismatch", "profile"),
        when(first & (F.coalesce(F.size("models"), F.lit(0)) <= 0), "empty_model_plan"),
        when(first & ~F.col("resource_classes").eqNullSafe(F.col("own_classes")), "model_plan_resource_mismatch"),
        when(first & (text("routing_reason") == ""), "missing_routing_reason"),
    ]
    faults = rated.filter("fault is not null").select(F.lit("error").alias("level"), F.col("fault").alias("code"), "page_id", F.when(F.col("is_object"), F.col("model_id")).otherwise("").alias("model_id"), F.lit("").alias("detail"))
    nameless = issues(plan.filter(text("page_id") == ""), [when(F.lit(True), "model_plan_missing_page_id")], page=None)
    missing = issues(known.join(r.select("page_id"), "page_id", "left_anti"), [when(F.lit(True), "missing_model_plan_page")])
    seen = rated.filter("fault is null").groupBy("model_id").agg(F.min(F.struct("line", "pos")).alias("at"))
    union = seen.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "model_id"))), lambda x: x["model_id"]).alias("union"))  # the models of a run: a handful
    differs = ~F.col("union").eqNullSafe(F.array(*map(F.lit, summary_models)).cast("array<string>"))
    return together(issues(r, found), faults, nameless, missing, issues(union, [when(differs, "summary_model_ids_mismatch")], page=None))


def timing_row_issues(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Timing rows without a stage, a page of the manifest, or finite seconds of 0 or more."""
    known = pages.select("page_id").distinct().withColumn("known", F.lit(True))
    s = number("seconds")
    bad = (F.coalesce("stage", F.lit("")) == "") | F.col("known").isNull() | ~(finite(s) & (s >= 0))
    return issues(rows.join(known, "page_id", "left"), [when(bad, "invalid_performance_row")], model="model_id")
