"""Checks across a run's records: headline counts, coverage, reports, artifacts; the counters and the text of a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.checks import issues, together, when

PLAN_SUMMARY_CONTRACT, PERFORMANCE_CONTRACT = "parser-model-plan-summary-v1", "parser-performance-summary-v1"
#: Headline counts and the issue of each that is not as counted.
HEADLINE = {
    "page_count": "page_count_mismatch",
    "pages_attempted": "pages_attempted_mismatch",
    "pages_completed": "pages_completed_mismatch",
    "pages_failed": "pages_failed_mismatch",
    "adapter_invocations_planned": "planned_invocations_mismatch",
    "adapter_invocations_observed": "observed_invocations_mismatch",
    "adapter_errors": "adapter_error_count_mismatch",
    "errors": "error_count_mismatch",
}
#: Counters in a report's order.
COUNTERS = (
    "rows unique_page_ids rows_with_files rows_with_checksums source_systems pages_manifest pages_completed pages_failed model_plan_rows adapter_invocations_planned "
    "models model_outputs model_regions fused_pages fused_regions transcripts performance_rows page_errors adapter_errors execution_errors errors warnings"
).split()


def headline_issues(stated: DataFrame, counted: DataFrame) -> DataFrame:
    """Stated against counted headline counts; both one row with HEADLINE's columns.  A page count of 0 or null never fits; errors are an issue of their own."""
    both = stated.select(*[F.col(c).alias(f"s_{c}") for c in HEADLINE]).join(counted.select(*HEADLINE))  # one row each
    said = lambda c: F.coalesce(F.nullif("s_page_count", F.lit(0)), F.lit(-1)) if c == "page_count" else F.col(f"s_{c}")
    found = [when(~said(c).eqNullSafe(F.col(c)), code) for c, code in HEADLINE.items()]
    return issues(both, [*found, when(F.col("errors") > 0, "run_has_errors")], page=None)


def pair_counts(planned: DataFrame, rows: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: planned, observed, missing, unexpected, repeated (pairs), differing (pairs that fail in one of rows and errors alone).

    planned and errors (page_id, model_id); rows: the adapter rows (page_id, model_id, status), empty ids included.
    """
    z = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    key = ["page_id", "model_id"]
    seen = rows.select(z("page_id"), z("model_id"), "status").groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.coalesce(F.col("status") == "error", F.lit(False))).alias("failed"))
    plan = planned.select(z("page_id"), z("model_id")).distinct().withColumn("planned", F.lit(True))
    said = errors.select(z("page_id"), z("model_id")).filter("page_id <> '' and model_id <> ''").distinct().withColumn("said", F.lit(True))
    m = plan.join(seen, key, "full_outer").join(said, key, "full_outer")
    no = lambda c: F.coalesce(c, F.lit(False))
    observed, wanted = F.col("n").isNotNull(), no("planned")
    return m.agg(
        F.count_if(wanted).alias("planned"),
        F.count_if(observed).alias("observed"),
        F.count_if(wanted & ~observed).alias("missing"),
        F.count_if(observed & ~wanted).alias("unexpected"),
        F.count_if(F.coalesce(F.col("n"), F.lit(1)) != 1).alias("repeated"),
        F.count_if(no("failed") != no("said")).alias("differing"),
    )


def coverage_issues(counts: DataFrame) -> DataFrame:
    """Issues of pair_counts, with the number of pairs."""
    codes = (("missing", "missing_adapter_performance_rows"), ("unexpected", "unexpected_adapter_performance_rows"), ("repeated", "duplicate_adapter_performance_rows"), ("differing", "adapter_error_rows_mismatch"))
    return issues(counts, [when(F.col(c) > 0, code, F.col(c)) for c, code in codes], page=None)


def report_issues(reports: DataFrame) -> DataFrame:
    """Issues of a run's reports against what the run holds.

    reports: a row per run with, for each report, whether it is an object (has_*), and the stated and counted (own_*) values:
    performance_fits, plan_contract, plan_profile, plan_pages, plan_planned, plan_models, timing_contract, raw_rows, cover_planned,
    cover_observed, cover_missing, cover_unexpected, provenance_fits, manifest_status.
    """
    has = lambda c: F.coalesce(f"has_{c}", F.lit(False))
    found: list[Column] = [when(~has("performance"), "invalid_performance_report"), when(has("performance") & ~F.coalesce("performance_fits", F.lit(False)), "performance_report_mismatch")]
    found += [when(~has("plan"), "invalid_plan_summary"), when(has("plan") & ~F.col("plan_contract").eqNullSafe(PLAN_SUMMARY_CONTRACT), "invalid_plan_summary_contract")]
    for c in ("profile", "pages", "planned", "models"):
        found.append(when(has("plan") & ~F.col(f"plan_{c}").eqNullSafe(F.col(f"own_{c}")), "plan_summary_mismatch", c))
    found += [
        when(~has("timing"), "invalid_performance_summary"),
        when(has("timing") & ~F.col("timing_contract").eqNullSafe(PERFORMANCE_CONTRACT), "invalid_performance_summary_contract"),
        when(has("timing") & ~F.col("raw_rows").eqNullSafe(F.col("own_raw_rows")), "performance_summary_row_mismatch"),
    ]
    for c in ("planned", "observed", "missing", "unexpected"):
        found.append(when(has("timing") & ~F.col(f"cover_{c}").eqNullSafe(F.col(f"own_{c}")), "performance_coverage_mismatch", c))
    found += [
        when(~has("provenance"), "invalid_provenance"),
        when(has("provenance") & ~F.coalesce("provenance_fits", F.lit(False)), "provenance_mismatch"),
        when(~has("manifest"), "invalid_input_manifest_validation"),
        when(has("manifest") & ~F.coalesce(F.col("manifest_status").isin("ok", "warning"), F.lit(False)), "input_manifest_validation_failed"),
    ]
    return issues(reports, found, page=None)


def artifact_issues(planned: DataFrame, failed: DataFrame, outputs: DataFrame) -> DataFrame:
    """Failed pairs that left an output, and the number of outputs where it is not that of the pairs planned and not failed; all (page_id, model_id)."""
    key = ["page_id", "model_id"]
    planned, failed, outputs = (d.select(*key).distinct() for d in (planned, failed, outputs))
    lost = failed.withColumn("lost", F.lit(True))
    m = planned.join(lost, key, "left").join(outputs.withColumn("there", F.lit(True)), key, "left")
    left_over = issues(m.filter("lost and there"), [when(F.lit(True), "failed_adapter_has_model_output")], model="model_id")
    counts = m.agg(F.count_if("there").alias("found"), F.count_if(F.col("lost").isNull()).alias("wanted"))
    return together(left_over, issues(counts, [when(F.col("found") != F.col("wanted"), "model_output_count_mismatch", F.concat_ws("/", "found", "wanted"))], page=None))


def page_artifact_issues(completed: DataFrame, fused: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Fused pages and transcripts whose number is not that of the completed pages; all (page_id).  A transcript counts beside its fused page."""
    flag = lambda d, c: d.select("page_id").distinct().withColumn(c, F.lit(True))
    m = completed.select("page_id").distinct().join(flag(fused, "f"), "page_id", "left").join(flag(transcripts, "t"), "page_id", "left")
    counts = m.agg(F.count(F.lit(1)).alias("pages"), F.count_if("f").alias("fused"), F.count_if(F.col("f") & F.col("t")).alias("written"))
    found = [when(F.col(c) != F.col("pages"), code, F.concat_ws("/", c, "pages")) for c, code in (("fused", "fused_page_count_mismatch"), ("written", "transcript_count_mismatch"))]
    return issues(counts, found, page=None)


def report_text(status: str, where: str, counts: dict, found: list[dict], most: int = 50) -> str:
    """A report as text: status, place, counters in their order and then by name, the first issues."""
    lines = [f"status: {status}", f"run_dir: {where}", "counts:"]
    lines += [f"  {c}: {counts[c]}" for c in [*[c for c in COUNTERS if c in counts], *sorted(set(counts) - set(COUNTERS))]]
    if found:
        lines.append("issues:")
        for i in found[:most]:
            place = "".join(f" {k}={i[c]}" for k, c in (("page", "page_id"), ("model", "model_id")) if i.get(c))
            lines.append(f"  [{i['level']}] {i['code']}{': ' + i['detail'] if i.get('detail') else ''}{place}")
        if len(found) > most:
            lines.append(f"  ... {len(found) - most} more issues")
    return "\n".join(lines) + "\n"
