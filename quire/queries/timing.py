"""Queries on timing rows: rollups, coverage, headline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import checks as C
from quire.operators import performance as P
from quire.operators import run_checks as R
from quire.operators import validation as V
from quire.queries.base import PLAN, TIMES, query
from quire.sources import derived as T

STATS = """count(*) as n, count(*) filter (status in ('ok', 'skipped')) as completed, count(*) filter (status not in ('ok', 'skipped')) as failed,
  round(sum(s), 6) as seconds_total, round(avg(s), 6) as seconds_mean, round(quantile_cont(s, 0.5), 6) as seconds_p50, round(quantile_cont(s, 0.95), 6) as seconds_p95, round(max(s), 6) as seconds_max,
  round(case when sum(s) > 0 then count(*) filter (status in ('ok', 'skipped')) / sum(s) * 60 else 0 end, 6) as completed_per_minute"""


def grouped(source: str, keys: str) -> str:
    return f"""
st as (select {keys}, {STATS} from {source} group by {keys}),
hs as (select {keys}, string_agg(status || '=' || m, ',' order by status) as status_counts from (select {keys}, status, count(*) as m from {source} group by {keys}, status) group by {keys})
select st.*, status_counts from st join hs using ({keys})"""


BREAKDOWNS = """
kd as (
  select 'stage' as breakdown, stage as value, s, status from tm union all
  select 'model', model_id, s, status from tm where stage = 'model_adapter' union all
  select 'model_family', family, s, status from tm where stage = 'model_adapter' union all
  select 'resource_class', resource_class, s, status from tm where stage = 'model_adapter' union all
  select 'page_complexity', complexity, s, status from tm)"""

PAIRS = """
m as (select pl.page_id is not null as p, ob.page_id is not null as o, ob.ok, coalesce(pl.page_id, ob.page_id) as page_id, coalesce(pl.model_id, ob.model_id) as model_id
      from pl full join ob on pl.page_id = ob.page_id and pl.model_id = ob.model_id)"""


@query("timing_by_stage", f"with {TIMES}, {grouped('tm', 'stage')}")
def timing_by_stage(s: SparkSession, d: str) -> DataFrame:
    return P.timing_summary(T.timings(s, d), "stage")


@query("timing_breakdowns", f"with {TIMES}, {BREAKDOWNS}, {grouped('kd', 'breakdown, value')}")
def timing_breakdowns(s: SparkSession, d: str) -> DataFrame:
    return P.timing_breakdowns(T.timings(s, d))


@query(
    "plan_observed_coverage",
    f"""with {TIMES}, {PLAN}, {PAIRS}
select count(*) filter (p) as planned, count(*) filter (o) as observed, count(*) filter (p and o and ok) as successful, count(*) filter (p and o and not ok) as failed,
  count(*) filter (p and not o) as missing, count(*) filter (o and not p) as unexpected, round(count(*) filter (p and o) / count(*) filter (p), 6) as coverage_ratio from m""",
)
def plan_observed_coverage(s: SparkSession, d: str) -> DataFrame:
    return P.coverage(T.planned_pairs(s, d), T.timings(s, d))


@query(
    "pair_samples",
    f"""with {TIMES}, {PLAN}, {PAIRS}
(select 'missing' as kind, page_id, model_id from m where p and not o order by page_id, model_id limit 25) union all
(select 'unexpected', page_id, model_id from m where o and not p order by page_id, model_id limit 25)""",
)
def pair_samples(s: SparkSession, d: str) -> DataFrame:
    return P.pair_samples(T.planned_pairs(s, d), T.timings(s, d))


@query("slowest_rows", f"with {TIMES} select ord, page_id, stage, model_id, family, resource_class, complexity, s, status from tm order by s desc, ord limit 10")
def slowest_rows(s: SparkSession, d: str) -> DataFrame:
    return P.slowest(T.timings(s, d))


OUTCOMES = """
po as (
  select page_id, count(*) filter (stage = 'model_adapter' and status <> 'error') as succeeded, count(*) filter (stage = 'model_adapter' and status = 'error') as failed from tm group by 1)"""


@query("page_outcomes", f"with {TIMES}, {OUTCOMES} select page_id, succeeded, failed, case when succeeded = 0 then 'error' else 'ok' end as status, case when succeeded = 0 then 'NoSuccessfulAdapters' end as error_type from po")
def page_outcomes(s: SparkSession, d: str) -> DataFrame:
    return P.page_outcomes(T.timings(s, d))


HEADLINE = f"""with {TIMES}, {PLAN}, {OUTCOMES},
hp as (select count(*) as pages_attempted, count(*) filter (succeeded > 0) as pages_completed, count(*) filter (succeeded = 0) as pages_failed from po),
hw as (select round(coalesce(sum(case when stage = 'page_total' then s end), 0), 6) as seconds_total, count(*) filter (stage = 'model_adapter') as adapter_invocations_observed,
  count(*) filter (stage = 'model_adapter' and status = 'error') as adapter_errors from tm),
hl as (select *, (select count(*) from pl) as adapter_invocations_planned, adapter_errors + pages_failed as errors, round(case when seconds_total > 0 then pages_completed / seconds_total * 60 else 0 end, 6) as pages_per_minute from hp, hw)
"""


@query("headline_performance", HEADLINE + "select * from hl")
def headline_performance(s: SparkSession, d: str) -> DataFrame:
    return P.headline(T.planned_pairs(s, d), T.timings(s, d))


@query(
    "timing_with_model_metadata",
    f"""with {TIMES}, ad as (select * from tm where stage = 'model_adapter'),
lm as (select model_id, arg_max(complexity, ord) as family, arg_max(resource_class, ord) as resource_class from ad where model_id <> 'column_detector_v1' group by 1),
rs as ({'with ' + grouped('ad', 'model_id').lstrip()})
select rs.*, coalesce(family, 'unknown') as family, coalesce(resource_class, 'unknown') as resource_class from rs left join lm using (model_id)""",
)
def timing_with_model_metadata(s: SparkSession, d: str) -> DataFrame:
    plan = T.timings(s, d).filter("stage = 'model_adapter' and model_id <> 'column_detector_v1'")
    return P.with_model_metadata(T.timings(s, d), plan.select("model_id", F.col("complexity").alias("family"), "resource_class", "ord"))


@query("page_resource_class", f"with {TIMES} select page_id, case when count(distinct resource_class) = 1 then min(resource_class) else 'mixed' end as resource_class from tm group by 1")
def page_resource_class(s: SparkSession, d: str) -> DataFrame:
    return P.page_resource_class(T.timings(s, d))


@query(
    "stage_progress",
    f"""with {TIMES},
g as (select p.page_id, s.stage, exists(select 1 from tm where tm.page_id = p.page_id and tm.stage = s.stage) as have from (select distinct page_id from tm) p, (select distinct stage from tm) s),
l as (select stage, list(page_id order by page_id) as missing from (select stage, cast(page_id as varchar) as page_id from g where not have qualify row_number() over (partition by stage order by cast(page_id as varchar)) <= 10) group by 1)
select stage, done, total, round(done * 100.0 / total, 2) as percent, coalesce(array_to_string(missing, ','), '') as missing
from (select stage, count(*) filter (have) as done, count(*) as total from g group by 1) left join l using (stage)""",
)
def stage_progress(s: SparkSession, d: str) -> DataFrame:
    page = F.col("page_id").cast("string").alias("slug")
    out = V.stage_progress(T.timings(s, d).select(page), T.timings(s, d).select("stage", page))
    return out.withColumn("missing", F.array_join("missing", ","))


@query(
    "timing_row_issues",
    f"""with {TIMES} select 'error' as level, 'invalid_performance_row' as code, cast(page_id as varchar) as page_id, model_id, '' as detail
from tm left join events e on e.event_id = tm.ord where (unreadable or e.value < 0) or stage = 'page_total' and resource_class = 'gpu' or page_id % 10 = 3""",
)
def timing_row_issues(s: SparkSession, d: str) -> DataFrame:
    """Some stages emptied, some pages unknown to the manifest."""
    rows = T.timings(s, d).withColumn("stage", F.when((F.col("stage") == "page_total") & (F.col("resource_class") == "gpu"), "").otherwise(F.col("stage")))
    return C.timing_row_issues(rows, T.timings(s, d).select("page_id").filter("page_id % 10 <> 3"))


COUNTS = f"""with {TIMES}, {PLAN},
ar as (select page_id, model_id, status from tm where stage = 'model_adapter'),
oc as (select page_id, model_id, count(*) as n, bool_or(status = 'error') as failed from ar group by all),
er as (select distinct page_id, model_id from ar where status = 'error' and page_id % 4 <> 1),
pc as (select
  (select count(*) from pl) as planned, (select count(*) from oc) as observed,
  (select count(*) from pl anti join oc using (page_id, model_id)) as missing, (select count(*) from oc anti join pl using (page_id, model_id)) as unexpected,
  (select count(*) from oc where n <> 1) as repeated,
  (select count(*) from (select page_id, model_id from oc where failed) anti join er using (page_id, model_id)) as differing)
"""


def pair_counts(s: SparkSession, d: str) -> DataFrame:
    """The error report lacks the failures of every fourth page."""
    rows = T.timings(s, d).filter("stage = 'model_adapter'")
    return R.pair_counts(T.planned_pairs(s, d), rows, rows.filter("status = 'error' and page_id % 4 <> 1"))


query("error_pair_counts", COUNTS + "select * from pc")(pair_counts)


@query(
    "coverage_issues",
    COUNTS + """select 'error' as level, code, '' as page_id, '' as model_id, cast(n as varchar) as detail from (
  select 'missing_adapter_performance_rows' as code, missing as n from pc union all select 'unexpected_adapter_performance_rows', unexpected from pc union all
  select 'duplicate_adapter_performance_rows', repeated from pc union all select 'adapter_error_rows_mismatch', differing from pc) where n > 0""",
)
def coverage_issues(s: SparkSession, d: str) -> DataFrame:
    return R.coverage_issues(pair_counts(s, d))


@query(
    "headline_issues",
    HEADLINE + """, i as (select 'page_count_mismatch' as code, true as bad from hl union all select 'pages_attempted_mismatch', true from hl union all select 'pages_completed_mismatch', true from hl union all
  select 'pages_failed_mismatch', true from hl union all select 'planned_invocations_mismatch', true from hl union all select 'observed_invocations_mismatch', true from hl union all
  select 'adapter_error_count_mismatch', false from hl union all select 'error_count_mismatch', true from hl union all select 'run_has_errors', errors > 0 from hl)
select 'error' as level, code, '' as page_id, '' as model_id, '' as detail from i where bad""",
)
def headline_issues(s: SparkSession, d: str) -> DataFrame:
    """A summary that states one more of everything but adapter errors, and no page count."""
    own = headline_performance(s, d).withColumn("page_count", F.col("pages_attempted"))
    said = own.select(*[(F.lit(0) if c == "page_count" else F.col(c) if c == "adapter_errors" else F.col(c) + 1).alias(c) for c in R.HEADLINE])
    return R.headline_issues(said, own)


ARTIFACTS = f"""with {TIMES}, {PLAN}, f as (select page_id, model_id from ob where not ok), o as (select page_id, model_id from ob where ok or page_id % 7 = 0),
m as (select pl.page_id, pl.model_id, f.page_id is not null as lost, o.page_id is not null as there from pl left join f using (page_id, model_id) left join o using (page_id, model_id)),
c as (select count(*) filter (there) as found, count(*) filter (not lost) as wanted from m)
"""


@query(
    "artifact_issues",
    ARTIFACTS + """select 'error' as level, 'failed_adapter_has_model_output' as code, cast(page_id as varchar) as page_id, model_id, '' as detail from m where lost and there union all
select 'error', 'model_output_count_mismatch', '', '', found || '/' || wanted from c where found <> wanted""",
)
def artifact_issues(s: SparkSession, d: str) -> DataFrame:
    """Pairs that only failed; every seventh page kept what they wrote."""
    pairs = P.adapter_pairs(T.timings(s, d))
    return R.artifact_issues(T.planned_pairs(s, d), pairs.filter("not ok"), pairs.filter("ok or page_id % 7 = 0"))


@query(
    "page_artifact_issues",
    f"""with {TIMES}, {OUTCOMES}, c as (select count(*) as pages, count(*) filter (page_id % 9 <> 0) as fused, count(*) filter (page_id % 9 <> 0 and page_id % 11 <> 0) as written from po where succeeded > 0)
select 'error' as level, 'fused_page_count_mismatch' as code, '' as page_id, '' as model_id, fused || '/' || pages as detail from c where fused <> pages union all
select 'error', 'transcript_count_mismatch', '', '', written || '/' || pages from c where written <> pages""",
)
def page_artifact_issues(s: SparkSession, d: str) -> DataFrame:
    done = page_outcomes(s, d).filter("status = 'ok'").select("page_id")
    every = T.timings(s, d).select("page_id")
    return R.page_artifact_issues(done, every.filter("page_id % 9 <> 0"), every.filter("page_id % 11 <> 0"))


@query(
    "report_issues",
    f"""with {TIMES}, r as (select distinct page_id as run from tm)
select 'error' as level, unnest(list_filter([
  case when run % 5 = 0 then 'invalid_performance_report' end, case when run % 5 <> 0 and run % 7 = 0 then 'performance_report_mismatch' end,
  case when run % 11 = 0 then 'invalid_plan_summary' end, case when run % 11 <> 0 and run % 3 = 0 then 'invalid_plan_summary_contract' end,
  case when run % 11 <> 0 and run % 4 = 0 then 'plan_summary_mismatch' end, case when run % 11 <> 0 and run % 6 = 0 then 'plan_summary_mismatch' end,
  case when run % 11 <> 0 and run % 8 = 0 then 'plan_summary_mismatch' end, case when run % 11 <> 0 and run % 9 = 0 then 'plan_summary_mismatch' end,
  case when run % 13 = 0 then 'invalid_performance_summary' end, case when run % 13 <> 0 and run % 10 = 0 then 'invalid_performance_summary_contract' end,
  case when run % 13 <> 0 and run % 12 = 0 then 'performance_summary_row_mismatch' end,
  case when run % 13 <> 0 and run % 14 = 0 then 'performance_coverage_mismatch' end, case when run % 13 <> 0 and run % 15 = 0 then 'performance_coverage_mismatch' end,
  case when run % 13 <> 0 and run % 16 = 0 then 'performance_coverage_mismatch' end, case when run % 13 <> 0 and run % 17 = 0 then 'performance_coverage_mismatch' end,
  case when run % 18 = 0 then 'invalid_provenance' end, case when run % 18 <> 0 and run % 19 = 0 then 'provenance_mismatch' end,
  case when run % 20 = 0 then 'invalid_input_manifest_validation' end, case when run % 20 <> 0 and run % 21 = 0 then 'input_manifest_validation_failed' end], lambda x: x is not null)) as code from r""",
)
def report_issues(s: SparkSession, d: str) -> DataFrame:
    """One run for each page of the timings, its reports wrong by the run's number."""
    k = F.col("run")
    not_at = lambda m: k % m != 0
    off = lambda m: F.when(k % m == 0, 8).otherwise(7)
    models = F.array(*map(F.lit, T.MODELS))
    r = T.timings(s, d).select(F.col("page_id").alias("run")).distinct().select(
        not_at(5).alias("has_performance"), not_at(7).alias("performance_fits"),
        not_at(11).alias("has_plan"), F.when(not_at(3), R.PLAN_SUMMARY_CONTRACT).alias("plan_contract"),
        F.when(not_at(4), "adaptive").otherwise("full").alias("plan_profile"), off(6).alias("plan_pages"), off(8).alias("plan_planned"), F.when(not_at(9), models).alias("plan_models"),
        not_at(13).alias("has_timing"), F.when(not_at(10), R.PERFORMANCE_CONTRACT).otherwise("v0").alias("timing_contract"), off(12).alias("raw_rows"),
        off(14).alias("cover_planned"), off(15).alias("cover_observed"), off(16).alias("cover_missing"), off(17).alias("cover_unexpected"),
        not_at(18).alias("has_provenance"), not_at(19).alias("provenance_fits"), not_at(20).alias("has_manifest"), F.when(not_at(21), "warning").otherwise("error").alias("manifest_status"),
        F.lit("adaptive").alias("own_profile"), models.alias("own_models"), *[F.lit(7).alias(f"own_{c}") for c in ("pages", "planned", "raw_rows", "observed", "missing", "unexpected")],
    )
    return R.report_issues(r).select("level", "code")
