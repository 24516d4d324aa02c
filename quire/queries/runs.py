"""Queries on the records of runs: manifests, regions, outputs, fused pages, plans, imports; each with defects put in by the record's number."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import checks as C
from quire.operators import validation as V
from quire.plans import batching
from quire.plans import routing as R
from quire.queries.base import BOXES, boxes, query
from quire.sources import bundle as B
from quire.sources import derived as T
from quire.sources import files
from quire.sources import legacy as G

ISSUE = "'error' as level, code, page_id, model_id, detail"


def unnested(source: str, page: str, model: str, *pairs: tuple[str, str] | tuple[str, str, str] | tuple[str, str, str, str]) -> str:
    """Issue rows of SQL conditions: (condition, code, detail, level)."""
    each = ", ".join(f"case when {c} then {{'level': '{(rest[1] if len(rest) > 1 else 'error')}', 'code': '{code}', 'detail': {(rest[0] if rest else chr(39) * 2)}}} end" for c, code, *rest in pairs)
    return f"select i.level as level, i.code as code, page_id, model_id, i.detail as detail from (select {page} as page_id, {model} as model_id, unnest(list_filter([{each}], lambda x: x is not null)) as i from {source})"


MANIFEST = """
mf as (
  select o_orderkey as line, o_orderkey % 7 as m,
    case when o_orderkey % 97 = 0 then '' when o_orderkey % 89 = 0 then '../x' || o_orderkey else 'p' || (o_orderkey % 4999) end as page_id,
    case when o_orderkey % 53 = 0 then '' else 'img/' || o_orderkey end as image_path,
    case when starts_with(o_orderpriority, '1') then 'x' when starts_with(o_orderpriority, '2') then '3.7' when o_orderkey % 3 = 0 then '' else cast(o_orderkey % 40 as varchar) end as page_number,
    o_orderkey % 2 = 0 as number_is_text,
    case when o_orderkey % 11 = 0 then 'abc' when o_orderkey % 13 = 0 then '' when o_orderkey % 17 = 0 then upper(sha256(cast(o_orderkey + 1 as varchar))) else sha256(cast(o_orderkey as varchar)) end as checksum
  from orders),
mt as (select *, row_number() over (partition by page_id order by line) as turn, regexp_full_match(page_id, '[A-Za-z0-9][A-Za-z0-9._-]{0,254}') and not contains(page_id, '..') as safe from mf)"""


def manifest(s: SparkSession, d: str) -> DataFrame:
    k, n = F.col("o_orderkey"), F.col("o_orderpriority")
    word = k.cast("string")
    return T.table(s, d, "orders").select(
        k.alias("line"),
        F.when(k % 97 == 0, "").when(k % 89 == 0, F.concat(F.lit("../x"), word)).otherwise(F.concat(F.lit("p"), (k % 4999).cast("string"))).alias("page_id"),
        F.when(k % 53 == 0, "").otherwise(F.concat(F.lit("img/"), word)).alias("image_path"),
        F.when(n.startswith("1"), "x").when(n.startswith("2"), "3.7").when(k % 3 == 0, "").otherwise((k % 40).cast("string")).alias("page_number"),
        (k % 2 == 0).alias("number_is_text"),
        F.when(k % 11 == 0, "abc").when(k % 13 == 0, "").when(k % 17 == 0, F.upper(F.sha2((k + 1).cast("string"), 256))).otherwise(F.sha2(word, 256)).alias("checksum"),
        F.when(k % 7 == 1, "object").when(k % 7 == 2, "object").when(k % 7 == 3, "other").alias("source_kind"),
        F.when(k % 7 == 1, "loc").otherwise("").alias("source_system"),
        F.when(k % 7 == 4, "object").when(k % 7 == 5, "other").alias("metadata_kind"),
    )


def image_files(s: SparkSession, d: str) -> DataFrame:
    """The images that exist: all but every 19th order's."""
    word = F.col("o_orderkey").cast("string")
    return T.table(s, d, "orders").filter("o_orderkey % 19 <> 0").select(F.concat(F.lit("img/"), word).alias("image_path"), F.sha2(word, 256).alias("checksum"))


MANIFEST_ISSUES = f"with {MANIFEST} " + unnested(
    "mt", "page_id", "''",
    ("page_id = ''", "missing_page_id"), ("page_id <> '' and not safe", "invalid_page_id"), ("safe and turn > 1", "duplicate_page_id"), ("image_path = ''", "missing_image_path"),
    ("image_path <> '' and line % 19 = 0", "missing_image_file", "image_path", "warning"), ("number_is_text and page_number in ('x', '3.7')", "invalid_page_number"),
    ("checksum = 'abc'", "invalid_checksum"), ("line % 17 = 0 and line % 11 <> 0 and line % 13 <> 0 and line % 19 <> 0 and image_path <> ''", "checksum_mismatch"), ("checksum = ''", "missing_checksum"),
    ("m = 3", "invalid_source"), ("m = 2", "missing_source_system", "''", "warning"), ("m = 5", "invalid_metadata"),
)


@query("manifest_issues", MANIFEST_ISSUES)
def manifest_issues(s: SparkSession, d: str) -> DataFrame:
    return C.manifest_issues(manifest(s, d), image_files(s, d), require_checksums=True, verify_checksums=True)


query("empty_manifest", "select 'error' as level, 'empty_manifest' as code, '' as page_id, '' as model_id, '' as detail")(lambda s, d: C.manifest_issues(manifest(s, d).filter("line < 0")))


@query("issue_rollup", f"with i as ({MANIFEST_ISSUES}) select count(*) filter (level = 'error') as errors, count(*) filter (level = 'warning') as warnings, case when count(*) filter (level = 'error') > 0 then 'error' when count(*) > 0 then 'warning' else 'ok' end as status from i")
def issue_rollup(s: SparkSession, d: str) -> DataFrame:
    return V.issue_rollup(manifest_issues(s, d))


@query(
    "jsonl_issues",
    """select line, case when line % 13 = 0 then 'invalid_jsonl' when line % 17 = 0 then 'invalid_jsonl_row' end as code, case when line % 13 <> 0 and line % 17 <> 0 then cast(regexp_extract(props, '([0-9]+)', 1) as bigint) else -1 end as k
from (select event_id as line, props from events) where line % 19 <> 0 and line % 23 <> 0""",
)
def jsonl_issues(s: SparkSession, d: str) -> DataFrame:
    """The events' JSON as lines: cut off, lists, blank ones, comments."""
    i = F.col("event_id")
    raw = F.when(i % 19 == 0, " \t ").when(i % 23 == 0, " # note").when(i % 13 == 0, '{"k": ').when(i % 17 == 0, "[1]").otherwise(F.concat(F.lit("  "), "props"))
    found = files.classified(T.table(s, d, "events").select(i.alias("line"), raw.alias("raw")), comments=True)
    return found.select("line", "code", F.when(F.col("code").isNull(), F.try_variant_get("value", "$.k", "bigint")).otherwise(-1).alias("k"))


REGIONS = f"with {BOXES}, r as (select *, cast(page_id as varchar) as p, seq % 31 = 0 as odd, seq % 29 = 0 as three, seq % 23 = 0 as word, seq % 19 = 0 as endless from bx)"
REGION_ISSUES = unnested(
    "r", "p", "source_model",
    ("odd", "invalid_region", "cast(seq as varchar)"), ("not odd and three", "invalid_bbox", "seq || ' no four numbers'"), ("not odd and not three and word", "invalid_bbox", "seq || ' not numeric'"),
    ("not odd and not three and not word and (endless or x2 <= x1 or y2 <= y1)", "invalid_bbox", "seq || ' degenerate or not finite'"), ("not odd and seq % 37 = 0", "missing_region_label", "cast(seq as varchar)"),
    ("not odd and seq % 41 <> 0 and (seq % 43 = 0 or seq % 47 = 0 or seq % 53 = 0)", "invalid_confidence", "cast(seq as varchar)"),
)


def regions(s: SparkSession, d: str) -> DataFrame:
    """Boxes as regions: no objects, three numbers, words and infinity among the corners, blank labels, scores absent, beyond 1, NaN and unreadable; 0 is sound."""
    q, word = F.col("seq"), lambda c: F.col(c).cast("string")
    x2 = F.when(q % 23 == 0, "wide").when(q % 19 == 0, "Infinity").otherwise(word("x2"))
    coords = F.when(q % 29 == 0, F.array(word("x1"), word("y1"), x2)).otherwise(F.array(word("x1"), word("y1"), x2, word("y2")))
    score = F.when(q % 41 == 0, None).when(q % 43 == 0, "1.5").when(q % 47 == 0, "NaN").when(q % 53 == 0, "high").when(q % 59 == 0, "0").otherwise(word("score"))
    return boxes(s, d).select("page_id", F.col("source_model").alias("model_id"), q.alias("region"), (q % 31 != 0).alias("is_object"), coords.alias("coords"), F.when(q % 37 == 0, " ").otherwise(F.col("source_label")).alias("label"), score.alias("confidence"))


query("region_issues", f"{REGIONS} {REGION_ISSUES}")(lambda s, d: C.region_issues(regions(s, d)))
query("valid_regions", f"{REGIONS} select page_id, count(*) as n from r where not (odd or three or word or endless or x2 <= x1 or y2 <= y1 or seq % 37 = 0 or seq % 41 <> 0 and (seq % 43 = 0 or seq % 47 = 0 or seq % 53 = 0)) group by 1")(lambda s, d: C.valid_regions(regions(s, d)).groupBy("page_id").agg(F.count(F.lit(1)).alias("n")))


@query(
    "model_output_issues",
    "with k as (select c_custkey as k, cast(c_custkey as varchar) as p from customer) "
    + unnested(
        "k", "p", "'m1'",
        ("k % 5 = 0", "missing_file"), ("k % 5 <> 0 and k % 7 = 0", "model_output_page_mismatch"), ("k % 5 <> 0 and k % 11 = 0", "model_output_model_mismatch"), ("k % 5 <> 0 and k % 13 = 0", "missing_runtime"),
        ("k % 5 <> 0 and k % 13 <> 0 and k % 3 = 0", "missing_runtime_status"), ("k % 5 <> 0 and k % 13 <> 0 and k % 3 = 1 and k % 4 = 0", "invalid_runtime_status"),
        ("k % 5 <> 0 and k % 13 <> 0 and k % 17 = 0", "missing_runtime_resource_class"), ("k % 5 <> 0 and k % 13 <> 0 and k % 9 in (0, 1, 2)", "invalid_runtime_seconds"), ("k % 5 <> 0 and k % 19 = 0", "invalid_regions"),
    ),
)
def model_output_issues(s: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    c = T.table(s, d, "customer").select(k, k.alias("page_id"), F.lit("m1").alias("model_id"))
    status = F.when(k % 3 == 0, " ").when((k % 3 == 1) & (k % 4 == 0), "OK").when(k % 3 == 1, "skipped").otherwise("ok")
    outputs = c.filter("c_custkey % 5 <> 0").select(
        "page_id", "model_id", F.when(k % 7 == 0, "other").otherwise(k.cast("string")).alias("said_page"), F.when(k % 11 != 0, "m1").alias("said_model"), (k % 13 != 0).alias("has_runtime"),
        status.alias("status"), F.when(k % 17 != 0, "cpu").alias("resource_class"), F.when(k % 9 == 0, "-1").when(k % 9 == 1, "soon").when(k % 9 == 2, None).otherwise("0.5").alias("seconds"), (k % 19 != 0).alias("has_regions"),
    )
    return C.model_output_issues(c.select("page_id", "model_id"), outputs)


@query(
    "fused_page_issues",
    "with k as (select c_custkey as k, cast(c_custkey as varchar) as p from customer) "
    + unnested(
        "k", "p", "''",
        ("k % 5 = 0", "missing_file"), ("k % 5 <> 0 and k % 7 = 0", "fused_page_mismatch"), ("k % 5 <> 0 and k % 11 in (0, 1)", "fused_model_ids_mismatch"), ("k % 5 <> 0 and k % 13 = 0", "invalid_transcript"),
        ("k % 5 <> 0 and k % 3 = 0", "missing_transcript_file"), ("k % 5 <> 0 and k % 3 <> 0 and (k % 4 = 1 or k % 13 = 0)", "transcript_mismatch"), ("k % 5 <> 0 and k % 19 = 0", "invalid_fused_regions"),
    ),
)
def fused_page_issues(s: SparkSession, d: str) -> DataFrame:
    """Files with a line end, another text, none, and several line ends after the transcript."""
    k = F.col("c_custkey")
    c = T.table(s, d, "customer").select(k, k.alias("page_id"))
    two, swapped = F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("a"))
    fused = c.filter("c_custkey % 5 <> 0").select("page_id", F.when(k % 7 != 0, k.cast("string")).alias("said_page"), F.when(k % 11 == 0, swapped).when(k % 11 != 1, two).alias("said_models"), F.when(k % 13 != 0, "one\ntwo").alias("transcript"), (k % 19 != 0).alias("has_regions"))
    written = F.when(k % 4 == 0, "one\ntwo\n").when(k % 4 == 1, "one").when(k % 4 == 2, "one\ntwo").otherwise("one\ntwo\n\n")
    return C.fused_page_issues(c.select("page_id", two.alias("model_ids")), fused, c.filter("c_custkey % 3 <> 0").select("page_id", written.alias("written")))


PLAN = """with o as (select o_orderkey as k, 'p' || (o_orderkey % 1009) as p from orders), f as (select *, row_number() over (partition by p order by k) = 1 as first from o where k % 101 <> 0),
m as (select k, p, unnest([{'pos': 0, 'id': 'a', 'fault': cast(null as varchar)}, {'pos': 1, 'id': case when k % 6 = 0 then 'a' when k % 6 = 1 then '..b' when k % 6 = 2 then '' else 'b' end,
  'fault': case when k % 6 = 0 then 'duplicate_planned_model' when k % 6 = 1 then 'invalid_planned_model_id' when k % 6 = 2 then 'invalid_planned_model' end},
  {'pos': 2, 'id': case when k % 8 = 0 then '' else 'c' end, 'fault': case when k % 8 = 0 then 'invalid_planned_model' end}]) as m from f where first and k % 9 <> 0)
"""


def plan(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    model = lambda ok, i, c: F.struct(ok.alias("is_object"), i.alias("model_id"), F.lit("f").alias("family"), F.lit(c).alias("resource_class"))
    yes = F.lit(True)
    second = F.when(k % 6 == 0, "a").when(k % 6 == 1, "..b").when(k % 6 == 2, "").otherwise("b")
    models = F.array(model(yes, F.lit("a"), "cpu"), model(yes, second, "gpu"), model(k % 8 != 0, F.lit("c"), "cpu"))
    classes = F.when((k % 6 < 3) | (k % 9 == 0), F.array(F.lit("cpu"))).otherwise(F.array(F.lit("cpu"), F.lit("gpu")))
    page = F.concat(F.lit("p"), (k % 1009).cast("string"))
    return T.table(s, d, "orders").select(
        k.alias("line"), F.when(k % 101 == 0, " ").otherwise(page).alias("page_id"), F.when(k % 12 != 0, C.PLAN_CONTRACT).alias("contract"), F.when(k % 14 == 0, "full").otherwise("adaptive").alias("profile_name"),
        F.when(k % 15 == 0, "odd").otherwise("easy").alias("complexity"), (k % 16 != 0).alias("has_profile"), F.when(k % 18 == 0, "x").otherwise(page).alias("profile_page"), F.when(k % 15 == 0, "odd").otherwise("easy").alias("profile_complexity"),
        F.when(k % 9 != 0, models).alias("models"), F.when(k % 20 == 0, F.array(F.lit("tpu"))).otherwise(classes).alias("resource_classes"), F.when(k % 22 == 0, "").otherwise("r").alias("routing_reason"),
    )


@query(
    "model_plan_issues",
    PLAN + unnested(
        "f", "p", "''",
        ("not first", "duplicate_model_plan_page"), ("first and k % 1009 % 10 = 0", "unknown_model_plan_page"), ("first and k % 12 = 0", "invalid_model_plan_contract"), ("first and k % 14 = 0", "model_plan_profile_mismatch", "'profile_name'"),
        ("first and k % 15 = 0", "invalid_page_complexity"), ("first and k % 16 = 0", "missing_page_profile"), ("first and k % 16 <> 0 and k % 18 = 0", "model_plan_profile_mismatch", "'profile'"), ("first and k % 9 = 0", "empty_model_plan"),
        ("first and (k % 20 = 0 or k % 9 = 0)", "model_plan_resource_mismatch"), ("first and k % 22 = 0", "missing_routing_reason"),
    )
    + """ union all select 'error', m.fault, p, m.id, '' from m where m.fault is not null
union all select 'error', 'model_plan_missing_page_id', '', '', '' from o where k % 101 = 0
union all select 'error', 'missing_model_plan_page', 'p' || i, '', '' from range(0, 1100) r(i) where i % 10 <> 0 and 'p' || i not in (select p from f)
union all select 'error', 'summary_model_ids_mismatch', '', '', ''""",
)
def model_plan_issues(s: SparkSession, d: str) -> DataFrame:
    """Two plan rows or more a page, some pages without, a summary that names the models in another order."""
    pages = s.range(1100).filter("id % 10 <> 0").select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("page_id"))
    return C.model_plan_issues(plan(s, d), pages, "adaptive", ["c", "b", "a"])


query("planned_models", PLAN + "select p as page_id, m.id as model_id, m.pos as pos from m where m.fault is null")(lambda s, d: C.planned_models(plan(s, d)).select("page_id", "model_id", "pos"))


PROFILE = """
pf as (
  select c_custkey as page_id, cast(300 + c_custkey % 700 as int) as w, cast(400 + c_custkey % 900 as int) as h,
    case when c_acctbal / 40000.0 > 0.22 or cast(c_custkey % 10 as double) / 5 > 1.8 then 'hard' when c_acctbal / 40000.0 > 0.12 then 'medium' else 'easy' end as complexity from customer),
md(ord, model_id, family, resource_class, fits) as (values (0, 'baseline_geometry_v1', 'profile', 'cpu', 'easy,medium,hard'), (1, 'column_detector_v1', 'layout', 'cpu', 'easy,medium,hard'), (2, 'legal_notice_probe_v1', 'text_probe', 'cpu', 'easy,medium,hard'),
  (3, 'deep_layout', 'external', 'gpu', 'medium,hard'), (4, 'vision', 'external', 'gpu', 'hard')),
rt as (select page_id, complexity, cast(row_number() over (partition by page_id order by ord) - 1 as int) as ord, model_id, family, resource_class from pf join md on contains(fits, complexity))"""
CONFIG = {
    "command_adapters": [
        {"model_id": "deep_layout", "resource_class": "gpu", "profiles": ["full", "deep"], "complexities": "medium,hard".split(","), "command": ["deep", "{image_path}"]},
        {"model_id": "vision", "resource_class": "gpu", "profile_names": "full", "complexity_names": "hard", "command": ["vision"], "timeout_seconds": 30},
        {"model_id": "other", "profiles": ["deep"], "command": ["other"]},
    ]
}


def profiles(s: SparkSession, d: str) -> DataFrame:
    """Page profiles from customers: dark share by balance, aspect by key."""
    k = F.col("c_custkey")
    dark, aspect = F.col("c_acctbal") / 40000.0, (k % 10).cast("double") / 5
    return T.table(s, d, "customer").select(k.alias("page_id"), (F.lit(300) + k % 700).cast("int").alias("w"), (F.lit(400) + k % 900).cast("int").alias("h"), R.complexity(dark, aspect).alias("complexity"))


def routed(s: SparkSession, d: str) -> DataFrame:
    return R.route(profiles(s, d), R.adapters_for("full", R.config_of(CONFIG)))


query("plan_routing", f"with {PROFILE} select * from rt")(routed)
query("plan_with_profiles", f"with {PROFILE} select rt.*, c_name as name, w, h from rt join pf using (page_id) join customer on c_custkey = page_id")(lambda s, d: R.with_profiles(routed(s, d), T.table(s, d, "customer").select(F.col("c_custkey").alias("page_id"), F.col("c_name").alias("name")), profiles(s, d)))


@query(
    "plan_summary",
    f"""with {PROFILE} select 'model' as kind, model_id as name, cast(min(ord) as int) as ord, count(*) as n from rt group by model_id
union all select 'resource_class', resource_class, -1, count(*) from rt group by resource_class union all select 'complexity', complexity, -1, count(distinct page_id) from rt group by complexity
union all select 'pages', '', -1, count(distinct page_id) from rt union all select 'invocations', '', -1, count(*) from rt""",
)
def plan_summary(s: SparkSession, d: str) -> DataFrame:
    return R.plan_summary(routed(s, d)).withColumn("ord", F.coalesce("ord", F.lit(-1)))


@query(
    "plan_rows",
    f"""with {PROFILE} select 'parser-model-plan-v1' as contract, page_id, 'full' as profile_name, complexity as estimated_complexity, string_agg(model_id, ',' order by ord) as models,
  case when complexity = 'easy' then 'cpu' else 'cpu,gpu' end as resource_classes, concat('matched profile=', chr(39), 'full', chr(39), ' and estimated_complexity=', chr(39), complexity, chr(39)) as routing_reason from rt group by page_id, complexity""",
)
def plan_rows(s: SparkSession, d: str) -> DataFrame:
    out = R.plan_rows(routed(s, d), "full")
    return out.withColumn("models", F.array_join(F.transform("models", lambda m: m["model_id"]), ",")).withColumn("resource_classes", F.array_join("resource_classes", ","))


@query(
    "builtin_adapter_regions",
    f"""with {PROFILE}, g as (select *, greatest(8, cast(trunc(w*cast(0.08 as double)) as int)) as mx, greatest(8, cast(trunc(h*cast(0.08 as double)) as int)) as my, greatest(8, cast(trunc(w*cast(0.03 as double)) as int)) as gu, greatest(8, cast(trunc(h*cast(0.10 as double)) as int)) as tp, w // 2 as mid, cast(trunc(w*cast(0.06 as double)) as int) as m6 from pf),
u as (select page_id, 'baseline_geometry_v1' as model_id, 'baseline:main' as r, 'baseline text region' as t, mx as x1, my as y1, w-mx as x2, h-my as y2, 'text' as label, cast(0.55 as double) as confidence, 1 as reading_order from g
union all select page_id, 'column_detector_v1', 'columns:left', 'left column candidate', m6, tp, mid-gu, h-my, 'text', 0.68, 1 from g
union all select page_id, 'column_detector_v1', 'columns:right', 'right column candidate', mid+gu, tp, w-m6, h-my, 'text', 0.68, 2 from g
union all select page_id, 'legal_notice_probe_v1', 'legal-probe:footer', 'legal notice candidate', cast(trunc(w*cast(0.08 as double)) as int), cast(trunc(h*cast(0.70 as double)) as int), cast(trunc(w*cast(0.92 as double)) as int), cast(trunc(h*cast(0.93 as double)) as int),
  'legal_notice_candidate', case when complexity = 'easy' then 0.42 else 0.72 end, 3 from g)
select page_id, model_id, page_id || ':' || r as region_id, x1, y1, x2, y2, label, confidence, '[' || t || ' for ' || page_id || ']' as text, reading_order from u""",
)
def builtin_adapter_regions(s: SparkSession, d: str) -> DataFrame:
    return R.builtin_regions(profiles(s, d))


@query(
    "fixture_adapter_regions",
    f"""with {PROFILE}, g as (select *, greatest(12, cast(trunc(w*cast(0.10 as double)) as int)) as mx, greatest(12, cast(trunc(h*cast(0.12 as double)) as int)) as my, greatest(40, cast(trunc(h*cast(0.20 as double)) as int)) as t from pf)
select page_id, mx as x1, my as y1, w - mx as x2, least(h - my, my + t) as y2, 'text' as label, cast(0.88 as double) as confidence, 'fixture command adapter text for ' || page_id as text, 1 as reading_order from g""",
)
def fixture_adapter_regions(s: SparkSession, d: str) -> DataFrame:
    return R.fixture_regions(profiles(s, d))


# Payloads of older runs: every list and wrapper key, box shape and field name in turn.
def payloads(s: SparkSession, d: str) -> DataFrame:
    e, i = T.table(s, d, "events"), F.col("event_id")
    k, v = F.regexp_extract("props", "([0-9]+)", 1), F.format_string("%.3f", "value")
    shape = i % 8
    box = (
        F.when(shape == 0, F.concat(F.lit('"bbox":['), k, F.lit(',2,'), k, F.lit('.5,"9"]')))
        .when(shape == 1, F.concat(F.lit('"poly":[[0,0],['), k, F.lit(",1],[9,20],[1,19]]")))
        .when(shape == 2, F.concat(F.lit('"box":{"left":'), k, F.lit(',"top":2,"width":0.5,"height":7}')))
        .when(shape == 3, F.concat(F.lit('"rect":{"x1":'), k, F.lit(',"y1":2,"x2":"'), k, F.lit('.5","y2":9}')))
        .when(shape == 4, F.concat(F.lit('"dt_poly":['), k, F.lit(",2,"), k, F.lit(".5,2,"), k, F.lit(".5,9,"), k, F.lit(",9]")))
        .when(shape == 5, F.concat(F.lit('"bbox_xyxy":[9,9,1,1],"coordinate":['), k, F.lit(",2,"), k, F.lit(".5,9]")))
        .when(shape == 6, '"bbox":[1,2,"x",4]')
        .otherwise(F.concat(F.lit('"polygon":[['), k, F.lit(',2],[1,"z"],['), k, F.lit(".5,9],[0,0]]")))
    )
    label = F.when(i % 3 == 0, ',"category":"Photo","class":"x"').when(i % 3 == 1, ',"norm_label":"title","text":"t"').otherwise(',"type":"","label":null,"ocr_text":"u"')
    score = F.when(i % 4 == 0, F.concat(F.lit(',"score":'), v)).when(i % 4 == 1, F.concat(F.lit(',"confidence":"?","prob":'), v)).when(i % 4 == 2, ',"score":null').otherwise("")
    order = F.when(i % 5 == 0, ',"order":7').when(i % 5 == 1, ',"reading_order":null,"order":7').when(i % 5 == 2, ',"reading_order":"3"').when(i % 5 == 3, ',"order":0').otherwise("")
    record = F.concat(F.lit('{"bbox":[3,3,1,1]},{'), box, label, score, order, F.lit("}"))
    which = i % 6
    wrapped = F.when(which == 5, F.concat(F.lit('{"pages":[{"slug":"none","boxes":[{"bbox":[0,0,5,5]}]},{"image":"/a/'), i.cast("string"), F.lit('.png","blocks":['), record, F.lit("]}]}")))
    for n, name in enumerate(("regions", "boxes", "candidates", "layout_boxes")):
        wrapped = wrapped.when(which == n, F.concat(F.lit(f'{{"{G.WRAPPERS[n]}":{{"{name}":['), record, F.lit("]}}")))
    return e.select(i.alias("page_id"), F.when(i % 29 == 0, None).when(i % 31 == 0, '{"x"').otherwise(wrapped.otherwise(F.concat(F.lit("["), record, F.lit("]")))).alias("payload"))


LEGACY = """with e as (select event_id as i, cast(regexp_extract(props, '([0-9]+)', 1) as double) as k, cast(printf('%.3f', value) as double) as v from events),
r as (select i, case when i % 8 = 1 then 0 when i % 8 = 7 then 0 else k end as x1, case when i % 8 in (1, 7) then 0 else 2 end as y1, case when i % 8 = 1 then greatest(k, 9) else k + 0.5 end as x2, case when i % 8 = 1 then 20 else 9 end as y2, v from e where i % 29 <> 0 and i % 31 <> 0 and i % 8 <> 6)
"""


@query(
    "legacy_regions",
    LEGACY + """select cast(i as varchar) as page_id, 2 as region, i || ':old:0002' as region_id, cast(x1 as double) as x1, cast(y1 as double) as y1, x2, cast(y2 as double) as y2,
  case i % 3 when 0 then 'image' when 1 then 'title' else 'text' end as label, case i % 3 when 0 then 'Photo' when 1 then 'title' else 'text' end as source_label, case when i % 4 in (0, 1) then least(1.0, greatest(0.0, v)) else 0.5 end as confidence,
  'paddle' as source_family, 'old' as source_model, case i % 3 when 0 then '' when 1 then 't' else 'u' end as text, case i % 5 when 0 then 7 when 1 then 2 when 2 then 3 when 3 then 0 else 2 end as reading_order, 'old,paddle' as provenance from r""",
)
def legacy_regions(s: SparkSession, d: str) -> DataFrame:
    out = G.legacy_regions(payloads(s, d), "old", "paddle")
    return out.drop("model_id", "payload_keys").withColumn("provenance", F.array_join("provenance", ","))


@query(
    "legacy_outcome",
    """select cast(event_id as varchar) as page_id, 'old' as model_id, case when event_id % 29 = 0 or event_id % 31 = 0 then 0 else 2 end as observed, case when event_id % 29 = 0 or event_id % 31 = 0 or event_id % 8 = 6 then 0 else 1 end as emitted,
  case when event_id % 29 = 0 or event_id % 31 = 0 then 0 when event_id % 8 = 6 then 2 else 1 end as skipped, case when event_id % 29 = 0 then 'skipped' when event_id % 31 = 0 then 'error' else 'ok' end as status from events""",
)
def legacy_outcome(s: SparkSession, d: str) -> DataFrame:
    return G.legacy_outcome(payloads(s, d), "old").drop("error")


@query(
    "legacy_sources",
    """with p as (select p_partkey % 5 as r, p_size % 3 as v, p_partkey from part where p_partkey % 7 <> 0)
select case r when 0 then 'paddle_layout' when 1 then 'paddle_vl15' when 2 then 'dell' else 'mineru' end as source_root, 'V-' || v || '.x' as variant, case r when 2 then 'dell' when 3 then 'mineru' else 'paddle' end as family, count(*) as n,
  'legacy_' || case r when 0 then 'paddle_layout' when 1 then 'paddle_vl15' when 2 then 'dell' else 'mineru' end || '_v_' || v || '_x' as model_id from p where r < 4 group by r, v""",
)
def legacy_sources(s: SparkSession, d: str) -> DataFrame:
    """Stored results named after parts, some under unknown roots, some of other names."""
    root = T.pick(F.col("p_partkey") % 5, (*G.ROOTS, "elsewhere"))
    name = F.when(F.col("p_partkey") % 7 == 0, "other.json").otherwise("layout_boxes.normalized.json")
    path = F.concat_ws("/", F.lit("/run/outputs/sources"), root, F.concat(F.lit("V-"), (F.col("p_size") % 3).cast("string"), F.lit(".x")), F.concat(F.lit("s"), F.col("p_partkey").cast("string")), name)
    return G.legacy_sources(T.table(s, d, "part").select(path.alias("path")))


@query(
    "adapter_output_regions",
    """with c as (select c_custkey as k, cast(c_custkey as varchar) as p from customer)
select p as page_id, case when k % 6 in (1, 2, 3, 4) then -1 else 1 end as region_ord, case when k % 6 in (1, 2, 3, 4) then null else p || ':m1:0001' end as region_id, case when k % 6 in (0, 5) then cast(k as double) end as x1, case when k % 6 in (0, 5) then k + 5.0 end as x2,
  case k % 6 when 0 then 'text' when 5 then 'title' end as label, case k % 6 when 0 then 1.0 when 5 then 0.0 end as confidence, case when k % 6 = 0 then 4 else -1 end as reading_order, case k % 6 when 1 then 'ValueError' when 2 then 'ValueError' when 3 then 'TypeError' when 4 then 'ValueError' end as error_type from c""",
)
def adapter_output_regions(s: SparkSession, d: str) -> DataFrame:
    """Outputs of another page, without a box, with a null confidence, unreadable, and sound ones."""
    k = F.col("c_custkey")
    word = k.cast("string")
    box = F.concat(F.lit("["), word, F.lit(",2,"), (k + 5).cast("string"), F.lit(",9]"))
    page = F.when(k % 6 == 1, "other").otherwise(word)
    fields = (
        F.when(k % 6 == 2, '"bbox":[1,2]')
        .when(k % 6 == 3, F.concat(F.lit('"bbox":'), box, F.lit(',"confidence":null')))
        .when(k % 6 == 5, F.concat(F.lit('"bbox_xyxy":[],"box":'), box, F.lit(',"label":"","norm_label":"title"')))
        .otherwise(F.concat(F.lit('"bbox":'), box, F.lit(',"score":7,"label":" ","reading_order":"4"')))
    )
    payload = F.when(k % 6 == 4, "{").otherwise(F.concat(F.lit('{"page_id":"'), page, F.lit('","regions":[{'), fields, F.lit("}]}")))
    out = B.output_regions(T.table(s, d, "customer").select(k.alias("page_id"), F.lit("m1").alias("model_id"), payload.alias("payload")))
    return out.select("page_id", F.coalesce("region_ord", F.lit(-1)).alias("region_ord"), "region_id", "x1", "x2", "label", "confidence", F.coalesce("reading_order", F.lit(-1)).alias("reading_order"), F.regexp_replace("error_type", "^JSONDecodeError$", "ValueError").alias("error_type"))


def count_words(pages: pd.DataFrame) -> list[int]:
    """A model for batches of pages: the words of their html; a batch with a page it cannot take fails whole."""
    for i, url in zip(pages["page_id"], pages["url"], strict=True):
        if i % 41 == 7:
            raise ValueError("cannot be decoded")
        if url is None or "://" not in url:
            raise KeyError("url")
    return [len((html or "").split(" ")) for html in pages["html"]]


@query(
    "batch_fallback",
    """select page_id, case when bad is null then 'ok' else 'error' end as status, bad as error_type, case when bad is null then cast(len(string_split(coalesce(html, ''), ' ')) as varchar) end as result
from (select *, case when page_id % 41 = 7 then 'ValueError' when url is null or not contains(url, '://') then 'KeyError' end as bad from pages)""",
)
def batch_fallback(s: SparkSession, d: str) -> DataFrame:
    """Pages through a model that takes eight at a time, some of which fail their batch."""
    return batching.run_batched(T.table(s, d, "pages"), count_words, "page_id", 8).select("page_id", "status", "error_type", "result")
