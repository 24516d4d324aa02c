"""The register of queries and the SQL of the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import layout as L
from quire.operators.spatial import variant_members
from quire.sources import derived as T

W, H = T.WIDTH, T.HEIGHT
TEXT = ("text", "title")

Q: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        Q[name] = (f, sql)
        return f

    return add


def boxes(spark: SparkSession, d: str, counted: bool = False) -> DataFrame:
    return T.boxes(spark, d, counted).withColumn("norm_label", L.normalize_label(F.col("source_label")))


def sound(spark: SparkSession, d: str, counted: bool = False) -> DataFrame:
    return boxes(spark, d, counted).filter(~L.degenerate())


BOXES = """
bh as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as bigint) as q,
         l_partkey*7919 + l_suppkey*104729 + l_linenumber*1299709 as h
  from lineitem),
bg as (
  select cast(floor(l_orderkey/64.0) as bigint) as page_id, l_orderkey % 64 as k, h, q,
         row_number() over (partition by cast(floor(l_orderkey/64.0) as bigint) order by l_orderkey, l_linenumber, l_partkey, l_suppkey) as seq
  from bh),
braw as (
  select page_id, cast(seq as int) as seq, k,
    case h % 6 when 4 then 'dell' when 5 then 'mineru' else 'paddle' end as source_family,
    case h % 6 when 0 then 'pld_v2' when 1 then 'pld_v3' when 2 then 'pld_plusL' when 3 then 'pvl15' when 4 then 'dell' else 'mineru25' end as source_model,
    case when k % 16 = 0 then 'headline' when k % 16 = 1 then 'photograph' when k % 16 = 2 then 'table' when h % 2 = 0 then 'article' else 'paragraph' end as source_label,
    cast(case when q >= 50 then 50 when q = 1 then 0 when q = 2 then 20 + (k % 4)*600 else 20 + (k % 4)*600 + (h % 7)*3 end as double) as x1,
    cast(case when q >= 50 then 100 + (h % 5)*8 when q = 1 then 10 + floor(k/4.0)*198 when q = 2 then 10 else 10 + floor(k/4.0)*198 + (h % 5)*3 end as double) as y1,
    cast(case when q >= 50 then 2350 when q = 1 then 2400 when q = 2 then 100 + (k % 4)*600 when q = 3 then 20 + (k % 4)*600 else 560 + (k % 4)*600 - (h % 4)*8 end as double) as x2,
    cast(case when q >= 50 then 2600 when q = 1 then 70 + floor(k/4.0)*198 when q = 2 then 3190 else 180 + floor(k/4.0)*198 - (h % 3)*6 end as double) as y2,
    cast(h % 128 as double)/128 as score
  from bg),
bx as (
  select *, case when k % 16 = 0 then 'title' when k % 16 = 1 then 'image' when k % 16 = 2 then 'table' else 'text' end as norm_label,
    greatest(0, x2-x1)*greatest(0, y2-y1) as area, x2-x1 <= 1 or y2-y1 <= 1 as flat,
    case when x2-x1 >= 1560 and y2-y1 <= 192 then 'wide' when y2-y1 >= 2080 and x2-x1 <= 144 then 'tall' else 'none' end as strip
  from braw)"""

TIMES = """
tk as (select *, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events),
tm as (
  select event_id as ord, user_id as page_id,
    case event_type when 'view' then 'page_profile' when 'purchase' then 'page_total' else 'model_adapter' end as stage,
    case when event_type in ('view', 'purchase') then '' when k % 3 = 0 then 'baseline_geometry_v1' when k % 3 = 1 then 'column_detector_v1' else 'legal_notice_probe_v1' end as model_id,
    case when event_type = 'view' then 'profiler' when event_type = 'purchase' then 'orchestration' when k % 3 = 0 then 'profile' when k % 3 = 1 then 'layout' else 'text_probe' end as family,
    event_id % 211 = 0 or event_id % 223 = 0 or event_id % 227 = 0 or event_id % 229 = 0 as unreadable,
    case when event_id % 211 = 0 or event_id % 223 = 0 or event_id % 227 = 0 or event_id % 229 = 0 or value < 0 then 0 else value end as s,
    case when event_type = 'error' then 'error' when k % 11 = 0 then 'skipped' else 'ok' end as status,
    case when k % 2 = 0 then 'cpu' else 'gpu' end as resource_class,
    case when value > 50 then 'hard' when value > 20 then 'medium' else 'easy' end as complexity
  from tk)"""

MODELS = ", ".join(f"('{m}')" for m in T.MODELS)
PLAN = f"""
pl as (select page_id, model_id from (select distinct user_id as page_id from events), (values {MODELS}) as m(model_id) where (page_id + length(model_id)) % 5 <> 0),
ob as (select page_id, model_id, bool_or(status in ('ok', 'skipped')) as ok from tm where stage = 'model_adapter' group by all)"""


def inter(a: str, b: str) -> str:
    return f"greatest(0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"


def apart(a: str, b: str) -> str:
    """Comparisons that leave only overlapping boxes, so that a pair costs little."""
    return f"{a}.x1 < {b}.x2 and {b}.x1 < {a}.x2 and {a}.y1 < {b}.y2 and {b}.y1 < {a}.y2"


SUPPORT = f"""
sp as (
  select a.page_id, a.seq, cast(least(3, count(distinct b.source_family)) as int) as support
  from bx a join bx b on a.page_id = b.page_id and a.norm_label = b.norm_label and not a.flat and not b.flat and {apart('a', 'b')}
  where {inter('a', 'b')} / (a.area + b.area - {inter('a', 'b')}) >= 0.2 or {inter('a', 'b')} / a.area >= 0.6 or {inter('a', 'b')} / b.area >= 0.6
  group by all)"""

LINES = """
lq as (
  select *, round_even(x1/8, 0) as a, round_even(y1/8, 0) as b, round_even(x2/8, 0) as c, round_even(y2/8, 0) as d from bx
  where norm_label in ('text', 'title') and not flat and area <= 614400 and not (x2-x1 >= 2160 and y2-y1 <= 192) and not (y2-y1 >= 2880 and x2-x1 <= 144)),
lf as (select * from lq qualify row_number() over (partition by page_id, a, b, c, d order by score desc, area desc, seq) = 1),
ln as (
  select page_id, cast(row_number() over (partition by page_id order by score desc, area desc, seq) as int) as line_ord, seq, x1, y1, x2, y2, area from lf
  qualify row_number() over (partition by page_id order by score desc, area desc, seq) <= 120)"""

HITS = f"""
ht as (
  select b.page_id, b.seq, count(*) filter ({inter('l', 'b')} / l.area >= 0.5) as hits from bx b join ln l on l.page_id = b.page_id and {apart('l', 'b')} group by all)"""

BASE = """
bs as (
  select bx.* from bx join sp using (page_id, seq) left join ht using (page_id, seq)
  where norm_label not in ('text', 'title')
     or not (strip <> 'none' and support < 2 or area/7680000 >= 0.22 and support < 2 and score < 0.75 or area/7680000 >= 0.30 and support < 3 or coalesce(hits, 0) < 2))"""


def cells(source: str, keys: str, out: str) -> str:
    """Raster cells that a group's boxes touch: line by line, the lengths of the spans' union."""
    clip = lambda c, f, top: f"greatest(0, least({top}, {f}({c}/8)))"
    return f"""{out}_s as (
  select {keys}, {clip('x1', 'floor', 300)} as a, {clip('x2', 'ceil', 300)} as b, cast({clip('y1', 'floor', 400)} as bigint) as t, cast({clip('y2', 'ceil', 400)} as bigint) as u from {source}),
{out}_r as (select distinct {keys}, a, b, unnest(range(t, u)) as y from {out}_s where b > a and u > t),
{out}_n as (
  select {keys}, greatest(0, b - greatest(a, coalesce(max(b) over (partition by {keys}, y order by a, b rows between unbounded preceding and 1 preceding), a))) as n from {out}_r),
{out} as (select {keys}, cast(sum(n) as bigint) as cells from {out}_n group by {keys})"""


VARIANTS = "vm(variant, source_model) as (values " + ", ".join(f"('{v}', '{m}')" for v, ms in variant_members().items() for m in ms) + ")"
