"""SQL of the greedy fusion and its measures: the fold as a list_reduce whose state is a struct of lists."""

from __future__ import annotations

from quire.operators.fusion import model_sets
from quire.operators.spatial import variant_members
from quire.queries.base import BASE, BOXES, HITS, LINES, SUPPORT, H, W, apart, cells, inter

SETS = "st(name, members) as (values " + ", ".join(f"('{n}', {list(m)})" for n, m in model_sets().items()) + ")"
PAGE = float(W * H)


def let(name: str, value: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def cut(x1: str, y1: str, x2: str, y2: str) -> str:
    """A box cut to the page, zeros if nothing is left."""
    on = {"x1": f"least({W}.0, greatest(0.0, {x1}))", "y1": f"least({H}.0, greatest(0.0, {y1}))", "x2": f"least({W}.0, greatest(0.0, {x2}))", "y2": f"least({H}.0, greatest(0.0, {y2}))"}
    box = "{" + ", ".join(f"'{k}': cast({v} as double)" for k, v in on.items()) + "}"
    return let("z", box, "case when z.x2 > z.x1 and z.y2 > z.y1 then z else {'x1': 0.0::double, 'y1': 0.0::double, 'x2': 0.0::double, 'y2': 0.0::double} end")


def padded(v: str) -> str:
    return cut(f"{v}.x1 - 6", f"{v}.y1 - 6", f"{v}.x2 + 6", f"{v}.y2 + 6")


def fold() -> str:
    """State s: boxes chosen (o: their fields and turn, null for recovered ones) and lines covered (c)."""
    bare = "list_filter(b.hits, lambda i: not list_contains(s.c, i))"
    twins = f"""list_concat(list_transform(list_filter(b.twins, lambda t: len(list_filter(s.o, lambda k: k.turn = t.turn)) > 0), lambda t: t.shared),
      list_transform(list_filter(s.o, lambda k: k.turn is null and b.norm_label = 'text' and {inter('k', 'b')} / ((k.x2 - k.x1) * (k.y2 - k.y1) + b.area - {inter('k', 'b')}) >= 0.85), lambda k: {inter('k', 'b')}))"""
    support = "1 + len(list_distinct(list_transform(list_filter(b.partners, lambda p: list_contains(members, p.m)), lambda p: p.f)))"
    facts = f"{{'bare': {bare}, 'twins': {twins}, 'support': case when b.large then {support} else 1 end}}"
    giant = "(b.large and (b.share >= 0.22 and d.support < 2 and b.score < 0.75 or b.share >= 0.30 and d.support < 3))"
    earns = "(len(d.bare) >= 2 and len(d.bare) >= 0.4 * len(b.hits))"
    own = "{'turn': b.turn, 'x1': b.x1, 'y1': b.y1, 'x2': b.x2, 'y2': b.y2, 'score': b.score}"
    keep = f"{{'o': list_append(s.o, {own}), 'c': list_concat(s.c, d.bare)}}"
    end = lambda pick, c, of: f"{of}(b.{c}, list_{pick}(list_transform(d.bare, lambda i: lines[i].{c})))"
    hull = cut(end("min", "x1", "greatest"), end("min", "y1", "greatest"), end("max", "x2", "least"), end("max", "y2", "least"))
    place = lambda v: "[" + ", ".join(f"round_even({v}.{c} / 8, 0)" for c in ("x1", "y1", "x2", "y2")) + "]"
    single = let("e", f"list_transform(d.bare, lambda i: {padded('lines[i]')})", f"list_filter(e, lambda v, n: list_position(list_transform(e, lambda u: {place('u')}), {place('v')}) = n)[1:32]")
    found = let("h", hull, f"case when h.x2 > h.x1 and h.y2 > h.y1 and (h.x2 - h.x1) * (h.y2 - h.y1) <= 0.55 * greatest(1, b.area) then [{padded('h')}] else {single} end")
    made = "list_transform(r, lambda v: {'turn': null::bigint, 'x1': v.x1, 'y1': v.y1, 'x2': v.x2, 'y2': v.y2, 'score': least(0.95, greatest(0.1, b.score))::double})"
    inside = f"list_filter(range(1, len(lines) + 1), lambda i: len(list_filter(r, lambda v: {inter('v', 'lines[i]')} / lines[i].area >= 0.5)) > 0)"
    recover = let("r", found, f"{{'o': list_concat(s.o, {made}), 'c': list_distinct(list_concat(s.c, {inside}))}}")
    step = f"""case when b.thin and d.support < 2 then s
      when b.large and (d.support < 2 or {giant} and len(d.twins) = 0) and not {earns} then s
      when len(d.twins) > 0 and b.area - list_max(d.twins) <= 0.02 * {PAGE} and len(d.bare) = 0 then s
      when len(d.twins) > 0 or not b.large or d.support >= 2 and not {giant} then {keep}
      when b.share >= 0.12 then {recover}
      when {giant} then s else {keep} end"""
    start = "{'o': cast([] as struct(turn bigint, x1 double, y1 double, x2 double, y2 double, score double)[]), 'c': cast([] as bigint[])}"
    return f"list_reduce(items, lambda s, b: {let('d', facts, step)}, {start})"


FUSED = f"""with {BOXES}, {SUPPORT}, {LINES}, {HITS}, {BASE},
fb as (
  select *, row_number() over (partition by page_id order by score desc, area desc, seq) as turn, area / {PAGE} as share, norm_label in ('text', 'title') and strip <> 'none' as thin,
    norm_label in ('text', 'title') and (strip <> 'none' or area / {PAGE} >= 0.08) as large from bx),
fp as (
  select a.page_id, a.turn, list(distinct {{'m': b.source_model, 'f': b.source_family}}) as partners
  from fb a join fb b on a.page_id = b.page_id and a.norm_label = b.norm_label and a.large and a.source_family <> b.source_family and a.area > 0 and b.area > 0 and {apart('a', 'b')}
  where {inter('a', 'b')} / (a.area + b.area - {inter('a', 'b')}) >= 0.2 or {inter('a', 'b')} / least(a.area, b.area) >= 0.6 group by all),
ft as (
  select b.page_id, b.turn, list({{'turn': a.turn, 'shared': {inter('a', 'b')}}}) as twins
  from fb a join fb b on a.page_id = b.page_id and a.norm_label = b.norm_label and a.turn < b.turn and a.area > 0 and b.area > 0 and {apart('a', 'b')}
  where {inter('a', 'b')} / (a.area + b.area - {inter('a', 'b')}) >= 0.85 group by all),
fh as (
  select b.page_id, b.turn, list(cast(l.line_ord as bigint) order by l.line_ord) as hits from fb b join ln l on l.page_id = b.page_id and {apart('l', 'b')}
  where {inter('l', 'b')} / l.area >= 0.5 group by all),
fl as (select page_id, list({{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'area': area}} order by line_ord) as lines from ln group by 1),
fi as (
  select page_id, turn, source_model, flat, {{'turn': turn, 'norm_label': norm_label, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'score': score, 'area': area, 'share': share, 'thin': thin, 'large': large,
    'partners': coalesce(partners, []), 'twins': coalesce(twins, []), 'hits': coalesce(hits, [])}} as item
  from fb left join fp using (page_id, turn) left join ft using (page_id, turn) left join fh using (page_id, turn)),
{SETS},
fg as (select page_id, name, any_value(members) as members, list(item order by turn) as items from fi join st on list_contains(members, source_model) and not flat group by 1, 2),
fs as materialized (select page_id, name, {fold()} as s from fg left join (select page_id, lines from fl) using (page_id)),
fo as (
  select page_id, name, k.turn as turn, k.x1 as x1, k.y1 as y1, k.x2 as x2, k.y2 as y2, k.score as score, place
  from (select page_id, name, unnest(s.o) as k, generate_subscripts(s.o, 1) as place from fs)),
fk as (
  select f.*, coalesce(b.norm_label, 'text') as norm_label, coalesce(b.source_family, 'synthetic') as source_family, coalesce(b.source_model, 'synthetic_line_recovery') as source_model
  from fo f left join fb b using (page_id, turn)),
pt as (select * from bx where source_family = 'paddle' and norm_label in ('text', 'title')), {cells('pt', 'page_id, source_model', 'pc')},
pm as (
  select page_id, source_model, 0.02 * count(*) filter (norm_label in ('text', 'title')) + coalesce(any_value(cells), 0) / 120000.0 - 0.0002 * count(*) as v
  from bx left join pc using (page_id, source_model) where source_family = 'paddle' group by 1, 2),
fx as (
  select page_id, source_model as best from pm
  qualify row_number() over (partition by page_id order by v desc, case source_model when 'pld_v2' then 0 when 'pld_v3' then 1 when 'pld_plusL' then 2 else 3 end) = 1),
nm(name, variant) as (values {', '.join(f"('{n}', '{v}')" for v, m in variant_members().items() if v != 'S1' for n in ([v] if len(m) > 1 else m))}),
fv as (select page_id, name, variant from fx, nm union all select page_id, best, 'S1' from fx)"""

GREEDY = f"""{FUSED}
select page_id, variant, cast(row_number() over (partition by page_id, variant order by y1, x1, place) as int) as reading_order, source_family, source_model, norm_label, x1, y1, x2, y2, score
from fk join fv using (page_id, name)"""

MEASURES = f"""{FUSED},
kt as (select page_id, name, x1, y1, x2, y2 from fk where norm_label in ('text', 'title')),
kb as (select page_id, name, x1, y1, x2, y2 from bs, (select distinct name from st) where norm_label in ('text', 'title')),
kj as (select * from kt union all select * from kb), {cells('kt', 'page_id, name', 'ct')}, {cells('kb', 'page_id, name', 'cb')}, {cells('kj', 'page_id, name', 'cj')},
mm as (
  select p.page_id, st.name, coalesce(len(lines), 0) as n_lines, coalesce(len(list_distinct(s.c)), 0) as covered, coalesce(len(s.o), 0) as box_count,
    coalesce(ct.cells, 0) as own, coalesce(cb.cells, 0) as base, coalesce(cj.cells, 0) as joint, has is not null as has
  from fx p join st on true left join fs on fs.page_id = p.page_id and fs.name = st.name left join fl on fl.page_id = p.page_id
    left join ct on ct.page_id = p.page_id and ct.name = st.name left join cb on cb.page_id = p.page_id and cb.name = st.name left join cj on cj.page_id = p.page_id and cj.name = st.name
    left join (select distinct page_id, source_model as has from bx) h on h.page_id = p.page_id and h.has = st.name),
rw as (
  select page_id, name, 'variant' as kind, variant as shown from fv
  union all select page_id, name, 'source', name from mm where len((select any_value(members) from st where st.name = mm.name)) = 1 and (has or name in ('dell', 'mineru25'))),
ms as (
  select page_id, kind, shown as name, best as best_single, case when n_lines > 0 then covered / n_lines else 0 end as line_coverage, cast(covered as bigint) as covered_lines,
    cast(n_lines - covered as bigint) as uncovered_lines, cast(box_count as bigint) as box_count, own / 120000.0 as text_area, case when base > 0 then (own + base - joint) / base else 0 end as base_recall
  from rw join mm using (page_id, name) join fx using (page_id))"""
