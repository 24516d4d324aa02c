"""Queries on detected boxes: labels, geometry, joins of boxes and lines, unions, selections, fusion and its measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import layout as L
from quire.operators import documents as D
from quire.operators import fusion as Z
from quire.operators import spatial as S
from quire.operators.grid import fixed
from quire.queries import fusion_sql
from quire.queries.base import BASE, BOXES, HITS, LINES, SUPPORT, TEXT, VARIANTS, H, W, boxes, cells, inter, query, sound
from quire.sources import derived as T

#: Cells about as large as the pages' blocks.
GRID = fixed((W / 4, H / 8))
ENDINGS = (" Table", " PHOTO", " caption", " Masthead", "")


@query(
    "label_normalize",
    """select p_partkey, case when regexp_matches(x, 'text|article|paragraph|content|reference|number|footnote|caption') then 'text' when regexp_matches(x, 'title|header|headline|masthead|author') then 'title'
  when contains(x, 'table') then 'table' when regexp_matches(x, 'image|figure|photo|advert|cartoon|logo|picture') then 'image' else 'other' end as label
from (select p_partkey, lower(trim(p_type || case p_partkey % 5 when 0 then ' Table' when 1 then ' PHOTO' when 2 then ' caption' when 3 then ' Masthead' else '' end)) as x from part)""",
)
def label_normalize(s: SparkSession, d: str) -> DataFrame:
    return T.table(s, d, "part").select("p_partkey", L.normalize_label(F.concat("p_type", T.pick(F.col("p_partkey") % 5, ENDINGS))).alias("label"))


@query("label_histogram", f"with {BOXES} select source_label, count(*) as n from bx group by 1")
def label_histogram(s: SparkSession, d: str) -> DataFrame:
    return boxes(s, d).groupBy("source_label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source_label")


@query("source_family", f"with {BOXES} select case when seq % 9 = 0 then 'given' when source_model = 'pld_v3' and seq % 2 = 0 then 'other_v3' else source_family end as family, count(*) as n from bx group by 1")
def source_family(s: SparkSession, d: str) -> DataFrame:
    given = F.when(F.col("seq") % 9 == 0, "given").when(F.col("seq") % 2 == 0, "")
    model = F.when((F.col("source_model") == "pld_v3") & (F.col("seq") % 2 == 0), "other_v3").otherwise(F.col("source_model"))
    return boxes(s, d).groupBy(L.source_family(given, model).alias("family")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "box_geometry",
    f"""with {BOXES}, p as (select a.page_id, a.seq, b.seq as other, {inter('a', 'b')} as i, a.area as aa, b.area as ba from bx a join bx b on a.page_id = b.page_id and a.k = b.k and a.seq < b.seq where not a.flat and not b.flat)
select page_id, seq, other, round(i, 3) as inter, round(i / (aa + ba - i), 6) as iou, round(i / aa, 6) as ioa from p""",
)
def box_geometry(s: SparkSession, d: str) -> DataFrame:
    b = sound(s, d).select("page_id", "k", "seq", *S.XY)
    pairs = S.prefixed(b, "a_", "page_id", "k").join(S.prefixed(b, "b_", "page_id", "k"), ["page_id", "k"]).filter("a_seq < b_seq")
    return pairs.select("page_id", F.col("a_seq").alias("seq"), F.col("b_seq").alias("other"), F.round(L.intersection("a_", "b_"), 3).alias("inter"), F.round(L.iou("a_", "b_"), 6).alias("iou"), F.round(L.ioa("a_", "b_"), 6).alias("ioa"))


@query("box_flags", f"with {BOXES} select page_id, seq, flat, strip, area >= 614400 or strip <> 'none' as large, not flat and area <= 614400 and not (x2-x1 >= 2160 and y2-y1 <= 192) and not (y2-y1 >= 2880 and x2-x1 <= 144) as line_shaped from bx")
def box_flags(s: SparkSession, d: str) -> DataFrame:
    return boxes(s, d).select("page_id", "seq", L.degenerate().alias("flat"), L.strip_shape(W, H).alias("strip"), L.large(W, H).alias("large"), L.line_shaped(W, H).alias("line_shaped"))


@query(
    "crop_boxes",
    f"""with {BOXES}, c as (select page_id, seq, cast(greatest(0, floor(x1) - 2) as int) as cx1, cast(greatest(0, floor(y1) - 2) as int) as cy1, cast(least(2400, ceil(x2) + 2) as int) as cx2, cast(least(3200, ceil(y2) + 2) as int) as cy2 from bx)
select * from c where cx2 - cx1 >= 24 and cy2 - cy1 >= 18""",
)
def crop_boxes(s: SparkSession, d: str) -> DataFrame:
    return boxes(s, d).withColumn("c", L.crop_box(W, H)).filter("c is not null").select("page_id", "seq", "c.*")


@query(
    "clamped_boxes",
    f"""with {BOXES}, c as (select page_id, seq, least(1200, greatest(0, x1 - 6)) as x1, least(1600, greatest(0, y1 - 6)) as y1, least(1200, greatest(0, x2 + 6)) as x2, least(1600, greatest(0, y2 + 6)) as y2 from bx)
select page_id, seq, case when x2 > x1 and y2 > y1 then x1 else 0 end as x1, case when x2 > x1 and y2 > y1 then y1 else 0 end as y1, case when x2 > x1 and y2 > y1 then x2 else 0 end as x2, case when x2 > x1 and y2 > y1 then y2 else 0 end as y2 from c""",
)
def clamped_boxes(s: SparkSession, d: str) -> DataFrame:
    """Boxes grown by 6 pixels and cut to a page of a quarter of the size."""
    return boxes(s, d).select("page_id", "seq", L.clamped(F.lit(W / 2), F.lit(H / 2), 6.0).alias("c")).select("page_id", "seq", "c.*")


query("cross_source_support", f"with {BOXES}, {SUPPORT} select * from sp")(lambda s, d: S.cross_source_support(sound(s, d), grids=GRID))
query("pseudo_lines", f"with {BOXES}, {LINES} select page_id, line_ord, seq, x1, y1, x2, y2 from ln")(lambda s, d: S.pseudo_lines(boxes(s, d), W, H))


@query(
    "line_best_coverage",
    f"""with {BOXES}, {LINES}
select l.page_id, l.line_ord, round(coalesce(max({inter('l', 'b')} / l.area), 0), 6) as best_coverage, count(*) filter ({inter('l', 'b')} / l.area >= 0.5) as covering
from ln l left join bx b on l.page_id = b.page_id and not b.flat and b.source_family = 'dell' group by 1, 2""",
)
def line_best_coverage(s: SparkSession, d: str) -> DataFrame:
    return S.line_coverage_by(boxes(s, d, True), (F.col("source_family") == "dell") & ~L.degenerate(), W, H)


@query("line_hits", f"with {BOXES}, {LINES}, {HITS} select page_id, seq, coalesce(hits, 0) as hits from bx left join ht using (page_id, seq)")
def line_hits(s: SparkSession, d: str) -> DataFrame:
    return S.line_hits(boxes(s, d), S.pseudo_lines(boxes(s, d), W, H), grids=GRID)


query("base_candidates", f"with {BOXES}, {SUPPORT}, {LINES}, {HITS}, {BASE} select page_id, seq from bs")(lambda s, d: S.base_candidates(boxes(s, d, True).select("page_id", "seq", "norm_label", "source_family", "score", *S.XY), W, H).select("page_id", "seq"))


@query("union_area_ratio", f"with {BOXES}, t as (select * from bx where norm_label in ('text', 'title')), {cells('t', 'page_id', 'c')} select page_id, cells, round(cells / 120000.0, 6) as ratio from c")
def union_area_ratio(s: SparkSession, d: str) -> DataFrame:
    return S.union_cells(boxes(s, d).filter(F.col("norm_label").isin(*TEXT)), W, H)


@query(
    "base_recall",
    f"""with {BOXES}, {SUPPORT}, {LINES}, {HITS}, {BASE}, t as (select * from bx where norm_label in ('text', 'title') and source_family = 'dell'), g as (select * from bs where norm_label in ('text', 'title')),
j as (select page_id, x1, y1, x2, y2 from t union all select page_id, x1, y1, x2, y2 from g), {cells('t', 'page_id', 'ct')}, {cells('g', 'page_id', 'cg')}, {cells('j', 'page_id', 'cj')}
select page_id, round(case when coalesce(cg.cells, 0) > 0 then cast(coalesce(ct.cells, 0) + cg.cells - cj.cells as double) / cg.cells else 0 end, 6) as recall
from (select distinct page_id from j) left join ct using (page_id) left join cg using (page_id) left join cj using (page_id)""",
)
def base_recall(s: SparkSession, d: str) -> DataFrame:
    """What the Dell boxes' texts and titles cover of those fit to measure against."""
    text = F.col("norm_label").isin(*TEXT)
    b = boxes(s, d, True).select("page_id", "seq", "norm_label", "source_family", "score", *S.XY)
    return S.base_recall(S.rated(b, W, H), text & (F.col("source_family") == "dell"), text & S.fit_for_base(W, H), W, H)


@query(
    "best_single_variant",
    f"""with {BOXES}, pb as (select * from bx where source_family = 'paddle'), pt as (select * from pb where norm_label in ('text', 'title')), {cells('pt', 'page_id, source_model', 'c')},
m as (select page_id, source_model, 0.02 * count(*) filter (norm_label in ('text', 'title')) + coalesce(any_value(cells), 0) / 120000.0 - 0.0002 * count(*) as v from pb left join c using (page_id, source_model) group by 1, 2)
select page_id, source_model as best from m
qualify row_number() over (partition by page_id order by v desc, case source_model when 'pld_v2' then 0 when 'pld_v3' then 1 when 'pld_plusL' then 2 else 3 end) = 1""",
)
def best_single_variant(s: SparkSession, d: str) -> DataFrame:
    return Z.best_singles(boxes(s, d), S.variant_members()["P1"], W, H)


@query("reading_order", f"with {BOXES} select page_id, seq, cast(row_number() over (partition by page_id order by y1, x1, seq) as int) as reading_order from bx")
def reading_order(s: SparkSession, d: str) -> DataFrame:
    return S.reading_order(boxes(s, d)).select("page_id", "seq", "reading_order")


@query("quantized_dedupe", f"with {BOXES} select page_id, seq, source_label from bx qualify row_number() over (partition by page_id, source_label, round_even(x1/8, 0), round_even(y1/8, 0), round_even(x2/8, 0), round_even(y2/8, 0) order by seq) = 1")
def quantized_dedupe(s: SparkSession, d: str) -> DataFrame:
    return S.dedupe_quantized(boxes(s, d), 8.0, "source_label").select("page_id", "seq", "source_label")


@query("ocr_line_dedupe", f"with {BOXES} select page_id, seq from bx qualify row_number() over (partition by page_id, source_label || cast(k % 2 as varchar), round_even(x1/4, 0), round_even(y1/4, 0), round_even(x2/4, 0), round_even(y2/4, 0) order by seq) = 1")
def ocr_line_dedupe(s: SparkSession, d: str) -> DataFrame:
    """Boxes as lines of text: the first of each text and place."""
    lines = boxes(s, d).withColumn("text", F.concat("source_label", (F.col("k") % 2).cast("string")))
    return S.dedupe_quantized(lines, 4.0, "text").select("page_id", "seq")


@query("ordered_model_union", f"with {BOXES} select source_model, cast(row_number() over (order by min(page_id * 100000 + seq)) as int) as position from bx group by 1")
def ordered_model_union(s: SparkSession, d: str) -> DataFrame:
    return D.ordered_union(boxes(s, d))


@query("variant_boxes", f"with {BOXES}, {VARIANTS} select variant, source_model, count(*) as n from bx join vm using (source_model) where not flat group by all")
def variant_boxes(s: SparkSession, d: str) -> DataFrame:
    return variants(s, d).groupBy("variant", "source_model").agg(F.count(F.lit(1)).alias("n"))


SHAPE = "struct(x1 double, y1 double, x2 double, y2 double, area double, seq int)"


def keep(items: str, cover: float, same: float) -> str:
    """The fold over a page's boxes."""
    shared = "greatest(0, least(k.x2, b[1].x2) - greatest(k.x1, b[1].x1)) * greatest(0, least(k.y2, b[1].y2) - greatest(k.y1, b[1].y1))"
    clash = f"{shared} >= {cover} * b[1].area or {shared} >= {same} * (k.area + b[1].area - {shared})"
    return f"list_reduce(list_prepend(cast([] as {SHAPE}[]), list_transform({items}, lambda b: [b])), lambda acc, b: case when len(list_filter(acc, lambda k: {clash})) > 0 then acc else list_concat(acc, b) end)"


def folded(label: str, order: str, cover: float, same: float) -> str:
    items = "list({'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'area': area, 'seq': seq} order by " + order + ")"
    return f"(select page_id, unnest(list_transform({keep('items', cover, same)}, lambda k: k.seq)) as seq from (select page_id, {items} as items from ro where area > 0 and norm_label = '{label}' group by 1))"


ORDERED = f"""with {BOXES}, ro as (select * exclude (score), case when seq % 13 = 0 then null else score end as score, case when seq % 10 = 0 then 0 else row_number() over (partition by page_id order by y1, x1, seq) end as reading_order from bx where not flat)"""
LAST = "coalesce(nullif(reading_order, 0), 1000000000)"


def ordered(s: SparkSession, d: str) -> DataFrame:
    """Boxes in reading order, every tenth without a place, some without a score."""
    b = S.reading_order(sound(s, d, True))
    return b.withColumn("reading_order", F.when(F.col("seq") % 10 == 0, 0).otherwise(F.col("reading_order"))).withColumn("score", F.when(F.col("seq") % 13 != 0, F.col("score")))


@query(
    "ocr_box_selection",
    f"""{ORDERED}, kp as ({folded('title', f'area, coalesce(score, 0) desc, {LAST}, seq', 0.92, 0.85)} union all {folded('text', f'area desc, coalesce(score, 0) desc, {LAST}, seq', 0.85, 0.75)})
select page_id, seq, cast(row_number() over (partition by page_id order by {LAST}, y1, x1, norm_label desc, seq) as int) as box_index from kp join ro using (page_id, seq)""",
)
def ocr_box_selection(s: SparkSession, d: str) -> DataFrame:
    own = ordered(s, d).select("page_id", "seq", "norm_label", "reading_order", "score", *S.XY)
    return S.ocr_boxes(own).select("page_id", "seq", "box_index")


def variants(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of every variant, S1 being one fixed model."""
    members = S.variant_members()
    of = F.array_compact(F.array(*[F.when(F.col("source_model").isin(*m), v) for v, m in members.items()]))
    return sound(spark, d).withColumn("variant", F.explode(of))


@query("greedy_fusion", fusion_sql.GREEDY)
def fused(spark: SparkSession, d: str) -> DataFrame:
    """Fused boxes of all variants; S1 is the page's best Paddle model."""
    return Z.fuse_variants(boxes(spark, d, True), W, H).drop("seq")


@query("fused_measures", fusion_sql.MEASURES + " select * from ms")
def fused_measures(spark: SparkSession, d: str) -> DataFrame:
    return Z.measure(boxes(spark, d, True), None, W, H)


# The rankings' formulas on measures that SQL can make: plain counts of each variant's and source's boxes.
BOARD = """, s1 as (select page_id, coalesce(base_recall, 0) as r1 from ms where kind = 'variant' and name = 'S1'),
bd as (
  select kind, name, count(*) as pages, round(coalesce(avg(base_recall), 0), 6) as recall, round(avg(line_coverage), 6) as line_coverage, round(median(line_coverage), 6) as median_line_coverage,
    round(avg(text_area), 6) as area, round(avg(box_count), 3) as boxes, count(*) filter (coalesce(base_recall, 0) > r1) as improved, round(coalesce(avg(base_recall), 0) + 0.25 * avg(text_area) - 0.00025 * avg(box_count), 6) as score
  from ms left join s1 using (page_id) group by 1, 2)
"""
MEASURES = (
    f"""with {BOXES}, {VARIANTS}, vb as (select 'variant' as kind, variant as name, bx.* from bx join vm using (source_model) union all select 'source', source_model, bx.* from bx),
ms as (
  select page_id, kind, name, count(*) filter (score >= 0.25) / count(*) as line_coverage, count(*) filter (flat) as uncovered_lines, count(*) as box_count,
    count(*) filter (norm_label = 'text') / count(*) as text_area, case when page_id % 9 <> 0 or name = 'S1' then count(*) filter (score >= 0.5) / 64.0 end as base_recall
  from vb where not (name = 'P4' and page_id % 7 = 0) group by 1, 2, 3)"""
    + BOARD
)


def measures(s: SparkSession, d: str) -> DataFrame:
    members = S.variant_members()
    of = [F.when(F.col("source_model").isin(*m), F.struct(F.lit("variant").alias("kind"), F.lit(v).alias("name"))) for v, m in members.items()]
    of.append(F.struct(F.lit("source").alias("kind"), F.col("source_model").alias("name")))
    b = boxes(s, d).withColumn("flat", L.degenerate()).withColumn("o", F.explode(F.array_compact(F.array(*of)))).select("*", "o.*").filter(~((F.col("name") == "P4") & (F.col("page_id") % 7 == 0)))
    n, part = F.count(F.lit(1)), lambda c: F.count_if(c) / F.count(F.lit(1))
    g = b.groupBy("page_id", "kind", "name").agg(part(F.col("score") >= 0.25).alias("line_coverage"), F.count_if("flat").alias("uncovered_lines"), n.alias("box_count"), part(F.col("norm_label") == "text").alias("text_area"), (F.count_if(F.col("score") >= 0.5) / 64.0).alias("r"))
    return g.withColumn("base_recall", F.when((F.col("page_id") % 9 != 0) | (F.col("name") == "S1"), F.col("r"))).drop("r")


query("variant_leaderboard", MEASURES + "select * exclude (kind) from bd where kind = 'variant'")(lambda s, d: Z.variant_board(measures(s, d)))
query("source_leaderboard", MEASURES + "select name, pages, recall, line_coverage, area, boxes, score from bd where kind = 'source'")(lambda s, d: Z.source_board(measures(s, d)))
query("recommended_variant", MEASURES + "select arg_max(name, score) as best_by_score, 'P3' as recommended from bd where kind = 'variant'")(lambda s, d: Z.recommended(measures(s, d), "P3"))
query("per_page_variant_metrics", MEASURES + "select page_id, name, coalesce(base_recall, 0) as base_recall, line_coverage, uncovered_lines, box_count, text_area from ms where kind = 'variant'")(lambda s, d: Z.per_page(measures(s, d), "variant"))
query("per_page_source_metrics", MEASURES + "select page_id, name, coalesce(base_recall, 0) as base_recall, line_coverage, uncovered_lines, box_count, text_area from ms where kind = 'source'")(lambda s, d: Z.per_page(measures(s, d), "source"))


def gains(low: str, high: str, weights: tuple[float, float, float], how: str, out: str) -> str:
    a, b, c = weights
    return f"""{out} as (
  select page_id, round({a} * (coalesce(h.base_recall, 0) - coalesce(l.base_recall, 0)) + {b} * (coalesce(h.text_area, 0) - coalesce(l.text_area, 0)) + {c} * (1 - coalesce(l.base_recall, 0)), 6) as score,
    round(coalesce(h.base_recall, 0) - coalesce(l.base_recall, 0), 6) as recall_gain, round(coalesce(h.text_area, 0) - coalesce(l.text_area, 0), 6) as area_gain
  from (select * from ms where kind = 'variant' and name = '{low}') l {how} join (select * from ms where kind = 'variant' and name = '{high}') h using (page_id) order by 2 desc, 1 limit 20)"""


RANKED = "select *, cast(row_number() over (order by score desc, page_id) as int) as rank from "
INFORMATIVE, DELTA = gains("S1", "P2", (3.0, 2.0, 0.7), "full", "tf"), gains("P2", "P4", (3.5, 1.5, 0.5), "inner", "td")
query("top_informative", MEASURES + ", " + INFORMATIVE + " " + RANKED + "tf")(lambda s, d: Z.informative(measures(s, d), "P2"))
query("top_delta", MEASURES + ", " + DELTA + " " + RANKED + "td")(lambda s, d: Z.delta(measures(s, d)))


@query("review_pages", MEASURES + ", " + INFORMATIVE + ", " + DELTA + " select page_id from tf union select page_id from td")
def review_pages(s: SparkSession, d: str) -> DataFrame:
    pages = boxes(s, d).select("page_id").distinct().withColumn("ord", F.col("page_id"))
    return Z.review_pages(measures(s, d), pages, "P2", "top20")


# The same on the measures of fused boxes.
FUSED = fusion_sql.MEASURES + BOARD
query("fused_leaderboard", FUSED + "select * from bd")(lambda s, d: Z.board(fused_measures(s, d)))
query("fused_top_informative", FUSED + ", " + INFORMATIVE + " " + RANKED + "tf")(lambda s, d: Z.informative(fused_measures(s, d), "P2"))
query("fused_top_delta", FUSED + ", " + DELTA + " " + RANKED + "td")(lambda s, d: Z.delta(fused_measures(s, d)))
