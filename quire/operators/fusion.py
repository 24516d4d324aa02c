"""Greedy fusion of a page's detections, with small recovery boxes in place of large unsupported ones.

Whether a box is kept depends on those kept before it, so a set of models on a page is one ordered fold, inside the JVM.  All that
needs pairs of boxes is found before it, once for all sets: the models that support a box, the lines it covers and the earlier
boxes that are nearly it.  The boxes are dealt out by page once; pairs, folds and areas follow where a page lies.  The fold's state
is the kept boxes and the covered lines as bits; pages hold hundreds of boxes, which bounds a group, and pages spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import layout as L
from quire.operators.grid import overlapping, solid
from quire.operators.spatial import CELL, XY, near, rastered, variant_members
from quire.operators.sweep import on_raster, raster_size, raster_words

# Thresholds of the selection, and the names that recovered boxes carry.
SAME_IOU, NEW_SHARE, NEW_LEAST, UNCOVERED, RECOVER_AREA, TIGHT, PAD, MOST_RECOVERED = 0.85, 0.40, 2, 0.02, 0.12, 0.55, 6.0, 32
RECOVERED = {"source_family": "synthetic", "source_model": "synthetic_line_recovery", "norm_label": "text"}
TEXT = ("text", "title")
#: A page's boxes are grouped in memory up to so many a task; beyond, Spark sorts them, as it would from 128 on.
GROUPS = 65_536
MOST_LINES = 120


def model_sets() -> dict[str, tuple[str, ...]]:
    """The sets of models that are fused: every source alone, and the variants of several."""
    members = variant_members()
    return {m: (m,) for m in members["P4"]} | {v: m for v, m in members.items() if len(m) > 1}


def _let(name: str, value: str, body: str) -> str:
    """body, with value under a name: SQL's lambdas have no other way to use a value twice and compute it once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _with(name: str, value: str, body: str) -> str:
    """The state that body makes with value under a name."""
    return f"aggregate(array({value}), acc, (acc, {name}) -> {body})"


def _shared(a: str, b: str) -> str:
    side = lambda c: f"greatest(0d, least({a}.{c}2, {b}.{c}2) - greatest({a}.{c}1, {b}.{c}1))"
    return f"{side('x')} * {side('y')}"


def _touching(a: str, b: str) -> str:
    """Comparisons that spare most pairs the arithmetic."""
    return f"{a}.x1 < {b}.x2 and {b}.x1 < {a}.x2 and {a}.y1 < {b}.y2 and {b}.y1 < {a}.y2"


def _clamped(x1: str, y1: str, x2: str, y2: str, w: float, h: float) -> str:
    """A box cut to the page; all zeros without an extent."""
    cut = lambda v, top: f"greatest(0d, least({float(top)}D, {v}))"
    box = f"named_struct('x1', {cut(x1, w)}, 'y1', {cut(y1, h)}, 'x2', {cut(x2, w)}, 'y2', {cut(y2, h)})"
    return _let("q", box, "if(q.x2 > q.x1 and q.y2 > q.y1, q, named_struct('x1', 0d, 'y1', 0d, 'x2', 0d, 'y2', 0d))")


def _recovered(w: float, h: float) -> str:
    """Boxes around the bare lines of b: one, if much smaller than b, else one for each line and place."""
    edge = lambda pick, c, of: f"array_{pick}(transform(e.bare, i -> lines[i].{c}))" if of is None else f"{of}(b.{c}, array_{pick}(transform(e.bare, i -> lines[i].{c})))"
    hull = _clamped(edge("min", "x1", "greatest"), edge("min", "y1", "greatest"), edge("max", "x2", "least"), edge("max", "y2", "least"), w, h)
    padded = lambda v: _clamped(f"{v}.x1 - {PAD}D", f"{v}.y1 - {PAD}D", f"{v}.x2 + {PAD}D", f"{v}.y2 + {PAD}D", w, h)
    place = lambda v: f"array({', '.join(f'rint({v}.{c} / 8)' for c in XY)})"
    one = f"t.x2 > t.x1 and t.y2 > t.y1 and (t.x2 - t.x1) * (t.y2 - t.y1) / greatest(1d, b.area) <= {TIGHT}D"
    first = f"filter(each, (v, n) -> not exists(slice(each, 1, n), u -> {place('u')} = {place('v')}))"
    several = _let("each", f"transform(e.bare, i -> {padded('lines[i]')})", f"slice({first}, 1, {MOST_RECOVERED})")
    return _let("t", hull, f"if({one}, array({padded('t')}), {several})")


def _has(words: str, i: str) -> str:
    """Whether bit i, counted from 0, is set in words of 64."""
    return f"(get({words}, shiftright({i}, 6)) & shiftleft(1L, {i})) <> 0L"


def _step(w: float, h: float, threshold: float) -> str:
    """The state after box b, from that before it: acc(turns, made, covered).  Names: b box, e what the state says of it (of d, the facts), r recovered boxes.

    turns: the page's own chosen boxes, as bits by their turns; made: recovered ones, with the turn they were made at; covered: lines, as bits by their places.
    A box that is not large, and so small that any twin leaves little of it bare, goes if it has a twin and no bare line: few comparisons tell.
    """
    page = max(1.0, float(w) * float(h))
    mine = "(get(acc.turns, t.word) & t.bit) <> 0L"
    iou = f"{_shared('k', 'b')} / ((k.x2 - k.x1) * (k.y2 - k.y1) + b.area - {_shared('k', 'b')}) >= {SAME_IOU}D"
    twins = f"""concat(
        if(size(b.twins) = 0, b.none, transform(filter(b.twins, t -> {mine}), t -> t.shared)),
        if(size(acc.made) = 0 or b.norm_label <> '{RECOVERED["norm_label"]}', b.none, filter(transform(filter(acc.made, k -> {_touching("k", "b")}),
          k -> {_let('i', _shared('k', 'b'), f"if(i / ((k.x2 - k.x1) * (k.y2 - k.y1) + b.area - i) >= {SAME_IOU}D, i, null)")}), i -> i is not null)))"""
    bare = f"filter(b.hits, i -> not {_has('acc.covered', 'i')})"
    said = f"""named_struct('bare', {bare}, 'twins', {twins},
      'support', if(b.large, 1 + size(array_distinct(transform(filter(b.partners, p -> array_contains(members, p.model)), p -> p.family))), 1))"""
    judged = f"""named_struct('bare', d.bare, 'twins', d.twins, 'support', d.support,
      'earns', size(d.bare) >= {NEW_LEAST} and size(d.bare) >= {NEW_SHARE}D * size(b.hits),
      'giant', b.large and (b.share >= 0.22D and d.support < 2 and b.sure < 0.75D or b.share >= 0.30D and d.support < 3))"""
    state = lambda turns, made, covered: f"named_struct('turns', {turns}, 'made', {made}, 'covered', {covered})"
    keep = state("transform(acc.turns, (o, n) -> if(n = b.word, o | b.bit, o))", "acc.made", "if(size(b.hits) = 0, acc.covered, zip_with(acc.covered, b.words, (o, m) -> if(m is null, o, o | m)))")
    new = "transform(r, v -> named_struct('x1', v.x1, 'y1', v.y1, 'x2', v.x2, 'y2', v.y2, 'score', least(0.95D, greatest(0.10D, b.sure)), 'at', b.turn))"
    touching = _touching("v", "l") if threshold > 0 else "true"
    inside = f"transform(filter(lines, l -> exists(r, v -> {touching} and {_shared('v', 'l')} / l.area >= {threshold}D)), l -> l.place)"
    reached = _let("j", inside, "transform(acc.covered, (o, n) -> aggregate(j, o, (q, i) -> if(shiftright(i, 6) = n, q | shiftleft(1L, i), q)))")
    recover = _with("r", _recovered(w, h), state("acc.turns", f"concat(acc.made, {new})", reached))
    choice = f"""case
      when b.thin and e.support < 2 then acc
      when b.large and (e.support < 2 or e.giant and size(e.twins) = 0) and not e.earns then acc
      when size(e.twins) > 0 then if(b.area - array_max(e.twins) <= {UNCOVERED * page}D and size(e.bare) = 0, acc, {keep})
      when not b.large or e.support >= 2 and not e.giant then {keep}
      when b.share >= {RECOVER_AREA}D then {recover}
      when e.giant then acc
      else {keep} end"""
    judging = _with("e", _let("d", said, judged), choice)
    repeated = f"""not exists(b.hits, i -> not {_has('acc.covered', 'i')})
      and (exists(b.twins, t -> {mine}) or b.norm_label = '{RECOVERED["norm_label"]}' and exists(acc.made, k -> {_touching("k", "b")} and {iou}))"""
    return f"if(not b.large and b.area <= {UNCOVERED * page}D, if({repeated}, acc, {keep}), {judging})"


def prepared(boxes: DataFrame, lines: DataFrame | None, width: float, height: float, threshold: float = 0.5) -> DataFrame:
    """One row a page: items (its boxes in the order of the fold, with what pairs say of them) and lines.

    boxes (page_id, seq, source_family, source_model, norm_label, corners, score), lines (page_id, line_ord, corners); other columns are left aside.
    lines None: the boxes' own, as `pseudo_lines` has them, told where the boxes lie.
    An item's hits are places in lines (words: the same as bits), its twins the earlier boxes of its label with an overlap of SAME_IOU at least; the
    partners (of large texts alone, as no other box needs support) are the models of other families that support it.

    Boxes are dealt out by page once (not at all, if they lie so).  A page's boxes and lines are tried with each other in one compiled loop, which four comparisons
    end for most pairs: cheaper, on pages of hundreds, than to copy them to cells, sort and join.
    """
    boxes.sparkSession.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(GROUPS))
    sure, size = F.coalesce("score", F.lit(0.0)), L.box_area()
    rows = boxes.select("page_id", "seq", F.coalesce("source_family", F.lit("")).alias("source_family"), "source_model", "norm_label", *[F.col(c).cast("double").alias(c) for c in XY], F.col("score").cast("double").alias("score"))
    text, thin = F.col("norm_label").isin(*TEXT), L.strip_shape(width, height) != "none"
    share = size / max(1.0, float(width) * float(height))
    rows = rows.select("*", sure.alias("sure"), size.alias("area"), share.alias("share"), (text & thin).alias("thin"), (text & (thin | (share >= 0.08))).alias("large"), L.degenerate().alias("flat"), F.coalesce(solid(), F.lit(False)).alias("solid"))
    order = [F.desc("sure"), F.desc("area"), F.col("seq")]
    ranked, nothing = Window.partitionBy("page_id").orderBy(*order), F.lit(None).cast("int")
    if lines is None:
        q = [F.when(F.col("fit"), v).alias(f"q{c}") for c, v in zip(XY, L.quantized(CELL), strict=True)]
        first = F.col("fit") & (F.row_number().over(Window.partitionBy("page_id", "fit", "qx1", "qy1", "qx2", "qy2").orderBy(*order)) == 1)
        nth = F.sum(F.col("first").cast("int")).over(ranked.rowsBetween(Window.unboundedPreceding, 0))
        told = rows.withColumn("fit", F.coalesce(text & L.line_shaped(width, height), F.lit(False))).select("*", *q).withColumn("first", first)
        every = told.select("*", F.row_number().over(ranked).alias("turn"), nth.alias("nth")).withColumn("place", F.when(F.col("first") & (F.col("nth") <= MOST_LINES), F.col("nth") - 1).cast("int"))
    else:
        at = Window.partitionBy("page_id").orderBy("line_ord")
        placed = lines.select("page_id", "line_ord", *[F.col(c).cast("double").alias(c) for c in XY]).withColumn("place", F.row_number().over(at) - 1).drop("line_ord")
        placed = placed.select("*", size.alias("area"), F.coalesce(solid(), F.lit(False)).alias("solid"))
        every = rows.select("*", F.row_number().over(ranked).alias("turn"), nothing.alias("place")).unionByName(placed, True)
    entry = F.struct("turn", "place", "seq", "source_family", "source_model", "norm_label", *XY, "score", "sure", "area", "share", "thin", "large", "flat", "solid")
    line = F.when(F.col("place").isNotNull(), F.struct("place", *XY, "area"))
    pages = every.groupBy("page_id").agg(F.collect_list(entry).alias("all"), F.sort_array(F.collect_list(line)).alias("lines"))

    # The first filter stays small, so that the loop over pairs is one that the JVM compiles; the areas follow for what it leaves.
    own = pages.select("page_id", "all", "lines", F.explode("all").alias("b")).filter("b.turn is not null")
    pairs = own.select("page_id", "lines", "b", *[F.col(f"b.{c}").alias(f"b_{c}") for c in XY], F.explode("all").alias("a")).select("*", *[F.col(f"a.{c}").alias(f"a_{c}") for c in XY])
    self, alike = F.coalesce(F.col("a.turn") == F.col("b.turn"), F.lit(False)), F.coalesce(F.col("a.norm_label") == F.col("b.norm_label"), F.lit(False))
    telling = F.col("a.solid") & F.col("b.solid") & (F.col("a.place").isNotNull() | (F.col("b.large") | (F.col("a.turn") < F.col("b.turn"))) & alike)
    met = pairs.filter(self | overlapping("a_", "b_") & telling & F.col("page_id").isNotNull())
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    i, area_a, area_b = L.intersection("a_", "b_"), positive("a.area"), positive("b.area")
    solid_two, alike = F.col("a.solid") & F.col("b.solid") & F.col("page_id").isNotNull(), alike & F.col("a.turn").isNotNull()
    covers = solid_two & F.col("a.place").isNotNull() & (i / area_a >= threshold) & (i > 0)
    same = solid_two & alike & (F.col("a.turn") < F.col("b.turn")) & (i / (area_a + area_b - i) >= SAME_IOU)
    helps = solid_two & alike & F.col("b.large") & (F.col("a.source_family") != F.col("b.source_family")) & near(i, area_a, area_b)
    word, bit = (lambda of: F.call_function("shiftright", F.col(of) - 1, F.lit(6))), (lambda of: F.call_function("shiftleft", F.lit(1).cast("long"), F.col(of) - 1))
    hit = F.when(covers, F.col("a.place")).alias("hit")
    twin = F.when(same, F.struct(word("a.turn").alias("word"), bit("a.turn").alias("bit"), i.alias("shared"))).alias("twin")
    partner = F.when(helps, F.struct(F.col("a.source_model").alias("model"), F.col("a.source_family").alias("family"))).alias("partner")
    facts = met.select("page_id", F.col("b.turn").alias("turn"), F.when(self, F.col("b")).alias("box"), F.when(self & (F.col("b.turn") == 1), F.col("lines")).alias("lines"), hit, twin, partner)
    kept = lambda c: F.first(c, ignorenulls=True).alias(c)
    known = facts.groupBy("page_id", "turn").agg(kept("box"), kept("lines"), F.sort_array(F.collect_list("hit")).alias("hits"), F.collect_list("twin").alias("twins"), F.collect_set("partner").alias("partners"))
    words = F.expr("transform(sequence(0, shiftright(coalesce(array_max(hits), 0), 6)), n -> aggregate(filter(hits, i -> shiftright(i, 6) = n), 0L, (o, i) -> o | shiftleft(1L, i)))").alias("words")
    own = [F.col(f"box.{c}").alias(c) for c in ("seq", "source_family", "source_model", "norm_label", *XY, "score", "sure", "area", "share", "thin", "large", "flat")]
    item = F.struct("turn", *own, "hits", words, "twins", "partners", word("turn").alias("word"), bit("turn").alias("bit"), F.array().cast("array<double>").alias("none"))
    return known.groupBy("page_id").agg(F.sort_array(F.collect_list(item)).alias("items"), F.first("lines", ignorenulls=True).alias("lines"))


def folded(pages: DataFrame, sets: Column, width: float, height: float, threshold: float = 0.5) -> DataFrame:
    """The pages with states: for each of sets (an array of arrays of models) the state after the fold."""
    start = "named_struct('turns', array_repeat(0L, shiftright(size(items) + 63, 6)), 'made', cast(array() as array<struct<x1:double,y1:double,x2:double,y2:double,score:double,at:int>>), 'covered', array_repeat(0L, shiftright(size(lines) + 63, 6)))"
    mine = "filter(items, b -> array_contains(members, b.source_model) and not b.flat)"
    return pages.withColumn("sets", sets).withColumn("states", F.expr(f"transform(sets, members -> aggregate({mine}, {start}, (acc, b) -> {_step(width, height, threshold)}))")).drop("sets")


def _members(sets: dict[str, tuple[str, ...]]) -> Column:
    return F.array(*[F.array(*map(F.lit, m)) for m in sets.values()])


def _chosen(state: str, own: str, made: str) -> str:
    """SQL of the boxes that a state holds: own (of b) and made (of k, the n-th) make structs of one type."""
    return f"concat(transform(filter(items, b -> (get({state}.turns, b.word) & b.bit) <> 0L), b -> {own}), transform({state}.made, (k, n) -> {made}))"


def select_boxes(pages: DataFrame, sets: dict[str, tuple[str, ...]], width: float, height: float, threshold: float = 0.5) -> DataFrame:
    """The columns of pages, name, kept (boxes in the order of choice) and covered (places of lines), for every set of models on every page."""
    each = folded(pages, _members(sets), width, height, threshold)
    each = each.select(*pages.columns, F.explode(F.arrays_zip(F.lit(list(sets)).alias("name"), F.col("states").alias("state"))).alias("of")).select(*pages.columns, "of.name", "of.state")
    box = lambda turn, at, n, v: f"named_struct('at', {at}, 'n', {n}, 'turn', {turn}, {', '.join(f'{chr(39)}{c}{chr(39)}, {v}.{c}' for c in (*XY, 'score'))})"
    kept = f"sort_array({_chosen('state', box('b.turn', 'b.turn', '-1', 'b'), box('cast(null as int)', 'k.at', 'n', 'k'))})"
    covered = f"filter(transform(lines, l -> l.place), i -> {_has('state.covered', 'i')})"
    return each.select(*pages.columns, "name", F.expr(kept).alias("kept"), F.expr(covered).alias("covered"))


def _fused(states: DataFrame, names: Column) -> DataFrame:
    """page_id, name, reading_order, seq, family, model, label, corners, score: a row for each box that the states of a page (items, states) hold."""
    entry = lambda v, at, n, of: f"named_struct('y1', {v}.y1, 'x1', {v}.x1, 'at', {at}, 'n', {n}, {', '.join(f'{chr(39)}{c}{chr(39)}, {e}' for c, e in of.items())}, 'x2', {v}.x2, 'y2', {v}.y2, 'score', {v}.score)"
    own, made = {c: f"b.{c}" for c in ("seq", *RECOVERED)}, {"seq": "case when false then get(items, 0).seq end"} | {c: f"'{v}'" for c, v in RECOVERED.items()}
    ordered = F.expr(f"transform(states, s -> sort_array({_chosen('s', entry('b', 'b.turn', '-1', own), entry('k', 'k.at', 'n', made))}))")
    each = states.select("page_id", F.explode(F.arrays_zip(names.alias("name"), ordered.alias("kept"))).alias("of"))  # taken here, as rows of single boxes would each carry all items along
    out = each.select("page_id", "of.name", F.posexplode("of.kept").alias("place", "o"))
    return out.select("page_id", "name", (F.col("place") + 1).alias("reading_order"), *[F.col(f"o.{c}") for c in ("seq", *RECOVERED, *XY, "score")])


def fuse(boxes: DataFrame, lines: DataFrame | None, width: int, height: int, threshold: float = 0.5) -> DataFrame:
    """Fused boxes of every page and set of models, in reading order; recovered boxes have no seq.

    A null score counts as 0; pages without lines keep no large unsupported text; no boxes, no rows.
    """
    sets = model_sets()
    return _fused(folded(prepared(boxes, lines, width, height, threshold), _members(sets), width, height, threshold), F.lit(list(sets)))


def fuse_variants(boxes: DataFrame, width: int, height: int, threshold: float = 0.5) -> DataFrame:
    """Fused boxes of every page and variant on the boxes' own lines, as `as_variants` of `fuse` has them: S1 is the page's best single model, pages without one have none.

    A page's best model is known before its fold, so the models that are not best are not folded alone.
    """
    members = variant_members()
    best = best_singles(boxes, members["P1"], width, height)
    pages = prepared(boxes, None, width, height, threshold).join(best.hint("shuffle_hash"), "page_id")
    sets = F.array(*[F.array(F.col("best")) if v == "S1" else F.array(*map(F.lit, m)) for v, m in members.items()])
    return _fused(folded(pages, sets, width, height, threshold), F.lit(list(members))).withColumnRenamed("name", "variant")


def as_variants(by_set: DataFrame, best: DataFrame) -> DataFrame:
    """Rows of model sets as those of variants: S1 is the page's best single model; pages without one have none."""
    alias = {m[0]: v for v, m in variant_members().items() if len(m) == 1 and v != "S1"}
    own = F.when(F.col("name").isin(*[v for v, m in variant_members().items() if len(m) > 1]), F.col("name"))
    for model, v in alias.items():
        own = own.when(F.col("name") == model, v)
    names = F.array_compact(F.array(own, F.when(F.col("name") == F.col("best"), "S1")))
    return by_set.join(best, "page_id").withColumn("variant", F.explode(names)).drop("name", "best")


def best_singles(boxes: DataFrame, models: tuple[str, ...], width: int, height: int) -> DataFrame:
    """page_id, best: the model whose raw boxes score best by texts, their area and few boxes, the first of equals, on every page that has boxes of any."""
    text = F.col("norm_label").isin(*TEXT)
    own = boxes.filter(F.col("source_model").isin(*models)).select("page_id", "source_model", F.coalesce(text, F.lit(False)).alias("text"), *[F.when(text, F.col(c)).alias(c) for c in XY])
    cells = rastered(own, width, height, "page_id", "source_model", "text").withColumn("top", F.col("y1").cast("int"))
    words = raster_words(cells, width, CELL, "page_id", "source_model", "text", "top").withColumn("head", F.col("row").isNull() | (F.col("row") == F.col("top")))
    masks = [c for c in words.columns if c.startswith("word")]
    rows = words.groupBy("page_id", "source_model", "row").agg(*[F.bit_or(c).alias(c) for c in masks], F.count_if(F.col("head") & F.col("text")).alias("texts"), F.count_if("head").alias("n"))
    area = sum((F.bit_count(c) for c in masks), F.lit(0))
    counts = rows.groupBy("page_id", "source_model").agg(F.sum(area).cast("double").alias("area"), F.sum("texts").alias("texts"), F.sum("n").alias("n"))
    score = 0.02 * F.col("texts") + F.col("area") / raster_size(width, height, CELL) - 0.0002 * F.col("n")
    first = F.array_position(F.lit(list(models)), F.col("source_model"))
    return counts.groupBy("page_id").agg(F.max_by("source_model", F.struct(score, -first)).alias("best"))


def _fits(width: float, height: float) -> str:
    """Whether an item is fit to measure recall against: no text, or text that is no unsupported strip or weak giant and covers two lines."""
    support = "1 + size(array_distinct(b.partners.family))"
    bad = f"size(b.hits) < 2 or b.thin and {support} < 2 or b.share >= 0.22D and {support} < 2 and b.sure < 0.75D or b.share >= 0.30D and {support} < 3"
    return f"not b.flat and b.norm_label in {TEXT} and not ({bad})"


def measure(boxes: DataFrame, lines: DataFrame | None, width: int, height: int, threshold: float = 0.5) -> DataFrame:
    """Measures of the fused boxes of every variant and source on every page (S1 is its best Paddle model); none for a page without Paddle boxes.

    boxes and lines as `prepared` takes them.  Returns page_id, kind, name, best_single, line_coverage, covered_lines, uncovered_lines, box_count, text_area, base_recall.
    The fold runs once a set.  The areas of all sets' texts, of the base, of each with the base and of the single models' raw texts come from one grouping: a page's raster is cut
    at its texts' upper and lower edges, and each strip's cells are bits of words joined by `or`, a word for each area.  Strip 0 carries the page's counts in their places.
    """
    members = variant_members()
    paddle, sets = members["P1"], model_sets()
    several, alone = [v for v, m in members.items() if len(m) > 1], {m[0]: v for v, m in members.items() if len(m) == 1 and v != "S1"}
    states = folded(prepared(boxes, lines, width, height, threshold), _members(sets), width, height, threshold).filter("page_id is not null")

    high = max(1, -(-height // int(CELL)))
    entry = lambda v, of: f"named_struct({', '.join(f'{chr(39)}{c}{chr(39)}, {e}' for c, e in of.items())}, {', '.join(f'{chr(39)}{c}{chr(39)}, {v}.{c}' for c in XY)})"
    own = entry("b", {"word": "b.word", "bit": "b.bit", "of": "cast(null as int)", "model": "b.source_model", "base": _fits(width, height)})
    made = entry("k", {"word": "0", "bit": "0L", "of": "n", "model": "''", "base": "false"})
    texts = F.expr(f"concat(transform(filter(items, b -> b.norm_label in {TEXT}), b -> {own}), flatten(transform(states, (s, n) -> transform(s.made, k -> {made}))))")
    ones = lambda w: f"aggregate({w}, 0, (o, m) -> o + bit_count(m))"
    pair = lambda a, b: f"shiftleft(cast({a} as bigint), 32) | {b}"
    counts = F.expr(f"concat(transform(states, s -> {pair('size(s.made) + ' + ones('s.turns'), ones('s.covered'))}), array(cast(size(lines) as bigint)), " + "array(" + ", ".join(pair(f"size(filter(items, b -> b.source_model = '{m}'))", f"size(filter(items, b -> b.source_model = '{m}' and b.norm_label in {TEXT}))") for m in paddle) + "))")
    pages = states.select("page_id", F.col("states.turns").alias("turns"), texts.alias("texts"), counts.alias("counts"))
    edge = lambda f, c: f"cast(greatest(0, least({high}, {f}(e.{c} / {CELL}D))) as int)"
    edges = F.expr(f"sort_array(array_distinct(flatten(transform(texts, e -> array({edge('floor', 'y1')}, {edge('ceil', 'y2')})))))")
    head = F.expr("array(cast(null as struct<word:int,bit:bigint,of:int,model:string,base:boolean,x1:double,y1:double,x2:double,y2:double>))")
    # Edges are a column before the texts are exploded: beside the explode they would be worked out for each of its rows.
    each = pages.withColumn("edges", edges).select("page_id", "turns", "counts", "edges", F.explode(F.concat(head, "texts")).alias("e"))

    parts = [(F.col("e.of") == n) | F.col("e.of").isNull() & (F.get(F.get("turns", F.lit(n)), F.col("e.word")).bitwiseAND(F.col("e.bit")) != 0) for n in range(len(sets))]
    parts += [F.col("e.base"), *[F.col("e.model") == m for m in paddle]]
    tags = [f"of{n}" for n in range(len(parts))]
    mask = sum((F.when(p, F.lit(1 << n)).otherwise(0) for n, p in enumerate(parts)), F.lit(0))
    corners = [c.cast("int").alias(n) for n, c in zip(XY, on_raster(*[F.col(f"e.{c}") for c in XY], width, height, CELL), strict=True)]
    placed = each.select("page_id", F.when(F.col("e").isNull(), F.col("counts")).alias("counts"), "edges", mask.alias("mask"), *corners)
    strips = F.when(F.col("counts").isNotNull(), F.array(F.lit(0))).when((F.col("x1") < F.col("x2")) & (F.col("y1") < F.col("y2")) & (F.col("mask") > 0), F.sequence(F.array_position("edges", F.col("y1")).cast("int"), F.array_position("edges", F.col("y2")).cast("int") - 1))
    cut = placed.select("page_id", "counts", "mask", "x1", "x2", "edges", F.explode(strips).alias("strip"))
    height_of = F.when(F.col("strip") > 0, F.get("edges", F.col("strip")) - F.get("edges", F.col("strip") - 1)).otherwise(0)
    sixth = lambda c: F.call_function("shiftright", c, F.lit(6))
    spans = F.when(F.col("strip") == 0, F.array(F.lit(0))).otherwise(F.sequence(sixth(F.col("x1")), sixth(F.col("x2") - 1)))
    worded = cut.select("page_id", "counts", "mask", "x1", "x2", "strip", height_of.alias("height"), F.explode(spans).alias("at"))
    ends, all_ones = (F.greatest(F.lit(0), F.col("x1") - 64 * F.col("at")), F.least(F.lit(64), F.col("x2") - 64 * F.col("at"))), F.lit(-1).cast("long")
    bits = F.call_function("shiftleft", all_ones, ends[0]).bitwiseAND(F.call_function("shiftrightunsigned", all_ones, 64 - ends[1]))
    rows = worded.select("page_id", "strip", "height", "at", "counts", "mask", bits.alias("bits"))
    value = lambda n: F.when(F.col("strip") == 0, F.get("counts", F.lit(n))).when(F.col("mask").bitwiseAND(F.lit(1 << n)) != 0, F.col("bits")).otherwise(F.lit(0).cast("long"))
    joined = rows.groupBy("page_id", "strip", "height", "at").agg(*[F.bit_or(value(n)).alias(t) for n, t in enumerate(tags)])

    base = tags[len(sets)]
    area = lambda w: F.sum(F.col("height") * F.bit_count(w)).cast("double")
    of_page = joined.groupBy("page_id").agg(
        *[area(F.col(t)).alias(f"area_{t}") for t in tags],
        *[area(F.col(t).bitwiseAND(F.col(base))).alias(f"both_{t}") for t in tags[: len(sets)]],
        *[F.max(F.when(F.col("strip") == 0, F.col(t))).alias(f"count_{t}") for t in tags],
    )
    upper, lower = (lambda c: F.call_function("shiftright", F.col(c), F.lit(32))), (lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))
    raw = dict(zip(paddle, tags[len(sets) + 1 :], strict=True))
    singles = [(m, 0.02 * lower(f"count_{t}") + F.col(f"area_{t}") / raster_size(width, height, CELL) - 0.0002 * upper(f"count_{t}"), upper(f"count_{t}") > 0) for m, t in raw.items()]
    best = F.array_max(F.array(*[F.when(some, F.struct(score.alias("score"), F.lit(-n).alias("first"), F.lit(m).alias("model"))) for n, (m, score, some) in enumerate(singles)]))["model"]
    has = lambda m: upper(f"count_{raw[m]}") > 0 if m in raw else F.lit(m in alone)
    by_set = F.array(*[F.struct(F.lit(m).alias("name"), F.col(f"area_{t}").alias("own"), F.col(f"both_{t}").alias("shared"), upper(f"count_{t}").alias("n"), lower(f"count_{t}").alias("c"), has(m).alias("has")) for m, t in zip(sets, tags)])
    by_set = of_page.select("page_id", best.alias("best"), F.col(f"area_{base}").alias("base"), F.col(f"count_{base}").alias("all"), F.explode(by_set).alias("s")).filter("best is not null").select("page_id", "best", "base", "all", "s.*")

    name, kind = F.col("name"), lambda k, v: F.struct(F.lit(k).alias("kind"), v.alias("name"))
    as_variant = F.create_map(*[F.lit(x) for kv in ({v: v for v in several} | alone).items() for x in kv])[name]
    out_rows = F.array_compact(F.array(F.when(as_variant.isNotNull(), kind("variant", as_variant)), F.when(name == F.col("best"), kind("variant", F.lit("S1"))), F.when(F.col("has"), kind("source", name))))
    out = by_set.withColumn("o", F.explode(out_rows))
    return out.select(
        "page_id",
        "o.kind",
        "o.name",
        F.col("best").alias("best_single"),
        L.ratio(F.col("c").cast("double"), F.col("all")).alias("line_coverage"),
        F.col("c").cast("long").alias("covered_lines"),
        (F.col("all") - F.col("c")).cast("long").alias("uncovered_lines"),
        F.col("n").cast("long").alias("box_count"),
        (F.col("own") / raster_size(width, height, CELL)).alias("text_area"),
        F.when(F.col("base") > 0, F.col("shared") / F.col("base")).otherwise(0.0).alias("base_recall"),
    )


def board(measures: DataFrame) -> DataFrame:
    """Each variant's and source's means over pages (recall over pages that have one), its pages better than S1 in recall, and score = recall + 0.25 area - 0.00025 boxes."""
    recall = F.coalesce("base_recall", F.lit(0.0))
    first = F.when((F.col("kind") == "variant") & (F.col("name") == "S1") & F.col("page_id").isNotNull(), recall)
    better = recall > F.col("r1")
    m = measures.withColumn("r1", F.max(first).over(Window.partitionBy("page_id"))).groupBy("kind", "name").agg(
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.avg("base_recall"), F.lit(0.0)).alias("r"),
        F.avg("line_coverage").alias("c"),
        F.median("line_coverage").alias("median"),
        F.avg("text_area").alias("a"),
        F.avg("box_count").alias("b"),
        F.count_if(better).alias("improved"),
    )
    score = F.col("r") + 0.25 * F.col("a") - 0.00025 * F.col("b")
    rounded = [F.round(c, n).alias(name) for c, n, name in (("r", 6, "recall"), ("c", 6, "line_coverage"), ("median", 6, "median_line_coverage"), ("a", 6, "area"), ("b", 3, "boxes"))]
    return m.select("kind", "name", "pages", *rounded, "improved", F.round(score, 6).alias("score"))


def variant_board(measures: DataFrame) -> DataFrame:
    """Variants, best first."""
    return board(measures).filter("kind = 'variant'").drop("kind").orderBy(F.desc("score"), "name")


def source_board(measures: DataFrame) -> DataFrame:
    """Sources, best first."""
    return board(measures).filter("kind = 'source'").drop("kind", "median_line_coverage", "improved").orderBy(F.desc("score"), "name")


def recommended(measures: DataFrame, wanted: str) -> DataFrame:
    """best_by_score and recommended: the wanted variant if it was measured, else the best."""
    b = board(measures).filter("kind = 'variant'")
    return b.agg(F.max_by("name", F.struct("score", F.col("name"))).alias("best_by_score"), F.max(F.when(F.col("name") == wanted, F.col("name"))).alias("found")).select("best_by_score", F.coalesce("found", "best_by_score").alias("recommended"))


def per_page(measures: DataFrame, kind: str) -> DataFrame:
    """Page by page and name by name."""
    return measures.filter(F.col("kind") == kind).select("page_id", "name", F.coalesce("base_recall", F.lit(0.0)).alias("base_recall"), "line_coverage", "uncovered_lines", "box_count", "text_area").orderBy("page_id", "name")


INFORMATIVE, DELTA = (3.0, 2.0, 0.7), (3.5, 1.5, 0.5)


def _sides(measures: DataFrame, *names: str) -> DataFrame:
    """page_id, and for every named variant a struct of recall and area, null where it was not measured: one pass over the measures."""
    rows = measures.filter((F.col("kind") == "variant") & F.col("name").isin(*names))
    side = lambda v: F.max(F.when(F.col("name") == v, F.struct(F.col("base_recall").alias("r"), F.col("text_area").alias("a")))).alias(v)
    alone = F.when(F.col("page_id").isNull(), F.col("name")).alias("alone")  # rows without a page do not meet
    return rows.groupBy("page_id", alone).agg(*[side(v) for v in dict.fromkeys(names)])


def _gain(low: str, high: str, weights: tuple[float, float, float], both: bool) -> Column:
    """score, recall_gain, area_gain of a page's sides; null where neither variant was measured, or not both."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    gain, area = z(f"{high}.r") - z(f"{low}.r"), z(f"{high}.a") - z(f"{low}.a")
    score = weights[0] * gain + weights[1] * area + weights[2] * (1.0 - z(f"{low}.r"))
    l, h = F.col(low).isNotNull(), F.col(high).isNotNull()
    return F.when(l & h & F.col("page_id").isNotNull() if both else l | h, F.struct(F.round(score, 6).alias("score"), F.round(gain, 6).alias("recall_gain"), F.round(area, 6).alias("area_gain")))


def _gains(measures: DataFrame, low: str, high: str, weights: tuple[float, float, float], most: int, both: bool) -> DataFrame:
    """rank, page_id, score, recall_gain, area_gain: the pages where `high` gains most over `low`, and those `low` does badly on."""
    each = _sides(measures, low, high).select("page_id", _gain(low, high, weights, both).alias("g")).filter("g is not null")
    top = each.select("page_id", "g.*").orderBy(F.desc("score"), "page_id").limit(most)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "page_id")))  # at most `most` rows


def informative(measures: DataFrame, variant: str, most: int = 20) -> DataFrame:
    """Pages ranked by what the variant gains over S1."""
    return _gains(measures, "S1", variant, INFORMATIVE, most, False)


def delta(measures: DataFrame, without: str = "P2", with_: str = "P4", most: int = 20) -> DataFrame:
    """Pages ranked by what the variant with one source more gains, where both were measured."""
    return _gains(measures, without, with_, DELTA, most, True)


def review_pages(measures: DataFrame, pages: DataFrame, variant: str, mode: str = "all", most: int = 20) -> DataFrame:
    """page_id of the pages to show: all, or those of either ranking (top20), the first five of `pages` (page_id, ord) if neither ranks any; in the order of pages."""
    if mode == "all":
        return pages.orderBy("ord").select("page_id")
    if mode != "top20":
        raise ValueError(f"unknown review mode {mode}: all or top20")
    both = {"informative": _gain("S1", variant, INFORMATIVE, False), "delta": _gain("P2", "P4", DELTA, True)}
    scores = F.array(*[F.when(g.isNotNull(), F.struct(F.lit(k).alias("ranking"), g["score"].alias("score"))) for k, g in both.items()])
    each = _sides(measures, "S1", variant, "P2", "P4").select("page_id", F.explode(F.array_compact(scores)).alias("s")).select("page_id", "s.*")
    place = F.row_number().over(Window.partitionBy("ranking").orderBy(F.desc("score"), "page_id"))
    named = each.withColumn("place", place).filter(F.col("place") <= most).select("page_id").distinct()
    listed = pages.join(F.broadcast(named), "page_id", "left_semi").withColumn("named", F.lit(True))  # at most 2 * most rows
    shown = listed.union(pages.orderBy("ord").limit(5).withColumn("named", F.lit(False)))
    best = shown.withColumn("any", F.max("named").over(Window.partitionBy(F.lit(0)))).filter("named = any")  # at most 2 * most + 5 rows
    return best.orderBy("ord").select("page_id")
