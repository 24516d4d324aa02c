"""Timing rollups and the reconciliation of planned with observed work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import layout as L

ADAPTER = "model_adapter"
#: Breakdowns: name, column, whether of adapter rows only.
BREAKDOWNS = (("stage", "stage", False), ("model", "model_id", True), ("model_family", "family", True), ("resource_class", "resource_class", True), ("page_complexity", "complexity", False))


def named(c: Column) -> Column:
    """Trimmed; empty and null are unknown."""
    return F.coalesce(F.nullif(L.strip(c.cast("string")), F.lit("")), F.lit("unknown"))


def coerced_seconds(c: str = "seconds") -> Column:
    """Unreadable, non-finite and negative seconds count as 0."""
    x = F.expr(f"try_cast({c} as double)")
    return F.when(x.isNotNull() & ~F.isnan(x) & (x >= 0) & (x < float("inf")), x).otherwise(0.0)


def done() -> Column:
    return F.coalesce(F.col("status").isin("ok", "skipped"), F.lit(False))


def summary() -> list[Column]:
    s, total = F.col("s"), F.sum("s")
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(done()).alias("completed"),
        F.count_if(~done()).alias("failed"),
        F.round(total, 6).alias("seconds_total"),
        F.round(F.avg("s"), 6).alias("seconds_mean"),
        F.round(F.percentile(s, F.lit(0.5)), 6).alias("seconds_p50"),
        F.round(F.percentile(s, F.lit(0.95)), 6).alias("seconds_p95"),
        F.round(F.max("s"), 6).alias("seconds_max"),
        F.round(F.when(total > 0, F.count_if(done()) / total * 60).otherwise(0.0), 6).alias("completed_per_minute"),
    ]


def summarized(rows: DataFrame, *keys: str) -> DataFrame:
    """summary() and the statuses' histogram (status=count, by status) of rows (keys, status, s)."""
    stats = rows.groupBy(*keys).agg(*summary())
    counted = rows.groupBy(*keys, named(F.col("status")).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    entries = F.transform(F.array_sort(F.collect_list(F.struct("status", "n"))), lambda x: F.concat_ws("=", x["status"], x["n"].cast("string")))
    return stats.join(counted.groupBy(*keys).agg(F.array_join(entries, ",").alias("status_counts")), list(keys))


def timing_summary(rows: DataFrame, key: str) -> DataFrame:
    """One row per key; an empty key counts as unknown."""
    return summarized(rows.select(named(F.col(key)).alias(key), "status", coerced_seconds().alias("s")), key)


def timing_breakdowns(rows: DataFrame) -> DataFrame:
    """All five breakdowns in one pass; rows need stage, model_id, family, resource_class, complexity, status, seconds."""
    of_adapter = F.col("stage") == ADAPTER
    sets = [F.when(of_adapter if adapter else F.lit(True), F.struct(F.lit(name).alias("breakdown"), named(F.col(c)).alias("value"))) for name, c, adapter in BREAKDOWNS]
    keyed = rows.select("status", coerced_seconds().alias("s"), F.explode(F.array_compact(F.array(*sets))).alias("g")).select("status", "s", "g.*")
    return summarized(keyed, "breakdown", "value")


def adapter_pairs(rows: DataFrame) -> DataFrame:
    """Observed (page_id, model_id, ok): adapter rows with both ids; ok if any of a pair's rows succeeded."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    own = rows.filter((F.col("stage") == ADAPTER) & some("page_id") & some("model_id"))
    return own.groupBy("page_id", "model_id").agg(F.bool_or(done()).alias("ok"))


def pair_status(planned: DataFrame, rows: DataFrame) -> DataFrame:
    """Full outer match of planned with observed pairs: planned, observed, ok flags."""
    p = planned.select("page_id", "model_id").distinct().withColumn("planned", F.lit(True))
    o = adapter_pairs(rows).withColumn("observed", F.lit(True))
    return p.join(o, ["page_id", "model_id"], "full_outer").select("page_id", "model_id", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("planned", "observed", "ok")])


def coverage(planned: DataFrame, rows: DataFrame) -> DataFrame:
    m = pair_status(planned, rows)
    both = F.col("planned") & F.col("observed")
    return m.agg(
        F.count_if("planned").alias("planned"),
        F.count_if("observed").alias("observed"),
        F.count_if(both & F.col("ok")).alias("successful"),
        F.count_if(both & ~F.col("ok")).alias("failed"),
        F.count_if(F.col("planned") & ~F.col("observed")).alias("missing"),
        F.count_if(~F.col("planned") & F.col("observed")).alias("unexpected"),
        F.round(F.when(F.count_if("planned") > 0, F.count_if(both) / F.count_if("planned")).otherwise(1.0), 6).alias("coverage_ratio"),
    )


def pair_samples(planned: DataFrame, rows: DataFrame, k: int = 25) -> DataFrame:
    """kind (missing or unexpected), page_id, model_id: the first k pairs of each kind, in order."""
    m = pair_status(planned, rows).filter(F.col("planned") != F.col("observed"))
    first = lambda flag, kind: m.filter(flag).orderBy("page_id", "model_id").limit(k).select(F.lit(kind).alias("kind"), "page_id", "model_id")
    return first("planned", "missing").unionByName(first("observed", "unexpected"))


def slowest(rows: DataFrame, k: int = 10) -> DataFrame:
    """The k slowest rows, earlier ones first among equals."""
    return rows.withColumn("s", coerced_seconds()).orderBy(F.desc("s"), "ord").limit(k).select("ord", "page_id", "stage", "model_id", "family", "resource_class", "complexity", "s", "status")


def page_outcomes(rows: DataFrame) -> DataFrame:
    """page_id, succeeded, failed (adapter rows), status and error_type: a page without a successful adapter fails as a whole."""
    own = rows.groupBy("page_id").agg(F.count_if((F.col("stage") == ADAPTER) & done()).alias("succeeded"), F.count_if((F.col("stage") == ADAPTER) & ~done()).alias("failed"))
    lost = F.col("succeeded") == 0
    return own.select("page_id", "succeeded", "failed", F.when(lost, "error").otherwise("ok").alias("status"), F.when(lost, "NoSuccessfulAdapters").alias("error_type"))


def headline(planned: DataFrame, rows: DataFrame) -> DataFrame:
    """The run's headline counts in one row; wall seconds are those of the page totals."""
    pages = page_outcomes(rows).agg(F.count(F.lit(1)).alias("pages_attempted"), F.count_if(F.col("status") == "ok").alias("pages_completed"), F.count_if(F.col("status") == "error").alias("pages_failed"))
    own = F.col("stage") == ADAPTER
    seconds = F.sum(F.when(F.col("stage") == "page_total", coerced_seconds()).otherwise(0.0))
    work = rows.agg(F.round(F.coalesce(seconds, F.lit(0.0)), 6).alias("seconds_total"), F.count_if(own).alias("adapter_invocations_observed"), F.count_if(own & (F.col("status") == "error")).alias("adapter_errors"))
    plan = planned.agg(F.count(F.lit(1)).alias("adapter_invocations_planned"))
    one = pages.join(work).join(plan)  # one row each
    rate = F.when(F.col("seconds_total") > 0, F.col("pages_completed") / F.col("seconds_total") * 60).otherwise(0.0)
    return one.withColumn("errors", F.col("adapter_errors") + F.col("pages_failed")).withColumn("pages_per_minute", F.round(rate, 6))


def with_model_metadata(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The adapter rows' summary by model beside its family and resource class: those of its last plan row (plan: model_id, family, resource_class, ord), else unknown."""
    last = plan.groupBy("model_id").agg(F.max_by(F.struct("family", "resource_class"), "ord").alias("m"))
    stats = timing_summary(rows.filter(F.col("stage") == ADAPTER), "model_id")
    return stats.join(last, "model_id", "left").select(*stats.columns, *[F.coalesce(f"m.{c}", F.lit("unknown")).alias(c) for c in ("family", "resource_class")])


def page_resource_class(rows: DataFrame) -> DataFrame:
    """The page's single resource class, else mixed."""
    return rows.groupBy("page_id").agg(F.when(F.min("resource_class") == F.max("resource_class"), F.min("resource_class")).otherwise("mixed").alias("resource_class"))
