"""Mixing sources to target weights by Poisson replication, in DataFrame functions alone.

A document of source s is repeated n times, n drawn from a Poisson distribution whose mean is the repetition rate
  rate(s) = weight(s) * total target size / size(s),     size = characters + 1 of each document.
The draw inverts the distribution function at a number in [0, 1) taken from a hash of seed, doc_id and text, so it
does not depend on partitions or retries.  Rates above `step` are drawn as sums of equal parts (a sum of Poisson numbers is Poisson), so
exp(-rate) cannot underflow.  The copies are then shuffled globally: sorted by a hash of seed, document and copy.

Null sources form a source of their own; null text counts as empty; repeated rows draw the same number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage

#: Sources up to which the rates are broadcast: about 600 bytes each.  Beyond, rows and rates meet by source and salt.
BROADCAST_SOURCES = 20_000
SALTS = 64
STEP = 8.0
#: Poisson(8) exceeds 60 with probability below 1e-30: under the spacing of the uniform numbers.
TERMS = 60


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the first 13 hex digits of md5; 52 bits, exact in double."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(16**13))


def poisson_cdf(rate: Column) -> Column:
    """Array of P(n <= k) for k = 0..TERMS."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all"))

    def further(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), F.concat(acc["all"], F.array(acc["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, further, lambda acc: acc["all"])


def source_rates(docs: DataFrame, weights: dict[str, float] | None, temperature: float, budget: float) -> DataFrame:
    """source, size, rate.  weights: relative target weight of each source, 0 if not named; None: size ** temperature.

    budget: total target size as a multiple of the input's.  The salted pre-aggregate is Spark's own partial aggregation.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit(""))) + 1).cast("double").alias("size"))
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow("size", F.lit(float(temperature))))
    else:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]) if weights else F.lit(None).cast("map<string,double>")
        weighted = sizes.withColumn("weight", F.coalesce(named[F.col("source")], F.lit(0.0)))
    total = weighted.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    target = total.select((F.col("all_size") * budget).alias("target"), "all_weight")
    return weighted.join(F.broadcast(target)).select("source", "size", F.coalesce(F.try_divide(F.col("weight"), F.col("all_weight")) * F.col("target") / F.col("size"), F.lit(0.0)).alias("rate"))  # target: one row


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.7, budget: float = 1.0, seed: str = "mix") -> DataFrame:
    """All columns of docs, then copy (int, from 1), rate (double) and shuffle_key (long), in shuffled order.

    Input columns of these three names are replaced; columns whose names begin with _mix_ are for this function's use, and raise ValueError.
    An empty table gives an empty result.
    """
    docs = docs.drop("copy", "rate", "shuffle_key")
    cols = docs.columns
    if taken := [c for c in cols if c.lower().startswith("_mix_")]:
        raise ValueError(f"columns {taken} clash with names of this operator")
    rates = stage(source_rates(docs, weights, temperature, budget), "rates")
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int")
    rates = rates.withColumn("parts", parts).withColumn("cdf", poisson_cdf(F.col("rate") / F.col("parts"))).select(F.col("source").alias("_mix_source"), F.col("rate").alias("_mix_rate"), F.col("parts").alias("_mix_parts"), F.col("cdf").alias("_mix_cdf"))
    # The key is made below the join, so that no lambda holds the digest of the text: it is computed once a row.
    keyed = docs.withColumn("_mix_key", F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text"), F.lit("")))))
    if rates.count() <= BROADCAST_SOURCES:
        drawn = keyed.join(F.broadcast(rates), docs["source"].eqNullSafe(rates["_mix_source"]))
    else:
        salted = rates.withColumn("_mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        keyed = keyed.withColumn("_mix_turn", F.pmod(F.xxhash64("_mix_key"), F.lit(SALTS)).cast("int"))
        drawn = keyed.join(salted, docs["source"].eqNullSafe(salted["_mix_source"]) & (F.col("_mix_turn") == F.col("_mix_salt")))
    uniform = F.transform(F.sequence(F.lit(1), F.col("_mix_parts")), lambda i: unit_hash(F.lit(seed), F.col("_mix_key"), i.cast("string")))
    draw = F.aggregate(uniform, F.lit(0), lambda n, u: n + F.size(F.filter(F.col("_mix_cdf"), lambda c: c <= u)))
    copies = drawn.withColumn("_mix_n", draw).filter("_mix_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_mix_n"))))
    shuffle_key = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("order"), F.lit(seed), "_mix_key", F.col("copy").cast("string"))), 1, 15), 16, 10).cast("long")
    out = copies.select(*cols, "copy", F.col("_mix_rate").alias("rate"), shuffle_key.alias("shuffle_key"))
    return out.orderBy("shuffle_key", "doc_id", "copy")
