"""A training corpus from documents: language identification, near-duplicate removal, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's
docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm import langid, mixing, packing, shinglejoin
from quire.llm.registry import documents, tokenizer_path
from quire.llm.shared import release, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the learned languages; what the calibrated rejection turns down goes."""
    release()
    model = langid.train(docs)
    return langid.predict(docs, model, COLUMNS).filter(~F.col("rejected")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group: that of the least doc_id, nulls last, and then digest.  Five-word shingles, similarity 0.8 or more.

    Of repeated rows with the kept id and text one stays.  Documents without words are no copies of others: repeats of one id go, those without an id stay.
    """
    release()
    keyed = docs.withColumn("_digest", F.coalesce(F.md5("text"), F.lit("")))
    keep = shinglejoin.representatives(keyed.select("doc_id", "text", "_digest"), "_digest", size=5, percent=80)
    keep = keep.select(F.col("doc_id").alias("_id"), F.col("_digest").alias("_text"), F.col("wordless").alias("_wordless"))
    kept = keyed.join(keep, keyed["doc_id"].eqNullSafe(keep["_id"]) & (keyed["_digest"] == keep["_text"]))
    one = Window.partitionBy("doc_id", "_digest").orderBy("source", "lang", "n_chars")
    ranked = kept.select("*", F.row_number().over(one).alias("_turn"))
    return ranked.filter("_turn = 1 or _wordless and doc_id is null").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, globally shuffled."""
    release()
    return mixing.mix_sources(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; a repeated document is packed as often as it stands there."""
    release()
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), end_id=1, capacity=2048)


STAGES = [("language_id", identify), ("shingle_join", drop_near_copies), ("poisson_mix", mix), ("packing", pack)]

#: Character models and the packing's linear program are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
