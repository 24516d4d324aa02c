"""Language identification by interpolated Kneser-Ney character models.

One model per language, orders 1 to ORDER over the characters of lower-cased words and their boundaries.  All languages
share sorted arrays of n-gram hashes; beside each hash stands, per language, the discounted probability (n-grams) or the
mass that goes to the shorter context (contexts).  A text gets the language with the lowest cross-entropy per character.

Rejection is calibrated: part of the training sample is kept out of the counts, and gives each language the spread of its
cross-entropy.  A text that its best language explains worse than any such text would, allowing for its length, is rejected.

Fitting reads a bounded sample (at most about `max_docs` documents a language, chosen by a hash of doc_id); prediction runs on
every whole text and looks at the text alone.  Words repeat, so each distinct word is scored once per batch of a worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import batch_limits, broadcast, doc_bucket, keep_only, mix64, small_batches

ORDER = 4
#: Share of the sample kept for calibration: sample hashes of this remainder modulo 8.
CALIBRATE = 0
_B = np.uint64(0x9E3779B97F4A7C15)
_EDGE = 32
#: Words scored at once; bounds the memory of a batch's n-gram tables.
BLOCK = 8192
#: Characters of the windows that rejection is calibrated on.
LENGTHS = (20, 40, 80, 160, 320, 640, 1280)
#: Characters after which further ones add little evidence for a language.
EVIDENCE = 200.0


def word_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """hashes[n, i]: the hash of the n + 1 characters that end at place i of the words laid out with a boundary at both
    sides (0 where they would cross the word); owner[i]: the word of place i.  Opening boundaries are not predicted."""
    sizes = np.array([len(w) for w in words], dtype=np.int64) + 2
    text = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) if words else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbol = mix64(text * _B + np.uint64(1))
    out, code = [], np.zeros(len(text), dtype=np.uint64)
    for n in range(ORDER):
        before = np.concatenate((np.zeros(1, np.uint64), code[:-1])) if n else code
        code = mix64(before * np.uint64(31) + symbol + np.uint64(n)) | np.uint64(1)
        out.append(np.where((place >= n) & (place >= 1), code, np.uint64(0)))
    context = [np.where((place >= max(1, n)), np.concatenate((np.zeros(1, np.uint64), _plain(symbol, place, n)[:-1])), np.uint64(0)) for n in range(ORDER)]
    return np.array([out, context]), np.where(place >= 1, owner, -1)


def _plain(symbol: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters ending at each place; 1 for n = 0."""
    if n == 0:
        return np.ones(len(symbol), dtype=np.uint64)
    code = np.zeros(len(symbol), dtype=np.uint64)
    for k in range(n):
        before = np.concatenate((np.zeros(1, np.uint64), code[:-1])) if k else code
        code = mix64(before * np.uint64(31) + symbol + np.uint64(k)) | np.uint64(1)
    return code


@dataclass
class Model:
    langs: list[str]
    grams: list[np.ndarray] = field(default_factory=list)  # sorted hashes, by order
    seen: list[np.ndarray] = field(default_factory=list)  # [gram, language] discounted probability
    contexts: list[np.ndarray] = field(default_factory=list)
    passed: list[np.ndarray] = field(default_factory=list)  # [context, language] mass for the shorter context
    floor: float = 1e-4  # probability of a character below order 1
    limits: np.ndarray | None = None  # [length, language] cross-entropy up to which a text is accepted

    def log_probs(self, words: list[str]) -> np.ndarray:
        """[word, language] natural log probability."""
        total = np.zeros((len(words), len(self.langs)))
        if not words or not self.langs:
            return total
        (grams, contexts), owner = word_hashes(words)
        ok = owner >= 0
        p = np.full((int(ok.sum()), len(self.langs)), self.floor)
        for n in range(ORDER):
            g, c = grams[n][ok], contexts[n][ok]
            i, j = np.searchsorted(self.grams[n], g), np.searchsorted(self.contexts[n], c)
            i[i == len(self.grams[n])] = 0
            j[j == len(self.contexts[n])] = 0
            hit, known = self.grams[n][i] == g, (self.contexts[n][j] == c) & (c != 0)
            p *= np.where(known[:, None], self.passed[n][j], 1.0)
            p += np.where((hit & known & (g != 0))[:, None], self.seen[n][i], 0.0)
        logs, own = np.log(p), owner[ok]
        for k in range(len(self.langs)):
            total[:, k] = np.bincount(own, weights=logs[:, k], minlength=len(words))
        return total


def count_grams(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct n-grams of words with counts [word, language]: order less one, hash, context's hash, hash of the gram less its first character, counts [gram, language]."""
    (grams, contexts), owner = word_hashes(words)
    ok = owner >= 0
    per_place, out = counts[owner[ok]], []
    for n in range(ORDER):
        g, c, shorter = grams[n][ok], contexts[n][ok], grams[max(0, n - 1)][ok]
        live = g != 0
        keys, first, inverse = np.unique(g[live], return_index=True, return_inverse=True)
        table = np.stack([np.bincount(inverse, weights=per_place[live, k], minlength=len(keys)) for k in range(counts.shape[1])], axis=1)
        out.append((np.full(len(keys), n, dtype=np.int32), keys, c[live][first], shorter[live][first], table))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def fit(langs: list[str], every: list[str], counts: np.ndarray) -> Model:
    """Kneser-Ney models from word counts [word, language], block by block of words."""
    blocks = [count_grams(every[i : i + BLOCK], counts[i : i + BLOCK]) for i in range(0, max(1, len(every)), BLOCK)]
    return fit_grams(langs, *map(np.concatenate, zip(*blocks, strict=True)))


def fit_grams(langs: list[str], order: np.ndarray, grams: np.ndarray, contexts: np.ndarray, shorter: np.ndarray, counts: np.ndarray) -> Model:
    """Kneser-Ney models from counts of n-grams, as `count_grams` gives them; rows of one n-gram add up."""
    model, raw = Model(langs), []
    for n in range(ORDER):
        own = np.flatnonzero(order == n)
        keys, first, inverse = np.unique(grams[own], return_index=True, return_inverse=True)
        table = np.stack([np.bincount(inverse, weights=counts[own, k], minlength=len(keys)) for k in range(len(langs))], axis=1)
        raw.append([keys, contexts[own][first], table, shorter[own][first]])
    for n in range(ORDER):
        keys, context, table, _ = raw[n]
        if n < ORDER - 1:  # continuation counts: how many longer n-grams end in this one
            where = np.searchsorted(keys, raw[n + 1][3])
            kn = np.zeros_like(table)
            for k in range(len(langs)):
                kn[:, k] = np.bincount(where, weights=(raw[n + 1][2][:, k] > 0).astype(float), minlength=len(keys))
            table = np.where(kn > 0, kn, (table > 0).astype(float))  # n-grams at a word's start have nothing before them
        ones, twos = (table == 1).sum(axis=0), (table == 2).sum(axis=0)
        discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
        ckeys, inverse = np.unique(context, return_inverse=True)
        total = np.stack([np.bincount(inverse, weights=table[:, k], minlength=len(ckeys)) for k in range(len(langs))], axis=1)
        kinds = np.stack([np.bincount(inverse, weights=table[:, k] > 0, minlength=len(ckeys)) for k in range(len(langs))], axis=1)
        under = np.maximum(total, 1e-12)[inverse]
        model.grams.append(keys if len(keys) else np.zeros(1, np.uint64))
        model.seen.append(np.where(total[inverse] > 0, np.maximum(table - discount, 0) / under, 0.0) if len(keys) else np.zeros((1, len(langs))))
        model.contexts.append(ckeys if len(ckeys) else np.zeros(1, np.uint64))
        model.passed.append(np.where(total > 0, discount * kinds / np.maximum(total, 1e-12), 1.0) if len(ckeys) else np.ones((1, len(langs))))
    return model


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def score_texts(model: Model, texts: list[str | None]) -> list[tuple[str, float, float, bool]]:
    """(language, score, cross-entropy per character, rejected) of each text.  Without a letter: und, 0.0, 0.0, True.

    score: the language's share of the likelihood, characters being dependent evidence that saturates at EVIDENCE of them, times the
    fit: limit over cross-entropy for texts beyond the limit of rejection, else 1.
    """
    split = [t.lower().split() if t else [] for t in texts]
    at: dict[str, int] = {}
    ids = [np.fromiter((at.setdefault(w, len(at)) for w in ws), dtype=np.int64, count=len(ws)) for ws in split]
    words = list(at)
    blocks = [model.log_probs(words[i : i + BLOCK]) for i in range(0, len(words), BLOCK)]
    table = np.concatenate(blocks) if blocks else np.zeros((0, len(model.langs)))
    sizes = np.fromiter((len(w) + 1 for w in at), dtype=np.int64, count=len(at))
    out = []
    for t, i in zip(texts, ids, strict=True):
        if not t or not has_letter(t) or not model.langs:
            out.append(("und", 0.0, 0.0, True))
            continue
        n = int(sizes[i].sum())
        entropy = -table[i].sum(axis=0) / n
        best = int(entropy.argmin())
        gap = (entropy - entropy[best]) * (n * EVIDENCE / (n + EVIDENCE))
        limit = np.inf if model.limits is None else float(np.interp(np.log(n), np.log(LENGTHS), model.limits[:, best]))
        fit = min(1.0, limit / float(entropy[best])) if entropy[best] > 0 else 1.0
        out.append((model.langs[best], fit * float(1 / np.exp(-gap).sum()), float(entropy[best]), bool(entropy[best] > limit)))
    return out


def windows(text: str, length: int, most: int = 8) -> list[str]:
    """The first runs of whole words that reach the length, one after another; none that a long word makes more than twice as long."""
    out, run, size = [], [], 0
    for w in text.split():
        run.append(w)
        size += len(w) + 1
        if size > 2 * length:
            run, size = [], 0
        elif size >= length:
            out.append(" ".join(run))
            run, size = [], 0
            if len(out) == most:
                break
    return out


def calibrate(model: Model, cuts: list[tuple[int, str, str]], slack: float = 8.0) -> None:
    """Set each language's limit of cross-entropy by length: median and slack deviations, at least 30 %, of the windows (length, text, language).

    The allowance keeps texts that quote another learned language or hold some noise; texts of other languages lie 60 % and more above the median.
    """
    limits: list[np.ndarray] = []
    for length in LENGTHS:
        cut = [(w, lang) for n, w, lang in cuts if n == length]
        found: dict[str, list[float]] = {lang: [] for lang in model.langs}
        for (_, lang), (got, _, entropy, _) in zip(cut, score_texts(model, [w for w, _ in cut]), strict=True):
            if got == lang:
                found[lang].append(entropy)
        every = [x for v in found.values() for x in v]
        pick = [np.array(found[lang] if len(found[lang]) >= 5 else every) for lang in model.langs]
        unknown = limits[-1] if limits else np.full(len(model.langs), np.inf)  # no text is that long: the shorter windows' limit
        limits.append(np.array([np.median(v) + max(slack * 1.4826 * np.median(np.abs(v - np.median(v))), 0.3 * np.median(v)) if len(v) else unknown[k] for k, v in enumerate(pick)]))
    model.limits = np.array(limits)


def train(docs: DataFrame, max_docs: int = 500, modulus: int = 4, held_remainder: int = 2) -> Model:
    """Fit on at most about max_docs documents a language, those of least hash; held-out documents never count.

    Repeated rows (same id and text) enter the sample together, but count as one document each.
    """
    with batch_limits(docs.sparkSession):
        return _train(docs, max_docs, modulus, held_remainder)


def _train(docs: DataFrame, max_docs: int, modulus: int, held_remainder: int) -> Model:
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang").filter("text is not null and lang is not null").filter(doc_bucket(F.col("doc_id"), modulus) != held_remainder)
    rows = rows.withColumn("draw", F.xxhash64(F.lit("sample"), F.col("doc_id"), F.col("text")).bitwiseAND(F.lit((1 << 62) - 1)))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    if not sizes:
        return Model([])
    limits = spark.createDataFrame([(k, int(min(1.0, max_docs / n) * ((1 << 62) - 1))) for k, n in sizes.items()], "lang string, draw_limit long")
    sample = rows.join(F.broadcast(limits), "lang").filter("draw <= draw_limit")  # limits: one row per language

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        found: dict[str, Counter] = {}
        for b in batches:
            for t, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(t.lower().split())
        for lang, c in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])

    fold = F.pmod(F.shiftright("draw", 3), F.lit(8))
    langs = sorted(sizes)
    each = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).cast("double").alias(f"n{i}") for i, lang in enumerate(langs)]
    totals = [f"n{i}" for i in range(len(langs))]
    matrix = lambda b: np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in totals], axis=1)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            order, *hashes, found = count_grams(b.column("word").to_pylist(), matrix(b))
            yield pa.RecordBatch.from_arrays([pa.array(order), *[pa.array(h.view(np.int64)) for h in hashes], *map(pa.array, found.T)], names=["order", "gram", "context", "shorter", *totals])

    words = sample.filter(fold != CALIBRATE).select("text", "lang").mapInArrow(count, "lang string, word string, n long").groupBy("word").agg(*each)
    grams = words.mapInArrow(split, "order int, gram long, context long, shorter long, " + ", ".join(f"{c} double" for c in totals))
    counted = grams.groupBy("order", "gram").agg(F.min("context").alias("context"), F.min("shorter").alias("shorter"), *[F.sum(c).alias(c) for c in totals]).toArrow().combine_chunks()  # the n-grams of a bounded sample, far fewer than its words
    hashes = [counted.column(c).to_numpy().view(np.uint64) for c in ("gram", "context", "shorter")]
    model = fit_grams(langs, counted.column("order").to_numpy(), *hashes, np.stack([counted.column(c).to_numpy() for c in totals], axis=1))
    del counted, hashes

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(n, w, lang) for t, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True) for n in LENGTHS for w in windows(t, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True) if found else ((), (), ()), (pa.int32(), pa.string(), pa.string()), strict=True)], names=["length", "text", "lang"])

    kept = sample.filter(fold == CALIBRATE).select("text", "lang").mapInArrow(cut, "length int, text string, lang string")
    calibrate(model, [tuple(r) for r in kept.collect()])  # of an eighth of the sample, a few windows of bounded length each
    return model


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("cross_entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType())])


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """keep columns of every row, then lang_pred, score, cross_entropy (nats a character) and rejected.

    Only the text is looked at.  Null text or text without a letter: und, 0, 0, rejected.  A kept column of a result's name gives way to it.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keep = [c for c in keep if c not in RESULT.names]
    shared = broadcast(spark, model)  # bounded by the training sample
    rows = docs.select(*keep, F.col("text").cast("string").alias("_lid_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for b in batches:
            said = list(zip(*score_texts(shared.value, b.column(b.num_columns - 1).to_pylist()), strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(v, k) for v, k in zip(said, (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True))], names=[*keep, *RESULT.names])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *RESULT.fields]))


def identify_languages(docs: DataFrame, max_docs: int = 500) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected for every document; the model learns from docs itself."""
    model = train(docs, max_docs)
    rows = docs.select("doc_id", "text", (doc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"))
    return predict(rows, model, ["doc_id", "held_out"])
