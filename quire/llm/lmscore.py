"""Language-model scores by a weighted backoff automaton.

Model.  A text is its words and one end.  The states are the words known from training, the start of a text and one boundary
state; reading a word leads to that word's state, from an unknown word to the boundary state.  State u has an arc for each word w
that followed it in training and a failure arc of weight MU / (c(u) + MU) to the boundary state, all smoothed towards it
(Dirichlet prior): p(w | u) = (c(u, w) + MU p(w)) / (c(u) + MU).  In the boundary state a word known from training has an arc with
absolutely discounted weight (c - D) / N; the mass D * V / N left over goes by the failure arc to a character automaton that
spells any word: its states are byte contexts (n-grams up to ORDER - 1 within a word and its boundary), Witten-Bell
smoothed, each with a failure arc to its longest known suffix.  Failure arcs are resolved when the automaton is compiled.

As in the add-one base, the words never seen in training are one event: its weight is what the spellings of all known words
leave of the failure arc's mass.  So in every state the known words, the end and the unknown one add up to 1.

Counts.  Words and word pairs are counted over all training documents: each block of documents deals its distinct words and
pairs out by hash, one shuffle adds them up and a second hands every block the totals of its own.  Both travel packed, one row for a
block and each part of the hashes that it has words or pairs of; parts that it has none of cost nothing, so rows stay linear in the corpus.  Pairs are told apart by 64-bit hashes.  Neither vocabulary nor pairs are ever broadcast; the
automaton is: every byte context of up to ORDER - 1 bytes that occurs is a state, so its size has a bound at any corpus size.

Null text is an empty one (its end alone).  Repeated rows count and score separately.  Null doc_id hashes as empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import broadcast, doc_bucket, mix64, partition_count, small_batches, stage, words_of

ORDER = 3
DISCOUNT = 0.5
#: Weight of the boundary state's prior in every word's state, in words.
MU = 100.0
#: Words and pairs of one part, about.
PART = 4_000_000
BLOCK_BYTES = 8 << 20
#: Stands for the end of a text; no word holds white space.
END = b"\n"
START = b" "
_EDGE = 32

BLOCK = T.StructType([T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("ids", T.BinaryType()), T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("train_tokens", T.LongType()), T.StructField("train_docs", T.LongType())])
DEALT = "part int, block long, words array<binary>, word_counts binary, pairs binary, pair_counts binary"
TOTALS = "part int, block long, word_totals binary, pair_totals binary, words array<binary>, counts array<long>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press, serial = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 32
    doc_ids, held, streams, vocab, size = [], [], [], {}, 0

    def flush() -> pa.RecordBatch:
        nonlocal doc_ids, held, streams, vocab, size, serial
        lengths = [len(s) for s in streams]
        ids = np.concatenate(streams)
        learn = np.repeat(~np.array(held, dtype=bool), lengths)
        out = pa.RecordBatch.from_arrays([pa.array([serial], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())), pa.array([lengths], pa.list_(pa.int64())), pa.array([press.compress(ids.astype("<u4").tobytes())], pa.binary()), pa.array([list(vocab)], pa.list_(pa.binary())), pa.array([int(learn.sum())], pa.int64()), pa.array([len(held) - sum(held)], pa.int64())], names=BLOCK.names)
        doc_ids, held, streams, vocab, size = [], [], [], {}, 0
        serial += 1
        return out

    for b in batches:
        for d, t, h in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("held").to_pylist(), strict=True):
            ws = words_of(t)
            ws.append(END)
            for w in set(ws).difference(vocab):
                vocab[w] = len(vocab)
            doc_ids.append(d)
            held.append(h)
            streams.append(np.fromiter(map(vocab.__getitem__, ws), dtype=np.uint32, count=len(ws)))
            size += len(t or "") + 1
            if size >= BLOCK_BYTES:
                yield flush()
    if doc_ids:
        yield flush()


def _squeeze(x: np.ndarray, kind: str = "<u8") -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(x.astype(kind).tobytes())


def _spread(x: bytes, kind: str = "<u8") -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=kind)


class Layout:
    """A block's tokens as pairs with the state they are read in, and its words and pairs in the order of their hashes."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, words: list[bytes]):
        before = np.empty(len(ids), dtype=np.uint64)
        before[1:] = ids[:-1]
        before[np.cumsum(lengths) - lengths] = len(words)  # the start of a text
        kinds = np.uint64(len(words) + 1)
        pairs, self.place = np.unique(before * kinds + ids, return_inverse=True)
        self.state, self.word = (pairs // kinds).astype(np.int64), (pairs % kinds).astype(np.int64)
        name = np.fromiter(map(xxhash.xxh3_64_intdigest, [*words, START]), dtype=np.uint64, count=len(words) + 1)
        pair = mix64(mix64(name[self.state]) + name[self.word])
        self.word_order, self.pair_order = np.argsort(name[:-1], kind="stable"), np.argsort(pair, kind="stable")
        self.names, self.pairs = name[self.word_order], pair[self.pair_order]


def _dealt(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Each block's words and pairs with their training counts, by the parts of the hashes that it has any of: a block makes at most a row for each of its words and pairs, however many parts there are."""
    part_of = lambda hashes: ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    for b in batches:
        for row in range(b.num_rows):
            head = {k: b.column(k)[row].as_py() for k in ("block", "held", "lengths", "ids", "words")}
            ids, lengths = _spread(head["ids"], "<u4"), np.array(head["lengths"], dtype=np.int64)
            lay, learn = Layout(ids, lengths, head["words"]), np.repeat(~np.array(head["held"], dtype=bool), lengths)
            word_counts = np.bincount(ids[learn], minlength=len(head["words"]))[lay.word_order]
            pair_counts = np.bincount(lay.place[learn], minlength=len(lay.pairs))[lay.pair_order]
            words = pa.array(head["words"], pa.binary()).take(pa.array(lay.word_order))
            word_parts, pair_parts = part_of(lay.names), part_of(lay.pairs)
            own = np.union1d(word_parts, pair_parts)
            bound = lambda found: np.append(np.searchsorted(found, own), len(found))  # noqa: E731, B023
            w, p = bound(word_parts), bound(pair_parts)
            cut = lambda x, at: [_squeeze(x[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]  # noqa: E731, B023
            plain = [lay.pairs[i:j].astype("<u8").tobytes() for i, j in zip(p[:-1], p[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([head["block"]] * len(own), pa.int64()), pa.ListArray.from_arrays(pa.array(w, pa.int32()), words), pa.array(cut(word_counts, w), pa.binary()), pa.array(plain, pa.binary()), pa.array(cut(pair_counts, p), pa.binary())], names=[c.split()[0] for c in DEALT.split(", ")])


def _added(t: pa.Table) -> pa.Table:
    """One part: the totals of each block's words and pairs, and each word once with its total beside the first block that has it."""
    split = lambda x, sizes: [_squeeze(y) for y in np.split(x, np.cumsum(sizes)[:-1])]
    lists = t.column("words").combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    words = lists.flatten()
    code = pc.dictionary_encode(words).indices.to_numpy()
    each = np.bincount(code, weights=np.concatenate([_spread(x) for x in t.column("word_counts").to_pylist()]))
    first = np.zeros(len(words), dtype=bool)
    first[np.unique(code, return_index=True)[1]] = True
    hashes = [np.frombuffer(x, dtype="<u8") for x in t.column("pairs").to_pylist()]
    _, pair = np.unique(np.concatenate(hashes), return_inverse=True)
    pairs = np.bincount(pair, weights=np.concatenate([_spread(x) for x in t.column("pair_counts").to_pylist()]))
    ends = pa.array(np.concatenate(([0], np.cumsum(np.add.reduceat(np.append(first, False), np.cumsum(sizes) - sizes) * (sizes > 0)))), pa.int32())
    own = [pa.ListArray.from_arrays(ends, words.filter(pa.array(first))), pa.ListArray.from_arrays(ends, pa.array(each[code[first]].astype(np.int64)))]
    return pa.Table.from_arrays([t.column("part"), t.column("block"), pa.array(split(each[code], sizes), pa.binary()), pa.array(split(pairs[pair], [len(h) for h in hashes]), pa.binary()), *own], names=[c.split()[0] for c in TOTALS.split(", ")])


class Automaton:
    """The compiled character automaton: next state and log10 weight for each (state, symbol)."""

    def __init__(self, grams: dict[bytes, int], order: int = ORDER):
        """grams: weighted counts of byte n-grams up to `order`; those of order `order` with their context's state present count."""
        seen = sorted({g[-1] for g in grams if len(g) == 1} | {_EDGE})
        self.symbol = np.full(256, len(seen), dtype=np.int32)  # the last symbol is any byte not seen
        self.symbol[seen] = np.arange(len(seen))
        a = len(seen) + 1
        follow: dict[bytes, list[tuple[int, int]]] = {}
        for g, n in grams.items():
            follow.setdefault(g[:-1], []).append((int(self.symbol[g[-1]]), n))
        contexts = sorted(follow, key=lambda c: (len(c), c))
        state = {c: i for i, c in enumerate(contexts)}
        if b"" not in state:
            contexts, state = [b"", *contexts], {b"": 0}
        weight = np.zeros((len(contexts), a))
        arc = np.zeros((len(contexts), a), dtype=np.int32)
        for i, c in enumerate(contexts):
            counts = np.zeros(a)
            for s, n in follow.get(c, ()):
                counts[s] += n
            if c:
                fail = next(state[c[k:]] for k in range(1, len(c) + 1) if c[k:] in state)
                lower = weight[fail]
                arc[i] = arc[fail]
            else:
                lower = np.full(a, 1.0 / 256)
                lower[-1] = max(1, 256 - (a - 1)) / 256
            kinds = np.count_nonzero(counts)
            weight[i] = (counts + kinds * lower) / (counts.sum() + kinds) if kinds else lower
            for s in range(a - 1):
                deeper = c + bytes([seen[s]])
                if len(deeper) < order and deeper in state:
                    arc[i, s] = state[deeper]
        weight[:, -1] /= max(1, 256 - (a - 1))  # shared among the bytes not seen
        self.arc, self.weight, self.start = arc, np.log10(weight), state.get(bytes([_EDGE]), 0)

    def word_weights(self, words: list[bytes]) -> np.ndarray:
        """log10 weight of spelling each word to its closing boundary, all words in step."""
        if not words:
            return np.zeros(0)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        text = self.symbol[np.frombuffer(b"".join(words), dtype=np.uint8)]
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))[order]
        ordered = lengths[order]
        total, at = np.zeros(len(words)), np.full(len(words), self.start, dtype=np.int32)
        edge, alive = int(self.symbol[_EDGE]), len(words)
        for step in range(int(ordered[0]) + 1):
            while alive and ordered[alive - 1] < step:
                alive -= 1
            here = at[:alive]
            reads = ordered[:alive] > step
            s = np.full(alive, edge, dtype=np.int32)
            s[reads] = text[begin[:alive][reads] + step]
            total[:alive] += self.weight[here, s]
            at[:alive] = self.arc[here, s]
        out = np.zeros(len(words))
        out[order] = total
        return out


def _word_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted n-gram counts of distinct words: (n-gram, count), added up for each batch."""
    for b in batches:
        words, counts = b.column("word").to_pylist(), np.array(b.column("c").to_pylist(), dtype=np.int64)
        lengths = np.array([len(w) for w in words], dtype=np.int64) + 2
        text = np.frombuffer(b" " + b"  ".join(words) + b" ", dtype=np.uint8).astype(np.uint64) if words else np.zeros(0, dtype=np.uint64)
        weight, place = np.repeat(counts, lengths), np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        grams, sums = [], []
        code = np.zeros(len(text), dtype=np.uint64)
        for n in range(1, ORDER + 1):
            code = (code << np.uint64(8)) | text if n == 1 else (np.concatenate((np.zeros(1, np.uint64), code[:-1])) << np.uint64(8)) | text
            ok = (place >= n - 1) & (place >= 1)
            keys, inverse = np.unique(code[ok], return_inverse=True)
            grams += [int(k).to_bytes(n, "big") for k in keys]
            sums.append(np.bincount(inverse, weights=weight[ok].astype(float)).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), pa.array(np.concatenate(sums) if sums else [], pa.int64())], names=["gram", "n"])


def _grams(vocab: DataFrame) -> dict[bytes, int]:
    """Counts of the byte n-grams of all words: at most 256 ** ORDER and fewer, whatever the corpus."""
    grams = vocab.filter("word <> X'0A'").mapInArrow(_word_grams, "gram binary, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(grams.column("gram").to_pylist(), grams.column("n").to_pylist(), strict=True))


def score_documents(docs: DataFrame, modulus: int = 7, held_remainder: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Documents whose crc32(doc_id as text) mod modulus is held_remainder are scored but not learned from.
    base_score: add-one unigram; score: the automaton's log10 probability of the text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (doc_bucket(F.col("doc_id"), modulus) == held_remainder).alias("held"))
    blocks = stage(rows.mapInArrow(_blocks, BLOCK), "blocks")
    tokens, texts, pieces = (x or 0 for x in blocks.agg(F.sum("train_tokens"), F.sum("train_docs"), F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)"))).first())
    parts = max(partition_count(spark), -(-pieces // PART))
    dealt = blocks.mapInArrow(lambda batches: _dealt(batches, parts), DEALT)
    totals = stage(dealt.groupBy("part").applyInArrow(_added, TOTALS), "totals")
    vocab = totals.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).select(F.col("x.words").alias("word"), F.col("x.counts").alias("c")).filter("c > 0")
    kinds = vocab.count()
    automaton = Automaton(_grams(vocab))
    shared = broadcast(spark, automaton)  # at most 1 + 256 + 256 ** 2 states of 257 symbols; texts in UTF-8 have far fewer

    def spelled_mass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float((10.0 ** shared.value.word_weights(b.column("word").to_pylist())).sum())])], names=["mass"])

    known_mass = vocab.filter("word <> X'0A'").select("word").mapInArrow(spelled_mass, "mass double").agg(F.sum("mass")).first()[0] or 0.0
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def run(block: pa.Table, own: pa.Table) -> pa.Table:
        """One block and the totals of its words and pairs: at most BLOCK_BYTES of text, or one longer document."""
        head = {k: block.column(k)[0].as_py() for k in ("doc_ids", "held", "lengths", "ids", "words")}
        ids, lengths = _spread(head["ids"], "<u4"), np.array(head["lengths"], dtype=np.int64)
        starts, lay, own = np.cumsum(lengths) - lengths, Layout(ids, lengths, head["words"]), own.sort_by("part")
        c, pair = np.zeros(len(head["words"])), np.zeros(len(lay.pairs))
        c[lay.word_order] = np.concatenate([_spread(x) for x in own.column("word_totals").to_pylist()])
        pair[lay.pair_order] = np.concatenate([_spread(x) for x in own.column("pair_totals").to_pylist()])
        base = np.log10((c + 1) / (tokens + kinds + 1))
        spelled = np.array([w != END for w in head["words"]])
        spell = np.zeros(len(c))
        spell[spelled] = shared.value.word_weights([w for w in head["words"] if w != END])
        left = DISCOUNT * kinds / tokens if tokens else 1.0
        known = c > 0
        p = np.where(known, (c - DISCOUNT) / max(tokens, 1) + np.where(spelled, left * 10.0**spell, 0.0), left * max(1.0 - known_mass, 1e-9))
        arc = np.log10((pair + MU * p[lay.word]) / (np.append(c, texts)[lay.state] + MU))
        add = np.add.reduceat
        n = len(head["doc_ids"])
        return pa.Table.from_arrays([pa.array(head["doc_ids"], pa.int64()), pa.array(head["held"], pa.bool_()), pa.array(lengths, pa.int64()), pa.array(add(known[ids].astype(np.int64), starts), pa.int64()), pa.array([tokens] * n, pa.int64()), pa.array(add(base[ids], starts), pa.float64()), pa.array(add(arc[lay.place], starts), pa.float64())], names=out.names)

    heads = blocks.select("block", "doc_ids", "held", "lengths", "ids", "words")
    return heads.groupBy("block").cogroup(totals.select("block", "part", "word_totals", "pair_totals").groupBy("block")).applyInArrow(run, out)
