import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quire.llm import idstore, packing, tsmedia
from quire.llm.registry import tokenizer_path
from quire.llm.tokens import WordEncoder

from .fixtures import documents, nothing

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


def encode(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("path, keeps", [(BYTE, True), (WORD, False)])
def test_word_encoder_equals_library(path, keeps, as_text):
    enc = WordEncoder(path, keeps, as_text, max_words=50)
    tok = Tokenizer.from_file(path)
    if as_text:
        tok.encode_special_tokens = True
    rng = random.Random(3)
    bits = ["a", "The", " ", "  ", "\n", "\t", " \n", "é", "e\u0301", "\u0301", "'s", "don't", "12 345", "<|endoftext|>", "\xa0", "\u2003", "\x1c", "\x1d", "\x85", "ß", "Σ", "ΣΑΣ", "日本", "🙂", ".", "...", ",", "),", "\r\n", "İ", "ŉ", "ǅ", "ª"]
    texts = ["", " ", "  a", "a ", "a  b", "\n a", ", a", "a.,b", None]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(1500)]
    texts += ["".join(rng.choice(["a", "Word", " ", " ", ",", ".", "\n", "é"]) for _ in range(rng.randrange(30))) for _ in range(1500)]
    for i in range(0, len(texts), 100):
        batch = texts[i : i + 100]
        ids, sizes = enc.encode(pa.array(batch, pa.string()), 7)
        ends = np.cumsum(sizes)
        got = [ids[e - n : e].tolist() for e, n in zip(ends, sizes)]
        assert got == [[*tok.encode(t or "", add_special_tokens=False).ids, 7] for t in batch]
    assert [len(x) for x in enc.encode(pa.array([], pa.string()))] == [0, 0]


def test_packing_covers_every_id_once(spark):
    docs = documents(spark)
    rows = [r.asDict() for r in packing.pack_documents(docs, BYTE).collect()]
    want = collections.Counter()
    for r in docs.collect():
        ids = [*encode(BYTE, r["text"] or ""), 1]
        for s in range(0, len(ids), 2048):
            part = np.array(ids[s : s + 2048], dtype="<u4")
            want[(r["doc_id"], s, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    seqs = collections.defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in seqs.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(seqs) <= total / 2048 * 1.05 + 1
    assert packing.pack_documents(nothing(spark), BYTE).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 3000), min_size=1, max_size=40))
def test_cutting_stock_meets_demand_with_little_waste(demand):
    sizes = np.array(sorted(demand))
    need = np.array([demand[s] for s in sizes])
    got = packing.cutting_stock(sizes, need.astype(float), 64)
    assert (sum(a * n for a, n in got) == need).all()
    assert all((a * sizes).sum() <= 64 for a, _ in got)
    big = (need[sizes > 32]).sum()
    assert sum(n for _, n in got) >= max(big, (sizes * need).sum() / 64)


def test_column_generation_beats_first_fit():
    sizes, need = np.array([21, 22, 31, 33, 43]), np.array([900.0, 700, 800, 500, 600])
    _, x = packing._first_basis(sizes, need, 64)
    got = packing.cutting_stock(sizes, need, 64)
    assert sum(n for _, n in got) <= np.ceil(x.sum())


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sizes, values = rng.choice(np.arange(1, 15), 4, replace=False), rng.random(4)
        best = np.zeros(31)
        for c in range(1, 31):
            best[c] = max([best[c - 1]] + [best[c - s] + v for s, v in zip(sizes, values) if s <= c])
        value, counts = packing.knapsack(values, sizes, 30)
        assert abs(value - best[30]) < 1e-9 and abs((counts * values).sum() - value) < 1e-9 and (counts * sizes).sum() <= 30


def test_id_store_round_trip(spark):
    docs = documents(spark)
    got = sorted(((r["doc_id"] is not None, r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in idstore.store_documents(docs, WORD).collect()), key=lambda r: r[2])
    want = collections.Counter()
    for r in docs.collect():
        ids = np.array([*encode(WORD, r["text"] or ""), 2], dtype="<u4")
        want[(r["doc_id"], len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert collections.Counter((r[1], r[3], r[4]) for r in got) == want
    at = 0
    for r in got:
        assert r[2] == at
        at += r[3]
    ids = [r[1] for r in got if r[0]]
    assert ids == sorted(ids)
    assert idstore.store_documents(nothing(spark), WORD).count() == 0


def test_store_keeps_each_chunk_once_and_notices_damage(spark, tmp_path):
    docs = documents(spark)
    path = f"file://{tmp_path}/store"
    idstore.write_store(docs, WORD, 2, path)
    rows = [r.asDict() for r in spark.read.schema(idstore.RECORD).parquet(f"{path}/records").collect()]
    root = spark.read.parquet(f"{path}/root").collect()
    chunks = collections.Counter(bytes(r["digests"][0]) for r in rows if r["kind"] == "chunk")
    packed = collections.Counter(bytes(d) for r in rows if r["kind"] == "doc" for d in r["pack"])
    assert chunks and packed and max(chunks.values()) == 1 and max(packed.values()) == 1 and not set(packed) & set(chunks)
    assert set(packed) | set(chunks) == {bytes(d) for r in rows if r["kind"] == "doc" for d in r["digests"]}
    doc = next(r for r in rows if r["doc_id"] == 7)
    chunk = next(r for r in rows if r["kind"] == "chunk")
    last = max((r for r in rows if r["kind"] == "doc"), key=lambda r: (r["part"], r["local_start"]))
    damage = {
        "a changed document's root": [r | {"root": b"0" * 16} if r is doc else r for r in rows],
        "a removed document": [r for r in rows if r is not doc],
        "changed manifests": [r | {"root": b"0" * 16} if r["kind"] == "manifest" else r for r in rows],
        "a removed file": [r for r in rows if r["part"] != last["part"]],
        "a removed chunk": [r for r in rows if r is not chunk],
    }
    for k, (what, broken) in enumerate(damage.items()):
        at = f"file://{tmp_path}/broken{k}"
        spark.createDataFrame(broken, idstore.RECORD).coalesce(1).write.parquet(f"{at}/records")
        spark.createDataFrame(root).coalesce(1).write.parquet(f"{at}/root")
        with pytest.raises(Exception, match="fit|missing|body"):
            idstore.read_store(spark, at).collect()
            pytest.fail(what)


def test_hot_chunks_come_back(spark, monkeypatch):
    """Every key is hot, then none is."""
    docs = documents(spark)
    want = None
    for hot in (10**9, 1):
        monkeypatch.setattr("quire.llm.shared.HOT", hot)
        got = sorted((r["start"], r["n_tokens"], r["ids_crc32"]) for r in idstore.store_documents(docs, WORD).collect())
        assert want is None or got == want
        want = got


def test_ids_beyond_16_bits_are_refused(spark):
    with pytest.raises(Exception, match="16 bits"):
        idstore.store_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"), WORD, end_id=65536).collect()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 65535), min_size=1, max_size=5000))
def test_chunks_cover_the_stream(ids):
    ends, counts = idstore.cut_points(np.array(ids, dtype=np.uint16), np.array([len(ids)]))
    assert ends[-1] == len(ids) and ends == sorted(set(ends)) and counts == [len(ends)]
    assert all(b - a <= idstore.MOST for a, b in zip([0, *ends], ends))


def plain_cuts(ids):
    """Cut points by the definition, id after id."""
    ends, start = [], 0
    for c in range(1, len(ids) + 1):
        h = sum(int(idstore._GEAR[ids[c - 1 - j]]) << j for j in range(min(idstore.WINDOW, c))) & 0xFFFFFFFFFFFFFFFF
        if c - start == idstore.MOST or c - start >= idstore.LEAST and not h & int(idstore.CUT_MASK) or c == len(ids):
            ends.append(c)
            start = c
    return ends


def test_cuts_of_streams_in_a_row_equal_those_of_each():
    rng = np.random.default_rng(2)
    streams = [rng.integers(0, 49000, n).astype(np.uint16) for n in (1, 2, 15, 16, 17, 63, 64, 65, 3000, 1, 1024, 1025, 700)] + [np.zeros(5000, np.uint16)]
    ends, counts = idstore.cut_points(np.concatenate(streams), np.array([len(s) for s in streams]))
    at, k = 0, 0
    for s, n in zip(streams, counts):
        assert [e - at for e in ends[k : k + n]] == plain_cuts(s)
        at, k = at + len(s), k + n


def test_cuts_follow_content():
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 49000, 6000).astype(np.uint16)
    a, b = (np.concatenate((rng.integers(0, 49000, n).astype(np.uint16), shared)) for n in (777, 1502))

    def chunks(x):
        ends, _ = idstore.cut_points(x, np.array([len(x)]))
        return {x[s:e].tobytes() for s, e in zip([0, *ends], ends)}

    ca, cb = chunks(a), chunks(b)
    assert len(ca & cb) >= 0.6 * len(ca)


def test_transport_stream_round_trip():
    rng = random.Random(5)
    for n in [1, 176, 177, 183, 184, 200, 576, 9216, 9217, 9216 * 8, 9216 * 8 + 1, 9216 * 20 + 555, *(rng.randrange(1, 60000) for _ in range(60))]:
        payload = rng.randbytes(n)
        media = tsmedia.mux(payload)
        assert len(media) % 188 == 0 and all(media[i] == 0x47 for i in range(0, len(media), 188))
        s = tsmedia.demux(media)
        units = -(-n // tsmedia.UNIT)
        assert s.payload == payload and (s.lost, s.repeated, s.broken) == (0, 0, 0)
        assert s.timestamps == [k * tsmedia.TICKS for k in range(units)] and s.random_access == list(range(0, units, tsmedia.GROUP))


def test_transport_stream_damage_is_noticed():
    payload = random.Random(6).randbytes(9216 * 3)
    media = tsmedia.mux(payload)
    packets = [media[i : i + 188] for i in range(0, len(media), 188)]
    s = tsmedia.demux(b"".join(packets[:10] + packets[11:]))
    assert s.lost == 1 and s.broken >= 1 and s.payload == payload[9216:]
    s = tsmedia.demux(b"".join(packets[:11] + packets[10:]))
    assert s.repeated == 1 and s.payload == payload
    assert tsmedia.demux(b"").payload == b""
    bad = bytearray(packets[0])
    bad[20] ^= 1
    assert tsmedia.demux(bytes(bad) + b"".join(packets[1:])).payload in (b"", payload)


def test_media_features(spark):
    docs = documents(spark)
    got = {(r["doc_id"], r["payload_sha256"]): r for r in tsmedia.media_features(docs).collect()}
    for r in docs.collect():
        payload, n = tsmedia.payload_of(r["text"])
        g = got[(r["doc_id"], hashlib.sha256(payload).hexdigest())]
        assert (g["n_bytes"], g["payload_bytes"], g["tail_crc32"]) == (n, len(payload), zlib.crc32(payload[-32:]))
        assert len(payload) % 576 == 0 and len(payload) >= 576 and g["media_sha256"] == hashlib.sha256(tsmedia.mux(payload)).hexdigest()
    assert tsmedia.media_features(nothing(spark)).count() == 0
