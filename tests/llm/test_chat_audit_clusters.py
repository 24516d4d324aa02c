"""Prefix-target chat examples, the audit of filters and annulus clustering, each against a plain version."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import annulus, chatexamples, filteraudit

from . import fixtures

TURNS = "conv_id long, turn long, role string, text string, start string, piece string, example string"
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[TURN]", "[/TURN]"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def chats(spark):
    rng = random.Random(3)
    text = lambda: "".join(rng.choice([*CONTROLS, "\\", "<", "[", "é", "a b", "\n", "😀", "/INST]"]) for _ in range(rng.randrange(9)))
    rows = [(0, t, rng.choice(["user", "assistant"]), text()) for t in range(200)]  # much of the table
    for c in range(1, 25):
        rows += [(c, t, rng.choice(["system", "user", "assistant", "tool", "[TURN]", "a\n[/TURN] ", None]), text()) for t in range(rng.randrange(1, 8))]
    rows += [(30, 0, "user", "no reply"), (31, 0, "assistant", None), (32, 0, "assistant", ""), (33, 0, "user", "x" * 300_000), (33, 1, "assistant", "y" * 300_000)]
    rows += [(34, 1, "user", "tie b"), (34, 1, "user", "tie a"), (34, 1, "user", "tie a"), (34, None, "assistant", "first"), (None, 0, "user", "q"), (None, 1, "assistant", "r"), (None, None, None, None)]
    return rows, spark.createDataFrame([(*r, "s", "p", "e") for r in rows], TURNS).repartition(3)


def in_order(rows):
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t if t is not None else -1, role or "", text or ""))
    return by


def escape(text):
    """Character by character: at an opening one, look whether backslashes and the rest of a control string follow."""
    out = ""
    for i, ch in enumerate(text):
        out += ch
        bare = text[i + 1 :].lstrip("\\")
        if ch in "<[" and any(bare.startswith(c[1:]) for c in CONTROLS):
            out += "\\"
    return out


def piece(role, text):
    known = {"system": "[SYS] %s [/SYS]", "user": "[INST] %s [/INST]", "assistant": " %s</s>"}
    return known[role].replace("%s", escape(text)) if role in known else f"[TURN]{escape(role)}[/TURN] {escape(text)}</s>"


def test_examples_are_prefixes_that_end_with_their_reply(spark):
    rows, df = chats(spark)
    examples = chatexamples.expand_targets(df).persist()
    got = defaultdict(list)
    for r in chatexamples.example_texts(examples).orderBy("conv_id", "example").collect():
        got[r["conv_id"]].append((r["example"], r["text"], r["text"][r["loss_start"] : r["loss_end"]]))
    read = {r["conv_id"]: r for r in chatexamples.read_turns(examples).collect()}
    by = in_order(rows)
    assert set(read) == set(by)
    for conv, turns in by.items():
        turns = sorted(turns, key=lambda t: (t[0], t[1], piece(*t[1:])))
        so_far, want, rest = "", [], 0
        for _, role, text in turns:
            so_far += piece(role, text)
            rest += len(piece(role, text))
            if role == "assistant":
                want.append((len(want) + 1, so_far, escape(text)))
                rest = 0
        assert got[conv] == want
        replies = [text for _, role, text in turns if role == "assistant"]
        r = read[conv]
        assert r["turns_sha256"] == sha("".join(f"{role}\n{text}\n" for _, role, text in turns)) and r["n_turns"] == len(turns)
        assert (r["loss_chars"], r["loss_sha256"]) == (len("".join(replies)), sha("".join(replies)))
        assert r["formatted_chars"] == sum(len(w[1]) for w in want) + rest
    assert examples.filter("conv_id = 0").select("position").distinct().count() == 200
    examples.unpersist()


def test_texts_cannot_forge_marks(spark):
    _, df = chats(spark)
    for r in chatexamples.expand_targets(df).select("piece").collect():
        assert len(re.findall("|".join(map(re.escape, CONTROLS)), r["piece"])) == (1 if r["piece"].startswith(" ") else 3 if r["piece"].startswith("[TURN]") else 2)


def test_every_example_holds_its_whole_context(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "q3")]
    examples = chatexamples.expand_targets(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = [(r["example"], r["position"], r["piece"], r["trainable"]) for r in examples.orderBy(F.col("example").asc_nulls_last(), "position").collect()]
    q1, a1, q2, a2, q3 = (piece(role, text) for _, _, role, text in rows)
    assert got == [(1, 1, q1, False), (1, 2, a1, True), (2, 1, q1, False), (2, 2, a1, False), (2, 3, q2, False), (2, 4, a2, True), (None, 5, q3, False)]
    assert chatexamples.read_turns(examples).first()["formatted_chars"] == len(q1 + a1) + len(q1 + a1 + q2 + a2) + len(q3)


def test_no_conversations(spark):
    examples = chatexamples.expand_targets(spark.createDataFrame([], TURNS))
    assert examples.count() == 0 and chatexamples.read_turns(examples).count() == 0


def plain_mask(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return (len(words) < 100) + 2 * (100 * len(set(words)) < 80 * len(words)) + 4 * (100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)) + 8 * any(c in "#$%&*|" for c in text)


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, 1, 2, "x") for i, t, p in rows], "doc_id long, text string, lang string, part int, mask int, own string").repartition(3)
    got = filteraudit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, spread long"))
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got.collect()}


def test_audit_filter_by_filter(spark):
    rng = random.Random(5)
    base = [fixtures.words(rng, n) + tail for n in (0, 40, 99, 100, 130, 4000) for tail in ("", " #", " ABCDEFGHIJ" * 9, " same" * 60, "\x0b\x1f\x85 é")]
    rows = [(rng.randrange(300), rng.choice(base), rng.choice(["en", "fr", "", None])) for _ in range(250)]
    rows += [(i, "hot text", "en") for i in range(400, 600)] + [(400, "hot text", "fr")] * 2 + [(None, "hot text", "en"), (None, None, None), (700, None, "en"), (701, "", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), 7) for i in range(650) if rng.random() < 0.7] + [(5, 1, 0, 7), (5, 0, 1, 7), (None, 1, 1, 7)]
    good, toxic = ({i for i, *l in labels if i is not None and l[k] == 1} for k in (0, 1))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    docs = [(p or "", i, plain_mask(t or "") + 16 * (i is not None and i > least[t or ""])) for i, t, p in rows]
    got = audited(spark, rows, labels)
    parts = {p for p, *_ in docs}
    assert len(got) == len(parts) * 600
    shapley = Counter()
    want = {}
    for order in map("".join, permutations("ABCDE")):
        gone = set()
        for step, f in enumerate(order, 1):
            bit = 1 << "ABCDE".index(f)
            for p in parts:
                own = [(k, d) for k, d in enumerate(docs) if d[0] == p]
                fails = [(k, d) for k, d in own if d[2] & bit]
                now = [(k, d) for k, d in fails if k not in gone]
                shapley[p, f] += len(now)
                want[p, order, step] = [len([1 for k, _ in own if k not in gone]) - len(now), len(now), len(fails) - len(now), sum(d[2] == bit for _, d in own), sum(d[1] in good for _, d in now), sum(d[1] in toxic for _, d in now)]
            gone |= {k for k, d in enumerate(docs) if d[2] & bit}
    for (p, order, step), w in want.items():
        assert got[p, order, step] == (*w, shapley[p, order[step - 1]])


def test_signed_sums_give_back_every_cell(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.randrange(2), rng.randrange(2), rng.randrange(32), rng.randrange(1, 10**12)) for _ in range(300)]
    want = defaultdict(lambda: [[0] * 32 for _ in range(3)])
    for p, g, t, m, n in rows:
        for k, on in enumerate((1, g, t)):
            want[p][k][m] += n * on
    for r in filteraudit.cells(spark.createDataFrame(rows, "part string, good int, toxic int, mask int, n long")).collect():
        assert [r["every"], r["good"], r["toxic"]] == want[r["part"]]


def test_audit_of_nothing(spark):
    assert audited(spark, [], [(1, 1, 1, 0)]) == {}
    assert set(audited(spark, [(1, "a", "en")], [])["en", "ABCDE", 1]) == {0, 1, 120}


VECTORS = "vec_id long, embedding array<double>, cluster string, v int"


def plain_clusters(rows, k, rounds):
    """Lloyd's rounds in Python's integers, every centroid compared."""
    kept = [(i, [int(np.floor(64 * x)) for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e)]
    first = sorted(kept, key=lambda r: (sha(f"1:{'' if r[0] is None else r[0]}"), r[1]))[:k]
    centroids = [v for _, v in first]
    away = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    place = lambda v: min(range(len(centroids)), key=lambda c: (away(v, centroids[c]), c))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[place(v)].append(v)
        for c, vs in own.items():
            centroids[c] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    out = [(i, place(v), away(v, centroids[place(v)])) for i, v in kept]
    own = Counter()
    for _, c, d in out:
        own[c] += d
    return sorted(((i, c, d, own[c], sum(own.values()), sha(",".join(map(str, centroids[c])))) for i, c, d in out), key=str)


def vectors(rng, n):
    rows = [(i, (rng.normal(size=64) * 0.1 + (i % 5)).tolist()) for i in range(n)]
    rows += [(n, [0.0] * 64), (n + 1, [0.0] * 64), (n + 1, [0.0] * 64), (None, [-1 / 64] * 64), (n + 2, [1.0] * 63), (n + 3, None), (n + 4, [None] + [0.0] * 63), (n + 5, [float("nan")] + [0.0] * 63), (n + 6, [float("inf")] + [0.0] * 63), (n + 7, [])]
    return rows + rows[:30]


@pytest.mark.parametrize(("n", "k", "rounds"), [(200, 16, 3), (3, 16, 3), (60, 5, 0)])
def test_clusters_are_those_of_plain_rounds(spark, n, k, rounds):
    rows = vectors(np.random.default_rng(n), n)
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], VECTORS).repartition(3)
    assert sorted(map(tuple, annulus.cluster(df, k, rounds).collect()), key=str) == plain_clusters(rows, k, rounds)


def test_empty_clusters_stay_and_no_vectors(spark):
    df = spark.createDataFrame([(i, [float(i // 20)] * 64, "", 0) for i in range(40)], VECTORS)
    got = annulus.cluster(df).collect()
    assert len({r["cluster"] for r in got}) == 2 and {r["inertia"] for r in got} == {0}
    assert annulus.cluster(df.filter("false")).collect() == []
    with pytest.raises(Exception, match="too large"):
        annulus.cluster(spark.createDataFrame([(1, [1e30] * 64, "", 0)], VECTORS)).collect()


def test_annulus_compares_few_and_loses_no_tie():
    rng = np.random.default_rng(1)
    rows = (rng.normal(size=(300, 8)) * rng.gamma(2, 200, size=(300, 1))).astype(np.int64)
    rows = np.vstack([rows, rows[:40], -rows[:40]])  # equal centroids, and equal norms
    x = np.vstack([(rng.normal(size=(900, 8)) * rng.gamma(2, 200, size=(900, 1))).astype(np.int64), rows, np.zeros((1, 8), np.int64), (rows[:100] + rows[100:200]) // 2])
    number, away, tried = annulus.Centroids(rows).nearest(x)
    every = ((x[:, None] - rows[None]) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (away == every.min(1)).all()
    assert tried < 0.6 * every.size
