import pytest

import corpus_pipeline
from quire.llm import langid
from quire.llm.shared import words_of

from .fixtures import DOCS, documents, nothing


def shingles(text):
    ws = words_of(text)
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())


def least_of_each_group(rows):
    """Brute force over all pairs: the kept (doc_id, text)s, sorted."""
    texts = list({(r["doc_id"], r["text"]) for r in rows})
    sets = [shingles(t) for _, t in texts]
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for (d, t), s, g in zip(texts, sets, group):
        if s:
            best.setdefault(g, []).append((d is None, d or 0, corpus_digest(t), t))
    kept = [(None if x[0] else x[1], x[3]) for x in map(min, best.values())]
    kept += [(d, t) for (d, t), s in zip(texts, sets) if not s and d is not None]
    return sorted(kept + [(None, r["text"]) for r in rows if r["doc_id"] is None and not shingles(r["text"])], key=str)


def corpus_digest(text):
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()


@pytest.fixture
def docs(spark):
    """The fixture, and ids that stand for unlinked texts, rows without an id, repeated rows."""
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    more = [(7001, a, "en", "s0", 1, "", "", ""), (7001, b, "en", "s0", 1, "", "", ""), (6000, b + " end", "fr", "s0", 1, "", "", "")]
    more += [(None, a, "en", "s1", 1, "", "", "")] * 2 + [(None, "only here without any id " + a[::-1], "en", "s1", 1, "", "", "")] * 3
    return documents(spark).union(spark.createDataFrame(more + [more[0]], DOCS))


def test_near_copies_against_all_pairs(spark, docs):
    rows = docs.collect()
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == corpus_pipeline.COLUMNS
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == least_of_each_group(rows)


def test_language_stage_keeps_what_is_not_rejected(spark, docs):
    model = langid.train(docs)
    want = [r for r in docs.collect() if not langid.score_texts(model, [r["text"]])[0][3]]
    got = corpus_pipeline.identify(spark, docs, "").collect()
    assert sorted(map(str, got)) == sorted(str(r) for r in spark.createDataFrame(want, DOCS).select(*corpus_pipeline.COLUMNS).collect())


def test_mixing_stage_repeats_whole_rows(spark, docs):
    rows = {tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()}
    got = corpus_pipeline.mix(spark, docs, "")
    assert got.columns == corpus_pipeline.COLUMNS and got.count() > 0 and {tuple(r) for r in got.collect()} <= rows


def test_packing_stage_covers_every_document(spark, docs):
    got = corpus_pipeline.pack(spark, docs.select(*corpus_pipeline.COLUMNS), "").collect()
    packed = sorted(((r["doc_id"] or -1), r["doc_tokens"]) for r in got if r["start"] == 0)
    assert len(packed) == docs.count() and sum(r["length"] for r in got) == sum(n for _, n in packed)


def test_stages_on_an_empty_table(spark):
    empty = nothing(spark).select(*corpus_pipeline.COLUMNS)
    assert [step(spark, empty, "").count() for _, step in corpus_pipeline.STAGES] == [0, 0, 0, 0]
