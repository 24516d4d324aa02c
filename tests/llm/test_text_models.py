import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import htmlmain, langid, lmscore, mixing, urlrules
from quire.llm.shared import words_of

from .fixtures import documents, nothing

SF = "/root/testdata/sf0.001"


def held(doc_id, modulus):
    return zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % modulus == 2


def test_base_scores_and_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "BLOCK_BYTES", 2000)
    docs = documents(spark)
    rows = [(r["doc_id"], words_of(r["text"]) + ["end"]) for r in docs.collect()]
    c = Counter(w for d, ws in rows if not held(d, 7) for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter((d, held(d, 7), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws in rows)
    got = lmscore.score_documents(docs).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    assert lmscore.score_documents(nothing(spark)).count() == 0


def test_model_beats_base_on_held_out_text(spark):
    got = lmscore.score_documents(spark.read.parquet(f"{SF}/documents.parquet")).filter("held_out").collect()
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_words_are_scored_after_the_word_before(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "BLOCK_BYTES", 20)
    texts = ["the cat sat on the mat", "the cat sat", "on the mat the cat", "mat the on sat cat the", "the cat sat on the mat", "a cat", "", None, "the zebra sat", "cat the sat", "end"] * 2
    got = lmscore.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), modulus=3).collect()
    c, pairs, docs = Counter(), Counter(), {i: [*words_of(t), b"\n"] for i, t in enumerate(texts)}
    for i, ws in docs.items():
        if not held(i, 3):
            c.update([b" ", *ws])
            pairs.update(zip([b" ", *ws], ws))
    grams = Counter()
    for w in set(c) - {b" ", b"\n"}:
        x = b" " + w + b" "
        for i in range(1, len(x)):
            for k in range(1, min(lmscore.ORDER, i + 1) + 1):
                grams[x[i - k + 1 : i + 1]] += c[w]
    m, n, v = lmscore.Automaton(grams), sum(c.values()) - c[b" "], len(c) - 1
    spell = {w: 10 ** m.word_weights([w])[0] for w in c if w not in (b" ", b"\n")}

    def p(w):
        return (c[w] - 0.5) / n + 0.5 * v / n * spell.get(w, 0) if c[w] else 0.5 * v / n * (1 - sum(spell.values()))

    for r in got:
        ws = docs[r["doc_id"]]
        assert abs(r["score"] - sum(math.log10((pairs[u, w] + lmscore.MU * p(w)) / (c[u] + lmscore.MU)) for u, w in zip([b" ", *ws], ws))) < 1e-9
    score = {r["doc_id"]: r["score"] for r in got}
    assert len(got) == len(texts) and score[0] > score[3] + 0.1  # the same words, in another order


def test_automaton_is_a_distribution_and_equals_plain_backoff():
    grams = Counter()
    for w, n in {"the": 9, "then": 4, "hat": 2, "a": 5}.items():
        t = f" {w} ".encode()
        for k in range(1, lmscore.ORDER + 1):
            for i in range(1, len(t)):
                if i - k + 1 >= 0:
                    grams[t[i - k + 1 : i + 1]] += n
    m = lmscore.Automaton(grams)
    used = len(set(m.symbol.tolist())) - 1
    assert np.allclose((10**m.weight)[:, :-1].sum(axis=1) + (256 - used) * (10**m.weight)[:, -1], 1)

    def p(context, ch):
        if context is None:
            return 1 / 256
        follow = {g[-1]: n for g, n in grams.items() if g[:-1] == context and len(g) == len(context) + 1}
        lower = p(context[1:] if context else None, ch)
        return (follow.get(ch, 0) + len(follow) * lower) / (sum(follow.values()) + len(follow)) if follow else lower

    for w in (b"the", b"thaten", b"zebra", b"a", b""):
        t, total = b" " + w + b" ", 0.0
        for i in range(1, len(t)):
            total += math.log10(p(t[max(0, i - lmscore.ORDER + 1) : i], t[i]))
        assert abs(m.word_weights([w])[0] - total) < 1e-9


def plain_kneser_ney(counts):
    """p(i, word laid out between spaces) by the definition, from counts of words."""
    seen = {n: Counter() for n in range(1, langid.ORDER + 1)}
    for w, c in counts.items():
        t = f" {w} "
        for n in seen:
            for i in range(1, len(t)):
                if i - n + 1 >= 0 and c:
                    seen[n][t[i - n + 1 : i + 1]] += c
    value = {langid.ORDER: seen[langid.ORDER]}
    for n in range(1, langid.ORDER):
        before = Counter(g[1:] for g in seen[n + 1])
        value[n] = {g: before[g] or 1 for g in seen[n]}
    discount, total, kinds = {}, {n: Counter() for n in value}, {n: Counter() for n in value}
    for n, v in value.items():
        ones, twos = (sum(x == k for x in v.values()) for k in (1, 2))
        discount[n] = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
        for g, x in v.items():
            total[n][g[:-1]] += x
            kinds[n][g[:-1]] += 1

    def p(t, i):
        out = 1e-4
        for n in range(1, langid.ORDER + 1):
            c = t[max(0, i - n + 1) : i]
            if i - n + 1 >= 0 and total[n][c]:
                out = out * discount[n] * kinds[n][c] / total[n][c] + max(value[n].get(c + t[i], 0) - discount[n], 0) / total[n][c]
        return out

    return p


def test_language_model_equals_plain_kneser_ney():
    words = ["abab", "ba", "cc", "abc", "a", "bca", "ababab", "éà", "cab"]
    counts = np.array([[5, 0], [3, 1], [0, 4], [2, 2], [1, 0], [0, 1], [1, 0], [0, 3], [1, 1]], dtype=float)
    model = langid.fit(["x", "y"], words, counts)
    probe = [*words, "zz", "abcab", "ab", "ccc", "é"]
    got = model.log_probs(probe)
    for k in range(2):
        p = plain_kneser_ney({w: int(c[k]) for w, c in zip(words, counts)})
        for w, row in zip(probe, got):
            t = f" {w} "
            assert abs(row[k] - sum(math.log(p(t, i)) for i in range(1, len(t)))) < 1e-9


def test_models_of_counted_grams_are_those_of_all_words(spark, monkeypatch):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("die katze sass da", "de"), ("a cat, a mat", "en"), ("le chat noir", "fr"), ("katze da", "de"), ("the the", "en")] * 20)]
    words = sorted({w for _, t, _ in rows for w in t.split()})
    counts = np.array([[i + 3.0 * k for k in range(3)] for i, _ in enumerate(words)])
    whole = langid.fit(["x", "y", "z"], words, counts)
    monkeypatch.setattr(langid, "BLOCK", 3)
    for a, b in ((whole, langid.fit(["x", "y", "z"], words, counts)),):
        assert all(np.array_equal(x, y) for f in ("grams", "seen", "contexts", "passed") for x, y in zip(getattr(a, f), getattr(b, f), strict=True))
    used = Counter()
    monkeypatch.setattr(langid, "calibrate", lambda *a: None)
    monkeypatch.setattr(langid, "fit", lambda *a: used.update(["words on the driver"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.train(docs)
    monkeypatch.undo()
    took = [r for r in rows if not held(r[0], 4)]
    fold = {r["doc_id"] for r in docs.withColumn("d", F.xxhash64(F.lit("sample"), "doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1))).filter(F.pmod(F.shiftright("d", 3), F.lit(8)) != langid.CALIBRATE).collect()}
    c = Counter((w, lang) for i, t, lang in took if i in fold for w in t.split())
    want = langid.fit(["de", "en", "fr"], words, np.array([[c[w, lang] for lang in ("de", "en", "fr")] for w in words], dtype=float))
    assert not used and model.log_probs(["cat", "katze"]).round(9).tolist() == want.log_probs(["cat", "katze"]).round(9).tolist()


def test_language_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.95
    assert np.mean([r["rejected"] for r in got]) < 0.02
    foreign = docs.limit(1).selectExpr("cast(1 as long) doc_id", "'Съешь же ещё этих мягких французских булок да выпей чаю' text", "lang")
    model = langid.train(docs)
    row = langid.predict(foreign, model, ["doc_id"]).first()
    assert row["rejected"] and row["score"] < 0.9


def test_repeated_rows_do_not_flood_the_sample(spark):
    docs = documents(spark)
    one = spark.range(3000).selectExpr("cast(null as long) doc_id", "concat('words of text number ', id) text", "'en' lang")
    model = langid.train(docs.select("doc_id", "text", "lang").union(one), max_docs=100)
    assert model.langs == ["en", "fr"] and 10 < len(model.grams[0])


def test_short_foreign_texts_are_rejected(spark):
    model = langid.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    foreign = ["Il gatto dorme sulla sedia mentre fuori piove senza smettere mai", "Wszyscy ludzie rodza sie wolni i rowni pod wzgledem swej godnosci", "zxq vbkjw qqpzt hjkxw vvbnm qwzxk jjkpl xzqwv bnmzx"]
    assert [r[3] for r in langid.score_texts(model, foreign)] == [True] * 3


def test_language_of_awkward_texts(spark):
    got = langid.identify_languages(documents(spark)).collect()
    assert len(got) == documents(spark).count()
    by = {r["doc_id"]: r for r in got}
    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    for d, t in texts.items():
        if d is not None:
            assert (by[d]["lang_pred"] == "und") == (not t or not any(map(str.isalpha, t)))
            assert by[d]["held_out"] == held(d, 4) and 0 <= by[d]["score"] <= 1
    assert langid.identify_languages(nothing(spark)).count() == 0


def test_names_of_furniture():
    for name in ("sidebar", "main-menu", "ad_box", "cookie-banner", "nav", "site-nav", "comments"):
        assert htmlmain.names_furniture(name)
    for name in ("side-effects", "related-work", "notice-period", "menu-analysis", "article", "content", "", "advance"):
        assert not htmlmain.names_furniture(name)


def test_text_of_main_beside_the_article_stays(spark):
    page = '<body><div class="menu">M</div><main><h1>Title</h1><article><p class="side-effects">Body</p></article><p id="notice-period">After</p></main><article>Other</article></body>'
    inside = page.replace("<article>Other</article>", "")
    assert texts_of(spark, ("a.example", page), ("b.example", inside)) == ["Body Other", "Title Body After"]


def test_pages_without_rows_and_with_clashing_columns(spark):
    schema = "page_id long, url string, html string, host string, place string, rule string, verdict string, n long"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([(1, "http://a.net/x", "<p>Hi", "h", "p", "r", "v", 3)], schema)
    assert htmlmain.extract_main(none).count() == 0 and urlrules.judge_urls(none).count() == 0
    assert [tuple(r) for r in htmlmain.extract_main(one).collect()] == [(1, "http://a.net/x", "Hi", 2)]
    assert [tuple(r) for r in urlrules.judge_urls(one).collect()] == [(1, "http://a.net/x", "a.net", "/x", "net/", "block")]


PAGE = '<html><head><title>T</title></head><body><nav><ul><li>Home<li>News</ul></nav><div class="ad">Buy</div><article><h1>A &amp; B{n}</h1><p>one  <b>two<br><p>three&nbsp;x</p><aside>side</aside><div id="comments">c</div></article><footer>f</footer></body></html>'


def test_main_text(spark):
    plain = '<html><body><div>Site menu of many words</div><div><p>Own text {n}.</p></div><script>var t="</p>";</script></body></html>'
    rows = [(i, "http://a.example/x", PAGE.format(n=i)) for i in range(3)] + [(10 + i, "http://b.example/", plain.format(n=i)) for i in range(8)] + [(30, None, None), (31, "http://b.example/", ""), (10, "http://b.example/", plain.format(n=0))]
    got = Counter((r["page_id"], r["text"]) for r in htmlmain.extract_main(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert got == Counter([(i, f"A & B{i} one two three x") for i in range(3)] + [(10 + i, f"Own text {i}.") for i in range(8)] + [(30, ""), (31, ""), (10, "Own text 0.")])


def texts_of(spark, *pages):
    rows = [(i, f"http://{host}/", html) for i, (host, html) in enumerate(pages)]
    got = htmlmain.extract_main(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


def test_template_inside_the_marked_region(spark):
    letter = "<div><p>Get our weekly letter</p><input></div>"
    long_notice = f"<section><p>{' '.join(f'rule{i}' for i in range(25))}</p></section>"
    own = " ".join(f"word{i}" for i in range(40))
    quoted = "<p>A passage quoted on every page</p>"
    pages = [("a.example", f"<main><div><a href=/>Home</a> <a href=/n>News</a></div><article><h1>Same</h1>{quoted}<p>{own} {n}</p>{letter}{long_notice}</article></main>") for n in range(6)]
    pages += [("b.example", f"<main><ul><li>Home<li>News</ul><h1>T</h1><p>Own {n}</p></main>") for n in range(2)]
    got = texts_of(spark, *pages)
    assert got == [f"Same A passage quoted on every page {own} {n}" for n in range(6)] + [f"T Own {n}" for n in range(2)]


def test_template_of_unmarked_pages_is_relative_to_the_host(spark):
    menu, passage = "<div>Home News Sport</div>", " ".join(f"p{i}" for i in range(30))
    cell = "<table><tr><td>1</td><td>{n}</td></tr></table><div><em>not</em> {n}</div>"
    pages = [("hot.example", f"<body>{menu}<div><p>{'A passage' if n < 9 else 'Text'} {'shared' if n < 9 else n}</p></div>{cell.format(n=n)}</body>") for n in range(30)]
    near = [("near.example", f"<body>{menu}<div><p>{passage}</p></div><p>edit {n}</p></body>") for n in range(8)]
    small = [("small.example", f"<body>{menu}<div>Own {n}</div></body>") for n in range(2)]
    want = [f"A passage shared 1 {n} not {n}" if n < 9 else f"Text {n} 1 {n} not {n}" for n in range(30)]
    assert texts_of(spark, *pages, *near, *small) == want + [f"{passage} edit {n}" for n in range(8)] + [f"Own {n}" for n in range(2)]


def test_every_url_gets_the_verdict_of_all_rules_tried(spark):
    import re

    urls = ["http://a.net/x", "HTTP://EXAMPLE.NET/en/", "https://x.example.net/en", "http://example.com/de/1?page=123", "http://q.org/fr/?ref=1", "http://q.org/en/?ref=1", "nothing", None, "", "://", "http://net", "http://q.org/ads/click", "http://q.org/print/12", "http://a.org/x?utm_source=b", "http://notexample.com/de/"]
    rows = urlrules.judge_urls(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")).collect()
    for r in rows:
        hosts = [x for x in urlrules.HOST_RULES if re.search(x.pattern, r["host"] + r["path"])]
        best = max(hosts, key=lambda x: len(x.text), default=None)
        verdict = best.verdict if best else "block" if any(re.search(x.pattern, (r["url"] or "").lower()) for x in urlrules.PATTERN_RULES) else "allow"
        assert (r["rule"], r["verdict"]) == (best.text if best else None, verdict)


def test_mix_rates_and_edges(spark):
    docs = documents(spark)
    out = mixing.mix_sources(docs, {"s0": 3.0, "s1": 1.0}, budget=40.0)
    size = {r["source"]: r["n"] for r in out.groupBy("source").agg({"n_chars": "sum"}).withColumnRenamed("sum(n_chars)", "n").collect()}
    assert set(size) == {"s0", "s1"} and 2.3 < size["s0"] / size["s1"] < 3.9
    assert mixing.mix_sources(nothing(spark)).count() == 0
    keys = [r["shuffle_key"] for r in mixing.mix_sources(docs).collect()]
    assert keys == sorted(keys)


def test_many_sources_mix_alike(spark, monkeypatch):
    docs = documents(spark)
    want = sorted(map(str, mixing.mix_sources(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mix_sources(docs).collect())) == want
    with pytest.raises(ValueError, match="clash"):
        mixing.mix_sources(docs.withColumnRenamed("token", "_mix_key"))


@pytest.mark.parametrize("rate", [0.0, 0.3, 1.0, 7.9])
def test_poisson_cdf(spark, rate):
    from pyspark.sql import functions as F

    got = spark.range(1).select(mixing.poisson_cdf(F.lit(rate))).first()[0]
    p = [math.exp(-rate) * rate**k / math.factorial(k) for k in range(61)]
    assert np.allclose(got, np.cumsum(p))
