"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, start string, token string, copy string"


def words(rng, n, stem="w"):
    return " ".join(f"{stem}{rng.randrange(400)}" for _ in range(n))


def documents(spark, seed=1, near=40):
    rng = random.Random(seed)
    rows = []
    base = words(rng, 120).split()
    for i in range(near):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append(" ".join(w))
    rows += [words(rng, rng.randrange(1, 60), f"u{i}_") for i in range(40)]
    passage = words(rng, 55, "shared")
    rows += [words(rng, 30, f"v{i}_") + "\n" + passage for i in range(25)]
    for i in range(12):  # small sets: 5 to 24 shingles
        w = words(rng, 8 + i, f"s{i}_").split()
        rows += [" ".join(w), " ".join(w + ["end"]), " ".join(["Start", *w]), " ".join(w).upper()]
    rows += ["", " \n\t", None, "one", "one two", "One TWO", "a b c d", "a b c d", "a b c d e", "É é", words(rng, 20000, "long")]
    out = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s0", "s1", None]), len(t or ""), "x", "y", "z") for i, t in enumerate(rows)]
    out += [out[3], out[50], (None, base and " ".join(base), "en", "s0", 1, "x", "y", "z"), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(out, DOCS).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], DOCS)
