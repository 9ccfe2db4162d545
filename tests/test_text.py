"""Tokeniser, n-grams and TF-IDF against independent Python restatements."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from jobsheet.operators import text as D

DOCS = ["Lackieren KOTFLÜGEL a+e", "hagel dellen  hagel", "", "x", "größe straße a+e c++ +b"]


def char_wb(doc, lo=3, hi=5):
    out = []
    for w in doc.lower().split():
        w = f" {w} "
        for n in range(lo, hi + 1):
            if len(w) > n:
                out += [w[i:i + n] for i in range(len(w) - n + 1)]
            elif len(w) == n:
                out.append(w)
    return out


def py_tokens(doc):
    return re.findall(r"(?u)\b[\w\+]+\b", doc.lower())


def test_word_tokens_and_ngrams(spark):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(DOCS)], "id int, text string")
    got = {r["id"]: r["t"] for r in df.select("id", D.word_ngrams(D.word_tokens(F.col("text")), 2).alias("t")).collect()}
    for i, d in enumerate(DOCS):
        tok = py_tokens(d)
        assert got[i] == tok + [f"{a} {b}" for a, b in zip(tok, tok[1:])], d


def test_char_wb_ngrams(spark):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(DOCS)], "id int, text string")
    got = {r["id"]: r["t"] for r in df.select("id", D.char_wb_ngrams(F.col("text")).alias("t")).collect()}
    for i, d in enumerate(DOCS):
        assert got[i] == char_wb(d), d


def test_tfidf_matches_formula(spark):
    docs = ["a b a", "b c", "c c c d", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, text string")
    terms = D.word_tokens(F.col("text"))
    fitted = D.fit_vocab(df, "id", terms, min_df=1, max_features=3)
    w = {(r["id"], r["term"]): r["weight"] for r in D.transform_frozen(df, "id", terms, fitted).collect()}
    # top-3 by corpus count, ties by term: c(4), a(2), b(2); d(1) dropped
    tf = [Counter(d.split()) for d in docs]
    dfreq = Counter(t for c in tf for t in c)
    vocab = ["c", "a", "b"]
    for i, c in enumerate(tf):
        raw = {t: (1 + math.log(c[t])) * (math.log((1 + len(docs)) / (1 + dfreq[t])) + 1) for t in vocab if c[t]}
        norm = math.sqrt(sum(v * v for v in raw.values())) if raw else 1
        for t, v in raw.items():
            assert math.isclose(w[(i, t)], v / norm, rel_tol=1e-12)
    assert not any(k[1] == "d" for k in w)


def test_mean_pool_and_l2(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0], 1.0), (1, [1.0, 0.0], 0.0), (2, [0.0, 0.0], 1.0)],
                               "g int, embedding array<double>, m double")
    pooled = {r["g"]: r["pooled"] for r in D.mean_pool(df, "g", mask=F.col("m")).collect()}
    assert pooled[1] == [3.0, 4.0] and pooled[2] == [0.0, 0.0]
    n = df.select(D.l2_norm(D.l2_normalise(F.col("embedding"))).alias("n")).collect()
    assert abs(n[0]["n"] - 1) < 1e-12 and n[2]["n"] == 0.0
