"""Text vectorisation queries (D1-D10) and their SQL oracles.

Corpus: the order texts of the order view (B4) and, for the Unicode
tokeniser, the whole multilingual ``documents`` texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsheet.config import part_catalog
from jobsheet.operators import text as D
from jobsheet.plans import sqlbase as S
from jobsheet.plans.q_eval import SPLIT, splits_frame
from jobsheet.plans.q_orders import features_frame, texts_frame
from jobsheet.plans.q_profile import ROLL
from jobsheet.plans.registry import query, round_doubles
from jobsheet.sources.sinks import kept
from jobsheet.sources.tables import table

CFG = part_catalog()
r = S.r
WORD_MIN_DF, WORD_MAX = 2, 2000
CHAR_MIN_DF, CHAR_MAX = 3, 1000

# RE2 restatement of (?U)\b[\w\+]+\b: maximal runs of word chars and '+',
# '+' trimmed at both ends, empties dropped.
SQL_TOKENS = ("list_filter(list_transform(regexp_extract_all(lower({t}), '[\\p{{L}}\\p{{N}}_+]+'), "
              "lambda x: trim(x, '+')), lambda x: x <> '')")


def docs_frame(spark, sf):
    return texts_frame(spark, sf).select("order_id", F.col("order_text").alias("text"))


def word_terms(text=None):
    return D.word_ngrams(D.word_tokens(F.col("text") if text is None else text), 2)


def char_terms(text=None):
    return D.char_wb_ngrams(F.col("text") if text is None else text)


def word_grams():
    return D.word_grams(F.col("text"), 2)


def char_grams():
    return D.char_grams(F.col("text"))


def _docs_sql():
    return S.with_(S.POS_RAW, S.HDR, S.pos_clean(CFG), S.order_aggs(CFG), S.features(CFG)) + \
        ",\ndocs AS (SELECT order_id, order_text AS text FROM feat)"


WORD_TERMS = f"""
tok AS (SELECT order_id, {SQL_TOKENS.format(t='text')} AS t FROM docs),
terms AS (SELECT order_id, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM tok),
tc AS (SELECT order_id, term, count(*) AS tf FROM terms GROUP BY order_id, term)"""

CHAR_TERMS = """
wds AS (SELECT order_id, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) AS wd FROM docs),
pw AS (SELECT order_id, ' ' || wd || ' ' AS w, length(' ' || wd || ' ') AS L FROM wds),
cg AS (SELECT order_id, w, L, n,
              unnest(CASE WHEN L > n THEN generate_series(1, L - n + 1) WHEN L = n THEN [1] ELSE [] END) AS i
       FROM pw, range(3, 6) t(n)),
ctc AS (SELECT order_id, substring(w, i, n) AS term, count(*) AS tf FROM cg GROUP BY order_id, substring(w, i, n))"""


def _vocab_sql(tc: str, name: str, min_df: int, max_features: int) -> str:
    return f"""
{name}_st AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM {tc} GROUP BY term),
{name} AS (SELECT term, df, ctf, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM
           (SELECT * FROM {name}_st WHERE df >= {min_df} ORDER BY ctf DESC, term LIMIT {max_features}))"""


def _tfidf_sql(tc: str, voc: str, ndocs: str, out: str) -> str:
    return f"""
{out}_w AS (SELECT x.order_id, x.term, v.idx,
                   (1 + ln(x.tf)) * (ln((1 + ({ndocs})) / (1 + v.df)) + 1) AS w
            FROM {tc} x JOIN {voc} v ON x.term = v.term),
{out} AS (SELECT w.order_id, w.term, w.idx, w.w / n.nr AS weight FROM {out}_w w
          JOIN (SELECT order_id, sqrt(sum(w * w)) AS nr FROM {out}_w GROUP BY order_id) n ON w.order_id = n.order_id)"""


# ---------------------------------------------------------------- D1
@query("word_tokenize", lambda: f"""
WITH t AS (SELECT doc_id, {SQL_TOKENS.format(t='text')} AS tok FROM documents)
SELECT doc_id, CAST(len(tok) AS INTEGER) AS n_tokens, CAST(len(list_distinct(tok)) AS INTEGER) AS n_distinct,
       CAST(list_sum(list_transform(tok, lambda x: length(x))) AS BIGINT) AS token_chars FROM t""", "D")
def q_word_tokenize(spark, sf):
    """D1 on the whole multilingual documents (umlauts, accents, a+e)."""
    d = table(spark, sf, "documents").select("doc_id", D.word_tokens(F.col("text")).alias("tok"))
    return d.select("doc_id", F.size("tok").alias("n_tokens"), F.size(F.array_distinct("tok")).alias("n_distinct"),
                    F.coalesce(F.aggregate("tok", F.lit(0).cast("long"), lambda a, x: a + F.length(x)),
                               F.lit(0).cast("long")).alias("token_chars"))


# ---------------------------------------------------------------- D2 / D3
@query("word_ngrams", lambda: _docs_sql() + "," + WORD_TERMS + """
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM tc GROUP BY term""", "D")
def q_word_ngrams(spark, sf):
    """Word 1-2-grams with document and corpus frequency."""
    return D.term_stats(D.term_counts(docs_frame(spark, sf), "order_id", word_terms), "order_id")


@query("char_wb_ngrams", lambda: _docs_sql() + "," + CHAR_TERMS + """
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM ctc GROUP BY term""", "D")
def q_char_wb_ngrams(spark, sf):
    """D3: padded in-word character 3-5-grams with frequencies."""
    return D.term_stats(D.term_counts(docs_frame(spark, sf), "order_id", char_terms), "order_id")


# ---------------------------------------------------------------- D4
@query("vocab_select", lambda: _docs_sql() + "," + WORD_TERMS + "," + CHAR_TERMS + "," +
       _vocab_sql("tc", "wv", WORD_MIN_DF, WORD_MAX) + "," + _vocab_sql("ctc", "cv", CHAR_MIN_DF, CHAR_MAX) + """
SELECT 'word' AS kind, term, idx, df, ctf FROM wv UNION ALL SELECT 'char', term, idx, df, ctf FROM cv""", "D")
def q_vocab_select(spark, sf):
    """min_df filter then top max_features by corpus count (ties by term)."""
    docs = docs_frame(spark, sf)
    wv = D.vocab_select(D.term_counts(docs, "order_id", word_terms), "order_id", WORD_MIN_DF, WORD_MAX)
    cv = D.vocab_select(D.term_counts(docs, "order_id", char_terms), "order_id", CHAR_MIN_DF, CHAR_MAX)
    cols = ["kind", "term", "idx", "df", "ctf"]
    return wv.withColumn("kind", F.lit("word")).select(cols).unionByName(
        cv.withColumn("kind", F.lit("char")).select(cols))


# ---------------------------------------------------------------- D5
@query("tfidf_weights", lambda: _docs_sql() + "," + WORD_TERMS + "," + _vocab_sql("tc", "wv", WORD_MIN_DF, WORD_MAX)
       + "," + _tfidf_sql("tc", "wv", "SELECT count(*) FROM docs", "tw1") + f"""
SELECT order_id, term, idx, {r('weight')} AS weight FROM tw1""", "D")
def q_tfidf_weights(spark, sf):
    """Sublinear-tf, smoothed-idf, L2-normalised word TF-IDF per order."""
    docs = docs_frame(spark, sf)
    fitted = D.fit_vocab(docs, "order_id", word_grams(), WORD_MIN_DF, WORD_MAX)
    return round_doubles(D.transform_frozen(docs, "order_id", word_grams(), fitted))


@query("tfidf_char_norms", lambda: _docs_sql() + "," + CHAR_TERMS + "," + _vocab_sql("ctc", "cv", CHAR_MIN_DF, CHAR_MAX)
       + "," + _tfidf_sql("ctc", "cv", "SELECT count(*) FROM docs", "tc1") + f"""
SELECT order_id, count(*) AS n_terms, {r('sum(weight)')} AS sum_w, {r('sum(weight * weight)')} AS sum_w2,
       {r('max(weight)')} AS max_w FROM tc1 GROUP BY order_id""", "D")
def q_tfidf_char_norms(spark, sf):
    """D5 on character n-grams, summarised per order (unit norm check)."""
    docs = docs_frame(spark, sf)
    fitted = D.fit_vocab(docs, "order_id", char_grams(), CHAR_MIN_DF, CHAR_MAX)
    w = D.transform_frozen(docs, "order_id", char_grams(), fitted)
    return round_doubles(w.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("weight").alias("sum_w"),
        F.sum(F.col("weight") * F.col("weight")).alias("sum_w2"), F.max("weight").alias("max_w")))


# ---------------------------------------------------------------- D10
@query("frozen_vectoriser_transform", lambda: S.with_(
        S.POS_RAW, S.HDR, S.pos_clean(CFG), S.order_aggs(CFG), S.features(CFG),
        S.targets_wide(CFG), ROLL, SPLIT) + """,
alld AS (SELECT f.order_id, f.order_text AS text, s.split FROM feat f JOIN split s ON f.order_id = s.order_id),
docs AS (SELECT order_id, text FROM alld WHERE split = 'train'),""" + WORD_TERMS + "," +
       _vocab_sql("tc", "wv", WORD_MIN_DF, WORD_MAX) + """,
tdocs AS (SELECT order_id, text FROM alld WHERE split = 'test'),
ttok AS (SELECT order_id, """ + SQL_TOKENS.format(t='text') + """ AS t FROM tdocs),
tterms AS (SELECT order_id, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM ttok),
ttc AS (SELECT order_id, term, count(*) AS tf FROM tterms GROUP BY order_id, term),""" +
       _tfidf_sql("ttc", "wv", "SELECT count(*) FROM docs", "fz") + f"""
SELECT order_id, term, idx, {r('weight')} AS weight FROM fz""", "D")
def q_frozen_vectoriser_transform(spark, sf):
    """Vocabulary and idf fitted on train orders, applied to test orders."""
    docs = docs_frame(spark, sf).join(splits_frame(spark, sf).select("order_id", "split"), "order_id")
    fitted = D.fit_vocab(docs.where(F.col("split") == "train"), "order_id", word_grams(), WORD_MIN_DF, WORD_MAX)
    return round_doubles(D.transform_frozen(docs.where(F.col("split") == "test"), "order_id", word_grams(), fitted))


# ---------------------------------------------------------------- D6
def _assemble_sql():
    from jobsheet.operators import positions as P
    num = [f"SELECT order_id, (SELECT count(*) FROM wv) + (SELECT count(*) FROM cv) + {k} AS idx, {c}::DOUBLE AS val FROM feat WHERE {c} <> 0"
           for k, c in enumerate(P.feature_columns(CFG))]
    return _docs_sql() + "," + WORD_TERMS + "," + CHAR_TERMS + "," + _vocab_sql("tc", "wv", WORD_MIN_DF, WORD_MAX) + "," + \
        _vocab_sql("ctc", "cv", CHAR_MIN_DF, CHAR_MAX) + "," + _tfidf_sql("tc", "wv", "SELECT count(*) FROM docs", "tw1") + "," + \
        _tfidf_sql("ctc", "cv", "SELECT count(*) FROM docs", "tc1") + f""",
ent AS (SELECT order_id, idx, weight AS val FROM tw1 UNION ALL
        SELECT order_id, (SELECT count(*) FROM wv) + idx, weight FROM tc1 UNION ALL {" UNION ALL ".join(num)})
SELECT f.order_id, coalesce(list(CAST(e.idx AS INTEGER) ORDER BY e.idx) FILTER (WHERE e.idx IS NOT NULL), []) AS idx,
       coalesce(list({r('e.val')} ORDER BY e.idx) FILTER (WHERE e.idx IS NOT NULL), []) AS val
FROM feat f LEFT JOIN ent e ON f.order_id = e.order_id GROUP BY f.order_id"""


@query("assemble_features", _assemble_sql, "D")
def q_assemble_features(spark, sf):
    """[word TF-IDF || char TF-IDF || numeric] as one sparse row per order."""
    from jobsheet.functions.stats import rnd
    from jobsheet.operators import positions as P
    docs = kept(docs_frame(spark, sf), "order-texts")  # read by both fits
    word = D.Vocabulary.of(D.fit_vocab(docs, "order_id", word_grams(), WORD_MIN_DF, WORD_MAX))
    char = D.Vocabulary.of(D.fit_vocab(docs, "order_id", char_grams(), CHAR_MIN_DF, CHAR_MAX))
    rows = features_frame(spark, sf).withColumn("text", F.col("order_text"))
    v = D.vectorise(rows, ["order_id"], [(word_grams(), word), (char_grams(), char)], [F.col(c) for c in P.feature_columns(CFG)])
    return v.select("order_id", "idx", F.transform("val", lambda x: rnd(x, 6)).alias("val"))


# ---------------------------------------------------------------- D7
def _assemble_embedding_sql():
    return f"""
SELECT vec_id, list_transform(embedding, lambda x: {r('x::DOUBLE')}) || [{r('sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)))')},
       {r('list_min(embedding)::DOUBLE')}, {r('list_max(embedding)::DOUBLE')}, {r('list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / len(embedding)')}] AS features,
       label::DOUBLE AS label_num FROM embeddings"""


@query("assemble_embedding_features", _assemble_embedding_sql, "D")
def q_assemble_embedding_features(spark, sf):
    """Dense embedding || numeric columns (norm, least, largest and mean component) as one vector."""
    from jobsheet.functions.stats import rnd
    x = F.transform("embedding", lambda c: c.cast("double"))
    mean = F.aggregate(x, F.lit(0.0), lambda a, c: a + c) / F.size(x)
    num = F.array(D.l2_norm(F.col("embedding")), F.array_min(x), F.array_max(x), mean)
    return table(spark, sf, "embeddings").select("vec_id", F.transform(F.concat(x, num), lambda c: rnd(c, 6)).alias("features"),
                                                 F.col("label").cast("double").alias("label_num"))


# ---------------------------------------------------------------- D8 / D9
@query("mean_pool", lambda: f"""
WITH ex AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(0, len(embedding))) AS dim FROM embeddings),
pd AS (SELECT label, dim, sum(v * 1.0) / greatest(count(*) * 1.0, 1e-9::DOUBLE) AS v FROM ex GROUP BY label, dim)
SELECT label, list({r('v')} ORDER BY dim) AS pooled FROM pd GROUP BY label""", "D")
def q_mean_pool(spark, sf):
    """Masked mean pooling of the 64-d vectors per label group."""
    from jobsheet.functions.stats import rnd
    p = D.mean_pool(table(spark, sf, "embeddings"), "label")
    return p.select("label", F.transform("pooled", lambda x: rnd(x, 6)).alias("pooled"))


@query("l2_normalise", lambda: f"""
WITH n AS (SELECT vec_id, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm,
                  embedding FROM embeddings)
SELECT vec_id, {r('norm')} AS norm_before,
       {r('sqrt(list_sum(list_transform(embedding, lambda x: (x::DOUBLE / greatest(norm, 1e-10::DOUBLE)) * (x::DOUBLE / greatest(norm, 1e-10::DOUBLE)))))')} AS norm_after,
       abs(norm - 1) <= 1e-4 AS unit_norm FROM n""", "D")
def q_l2_normalise(spark, sf):
    """Norms before / after L2 normalisation and the unit-norm check."""
    e = table(spark, sf, "embeddings")
    d = e.select("vec_id", D.l2_norm(F.col("embedding")).alias("norm"),
                 D.l2_normalise(F.col("embedding")).alias("unit"))
    return round_doubles(d.select("vec_id", F.col("norm").alias("norm_before"),
                                  D.l2_norm(F.col("unit")).alias("norm_after"),
                                  (F.abs(F.col("norm") - 1) <= 1e-4).alias("unit_norm")))
