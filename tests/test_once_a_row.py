"""Steps that must do their work once a row, and tables that must grow in files, not in file size."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from jobsheet.config import part_catalog
from jobsheet.operators import labels as L
from jobsheet.operators import positions as P
from jobsheet.operators import text as D
from jobsheet.sources import json_orders as A

CFG = part_catalog()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def word_terms(text):
    return D.word_ngrams(D.word_tokens(text), 2)


def test_word_ngrams_tokenise_a_text_once(spark):
    df = spark.createDataFrame([("a b c",), (None,), ("x",)], "text string").select(word_terms(F.col("text")).alias("t"))
    assert optimized(df).count("regexp_extract_all") == 1
    assert [r.t for r in df.collect()] == [["a", "b", "c", "a b", "b c"], None, ["x"]]


def test_term_counts_keep_a_document_in_one_row(spark):
    rows = [(1, "b a b"), (1, "b a b"), (1, "b c"), (2, "a"), (None, "a c"), (None, "c"), (3, ""), (4, None)]
    docs = spark.createDataFrame(rows, "id long, text string")
    counted = D.term_counts(docs, "id", word_terms)
    assert sorted(str(r.id) for r in counted.collect()) == ["1", "2", "3", "4", "None"]
    df, ctf = defaultdict(set), Counter()
    for i, t in rows:
        w = (t or "").split()
        for term in w + [" ".join(p) for p in zip(w, w[1:])]:
            df[term].add(i)
            ctf[term] += 1
    got = {r.term: (r.df, r.ctf) for r in D.term_stats(counted, "id").collect()}
    assert got == {t: (len(df[t]), ctf[t]) for t in ctf}


def test_vocabulary_fit_tokenises_a_text_once(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a")], "id long, text string")
    for plan in (optimized(D.corpus_terms(docs, word_terms(F.col("text")))), optimized(D.term_stats(D.term_counts(docs, "id", word_terms), "id"))):
        assert plan.count("regexp_extract_all") == 1


def test_requests_and_orders_are_parsed_once(spark, tmp_path):
    raw = spark.createDataFrame([('{"make": "x", "calculated_positions": [{"text": "a", "total_time": "1"}]}',), ("{",), (None,)], "value string")
    ok, bad = A.split_quarantine(A.validate_requests(A.parse_requests(raw)))
    assert optimized(A.adapt_requests(ok).select("make", F.explode("positions"))).count("from_json") == 1
    assert (ok.count(), bad.count()) == (1, 2)
    spark.createDataFrame([('{"order_id": 1}',), ("{",)], "value string").write.text(str(tmp_path / "o"))
    orders = A.read_orders(spark, str(tmp_path / "o"))
    assert optimized(orders.where("valid")).count("from_json") == 1
    assert [r.order_id for r in orders.where("valid").collect()] == [1] and orders.where("not valid").count() == 1


def test_nested_features_clean_the_positions_once(spark):
    docs = spark.createDataFrame([(1, [("a", "1", "2", None)])],
                                 "order_id long, positions array<struct<text:string,totalPrice:string,totalTime:string,genericCostCenter:string>>")
    assert optimized(P.nested_order_features(docs, CFG)).count("regexp_replace") == 1


def test_pivot_is_one_aggregation(spark):
    t = CFG.targets
    rows = [(1, t[0], 1.0), (1, t[1], 2.0), (2, t[1], None), (2, "other", 9.0), (None, t[0], 3.0)]
    got = L.pivot_targets(spark.createDataFrame(rows, "order_id long, target string, hours double"), t)
    assert optimized(got).count("Aggregate") == 1
    assert sorted((str(r.order_id), r[t[0]], r[t[1]]) for r in got.collect()) == [("1", 1.0, 2.0), ("2", 0.0, 0.0), ("None", 3.0, 0.0)]


def test_order_documents_grow_in_files(spark, tmp_path, monkeypatch):
    from jobsheet.plans import q_stream as Q
    n = 60
    one = spark.range(1)
    part = one.selectExpr("1L AS p_partkey", "'nut' AS p_name", "'SMALL' AS p_type", "'B' AS p_brand")
    part.write.parquet(f"{tmp_path}/part.parquet")
    one.selectExpr("1L AS c_custkey", "'auto' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1, n + 1).selectExpr("id AS o_orderkey", "1L AS o_custkey", "timestamp_ntz'2020-01-01 00:00:00' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1, n + 1).selectExpr("id AS l_orderkey", "1L AS l_partkey", "1L AS l_suppkey", "1 AS l_linenumber", "2.0D AS l_quantity",
                                     "3.0D AS l_extendedprice", "'R' AS l_returnflag").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(Q, "FILE_DOCUMENTS", 4, raising=False)
    path = Q.order_files(spark, str(tmp_path))
    files = spark.read.text(path).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == n and max(r["count"] for r in files) <= 4
