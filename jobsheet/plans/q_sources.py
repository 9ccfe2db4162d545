"""Source / sink queries (A1-A5, A8, A10-A12) and lookup-join queries (I*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from jobsheet.config import part_catalog
from jobsheet.functions import cleaning as C
from jobsheet.operators import positions as P
from jobsheet.plans import sqlbase as S
from jobsheet.plans.q_eval import SPLIT as SPLIT_
from jobsheet.plans.q_eval import full_eval_with, q_macro_fw_metrics, q_split_metrics_table
from jobsheet.plans.q_profile import ROLL as ROLL_
from jobsheet.plans.registry import query, round_doubles
from jobsheet.sources import json_orders as A
from jobsheet.sources import order_view as V
from jobsheet.sources import sinks as K
from jobsheet.sources.tables import table

CFG = part_catalog()
r, big, q = S.r, S.big, S.q


def _sfname(sf: str) -> str:
    return sf.rstrip("/").split("/")[-1].replace(".", "_")


def orders_json(spark, sf):
    """Write the order documents once per call under the shared folder and
    read them back with the explicit schema."""
    from jobsheet.plans.q_stream import order_files
    return A.read_orders(spark, order_files(spark, sf))


NP = """
np AS (SELECT order_id, count(*) AS n FROM pos_raw GROUP BY order_id),
docs AS (SELECT h.order_id, h.make, coalesce(np.n, 0) AS n FROM hdr h LEFT JOIN np ON h.order_id = np.order_id)"""


@query("scan_orders_json", lambda: S.with_(S.POS_RAW, S.HDR, NP) + """
SELECT order_id, make, CAST(CASE WHEN order_id % 103 = 0 THEN NULL ELSE n END AS INTEGER) AS n_positions,
       CAST(CASE WHEN order_id % 101 = 0 THEN NULL ELSE 6 END AS INTEGER) AS n_output
FROM docs WHERE order_id % 107 <> 0""", "A")
def q_scan_orders_json(spark, sf):
    """A1: JSON order documents read schema-first (corrupt lines set aside)."""
    o = orders_json(spark, sf).where(F.col("valid"))
    lst, out = F.col("input.calculatedPositions"), F.col("output")
    return o.select("order_id", F.col("input.make").alias("make"),
                    F.when(lst.isNull(), F.lit(None)).otherwise(F.size(lst)).alias("n_positions"),
                    F.when(out.isNull(), F.lit(None)).otherwise(F.size(out)).alias("n_output"))


@query("filter_valid_orders", lambda: S.with_(S.POS_RAW, S.HDR, NP, S.targets_wide(CFG)) + f"""
SELECT d.order_id, CAST(d.n AS INTEGER) AS n_positions, {r(' + '.join('tw.' + t for t in CFG.targets))} AS total_hours
FROM docs d JOIN tw ON d.order_id = tw.order_id
WHERE d.order_id % 107 <> 0 AND d.order_id % 101 <> 0 AND d.order_id % 103 <> 0""", "A")
def q_filter_valid_orders(spark, sf):
    """A2: orders with input, output and a position list."""
    v = A.filter_valid(orders_json(spark, sf))
    total = sum(F.col("output")[t] for t in CFG.targets)
    return round_doubles(v.select("order_id", F.size("input.calculatedPositions").alias("n_positions"),
                                  total.alias("total_hours")))


@query("schema_completeness", lambda: S.with_(S.HDR) + f"""
SELECT count(*) AS total, {big('count_if(order_id % 107 = 0)')} AS corrupt, 0::BIGINT AS missing_input,
       {big('count_if(order_id % 107 <> 0 AND order_id % 101 = 0)')} AS missing_output,
       {big('count_if(order_id % 107 <> 0 AND order_id % 103 = 0)')} AS missing_positions,
       {big('count_if(order_id % 107 <> 0 AND make IS NULL)')} AS missing_make,
       {big('count_if(order_id % 107 = 0 OR order_id % 101 = 0 OR order_id % 103 = 0)')} AS skipped,
       {', '.join(f'0::BIGINT AS missing_{t}' for t in CFG.targets)}
FROM hdr""", "A")
def q_schema_completeness(spark, sf):
    """A3: completeness counts of the raw documents."""
    return A.schema_completeness(orders_json(spark, sf), CFG.targets)


def requests_frame(spark, sf):
    raw = K.request_documents(V.positions(spark, sf), V.headers(spark, sf))
    return A.validate_requests(A.parse_requests(raw))


def _req_sql():
    return S.with_(S.POS_RAW, S.HDR, NP) + """
, bad AS (SELECT DISTINCT order_id FROM pos_raw WHERE part_key % 31 = 0),
rq AS (SELECT d.order_id, d.n, b.order_id IS NOT NULL AS has_bad FROM docs d LEFT JOIN bad b ON d.order_id = b.order_id),
ev AS (SELECT order_id, list_filter([
          CASE WHEN order_id % 13 = 0 THEN 'calculated_positions:field required' END,
          CASE WHEN order_id % 13 <> 0 AND n = 0 THEN 'calculated_positions:at least 1 item required' END,
          CASE WHEN order_id % 13 <> 0 AND has_bad THEN 'total_price:not a number' END], lambda x: x IS NOT NULL) AS errors
       FROM rq)"""


@query("validate_requests", lambda: _req_sql() + """
SELECT order_id, len(errors) = 0 AS accepted, errors FROM ev""", "A")
def q_validate_requests(spark, sf):
    """A4: request contract verdicts; failures listed as field:issue."""
    v = requests_frame(spark, sf)
    return v.select("order_id", (F.size("errors") == 0).alias("accepted"),
                    F.transform("errors", lambda e: F.concat(e["field"], F.lit(":"), e["issue"])).alias("errors"))


@query("adapt_request_names", lambda: _req_sql() + f"""
, acc AS (SELECT order_id FROM ev WHERE len(errors) = 0)
SELECT p.order_id, {S.clean_make('h.make')} AS make, count(*) AS n_positions,
       {r('sum(greatest(0.0, p.total_time))')} AS total_time, {r('sum(greatest(0.0, p.total_price))')} AS total_price,
       {big("count_if(p.cost_center IS NULL OR " + S.strip('p.cost_center') + " = '')")} AS n_unknown_cc
FROM pos_raw p JOIN acc ON p.order_id = acc.order_id JOIN hdr h ON h.order_id = p.order_id
GROUP BY p.order_id, h.make""", "A")
def q_adapt_request_names(spark, sf):
    """A5: accepted requests mapped to pipeline names with API coercion."""
    ok, _ = A.split_quarantine(requests_frame(spark, sf))
    a = A.adapt_requests(ok, CFG.unknown_cc)
    p = a.select("order_id", "make", F.explode("positions").alias("p"))
    return round_doubles(p.groupBy("order_id", "make").agg(
        F.count(F.lit(1)).alias("n_positions"), F.sum("p.totalTime").alias("total_time"),
        F.sum("p.totalPrice").alias("total_price"),
        F.count_if(F.col("p.genericCostCenter") == CFG.unknown_cc).alias("n_unknown_cc")))


@query("sample_records", lambda: """
SELECT o_orderkey AS order_id FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '42') LIMIT 30""", "A")
def q_sample_records(spark, sf):
    """min(n, N) orders without replacement, seed 42 (the limit is the
    sampling operator itself)."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"))
    return o.orderBy(F.md5(F.concat(F.col("order_id").cast("string"), F.lit("42")))).limit(30)


@query("lookup_record", lambda: """
WITH o AS (SELECT o_orderkey AS order_id, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders)
SELECT i.index, o.pos AS position, o.order_id FROM (VALUES (0), (7), (1000003), (-1)) i(index) JOIN o ON o.pos = ((i.index % o.n) + o.n) % o.n""", "A")
def q_lookup_record(spark, sf):
    """The record at ``index % N`` in key order, for any index."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"))
    return A.records_at(o, "order_id", [0, 7, 1000003, -1])


def _wrap_sql(name: str, extra: str = "") -> str:
    from jobsheet.plans.registry import REGISTRY
    return f"SELECT *{extra} FROM ({REGISTRY[name].sql()})"


@query("write_metrics", lambda: _wrap_sql("macro_fw_metrics", ", 'challenger' AS slot, 'v2' AS model_version"), "A")
def q_write_metrics(spark, sf):
    """A10: metrics written partitioned by (slot, model_version), read back."""
    path = K.shared_path(spark, "metrics", _sfname(sf))
    K.write_metrics(q_macro_fw_metrics(spark, sf), path, "challenger", "v2")
    m = K.read_metrics(spark, path)
    return m.where((F.col("slot") == "challenger") & (F.col("model_version") == "v2"))


@query("write_model_info", lambda: f"""
SELECT 'model_info' AS artifact, 'v2' AS model_version, {len(CFG.targets)}::BIGINT AS n_targets, strftime(max(o_orderdate), '%Y-%m-%d') AS trained_on,
       [{', '.join(S.q(t) for t in CFG.targets)}] AS targets,
       ['tfidf_word_ngrams', 'tfidf_char_ngrams', 'numeric_aggregates', 'keyword_flags', 'make_encoding'] AS feature_groups FROM orders""", "A")
def q_write_model_info(spark, sf):
    """A10: the model info record written beside a bundle and read back."""
    path = K.shared_path(spark, "model-info", uuid.uuid4().hex)
    trained = table(spark, sf, "orders").select(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd")).first()[0]
    K.write_model_info(spark, path, CFG.targets, "v2", trained)
    return spark.read.json(path).select("artifact", "model_version", "n_targets", "trained_on", "targets", "feature_groups")


@query("read_embeddings", lambda: """
SELECT (SELECT count(*) FROM embeddings) AS n_embeddings,
       (SELECT count(*) FROM embeddings e JOIN orders o ON e.vec_id = o.o_orderkey) AS n_matched,
       (SELECT count(*) FROM embeddings e ANTI JOIN orders o ON e.vec_id = o.o_orderkey) AS n_without_order,
       (SELECT count(*) FROM orders o ANTI JOIN embeddings e ON e.vec_id = o.o_orderkey) AS n_without_embedding,
       (SELECT count(*) FROM embeddings WHERE len(embedding) <> 64) AS n_bad_dim""", "A")
def q_read_embeddings(spark, sf):
    """Embeddings aligned by id (never by row position); both
    anti-joins report what does not line up."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("vec_id"))
    parts = [e.select(F.count(F.lit(1)).alias("v")), e.join(o, "vec_id").select(F.count(F.lit(1)).alias("v")),
             e.join(o, "vec_id", "left_anti").select(F.count(F.lit(1)).alias("v")),
             o.join(e, "vec_id", "left_anti").select(F.count(F.lit(1)).alias("v")),
             e.where(F.size("embedding") != 64).select(F.count(F.lit(1)).alias("v"))]
    names = ["n_embeddings", "n_matched", "n_without_order", "n_without_embedding", "n_bad_dim"]
    return spark.range(1).select(*[p.scalar().alias(n) for p, n in zip(parts, names)])


@query("write_metric_csv", lambda: _wrap_sql("split_metrics_table"), "A")
def q_write_metric_csv(spark, sf):
    """The val and test metric tables unioned and written as CSV."""
    m = K.kept(q_split_metrics_table(spark, sf), "split-metrics")  # a row per split and target, read twice
    path = K.shared_path(spark, "metric_csv", _sfname(sf))
    K.write_metric_csv([m.where(F.col("split") == "val"), m.where(F.col("split") == "test")], path)
    return K.read_metric_csv(spark, path, "split string, target string, threshold double, precision double, "
                                          "recall double, accuracy double")


# ====================================================================== I (joins)
@query("lookup_join", lambda: S.with_(S.HDR, S.targets_wide(CFG), ROLL_, SPLIT_) + f"""
, trm AS (SELECT {S.clean_make('h.make')} AS make_clean, count(*) AS freq
          FROM hdr h JOIN split s ON h.order_id = s.order_id WHERE s.split = 'train' GROUP BY 1)
SELECT h.order_id, {S.clean_make('h.make')} AS make, coalesce(t.freq, 1) AS make_freq
FROM hdr h LEFT JOIN trm t ON {S.clean_make('h.make')} = t.make_clean""", "I")
def q_lookup_join(spark, sf):
    """Make frequency fitted on the training split, looked up for
    every order with default 1 for unseen makes."""
    from jobsheet.plans.q_eval import splits_frame
    h = V.headers(spark, sf)
    train = h.join(splits_frame(spark, sf).where(F.col("split") == "train").select("order_id"), "order_id")
    mf = P.make_frequency(train).withColumnRenamed("make_freq", "freq")
    j = h.select("order_id", C.clean_make(F.col("make")).alias("make")).join(
        mf, F.col("make") == F.col("make_clean"), "left")
    return j.select("order_id", "make", F.coalesce(F.col("freq"), F.lit(1)).alias("make_freq"))


@query("semi_join_topk", lambda: S.with_(S.HDR) + """
, top AS (SELECT make FROM hdr WHERE make IS NOT NULL GROUP BY make ORDER BY count(*) DESC, make LIMIT 3)
SELECT order_id, make FROM hdr WHERE make IN (SELECT make FROM top)""", "I")
def q_semi_join_topk(spark, sf):
    """Orders whose make is among the three most frequent."""
    h = V.headers(spark, sf)
    top = h.where(F.col("make").isNotNull()).groupBy("make").count() \
        .orderBy(F.desc("count"), "make").limit(3).select("make")
    return h.join(top, "make", "left_semi").select("order_id", "make")


@query("anti_join_missing", lambda: """
SELECT o_orderkey AS order_id FROM orders o ANTI JOIN lineitem l ON o.o_orderkey = l.l_orderkey""", "I")
def q_anti_join_missing(spark, sf):
    """Orders that have no positions at all."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    return o.join(li, "order_id", "left_anti")


@query("inner_join_align", lambda: S.with_(S.POS_RAW, S.targets_wide(CFG), S.targets_long(CFG)) + f"""
, ci AS (SELECT order_id, sum(total_time) AS input_time FROM pos_raw WHERE cost_center = {q(CFG.paint_cc)} GROUP BY order_id)
SELECT ci.order_id, {r('ci.input_time')} AS input_time, {r('tl.hours')} AS hours
FROM ci JOIN tl ON ci.order_id = tl.order_id
WHERE tl.target = {q(CFG.paint_cc)} AND ci.input_time > 0 AND tl.hours > 0""", "I")
def q_inner_join_align(spark, sf):
    """Input time and output hours aligned on the order id (inner join),
    then both > 0."""
    from jobsheet.operators import profile as K2
    ci = K2.cc_input_time(V.positions(spark, sf)).where(F.col("cost_center") == CFG.paint_cc).drop("cost_center")
    tl = V.targets_long(spark, sf, CFG).where(F.col("target") == CFG.paint_cc)
    j = ci.join(tl, "order_id").where((F.col("input_time") > 0) & (F.col("hours") > 0))
    return round_doubles(j.select("order_id", "input_time", "hours"))


@query("union_tables", lambda: full_eval_with() + f"""
SELECT 'val' AS split, target, model, {r('threshold')} AS threshold FROM best
UNION ALL SELECT 'chosen', target, model, {r('threshold')} FROM chosen""", "I")
def q_union_tables(spark, sf):
    """Two result tables stacked by name with a tag column."""
    from jobsheet.plans.q_eval import best_thresholds, chosen, scores_long
    scores = scores_long(spark, sf)
    a = best_thresholds(spark, sf, scores).select(F.lit("val").alias("split"), "target", "model", "threshold")
    b = chosen(spark, sf, scores).select(F.lit("chosen").alias("split"), "target", "model", "threshold")
    return round_doubles(a.unionByName(b))


@query("left_join_index", lambda: S.with_(S.HDR, S.targets_wide(CFG)) + """
SELECT h.order_id, h.make, """ + ", ".join(f"tw.{t}" for t in CFG.targets) + """
FROM hdr h LEFT JOIN tw ON h.order_id = tw.order_id""", "I")
def q_left_join_index(spark, sf):
    """Order make joined with its targets (left join on the order id)."""
    return V.headers(spark, sf).select("order_id", "make").join(V.targets_wide(spark, sf, CFG), "order_id", "left")


def _sort_report_sql():
    from jobsheet.plans.registry import REGISTRY
    return f"""SELECT target, f1, mae, CAST(row_number() OVER (ORDER BY f1 DESC, target) AS INTEGER) AS rank
FROM ({REGISTRY['rule_scores_per_target'].sql()})"""


@query("sort_report", _sort_report_sql, "I")
def q_sort_report(spark, sf):
    """The per-target rule report sorted by F1 (rank made explicit; a
    single small partition - one row per target)."""
    from pyspark.sql import Window
    from jobsheet.plans.q_profile import q_rule_scores_per_target
    s = q_rule_scores_per_target(spark, sf).select("target", "f1", "mae")
    return s.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("f1"), "target")))


@query("gen_synthetic_orders", None, "A")
def q_gen_synthetic_orders(spark, sf):
    """One synthetic order document per ``orders`` key (the generator's
    distributional contract), summarised per order."""
    from jobsheet.sources.synthetic import synthetic_orders
    keys = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"))
    d = synthetic_orders(keys)
    vals = F.map_values("output")
    return d.select("order_id", F.col("input.make").alias("make"),
                    F.size("input.calculatedPositions").alias("n_positions"),
                    F.size(F.filter(vals, lambda v: v > 0)).alias("n_active"),
                    F.aggregate(vals, F.lit(0.0), lambda a, v: a + v).alias("total_hours"))


@query("gen_monitor_batch", None, "A")
def q_gen_monitor_batch(spark, sf):
    """One monitoring request per ``orders`` key, featurised per document."""
    from jobsheet.sources.synthetic import monitor_batch
    keys = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"))
    b = monitor_batch(keys).select("order_id", F.col("input.calculatedPositions").alias("positions"))
    return P.nested_order_features(b, part_catalog()).select("order_id", "n_positions", "total_time", "total_price")
