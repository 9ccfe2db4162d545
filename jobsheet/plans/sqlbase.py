"""SQL building blocks for the oracle statements (DuckDB dialect).

The oracle restates each query independently in plain SQL over the driver
tables.  These helpers keep the shared parts - the order view, cleaning,
rounding - in one place.  DuckDB's regex engine has no look-around and an
ASCII ``\\w``; patterns that need more are rewritten in :data:`RE2_REWRITES`.
"""

from __future__ import annotations

from jobsheet.config import OrderConfig

RND = 6


def r(expr: str, digits: int = RND) -> str:
    """Same IEEE-only rounding as :func:`jobsheet.functions.stats.rnd`."""
    s = f"1e{digits}"
    return f"(floor(({expr}) * {s} + 0.5) / {s})::DOUBLE"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def clean_make(expr: str) -> str:
    s = strip(expr)
    return f"upper(CASE WHEN {expr} IS NULL OR {s} = '' THEN 'unknown' ELSE {s} END)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Look-ahead patterns of the part-catalog configuration, restated for RE2.
# X(?!Y) holds iff X still occurs after every "XY" is blanked out.
RE2_REWRITES = {
    r"small(?! widget)": "regexp_matches(replace({t}, 'small widget', '#'), 'small')",
}


def search(text_expr: str, pattern: str) -> str:
    if pattern in RE2_REWRITES:
        return "(" + RE2_REWRITES[pattern].format(t=text_expr) + ")"
    return f"regexp_matches({text_expr}, {q(pattern)})"


POS_RAW = """
pos_raw AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS part_key,
         l.l_suppkey AS supp_key,
         CASE WHEN l.l_partkey % 13 = 0 THEN ''
              ELSE upper(concat_ws(' ', p.p_name, p.p_type, p.p_brand)) END AS text,
         CASE WHEN l.l_suppkey % 7 = 0 THEN 0.0
              WHEN l.l_partkey % 29 = 0 THEN -l.l_extendedprice
              ELSE l.l_extendedprice END AS total_price,
         CASE WHEN l.l_returnflag = 'N' THEN 0.0 ELSE l.l_quantity END AS total_time,
         CASE WHEN l.l_partkey % 23 = 0 THEN NULL ELSE lower(p.p_type) END AS cost_center
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

HDR = """
hdr AS (
  SELECT o.o_orderkey AS order_id,
         CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE upper(c.c_mktsegment) END AS make,
         o.o_orderdate AS order_date
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""


def pos_clean(cfg: OrderConfig, src: str = "pos_raw", clamp_time: bool = False) -> str:
    t = "greatest(0.0, coalesce(TRY_CAST(total_time AS DOUBLE), 0.0))" if clamp_time \
        else "coalesce(TRY_CAST(total_time AS DOUBLE), 0.0)"
    return f"""
pos_clean AS (
  SELECT * FROM (
    SELECT order_id, line_no, part_key, supp_key,
           {strip("coalesce(text, '')")} AS text,
           greatest(0.0, coalesce(TRY_CAST(total_price AS DOUBLE), 0.0)) AS total_price,
           {t} AS total_time,
           CASE WHEN cost_center IS NULL OR cost_center = '' THEN {q(cfg.unknown_cc)}
                ELSE cost_center END AS cost_center
    FROM {src}) x
  WHERE NOT (text = '' AND total_price = 0 AND total_time = 0)
)"""


def targets_wide(cfg: OrderConfig) -> str:
    sums = ",\n         ".join(
        f"sum(CASE WHEN lower(p.p_type) = {q(t)} THEN l.l_quantity END) AS {t}" for t in cfg.targets)
    outs = ", ".join(f"coalesce(s.{t}, 0.0) / 10.0 AS {t}" for t in cfg.targets)
    return f"""
tw_sums AS (
  SELECT l.l_orderkey AS order_id,
         {sums}
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_returnflag = 'R'
  GROUP BY l.l_orderkey
),
tw AS (
  SELECT o.o_orderkey AS order_id, {outs}
  FROM orders o LEFT JOIN tw_sums s ON o.o_orderkey = s.order_id
)"""


def targets_long(cfg: OrderConfig) -> str:
    parts = " UNION ALL\n  ".join(
        f"SELECT order_id, {q(t)} AS target, {t} AS hours FROM tw" for t in cfg.targets)
    return f"""
tl AS (
  {parts}
)"""


def order_aggs(cfg: OrderConfig) -> str:
    """pos_clean -> one row per order with positions (C1-C3 + texts)."""
    cc_aggs = []
    for c in cfg.cost_centers:
        cc_aggs += [
            f"sum(CASE WHEN cost_center = {q(c)} THEN total_time END) AS time_{c}",
            f"sum(CASE WHEN cost_center = {q(c)} THEN total_price END) AS price_{c}",
            f"count_if(cost_center = {q(c)}) AS n_{c}",
        ]
    cc_sql = ",\n         ".join(cc_aggs)
    return f"""
agg AS (
  SELECT order_id,
         count(*) AS n_positions,
         count_if(total_price > 0 OR total_time > 0) AS n_useful,
         count_if(total_time = 0) AS n_zero_time,
         count_if(total_price = 0) AS n_zero_price,
         sum(total_time) AS total_time, sum(total_price) AS total_price,
         max(total_time) AS max_time, avg(total_time) AS mean_time,
         median(total_time) AS median_time,
         max(total_price) AS max_price, avg(total_price) AS mean_price,
         stddev_pop(total_time) AS std_time, stddev_pop(total_price) AS std_price,
         {cc_sql},
         string_agg(lower(text), ' ' ORDER BY line_no, part_key, supp_key) AS full_text,
         string_agg(CASE WHEN (total_price > 0 OR total_time > 0) AND trim(lower(text)) <> ''
                         THEN lower(text) END, ' ' ORDER BY line_no, part_key, supp_key) AS order_text
  FROM pos_clean
  GROUP BY order_id
)"""


def features(cfg: OrderConfig) -> str:
    """hdr + agg -> per-order feature row ``feat`` (C1-C8), unrounded."""
    zero = ["n_positions", "n_useful", "n_zero_time", "n_zero_price", "total_time", "total_price",
            "max_time", "mean_time", "median_time", "max_price", "mean_price", "std_time", "std_price"]
    for c in cfg.cost_centers:
        zero += [f"time_{c}", f"price_{c}", f"n_{c}"]
    cols = [f"coalesce(a.{z}, 0) AS {z}" for z in zero]
    cols += ["coalesce(a.full_text, '') AS full_text", "coalesce(a.order_text, '') AS order_text"]
    base = ",\n         ".join(cols)
    derived = []
    for c in cfg.ratio_time_ccs:
        derived.append(f"CASE WHEN total_time > 0 THEN time_{c} / total_time ELSE 0.0 END AS ratio_{c}_time")
    for c in cfg.ratio_price_ccs:
        derived.append(f"CASE WHEN total_price > 0 THEN price_{c} / total_price ELSE 0.0 END AS ratio_{c}_price")
    for c in cfg.flag_ccs:
        derived.append(f"CAST(n_{c} > 0 AS INTEGER) AS has_{c}_cc")
    for name, pat in cfg.keyword_flags.items():
        derived.append(f"CAST({search('full_text', pat)} AS INTEGER) AS {name}")
    derived.append("coalesce(mf.make_freq, 1) AS make_freq")
    for m in cfg.top_makes:
        derived.append(f"CAST(make = {q(m)} AS INTEGER) AS make_{m.replace('-', '_')}")
    inlist = ", ".join(q(m) for m in cfg.top_makes)
    derived.append(f"CAST(make NOT IN ({inlist}) AS INTEGER) AS make_other")
    der = ",\n         ".join(derived)
    return f"""
mf AS (
  SELECT {clean_make('make')} AS make_clean, count(*) AS make_freq FROM hdr GROUP BY 1
),
feat0 AS (
  SELECT h.order_id, {clean_make('h.make')} AS make,
         {base}
  FROM hdr h LEFT JOIN agg a ON h.order_id = a.order_id
),
feat AS (
  SELECT feat0.*,
         {der}
  FROM feat0 LEFT JOIN mf ON feat0.make = mf.make_clean
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def feature_ctes(cfg: OrderConfig) -> str:
    return with_(POS_RAW, HDR, pos_clean(cfg), order_aggs(cfg), features(cfg))
