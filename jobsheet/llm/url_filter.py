"""URL filter: host and path rules, and a logistic regression for the urls that no rule covers (operator 5).

The model sees hashed character n-grams of host and of path (marked apart, with
their ends marked), present or absent.  It is trained on a small labelled url
table: by default urls that a rule covers, the rule's verdict as label, at most
``max_rows`` of each label, those that come first by hash, weighted to the
label's number of distinct urls, so the bound does not move the class balance.  All of it is
DataFrame functions and Spark ML, so it runs in the JVM.

Defined results: a null url or one without ``://`` has empty host and path, no
rule, and the model's verdict for no n-grams; repeated urls are judged alike;
where the labelled urls lack one of the two labels, the method answers the
label that there is, and allow where there is none; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsheet.llm.common import keep

ALLOW, BLOCK = "allow", "block"
#: The rules of the query.
RULES = (("com/", ALLOW), ("example.com/en/", BLOCK), ("www.example.com/en/", ALLOW), ("net/es/", BLOCK), ("net/fr/", BLOCK))
MAX_ROWS = 2_000  #: labelled urls of each label that the fit reads
FEATURES = 1 << 16
SIZES = (2, 3, 4, 5)


def _after(url: Column, stops: str) -> Column:
    return F.regexp_extract(url, rf"(?s)^([^{stops}]*)", 1)


def parse(pages: DataFrame, url_col: str) -> DataFrame:
    """Adds host and path."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rest = pages.withColumn("rest", F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)^.*?://(.*)$", 1))
    host = rest.withColumn("host", _after(F.col("rest"), "/?#"))
    return host.withColumn("path", _after(F.expr("substr(rest, char_length(host) + 1)"), "?#")) \
        .withColumn("host", F.translate("host", upper, lower)).drop("rest")


def apply_rules(parsed: DataFrame, rules=RULES) -> DataFrame:
    """Adds rule (the longest that fits, else null) and rule_verdict."""
    by_length = sorted(rules, key=lambda r: -len(r[0]))

    def fits(rule: str) -> Column:
        domain, path = rule.split("/", 1)
        host = (F.col("host") == domain) | F.endswith(F.col("host"), F.lit("." + domain))
        return host & F.startswith(F.col("path"), F.lit("/" + path))

    def first(value) -> Column:
        return reduce(lambda other, r: F.when(fits(r[0]), value(r)).otherwise(other), reversed(by_length), F.lit(None).cast("string"))

    return parsed.withColumns({"rule": first(lambda r: F.lit(r[0])), "rule_verdict": first(lambda r: F.lit(r[1]))})


def with_grams(df: DataFrame) -> DataFrame:
    """Adds grams: the character n-grams of host and path."""
    def of(part: str, mark: str) -> list[Column]:
        text = f"concat('^', {part}, '$')"
        return [F.expr(f"transform(sequence(1, greatest(1, char_length({text}) - {n - 1})), i -> concat('{mark}', substr({text}, i, {n})))")
                for n in SIZES]

    return df.withColumn("grams", F.array_distinct(F.concat(*of("host", "h"), *of("path", "p"))))


def _hashing() -> HashingTF:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)


def labelled(ruled: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The labelled url table: host, path, label (1: block), weight (distinct urls of the label for each one taken)."""
    def some(verdict: str) -> DataFrame:
        rows = ruled.filter(F.col("rule_verdict") == verdict).select("host", "path").distinct()
        return rows.orderBy(F.xxhash64("host", "path"), "host", "path").limit(max_rows) \
            .withColumns({"label": F.lit(float(verdict == BLOCK)),
                          "weight": F.greatest(F.lit(1.0), rows.select(F.count(F.lit(1))).scalar() / F.lit(max_rows))})

    return some(ALLOW).unionByName(some(BLOCK))


def fit(table: DataFrame):
    """The model, or the one label of a table that has just one, or None."""
    small = keep(table.coalesce(1), "labelled-urls")
    labels = [r.label for r in small.select("label").distinct().collect()]  # two at most
    if len(labels) < 2:
        return labels[0] if labels else None
    rows = _hashing().transform(with_grams(small)).select("label", "weight", "features").cache()
    try:
        return LogisticRegression(weightCol="weight", maxIter=60, regParam=1e-3, aggregationDepth=2).fit(rows)
    finally:
        rows.unpersist()


def judge(pages: DataFrame, model, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """id, host, path, rule, verdict, score (of block, null where there is no model)."""
    ruled = apply_rules(parse(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), "url"), rules)
    if model is None or isinstance(model, float):
        scored = ruled.withColumns({"score": F.lit(None).cast("double"), "own": F.lit(BLOCK if model == 1.0 else ALLOW)})
    else:
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(_hashing().transform(with_grams(ruled))) \
            .withColumn("score", vector_to_array("probability")[1]) \
            .withColumn("own", F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce("rule_verdict", "own").alias("verdict"), "score")
