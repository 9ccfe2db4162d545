"""The registered queries of the numbered operators, with their SQL where there is any.

Each query projects what its contract asks for from what its operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsheet.llm import oracles
from jobsheet.sources.tables import table

#: The registered queries' key for surrogates; a user passes a secret one.
SURROGATE_KEY = "registered query"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@query("op2_binary_records")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.records import round_trip

    return round_trip(spark, table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.bestfit import pack

    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op4_toxicity_ftrl")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.toxicity_ftrl import score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


@query("op7_benchmark_decontamination", oracles.OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256", "contaminated")


@query("op3_line_frequency", oracles.OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.line_frequency import line_quality

    return line_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op5_url_filter")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.url_filter import apply_rules, fit, judge, labelled, parse

    pages = table(spark, sf_dir, "pages")
    model = fit(labelled(apply_rules(parse(pages.select("url"), "url"))))
    return judge(pages, model).select("page_id", "host", "path", "rule", "verdict")


@query("op1_quotation_linking")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.quotes import link

    return link(table(spark, sf_dir, "conversations"))


@query("op6_surrogates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.surrogates import replace_personal_data

    return replace_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY, count_col="n_entities")


@query("op8_ngram_jaccard_join", oracles.OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.jaccard_join import join_classes

    return join_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op9_suffix_dedup", oracles.OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op11_exact_topk", oracles.OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.topk_search import top_k

    return top_k(table(spark, sf_dir, "embeddings"), k=5, scale=256)


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.whitening import fit, whitened_components

    vectors = table(spark, sf_dir, "embeddings")
    return whitened_components(vectors, fit(vectors, k=16, scale=64, shift=1_000_000))


@query("op13_ranked_lexical_search", oracles.OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobsheet.llm.reversed_search import rank_documents

    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)
