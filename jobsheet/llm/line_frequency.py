"""Cross-document line frequency (operator 3).

Lines are normalised (case, digits, white space) and hashed.  For each host the
distinct documents of every line are counted; texts that repeat on a host are
one document.  A line in more than ``max_docs`` documents of its host and in
more than ``max_share`` of them is over the limits and removed.  A document
that keeps less than ``least_left`` of its words is depleted and rejected.

A document becomes one small row of line hashes where it is read.  Counting
combines before it shuffles; only lines over the limits are joined back.

Defined results: a null text has no words and fails the base rules; a null host
is a host of its own; repeated rows and ids are judged one by one; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from jobsheet.llm.common import keep, small_batches

MAX_DOCS, MAX_SHARE, LEAST_LEFT = 20, 0.005, 0.5
_WORD = re.compile("[^\x20\x09-\x0d]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_DIGITS = re.compile(r"\d+")


def repeated_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more, the first included."""
    if len(ids) < 4:
        return 0
    _, pair = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * (int(ids.max()) + 1) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k:k + len(twice)] |= twice
    return int(covered.sum())


def line_hash(words: list[str]) -> int:
    """Of a normalised line: lower case, runs of digits as 0, single spaces."""
    line = _DIGITS.sub("0", " ".join(words).lower())
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def measure(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, text hash, line hashes, words of the lines."""
    if not text:
        return 0, 0, 0, 0, 0, 0, [], []
    number: dict[str, int] = {}
    ids: list[int] = []
    chars = dups = 0
    raw: set[str] = set()
    lines: dict[int, int] = {}
    for line in text.split("\n"):
        words = _WORD.findall(line)
        if not words:
            continue
        ids += [number.setdefault(w, len(number)) for w in words]
        chars += sum(map(len, words))
        dups += line in raw
        raw.add(line)
        h = line_hash(words)
        lines[h] = lines.get(h, 0) + len(words)
    whole = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
    return (len(ids), chars, len(_SYMBOL.findall(text)), dups, repeated_words(np.array(ids, np.int64)), whole,
            list(lines), list(lines.values()))


def _measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    source = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    schema = source.sparkSession.createDataFrame(
        [], f"id {source.schema['id'].dataType.simpleString()}, host string, row long, n_words long, word_chars long,"
        " n_symbols long, n_dup_lines long, n_repeat_words long, text_hash long, lines array<long>, sizes array<long>").schema

    def run(batches):
        out, row = to_arrow_schema(schema), TaskContext.get().partitionId() << 40
        for b in batches:
            cols = list(zip(*map(measure, b.column("text").to_pylist()), strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("host"), pa.array(range(row, row + b.num_rows), pa.int64()),
                 *(pa.array(c, f.type) for c, f in zip(cols, list(out)[3:], strict=True))], schema=out)
            row += b.num_rows

    return keep(source.mapInArrow(run, schema), "line-hashes")


def frequent_lines(measured: DataFrame, max_docs: int, max_share: float) -> DataFrame:
    """host, line, n_docs of the lines over both limits."""
    distinct = measured.groupBy("host", "text_hash").agg(F.first("lines").alias("lines"))
    hosts = distinct.groupBy("host").agg(F.count("*").alias("host_docs"))
    lines = distinct.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    many = lines.filter(F.col("n_docs") > max_docs)
    return many.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))) \
        .filter(F.col("n_docs") > max_share * F.col("host_docs")).select("host", "line", "n_docs")


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                 max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, least_left: float = LEAST_LEFT) -> DataFrame:
    """Per document: id, host, the base measures, removed_words, removed_lines (hashes), base_failed, depleted, kept."""
    small_batches(docs.sparkSession)
    measured = _measured(docs, id_col, text_col, host_col)
    over = frequent_lines(measured, max_docs, max_share).select(F.col("host").alias("h"), F.col("line").alias("l"))
    own = measured.select("row", "host", F.explode(F.arrays_zip("lines", "sizes")).alias("x")) \
        .select("row", "host", F.col("x.lines").alias("line"), F.col("x.sizes").alias("size"))
    removed = own.join(over, F.col("line").eqNullSafe(F.col("l")) & F.col("host").eqNullSafe(F.col("h")), "left_semi") \
        .groupBy("row").agg(F.sum("size").alias("removed_words"), F.collect_list("line").alias("removed_lines"))
    joined = measured.drop("lines", "sizes", "text_hash").join(removed, "row", "left") \
        .withColumns({"removed_words": F.coalesce("removed_words", F.lit(0)),
                      "removed_lines": F.coalesce("removed_lines", F.array().cast("array<bigint>"))})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    return joined.withColumns({"base_failed": failed, "depleted": left < least_left * F.col("n_words")}) \
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted")).drop("row").withColumnRenamed("id", id_col)


def without_lines(text: str | None, hashes: set[int]) -> str | None:
    """The text without the lines whose normalised hash is in ``hashes``."""
    if not text or not hashes:
        return text
    return "\n".join(x for x in text.split("\n") if not (w := _WORD.findall(x)) or line_hash(w) not in hashes)


def cleaned(docs: DataFrame, quality: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept documents (ids must be unique) without their lines over the limits; all columns as they were."""
    marks = quality.filter("kept").select(F.col(id_col).alias("__id"), F.col("removed_lines").alias("__lines"))
    joined = docs.join(marks, docs[id_col] == marks["__id"])
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = [without_lines(t, set(h)) for t, h in zip(b.column(at).to_pylist(), b.column("__lines").to_pylist(), strict=True)]
            cols = [b.column(i) for i in range(len(docs_columns))]
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=docs_columns)

    docs_columns = docs.columns
    return joined.mapInArrow(run, docs.schema)
