"""Ranked lexical search, reversed: the documents stream through an index of the items (operator 13).

The items' terms form an inverted index, term to (item, times), built block by block
(``BLOCK_POSTINGS`` postings and ``BLOCK_ITEMS`` items at most, unless one item alone
has more terms) and broadcast.  For a block:

1. one pass over the documents counts each document's terms, keeps its length and the counts of the
   terms that the index holds, and, for every task, the number of documents holding each
   term; a task emits partial sums, so what is shuffled is tasks times terms;
2. with the statistics of all documents known, the kept counts stream through the
   index; each task holds one bounded heap for each item;
3. the tasks' heaps are merged by item.

A document is read once for each block; no document is compared with a document.

Defined results: null texts have no terms, and a document without terms counts nowhere; rows
with one item id (null included) are one item with the terms of all of them; an item without terms,
or whose terms no document holds, has no rows; repeated documents are documents of their
own; equal scores go by ascending id, null ids last; an empty table of documents or
items gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsheet.llm.common import bounded_batches, delete_folder, keep, run_folder

#: Fixed value: digits, letters (A-Z lower-cased) and everything beyond ASCII, as UTF-8 bytes.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
TOP = 20
BLOCK_POSTINGS = 1_000_000
BLOCK_ITEMS = 50_000
CELLS = 4_000_000


def terms(text: str | None) -> list[bytes]:
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []  # bytes.lower: A-Z only


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Index:
    """Postings of one block: term number -> (item number, times in the item)."""

    def __init__(self, rows):
        rows = sorted(rows)  # (term, item, times)
        self.words: dict[bytes, int] = {}
        for word, _, _ in rows:
            self.words.setdefault(word, len(self.words))
        self.item = np.array([i for _, i, _ in rows], np.int64)
        self.times = np.array([t for _, _, t in rows], np.int64)
        number = np.array([self.words[w] for w, _, _ in rows], np.int64)
        self.first = np.searchsorted(number, np.arange(len(self.words) + 1))
        self.items = int(self.item.max(initial=-1)) + 1


def _item_terms(batches):
    for b in batches:
        ids, words, at = [], [], b.column("item")
        for k, text in enumerate(b.column("text").to_pylist()):
            found = terms(text)
            words += found
            ids += [k] * len(found)
        yield pa.RecordBatch.from_arrays([at.take(pa.array(ids, pa.int64())), pa.array(words, pa.binary())], names=["item", "term"])


def postings(items: DataFrame, id_col: str, text_col: str, path: str, block_postings: int, block_items: int) -> int:
    """Write (block, number, item, term, times), a folder for each block; returns the number of blocks."""
    spark = items.sparkSession
    kind = items.schema[id_col].dataType.simpleString()
    found = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")).mapInArrow(_item_terms, f"item {kind}, term binary")
    counts = keep(found.groupBy("item", "term").agg(F.count("*").alias("times")), "reversed-counts")
    n_postings, n_items = counts.select(F.count("*"), F.count_distinct(F.struct("item"))).first()
    blocks = max(1, -(-n_postings // block_postings), -(-n_items // block_items))
    by = Window.partitionBy("block").orderBy("item")
    counts.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")) \
        .withColumn("number", F.dense_rank().over(by) - 1).write.partitionBy("block").parquet(path)
    return blocks if n_postings else 0


def _counts(shared):
    """A row for each document with terms (length, index terms, counts); at the end one for each term met: (term, documents)."""
    def run(batches):
        words = shared.value.words
        met = np.zeros(len(words), np.int64)
        for b in batches:
            n, found, times = [], [], []
            for text in b.column("text").to_pylist():
                all_terms = terms(text)
                own = [i for i in map(words.get, all_terms) if i is not None]
                t, c = np.unique(np.array(own, np.int64), return_counts=True)
                met[t] += 1
                n.append(len(all_terms))
                found.append(t.astype("<i4").tobytes())
                times.append(c.astype("<i4").tobytes())
            keep_ = pa.array(np.flatnonzero(n), pa.int64())
            out = pa.RecordBatch.from_arrays([b.column("doc"), pa.array(n, pa.int64()), pa.array(found, pa.binary()), pa.array(times, pa.binary()),
                                              pa.array([False] * len(n), pa.bool_())], names=["doc", "n", "terms", "times", "is_sum"])
            yield out.take(keep_)
        at = np.flatnonzero(met)
        none = pa.nulls(len(at), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(met[at]), none, none, pa.array([True] * len(at), pa.bool_())],
                                         names=["doc", "n", "terms", "times", "is_sum"])
    return run


class ItemHeaps:
    """The best documents of each item: higher score first, then smaller id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.items = k, items
        self.item, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.doc, self.null = np.zeros(0, np.int64), np.zeros(0, bool)
        self.least = np.ones(items, np.int64)  # a score must be above 0

    def add(self, item, score, doc, null) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        doc, null = np.concatenate([self.doc, doc]), np.concatenate([self.null, null])
        order = np.lexsort((doc, null, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[place < self.k]
        self.item, self.score, self.doc, self.null = item[order], score[order], doc[order], null[order]
        full = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.least[self.item[full]] = self.score[full]


def _lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if int(n.max(initial=0)) * 25 * n_docs < 2**62:
        return 75 + (25 * n * n_docs) // n_terms
    return np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64)


def scores(index: Index, weights: np.ndarray, doc: np.ndarray, found: np.ndarray, times: np.ndarray, m: np.ndarray, docs: int) -> np.ndarray:
    """Scores (documents x items) of documents given as (document, term, times) rows; ``m`` by document."""
    part = weights[found] * ((1_000_000_000 * times) // (1000 * times + 12 * m[doc]))
    size = index.first[found + 1] - index.first[found]
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - index.first[found], size)  # every posting of every row
    cell = np.repeat(doc, size) * index.items + index.item[at]
    value = np.repeat(part, size) * index.times[at]
    if float(value.astype(np.float64).sum()) < 2**53:  # then every sum is exact in doubles
        total = np.bincount(cell, weights=value, minlength=docs * index.items).astype(np.int64)
    else:
        total = np.zeros(docs * index.items, np.int64)
        np.add.at(total, cell, value)
    return total.reshape(docs, index.items)


def _rank(shared, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    def run(batches):
        index = shared.value
        heaps = ItemHeaps(index.items, k)
        step = max(1, CELLS // max(1, index.items))
        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                bits = [np.frombuffer(x, "<i4") for x in part.column("terms").to_pylist()]
                found = np.concatenate(bits).astype(np.int64)
                times = np.concatenate([np.frombuffer(x, "<i4") for x in part.column("times").to_pylist()]).astype(np.int64)
                doc = np.repeat(np.arange(len(bits)), [len(x) for x in bits])
                m = _lengths(part.column("n").to_numpy(), n_docs, n_terms)
                table = scores(index, weights, doc, found, times, m, len(bits))
                d, i = np.nonzero(table >= heaps.least)
                null = part.column("doc").is_null().to_numpy(zero_copy_only=False)
                ids = part.column("doc").fill_null(0).to_numpy(zero_copy_only=False)
                heaps.add(i, table[d, i], ids[d], null[d])
        yield pa.RecordBatch.from_arrays([pa.array(heaps.item), pa.array(heaps.doc, mask=heaps.null), pa.array(heaps.score)],
                                         names=["number", "doc_id", "score"])
    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", block_postings: int = BLOCK_POSTINGS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    listed, out = run_folder(spark, "reversed-postings"), run_folder(spark, "reversed-heaps")
    schema = f"item {kind}, number long, doc_id long, score long"
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    spark.createDataFrame([], schema).write.parquet(out)
    with bounded_batches(spark):
        for block in range(postings(items, item_col, item_text_col, listed, block_postings, block_items)):
            held = spark.read.parquet(listed).where(F.col("block") == block)
            rows = held.select("term", "number", "times").collect()  # a block's postings
            if not rows:
                continue
            index = spark.sparkContext.broadcast(Index([(bytes(t), i, c) for t, i, c in rows]))
            path = run_folder(spark, "reversed-terms")
            plain.mapInArrow(_counts(index), "doc long, n long, terms binary, times binary, is_sum boolean").write.parquet(path)
            counted = spark.read.parquet(path)
            n_docs, n_terms = counted.where("not is_sum").select(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
            met = np.zeros(len(index.value.words), np.int64)
            for term, df in counted.where("is_sum").groupBy("doc").agg(F.sum("n")).collect():  # a row for each term of the block
                met[term] = df
            if n_docs:
                weights = np.array([weight(n_docs, int(x)) for x in met], np.int64)
                ranked = counted.where("not is_sum").mapInArrow(_rank(index, weights, n_docs, n_terms, k), "number long, doc_id long, score long")
                names = held.select("number", "item").distinct()
                ranked.join(names, "number").select("item", "number", "doc_id", "score").write.mode("append").parquet(out)
            delete_folder(spark, path)
            index.destroy()
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return spark.read.schema(schema).parquet(out).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k) \
        .select(F.col("item").alias(item_col), "rank", "doc_id", "score")
