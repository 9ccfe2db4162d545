"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams (operator 4).

Features are present or absent: words, their stems (the first 4, 5 and 6
letters, so that inflected forms share what is learned), word pairs, and pairs
with one or two words skipped, hashed into ``2**BITS`` places.  FTRL-proximal keeps a learning
rate per coordinate; its L1 term leaves most weights at exactly 0, so the
model that is broadcast holds only the others.

Training reads a bounded, documented sample: the ``MAX_TRAIN`` labelled rows of
the learning folds that come first by a hash of their id.  Scoring reads every
whole text and nothing but the text.

Defined results: null and empty texts get the score of no features (the bias);
labels that are null or belong to no document are not learned from; of
repeated labels for a document each counts; without labels the score is 0.5
less a hair, so predicted is 0; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from jobsheet.llm.common import keep, small_batches
from jobsheet.llm.tokens import _Memo, only

BITS = 18
STEMS = (4, 5, 6)
MAX_TRAIN = 12_000  #: labelled rows that the fit reads
MAX_TRAIN_BYTES = 128 << 20  #: of their features (4 bytes each); rows beyond, in hash order, are left out
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 6.0, 1.0
NO_LABELS = -1e-9
_WORD = re.compile(r"[^\W_]+")


def _word_hashes(word: str) -> bytes:
    """Of the word and of its stems, 4 bytes each."""
    return pack(f"<{1 + len(STEMS)}I", *(zlib.crc32(w.encode("utf-8", "surrogatepass"), k)
                                         for k, w in enumerate((word, *(word[:n] for n in STEMS)))))


_HASHES = _Memo(_word_hashes, 100_000)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None) -> np.ndarray:
    """The hashed places of a text's words, pairs and skip-grams, with repeats."""
    found = _WORD.findall(text.lower()) if text else []
    if not found:
        return np.zeros(0, np.int64)
    table = np.frombuffer(b"".join(map(_HASHES.__getitem__, found)), "<u4").reshape(len(found), -1).astype(np.uint64)
    h = table[:, 0]
    parts = [(table * _MIX).ravel()]
    for gap in (1, 2, 3):
        if len(h) > gap:
            parts.append((h[:-gap] * np.uint64(0xC2B2AE3D27D4EB4F + 2 * gap) ^ h[gap:] * np.uint64(0x165667B19E3779F9)) * _MIX)
    x = np.concatenate(parts)
    x ^= x >> np.uint64(29)
    return (x * _MIX >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """FTRL-proximal with per-coordinate rates; the last place is the bias, without L1."""

    def __init__(self, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, i: np.ndarray) -> np.ndarray:
        z = self.z[i]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - np.where(i == 1 << BITS, 0.0, self.l1), 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2)

    def learn(self, i: np.ndarray, y: int) -> None:
        w = self.weights(i)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - y
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[i] = n + g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        i = np.flatnonzero((np.abs(self.z) > self.l1) | (np.arange(len(self.z)) == 1 << BITS))
        w = self.weights(i)
        return i, w


def held_out(id_col) -> F.Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


def _featurise(batches):
    only(_HASHES)
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column("h"), b.column("y"),
             pa.array([np.unique(features(t)).astype("<i4").tobytes() for t in b.column("text").to_pylist()], pa.binary())],
            names=["h", "y", "x"])


def _fit(batches):
    rows, size = [], 0  # 4 bytes a place, as they came
    for b in batches:
        for y, x in zip(b.column("y").to_pylist(), b.column("x").to_pylist(), strict=True):
            size += len(x)
            if size <= MAX_TRAIN_BYTES:
                rows.append((x, y))
    model, rng, bias = Ftrl(), np.random.default_rng(7), np.array([1 << BITS], "<i4")
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)).tolist():
            x, y = rows[k]
            model.learn(np.concatenate([np.frombuffer(x, "<i4"), bias]).astype(np.int64), y)
    i, w = model.sparse()
    yield pa.RecordBatch.from_arrays([pa.array([i.astype("<i8").tobytes()]), pa.array([w.astype("<f8").tobytes()])], names=["i", "w"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_rows: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray]:
    """The non-zero weights, fitted on at most ``max_rows`` labelled rows of the learning folds."""
    small_batches(docs.sparkSession)
    sample = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
              .filter(F.col("y").isin(0, 1) & ~held_out("id"))
              .withColumn("h", F.xxhash64("id")).orderBy("h", "id", "y").limit(max_rows))
    joined = F.broadcast(sample).join(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id")
    examples = keep(joined.select("h", "y", "text").mapInArrow(_featurise, "h long, y int, x binary"), "ftrl-examples")
    # one sequential learner over a sample of bounded size
    fitted = examples.repartition(1).sortWithinPartitions("h", "y", "x").mapInArrow(_fit, "i binary, w binary").collect()  # one row: the non-zero weights
    return np.frombuffer(b"".join(bytes(r.i) for r in fitted), "<i8"), np.frombuffer(b"".join(bytes(r.w) for r in fitted), "<f8")


def _scores(texts, weights: np.ndarray, used: np.ndarray) -> np.ndarray:
    total = np.empty(len(texts))
    for k, text in enumerate(texts):
        i = features(text)
        i = np.unique(i[used[i]])
        total[k] = weights[i].sum()
    return 1 / (1 + np.exp(-np.clip(total + weights[1 << BITS], -35, 35)))


def _model(docs: DataFrame, fitted):
    i, w = fitted
    shared = docs.sparkSession.sparkContext.broadcast((i.astype(np.int32), w.astype(np.float64)))  # at most 2**BITS + 1 weights
    trained = bool(len(i))

    def dense():
        weights = np.zeros((1 << BITS) + 1)
        weights[shared.value[0]] = shared.value[1]
        if not trained or not (weights != 0).any():
            weights[1 << BITS] = NO_LABELS
        used = weights != 0
        used[1 << BITS] = False
        return weights, used

    return dense


def score(docs: DataFrame, fitted, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted for every document."""
    small_batches(docs.sparkSession)
    dense = _model(docs, fitted)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = source.sparkSession.createDataFrame([], f"id {source.schema['id'].dataType.simpleString()}, score double").schema

    def run(batches):
        only(_HASHES)
        weights, used = dense()
        out = to_arrow_schema(schema)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(_scores(b.column("text").to_pylist(), weights, used))], schema=out)

    return source.mapInArrow(run, schema).select(
        F.col("id").alias(id_col), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, fitted, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, all columns as they were."""
    small_batches(docs.sparkSession)
    dense = _model(docs, fitted)

    def run(batches):
        only(_HASHES)
        weights, used = dense()
        for b in batches:
            yield b.filter(pa.array(_scores(b.column(text_col).to_pylist(), weights, used) < threshold))

    return docs.mapInArrow(run, docs.schema)
