"""Text vectorisation (D1-D10), relational.

A document is one row, so its term counts and norm never leave the row:
fitting shuffles one partial (term, df, count) row per task and term, and
weighting looks each document's terms up in the frozen vocabulary (at most
``max_features`` rows) batch by batch, without a shuffle.  The weights equal a
sublinear-tf, smoothed-idf, L2-normalised TF-IDF:

    w = (1 + ln tf) * (ln((1 + N) / (1 + df)) + 1),  then w / ||w||_2
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsheet.functions.once import once
from jobsheet.operators.matrix import Rows, flat_lists

# (?U): \w and \b are Unicode-aware, as in Python 3 str patterns
WORD_PATTERN = r"(?U)\b[\w\+]+\b"


def word_tokens(text: Column) -> Column:
    """Tokens of the lower-cased text; keeps ``a+e``."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), 0)


def word_ngrams(tokens: Column, n_max: int = 2) -> Column:
    """1..n_max-grams joined by a blank (n-grams of consecutive tokens).

    The tokens are bound once as the element of a one-element array: an expression inside a lambda runs
    for every element, so the text would be tokenised again for each n-gram."""
    def grams(t):
        def gram(n):  # one-argument lambdas only: F.transform reads arity
            return lambda i: F.array_join(F.slice(t, i, n), " ")
        out = [t]
        for n in range(2, n_max + 1):
            out.append(F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), gram(n)))
                       .otherwise(F.array().cast("array<string>")))
        return F.flatten(F.array(*out))
    return F.get(F.transform(F.array(tokens), grams), F.lit(0)) if n_max > 1 else tokens


def char_wb_ngrams(text: Column, n_min: int = 3, n_max: int = 5) -> Column:
    """D3: character n-grams inside blank-padded words.

    A padded word of length L yields every n-gram for n < L; when L == n it
    yields the padded word once and larger n yield nothing.
    """
    words = F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def per_word(w):
        ln = F.length(w)

        def sub(n):  # one-argument lambda: F.transform reads arity
            return lambda i: F.substring(w, i, F.lit(n))
        per_n = [F.when(ln > n, F.transform(F.sequence(F.lit(1), ln - n + 1), sub(n)))
                 .when(ln == n, F.array(w)).otherwise(F.array().cast("array<string>"))
                 for n in range(n_min, n_max + 1)]
        return F.flatten(F.array(*per_n))
    return F.flatten(F.transform(padded, per_word))


@dataclass(frozen=True)
class Grams:
    """The terms of a text as its units, an array column of strings, and how their n-grams are made in Arrow batches.

    ``inside``: n-grams of the characters of every unit, padded with blanks (D3), else of consecutive units joined by a
    blank (D2).  The n-grams of equal units are made once a batch, so a text costs its words, not its n-grams."""
    units: Column
    inside: bool
    n_min: int
    n_max: int

    def how(self) -> tuple[bool, int, int]:
        return self.inside, self.n_min, self.n_max


def word_grams(text: Column, n_max: int = 2) -> Grams:
    """D1 + D2: the terms of :func:`word_ngrams` of :func:`word_tokens`."""
    return Grams(word_tokens(text), False, 1, n_max)


def char_grams(text: Column, n_min: int = 3, n_max: int = 5) -> Grams:
    """D3: the terms of :func:`char_wb_ngrams`."""
    return Grams(F.split(F.lower(text), r"(?U)\s+"), True, n_min, n_max)


#: Rows of a batch whose terms are made together.
SLICE = 2048


def _slices(batches):
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            yield b.slice(at, SLICE)


def _inside(word: str, n_min: int, n_max: int) -> list[str]:
    """The n-grams of one word, as :func:`char_wb_ngrams` has them."""
    w = f" {word} "
    out: list[str] = []
    for n in range(n_min, n_max + 1) if word else ():
        out += [w[i:i + n] for i in range(len(w) - n + 1)] if len(w) > n else [w] if len(w) == n else []
    return out


def occurrences(column: pa.ListArray, how: tuple[bool, int, int] | None, wanted: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, number of the term, the terms by number) of every term in an Arrow column of unit lists; ``how`` as in
    :class:`Grams`, or None where the units are the terms.  With ``wanted`` only its terms, numbered by their place in it."""
    offsets, flat = column.offsets.to_numpy().astype(np.int64) - column.offsets[0].as_py(), column.flatten().cast(pa.string())
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    if flat.null_count:  # a null is no term
        row, flat = row[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
        offsets = np.searchsorted(row, np.arange(len(column) + 1))
    units = flat.dictionary_encode()
    code = units.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def numbered(names: pa.Array) -> tuple[np.ndarray, pa.Array]:
        if wanted is not None:
            return pc.index_in(names, value_set=wanted).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), wanted
        own = names.dictionary_encode()
        return own.indices.to_numpy(zero_copy_only=False).astype(np.int64), own.dictionary

    if how is not None and how[0]:
        lists = [_inside(w, *how[1:]) for w in units.dictionary.to_pylist()]
        number, names = numbered(pa.array([g for x in lists for g in x], pa.string()))
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])[number >= 0]
        number = number[number >= 0]
        size = np.bincount(owner, minlength=len(lists))
        first, times = np.cumsum(size) - size, size[code]
        entry = np.arange(times.sum()) + np.repeat(first[code] - (np.cumsum(times) - times), times)
        return np.repeat(row, times), number[entry], names
    # consecutive units: an n-gram is the (n - 1)-gram at its first unit and the unit after that
    names, at, here, all_rows, all_codes, all_names = units.dictionary, code, np.arange(len(code)), [], [], []
    for n in range(1, how[2] + 1 if how is not None else 2):
        if n > 1:
            fits = here + n <= offsets[1:][row[here]]
            pair, at = np.unique(at[fits] * max(len(units.dictionary), 1) + code[here[fits] + n - 1], return_inverse=True)
            here = here[fits]
            names = pc.binary_join_element_wise(names.take(pa.array(pair // max(len(units.dictionary), 1))),
                                                units.dictionary.take(pa.array(pair % max(len(units.dictionary), 1))), " ")
        if how is None or n >= how[1]:
            all_rows.append(row[here])
            all_codes.append(at + sum(map(len, all_names)))
            all_names.append(names)
    row, code = np.concatenate(all_rows), np.concatenate(all_codes)
    number, names = numbered(pa.concat_arrays(all_names))
    code = number[code]
    return row[code >= 0], code[code >= 0], names


def cells(row: np.ndarray, at: np.ndarray, rows: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (row, at) in order and how often each occurs."""
    key = row * max(width, 1) + at
    if rows * width <= 8 * len(key) + (1 << 16):  # counting beats sorting
        n = np.bincount(key)
        cell = np.flatnonzero(n)
        n = n[cell]
    else:
        cell, n = np.unique(key, return_counts=True)
    return *np.divmod(cell, max(width, 1)), n


def term_counts(docs: DataFrame, doc: str, terms: Callable[[Column], Column], text: str = "text") -> DataFrame:
    """One row per document with its counted terms, ``(doc, terms array<struct<term, first, n>>)``: they never leave the row.

    ``first`` is 1 for the first of equal terms of the document and 0 for the others, ``n`` the occurrences an entry
    stands for.  Rows with the same id are one document; copies of a row are counted before they meet."""
    rows = docs.groupBy(doc, text).agg(F.count(F.lit(1)).alias("_n")) \
        .groupBy(doc).agg(F.collect_list(F.struct(F.col(text).alias("text"), "_n")).alias("_rows"))

    def weighted(x):
        return F.transform(terms(x["text"]), lambda t: F.struct(t.alias("term"), x["_n"].alias("n")))
    d = rows.select(doc, F.sort_array(F.flatten(F.transform("_rows", weighted))).alias("_t"))

    def marked(x, i):
        first = ~F.get("_t", i - 1)["term"].eqNullSafe(x["term"])
        return F.struct(x["term"].alias("term"), first.cast("long").alias("first"), x["n"].alias("n"))
    return d.select(doc, once(F.transform("_t", marked)).alias("terms"))


def term_stats(tc: DataFrame, doc: str) -> DataFrame:
    """Per term: document frequency and corpus count, in one shuffle of partial sums."""
    return tc.select(F.inline("terms")).groupBy("term").agg(F.sum("first").alias("df"), F.sum("n").alias("ctf"))


def vocab_select(tc: DataFrame, doc: str, min_df: int, max_features: int) -> DataFrame:
    """Df >= min_df, then the max_features most frequent terms (ties by
    term), indexed 0.. in term order."""
    return select_top(term_stats(tc, doc), min_df, max_features)


def select_top(stats: DataFrame, min_df: int, max_features: int) -> DataFrame:
    """D4 on (term, df, ctf) rows."""
    from pyspark.sql import Window
    top = stats.where(F.col("df") >= min_df).orderBy(F.desc("ctf"), F.asc("term")).limit(max_features)
    return top.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))


def idf_table(vocab: DataFrame, n_docs: Column | int) -> DataFrame:
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return vocab.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1)


def corpus_terms(docs: DataFrame, terms: Column) -> DataFrame:
    """Per term: document frequency and corpus count, in one shuffle of partial sums.

    In the sorted terms of a document the first of equal ones stands for the document."""
    d = docs.select(once(F.sort_array(terms)).alias("_t"))
    marked = F.transform("_t", lambda t, i: F.struct(t.alias("term"), (F.coalesce(F.get("_t", i - 1), F.lit("")) != t).cast("long").alias("first")))
    return d.select(once(marked).alias("_m")).select(F.inline("_m")).groupBy("term").agg(F.sum("first").alias("df"), F.count(F.lit(1)).alias("ctf"))


def gram_terms(docs: DataFrame, grams: Grams) -> DataFrame:
    """:func:`corpus_terms` of :class:`Grams`: what is shuffled is a task's distinct terms."""
    how = grams.how()

    def run(batches):
        for b in _slices(batches):
            row, at, names = occurrences(b.column("_u"), how)
            _, own, n = cells(row, at, b.num_rows, len(names))
            yield pa.RecordBatch.from_arrays([names, pa.array(np.bincount(own, minlength=len(names))), pa.array(np.bincount(own, n, len(names)).astype(np.int64))],
                                             names=["term", "df", "ctf"])
    return docs.select(grams.units.alias("_u")).mapInArrow(run, "term string, df long, ctf long").groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("ctf").alias("ctf"))


def fit_vocab(docs: DataFrame, doc: str, terms: Column | Grams, min_df: int, max_features: int) -> DataFrame:
    """Vocabulary + idf fitted on ``docs`` (D4 + D5 fit side)."""
    n = docs.select(F.count(F.lit(1))).scalar()  # scalar subquery, no driver round trip
    stats = gram_terms(docs, terms) if isinstance(terms, Grams) else corpus_terms(docs, terms)
    return idf_table(select_top(stats, min_df, max_features), n)


@dataclass
class Vocabulary:
    """A frozen vocabulary: terms by index with their idf."""
    terms: pa.Array
    idf: np.ndarray

    @staticmethod
    def of(fitted: DataFrame) -> Vocabulary:
        rows = sorted(fitted.select("idx", "term", "idf").collect())  # at most max_features rows
        return Vocabulary(pa.array([r.term for r in rows], pa.string()), np.array([r.idf for r in rows]))

    def counts(self, column: pa.ListArray, how: tuple[bool, int, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, index, occurrences) of an Arrow column of unit lists, by row and index."""
        row, at, _ = occurrences(column, how, self.terms)
        return cells(row, at, len(column), len(self.terms))


def weigh(row: np.ndarray, tf: np.ndarray, idf: np.ndarray, rows: int) -> np.ndarray:
    """The weights of entries (row, occurrences, idf of the term); each row's have norm 1."""
    w = (1 + np.log(tf)) * idf
    norm = np.sqrt(np.bincount(row, w * w, minlength=rows))
    return w / norm[row]


def _lists(row: np.ndarray, n: int, *columns: np.ndarray) -> list[pa.ListArray]:
    offsets = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in columns]


def _by_row(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Entries (row, at, ...) of blocks that lie one after another, each by row and place, in one such order."""
    columns = [np.concatenate(c) for c in zip(*parts)]
    order = np.argsort(columns[0].astype(np.uint16), kind="stable")  # rows of a slice
    return tuple(c[order] for c in columns)


def _sources(df: DataFrame, keep: Sequence[str], texts: Sequence[tuple[Column | Grams, Vocabulary]], numeric: Sequence[Column]):
    """The columns that vectors are made of, how the units of each text become terms, the first index of each block."""
    units = [t.units if isinstance(t, Grams) else t for t, _ in texts]
    how = [t.how() if isinstance(t, Grams) else None for t, _ in texts]
    starts = np.cumsum([0, *[len(v.terms) for _, v in texts]])
    return df.select(*keep, *[t.alias(f"_t{k}") for k, t in enumerate(units)],
                     (F.array(*[c.cast("double") for c in numeric]) if numeric else F.array().cast("array<double>")).alias("_num")), how, starts


def vectorise(df: DataFrame, keep: Sequence[str], texts: Sequence[tuple[Column | Grams, Vocabulary]], numeric: Sequence[Column] = ()) -> DataFrame:
    """[TF-IDF blocks || numeric] as sparse rows ``idx``, ``val`` beside the columns ``keep``; nothing is shuffled.

    The blocks lie one after another, each as wide as its vocabulary; zeros are left out."""
    shared = df.sparkSession.sparkContext.broadcast([v for _, v in texts])  # at most max_features terms each
    sources, how, starts = _sources(df, keep, texts, numeric)
    keep, width = list(keep), len(numeric)

    def run(batches):
        for b in _slices(batches):
            parts = []
            for k, v in enumerate(shared.value):
                row, at, tf = v.counts(b.column(f"_t{k}"), how[k])
                parts.append((row, at + starts[k], weigh(row, tf, v.idf[at], b.num_rows)))
            num = flat_lists(b.column("_num"))[1].astype(np.float64).reshape(b.num_rows, width)
            row, at = np.nonzero(num)
            row, at, w = _by_row([*parts, (row, at + starts[-1], num[row, at])])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *_lists(row, b.num_rows, at.astype(np.int32), w)], names=[*keep, "idx", "val"])
    schema = sources.select(*keep).withColumn("idx", F.array(F.lit(0))).withColumn("val", F.array(F.lit(0.0))).schema
    return sources.mapInArrow(run, schema)


class Packed:
    """The sparse rows of :func:`vectorise` with the terms' occurrences in place of their weights: some three bytes an entry.

    :meth:`rows` makes the weights, as they were."""

    def __init__(self, batch: pa.RecordBatch, vocabularies: Sequence[Vocabulary], how, starts: np.ndarray, width: int, targets: int):
        n = batch.num_rows
        parts = []
        for k, v in enumerate(vocabularies):
            row, at, tf = v.counts(batch.column(f"_t{k}"), how[k])
            parts.append((row, at + starts[k], tf))
        num = flat_lists(batch.column("_num"))[1].astype(np.float64).reshape(n, width)
        row, at = np.nonzero(num)
        self.numbers = num[row, at]
        row, at, tf = _by_row([*parts, (row, at + starts[-1], np.ones(len(row), np.int64))])
        self.size = np.bincount(row, minlength=n).astype(np.int32)
        self.index = at.astype(np.uint16 if starts[-1] + width <= 1 << 16 else np.int32)
        self.tf = tf.astype(np.min_scalar_type(int(tf.max(initial=1))))
        self.labels = flat_lists(batch.column("labels"))[1].astype(np.float64).reshape(n, targets)
        self.starts = starts

    def rows(self, idf: Sequence[np.ndarray]) -> Rows:
        first = np.concatenate([[0], np.cumsum(self.size, dtype=np.int64)])
        row, index = np.repeat(np.arange(len(self.size)), self.size), self.index.astype(np.int32)
        value = np.empty(len(index))
        number = index >= self.starts[-1]
        value[number] = self.numbers
        for k, own in enumerate(idf):
            here = np.flatnonzero((index >= self.starts[k]) & (index < self.starts[k + 1]))
            value[here] = weigh(row[here], self.tf[here].astype(np.float64), own[index[here] - self.starts[k]], len(self.size))
        return Rows(first, index, value, self.labels)


def packed(df: DataFrame, texts: Sequence[tuple[Column | Grams, Vocabulary]], numeric: Sequence[Column], targets: int) -> tuple[DataFrame, Callable[[bytes], Rows]]:
    """The rows that :func:`vectorise` makes, with their ``labels``, as a table of packed blocks (``block`` binary) and what unpacks one."""
    shared = df.sparkSession.sparkContext.broadcast([v for _, v in texts])
    sources, how, starts = _sources(df, ["labels"], texts, numeric)
    width, idf = len(numeric), [v.idf for _, v in texts]

    def run(batches):
        for b in _slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Packed(b, shared.value, how, starts, width, targets))], pa.binary())], names=["block"])
    return sources.mapInArrow(run, "block binary"), lambda block: pickle.loads(block).rows(idf)


def transform_frozen(docs: DataFrame, doc: str, terms: Column | Grams, fitted: DataFrame) -> DataFrame:
    """Weight new documents with a saved vocabulary / idf, never refit: (doc, term, idx, weight)."""
    v = Vocabulary.of(fitted)
    rows = vectorise(docs, [doc], [(terms, v)])
    names = F.array(*[F.lit(t) for t in v.terms.to_pylist()]) if len(v.terms) else F.array().cast("array<string>")
    return rows.select(doc, F.inline(F.arrays_zip("idx", F.col("val").alias("weight")))).select(
        doc, F.get(names, F.col("idx")).alias("term"), "idx", "weight")


# ------------------------------------------------------------ vectors
def assemble(df: DataFrame, inputs: Sequence[str], out: str = "features") -> DataFrame:
    """Horizontal concatenation of vector and numeric columns."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(inputs), outputCol=out).transform(df)


def array_to_vec(c: Column) -> Column:
    from pyspark.ml.functions import array_to_vector
    return array_to_vector(c)


# ------------------------------------------------------------ embeddings
def mean_pool(tokens: DataFrame, group: str, vec: str = "embedding", mask: Column | None = None) -> DataFrame:
    """Masked mean of token vectors per group, denominator floored at 1e-9.

    Sums are per (group, dimension) - algebraic, partially aggregated; the
    final list is bounded by the embedding width."""
    m = mask if mask is not None else F.lit(1.0)
    d = tokens.select(group, m.cast("double").alias("_m"), F.posexplode(vec).alias("dim", "v"))
    g = d.groupBy(group, "dim").agg((F.sum(F.col("v").cast("double") * F.col("_m")) /
                                     F.greatest(F.sum("_m"), F.lit(1e-9))).alias("v"))
    return g.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "v"))),
                                            lambda x: x["v"]).alias("pooled"))


def l2_norm(c: Column) -> Column:
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalise(c: Column) -> Column:
    """V / max(||v||, 1e-10)."""
    n = F.greatest(l2_norm(c), F.lit(1e-10))
    return F.transform(c, lambda x: x.cast("double") / n)
