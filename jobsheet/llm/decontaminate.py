"""Benchmark decontamination by suffix arrays of the training texts (operator 7).

A task reads its documents in shards of at most ``SHARD_WORDS`` words (or one
document) and builds the shard's suffix array over word ids: the positions whose
suffix can begin a match at all, sorted by their next ``window`` words.  Every
test suffix is binary-searched in every shard.  Equal neighbours in the array
are one range, so a search yields all places of a suffix; a match longer than
the window is a chain of windows at consecutive places, joined afterwards into
longest verbatim matches.  A document lies wholly within one shard, so its
result is complete there: nothing is shuffled.

The tests are the stated query set.  They are read in blocks of at most
``block_bytes``, written as one file each to the shared folder, and every shard
is searched for one block after another, so memory holds one block at a time.

Defined results: null and empty texts have no words and are clean; an item
without words has no window; items with equal ids count as one item; a null
item id is written as an empty string; repeated documents are judged one by
one; without tests every document is clean; other columns pass through.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from jobsheet.llm.common import make_folder, open_fs, run_folder, small_batches

SHARD_WORDS = 250_000
BLOCK_BYTES = 32 << 20
#: Fixed value: digits, letters (A-Z lower-cased before) and everything beyond ASCII; as UTF-8 bytes.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []  # bytes.lower: A-Z only


def _keys(ids: np.ndarray, at: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """The next ``width`` ids of each place as one byte string in order of comparison; 0 from ``sizes`` on."""
    k = np.arange(width)
    grid = ids[np.minimum(at[:, None] + k, len(ids) - 1)]
    grid[k >= sizes[:, None]] = 0
    return np.ascontiguousarray(grid.astype(">u4")).view(f"S{4 * width}").ravel()


def build_block(items: list[tuple[str | None, str | None]], window: int) -> dict:
    """The distinct windows of these test items and, for each, its items."""
    vocab: dict[bytes, int] = {}
    names = sorted({i or "" for i, _ in items})
    number = {n: k for k, n in enumerate(names)}
    seqs = [(number[i or ""], [vocab.setdefault(w, len(vocab) + 1) for w in words(t)]) for i, t in items]
    ids, at, sizes, owner, place, base = [], [], [], [], [], 0
    for item, seq in seqs:
        n = len(seq)
        starts = range(max(1, n - window + 1)) if n else ()
        at += [base + s for s in starts]
        sizes += [min(window, n)] * len(starts)
        owner += [item] * len(starts)
        place += starts
        ids += [*seq, 0]  # 0 between texts: no match goes on in the next
        base += n + 1
    if not at:
        return {"vocab": {}, "least": 0}
    ids, at, sizes = np.array(ids, np.int64), np.array(at), np.array(sizes)
    low, where, inverse = np.unique(_keys(ids, at, sizes, window), return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([inverse, np.array(owner)], 1), axis=0)
    sizes = sizes[where]
    high = low.astype(f"S{4 * window}").view(np.uint8).reshape(len(low), -1).copy()
    high[np.arange(4 * window) >= 4 * sizes[:, None]] = 0xFF
    order = np.argsort(inverse, kind="stable")  # every window's places in the tests
    return {"places": at[order], "place_first": np.searchsorted(inverse[order], np.arange(len(low) + 1)), "place_item": np.array(owner)[order],
            "place_in_item": np.array(place)[order], "vocab": vocab, "names": names, "low": low, "high": high.view(f"S{4 * window}").ravel(), "sizes": sizes,
            "first": np.searchsorted(pairs[:, 0], np.arange(len(low) + 1)), "items": pairs[:, 1],
            "least": int(sizes.min()), "window": window}


def _save(block: dict, out) -> None:
    """A block as plain arrays: reading it executes nothing."""
    plain = {k: v for k, v in block.items() if k not in ("vocab", "names")}
    words_ = np.frombuffer(b"\n".join(block["vocab"]), np.uint8)  # numbered from 1 in this order
    buffer = io.BytesIO()
    np.savez(buffer, words=words_, item_names=np.frombuffer(json.dumps(block["names"]).encode(), np.uint8), **plain)
    out.write(buffer.getvalue())


def _load(data: bytes) -> dict:
    with np.load(io.BytesIO(data), allow_pickle=False) as f:
        block = {k: f[k] for k in f.files}
    block["vocab"] = {w: k for k, w in enumerate(block.pop("words").tobytes().split(b"\n"), 1)}
    block["names"] = json.loads(block.pop("item_names").tobytes())
    return block | {"least": int(block["least"]), "window": int(block["window"])}


def _write_blocks(tests: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> tuple[str, list[str]]:
    spark = tests.sparkSession
    rows = tests.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).filter("t is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    if n > 1:  # dealt once; then each block is a folder of its own
        dealt = run_folder(spark, "benchmark-rows")
        rows.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(n))).write.partitionBy("b").parquet(dealt)
        rows = spark.read.parquet(dealt)
    folder = make_folder(spark, run_folder(spark, "benchmark-blocks"))
    fs, base = open_fs(folder)
    names = []
    for b in range(n if total else 0):
        part = (rows if n == 1 else rows.filter(F.col("b") == b)).collect()  # bounded by block_bytes
        block = build_block([(r.i, r.t) for r in part], window)
        if block["least"]:
            names.append(f"block-{b}.npz")
            with fs.open_output_stream(os.path.join(base, names[-1])) as f:
                _save(block, f)
    return folder, names


_LAST: dict[str, dict] = {}


def _block(folder: str, name: str) -> dict:
    key = f"{folder}/{name}"
    if key not in _LAST:
        _LAST.clear()  # one block at a time
        fs, base = open_fs(folder)
        with fs.open_input_stream(os.path.join(base, name)) as f:
            _LAST[key] = _load(f.read())
    return _LAST[key]


def search(ids: np.ndarray, block: dict) -> tuple[np.ndarray, np.ndarray]:
    """All (place, test window) at which a window of the block occurs in ``ids``, where 0 matches nothing."""
    zero = np.append(np.flatnonzero(ids == 0), len(ids))
    run = zero[np.searchsorted(zero, np.arange(len(ids)))] - np.arange(len(ids))  # words up to the next that no test has
    at = np.flatnonzero(run >= block["least"])
    if not len(at):
        return at, at
    keys = _keys(np.append(ids, 0), at, np.minimum(run[at], block["window"]), block["window"])
    order = np.argsort(keys, kind="stable")  # the shard's suffix array
    keys, at = keys[order], at[order]
    lo, hi = np.searchsorted(keys, block["low"], "left"), np.searchsorted(keys, block["high"], "right")
    n = hi - lo
    test = np.repeat(np.arange(len(n)), n)
    return at[np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)], test


def longest_matches(at: np.ndarray, test: np.ndarray, block: dict) -> tuple[np.ndarray, ...]:
    """Verbatim matches as (length, place here, item, place in the item): windows at consecutive places both
    here and in one test text are one match."""
    n = block["place_first"][test + 1] - block["place_first"][test]
    ends = np.cumsum(n)
    k = np.arange(ends[-1]) - np.repeat(ends - n - block["place_first"][test], n)  # every place of every window found
    here, size = np.repeat(at, n), np.repeat(block["sizes"][test], n)
    lag = here - block["places"][k]
    order = np.lexsort((here, lag))
    here, lag, k, size = here[order], lag[order], k[order], size[order]
    head = np.concatenate([[True], (np.diff(lag) != 0) | (np.diff(here) != 1)])
    first = np.flatnonzero(head)
    run = np.diff(np.append(first, len(here)))
    return run - 1 + size[first], here[first], block["place_item"][k[first]], block["place_in_item"][k[first]]


def _judge(docs: list[list[bytes]], folder: str, blocks: list[str], places: bool = False):
    """For each document: words, hit words, covered words, sorted item ids, longest match (with ``places``)."""
    sizes = np.array([len(d) for d in docs])
    starts = np.cumsum(sizes + 1) - sizes - 1
    total = int((sizes + 1).sum())
    hit = np.zeros(total + 1, np.int64)
    found: list[set[str]] = [set() for _ in docs]
    longest: list[tuple | None] = [None] * len(docs)
    for name in blocks:
        block = _block(folder, name)
        get = block["vocab"].get
        ids = np.fromiter((x for d in docs for x in (*[get(w, 0) for w in d], 0)), np.int64, total)
        at, test = search(ids, block)
        if not len(at):
            continue
        np.add.at(hit, at, 1)
        np.add.at(hit, at + block["sizes"][test], -1)
        doc = np.searchsorted(starts, at, "right") - 1
        for d, t in np.unique(np.stack([doc, test], 1), axis=0).tolist():
            found[d].update(block["names"][i] for i in block["items"][block["first"][t]:block["first"][t + 1]].tolist())
        if places:
            length, here, item, place = longest_matches(at, test, block)
            owner = np.searchsorted(starts, here, "right") - 1
            for k in np.lexsort((place, item, here, -length)).tolist():  # the longest, then the first here
                d = int(owner[k])
                own = (-int(length[k]), int(here[k] - starts[d]), block["names"][item[k]], int(place[k]))
                if longest[d] is None or own < longest[d]:
                    longest[d] = own
    covered = np.cumsum(hit[:-1]) > 0
    sums = np.append(0, np.cumsum(covered))
    for d, (s, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
        n_hit = int(sums[s + n] - sums[s])
        yield n, n_hit, covered[s:s + n] if n_hit else None, sorted(found[d]), longest[d]


def _spans(covered: np.ndarray | None) -> list[dict]:
    if covered is None:
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _shards(batches, text_col: str):
    """(rows of a batch, their words) in shards of bounded size."""
    for b in batches:
        docs, lo, size = [], 0, 0
        for i, text in enumerate(b.column(text_col).to_pylist()):
            docs.append(words(text))
            size += len(docs[-1])
            if size >= SHARD_WORDS:
                yield b.slice(lo, i + 1 - lo), docs
                docs, lo, size = [], i + 1, 0
        if docs:
            yield b.slice(lo), docs


def contamination(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: id, n_words, n_hit, items (sorted ids), items_sha256, spans (hit words, start and end), longest, contaminated.

    ``longest`` is the longest verbatim match with one test text (of equal ones the first here): its words, its place here and in the item."""
    small_batches(docs.sparkSession)
    folder, blocks = _write_blocks(tests, item_col, item_text_col, window, block_bytes)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ddl = (f"id {source.schema['id'].dataType.simpleString()}, n_words long, n_hit long, items array<string>,"
           " items_sha256 string, spans array<struct<start:long,end:long>>, longest struct<length:long,place:long,item:string,item_place:long>,"
           " contaminated boolean")

    def run(batches):
        out = to_arrow_schema(schema)
        for rows, texts in _shards(batches, "text"):
            cols = [[] for _ in range(7)]
            for n, n_hit, covered, items, best in _judge(texts, folder, blocks, True):
                values = (n, n_hit, items, hashlib.sha256(",".join(items).encode()).hexdigest(), _spans(covered),
                          best and {"length": -best[0], "place": best[1], "item": best[2], "item_place": best[3]}, n_hit > 0)
                for c, v in zip(cols, values, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), *(pa.array(c, f.type) for c, f in zip(cols, list(out)[1:], strict=True))], schema=out)

    schema = source.sparkSession.createDataFrame([], ddl).schema
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def remove_contaminated(docs: DataFrame, tests: DataFrame, text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without a test window, all columns as they were."""
    small_batches(docs.sparkSession)
    folder, blocks = _write_blocks(tests, item_col, item_text_col, window, block_bytes)

    def run(batches):
        for rows, texts in _shards(batches, text_col):
            yield rows.filter(pa.array([n_hit == 0 for _, n_hit, _, _, _ in _judge(texts, folder, blocks)]))

    return docs.mapInArrow(run, docs.schema)
