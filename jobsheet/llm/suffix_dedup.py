"""Removal of repeated byte strings by partitioned suffix sorting (operator 9).

Every byte is the start of a suffix, far too many to shuffle.  Of each window
of ``length`` bytes the suffix at the least hashed ``GRAM`` bytes is chosen: equal
windows choose equal places, so two equal windows always meet as two chosen
suffixes with equal leading tokens (the gram), and about one suffix in
``(length - GRAM) / 2`` bytes is left.  Grams that occur once are dropped.

The rest are range-partitioned by their leading tokens with splitters sampled
from the repeated suffixes; equal leading tokens never lie on both sides of a
splitter, so all that has to be compared meets in one bucket.  Inside a group of
equal grams the suffixes are sorted by multikey quicksort on 8-byte tokens, to the
right and (for what stands before them) to the left.  A neighbour proves the windows
that both share; windows that the neighbours leave open, but whose longest matches
on both sides leave room, are settled by their hashes over the whole group.

A group beyond ``MAX_GROUP`` suffixes is no one task's: the hashes of its windows
are counted by key, combined before the shuffle, and joined back.

Defined results: null and empty texts have no bytes; texts shorter than
``length`` lose nothing; of repeated rows each is a document, so both lose what they
share; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from jobsheet.llm.common import keep, partitions, small_batches

LENGTH, GRAM, PERIOD = 400, 32, 16
SLICE = 1 << 20  #: bytes of text that are hashed at once; longer texts in overlapping slices
MAX_GROUP = 20_000
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _table(name: str, n: int) -> np.ndarray:
    if name not in _TABLES or len(_TABLES[name]) < n:
        _TABLES[name] = _powers(_BASE if name == "up" else _INVERSE, max(n, 1 << 16))
    return _TABLES[name][:n]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A non-zero hash of the GRAM bytes from every place on."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _table("up", len(data)))])
    h = (sums[GRAM:] - sums[:-GRAM]) * _table("down", len(data) - GRAM + 1)
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return ((h ^ h >> np.uint64(32)) >> np.uint64(1) | np.uint64(1)) | _periodic(data) << np.uint64(63)


def _periodic(data: np.ndarray) -> np.ndarray:
    """1 where the gram repeats itself with a period of up to PERIOD bytes: chosen only where a window has no other gram."""
    n = len(data) - GRAM + 1
    found = np.zeros(n, bool)
    for p in range(1, PERIOD + 1):
        same = data[p:] == data[:-p]
        # A run of GRAM - p >= 16 equal bytes holds 8 aligned ones; without such a run nothing has the period.
        if (same[:len(same) // 8 * 8].view(np.uint64) == 0x0101010101010101).any():
            sums = np.concatenate([np.zeros(1, np.int32), np.cumsum(same, dtype=np.int32)])
            found |= (sums[GRAM - p:] - sums[:p - GRAM])[:n] == GRAM - p
    return found.astype(np.uint64)


def _sliding(x: np.ndarray, w: int, best, worst) -> np.ndarray:
    """``best`` of each ``w`` adjoining values."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, worst, x.dtype)
    padded[:len(x)] = x
    rows = padded.reshape(-1, w)
    right = best.accumulate(rows, axis=1).ravel()
    left = np.ascontiguousarray(best.accumulate(rows[:, ::-1], axis=1)[:, ::-1]).ravel()
    return best(left[:n], right[w - 1:w - 1 + n])


def _chosen(v: np.ndarray, least: np.ndarray, w: int) -> np.ndarray:
    """For every window with a ``least`` the leftmost place that has it."""
    padded = np.zeros(len(least) + 2 * (w - 1), np.uint64)
    padded[w - 1:w - 1 + len(least)] = least
    at = np.flatnonzero(v == _sliding(padded, w, np.maximum, np.uint64(0)))  # with ties
    if not len(at):
        return at
    # The leftmost changes only where the least value does or where the window leaves a place behind.
    moved = np.zeros(len(least) + 1, bool)
    moved[0] = True
    moved[1:-1] = least[1:] != least[:-1]
    moved[at[at < len(least)] + 1] = True
    s = np.flatnonzero(moved[:-1] & (least > 0))
    values = np.unique(v[at])
    keys = np.sort(np.searchsorted(values, v[at]) * (len(v) + 1) + at)
    found = keys[np.searchsorted(keys, np.searchsorted(values, least[s]) * (len(v) + 1) + s)]
    return np.unique(found % (len(v) + 1))


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Places and hashes of the grams that some window chooses, and the bytes (start, stop) that are proven
    repeated already; windows don't cross ``ends``.

    Text with a short period would choose a place in every period.  There, a window equals one a period
    earlier: both are proven by comparing the text with itself, and only the earliest of them still chooses.
    """
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), []
    v, w = gram_hashes(data), length - GRAM + 1
    least = _sliding(v, w, np.minimum, np.uint64(2**64 - 1))
    for e in ends[:-1].tolist():  # windows over a text's end choose nothing
        least[max(0, e - length + 1):e] = 0
    chosen = _chosen(v, least, w)
    doc, gap = np.searchsorted(ends, chosen, "right"), np.diff(chosen)
    tied = (v[chosen[1:]] == v[chosen[:-1]]) & (doc[1:] == doc[:-1]) & (gap < w)
    if not tied.any():
        return chosen, v[chosen], []
    proven = np.zeros(len(least), bool)
    for d, p in np.unique(np.stack([doc[1:][tied], gap[tied]], 1), axis=0).tolist():
        lo, hi = int(ends[d - 1]) if d else 0, int(ends[d])
        equal = np.concatenate([[0], np.cumsum(data[lo + p:hi] == data[lo:hi - p])])
        earlier = lo + np.flatnonzero(equal[length:] - equal[:-length] == length)
        least[earlier + p] = 0
        proven[earlier] = proven[earlier + p] = True
    chosen = _chosen(v, least, w)
    return chosen, v[chosen], [(a, z + length) for a, z in _runs(proven)]


def _chunks(texts: list[bytes], length: int):
    """(row, offset in its text, bytes) of texts that are long enough, in overlapping slices."""
    for row, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), SLICE):
            if len(t) >= length:
                yield row, at, t[at:at + SLICE + length - 1]


def _bytes(column) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _anchors(length: int):
    """Chosen suffixes (gram, h, pos) and spans that are proven already (no gram; pos to stop)."""
    schema = pa.schema([("gram", pa.int64()), ("h", pa.int64()), ("pos", pa.int64()), ("stop", pa.int64())])

    def packed(parts, h):
        sizes = np.array([len(x) for *_, x in parts])
        ends = np.cumsum(sizes)
        shift = np.array([p[1] for p in parts]) - (ends - sizes)
        rows = np.array([p[0] for p in parts])
        at, gram, spans = anchors(np.frombuffer(b"".join(x for *_, x in parts), np.uint8), ends, length)
        which = np.searchsorted(ends, at, "right")
        # slices overlap: a place chosen in two of them is one
        first = np.unique(np.stack([rows[which], at + shift[which]], 1), axis=0, return_index=True)[1] if len(at) else at
        at, gram, which = at[first], gram[first], which[first]
        start, stop = (np.array([x[i] for x in spans], np.int64) for i in (0, 1))
        of = np.searchsorted(ends, start, "right")
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(gram.view(np.int64), np.zeros(len(of), np.int64)), mask=np.arange(len(at) + len(of)) >= len(at)),
             pa.array(h[np.append(rows[which], rows[of])]), pa.array(np.append(at + shift[which], start + shift[of])),
             pa.array(np.append(np.zeros(len(at), np.int64), stop + shift[of]))], schema=schema)

    def run(batches):
        for b in batches:
            h, parts, size = b.column("h").to_numpy(), [], 0
            last = None
            for part in _chunks(_bytes(b.column("text")), length):
                if size >= SLICE and part[0] != last:
                    yield packed(parts, h)
                    parts, size = [], 0
                parts.append(part)
                last, size = part[0], size + len(part[2])
            if parts:
                yield packed(parts, h)

    return run


def _contexts(length: int, splitters):
    """Each repeated suffix with the bytes that any of its windows can hold."""
    schema = pa.schema([("bucket", pa.int32()), ("gram", pa.int64()), ("hot", pa.bool_()), ("h", pa.int64()), ("pos", pa.int64()), ("before", pa.int32()), ("bytes", pa.binary())])

    def run(batches):
        edges = splitters.value
        for b in batches:
            cols = [[] for _ in range(6)]
            for h, t, places in zip(b.column("h").to_pylist(), _bytes(b.column("text")), b.column("places").to_pylist(), strict=True):
                for p in places or ():
                    at = p["pos"]
                    lo = max(0, at - (length - GRAM))
                    for c, x in zip(cols, (p["gram"], p["hot"], h, at, at - lo, t[lo:at + length]), strict=True):
                        c.append(x)
            gram = np.array(cols[0], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(edges, gram, "right").astype(np.int32)), pa.array(gram), pa.array(cols[1], pa.bool_()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.binary())], schema=schema)

    return run


def multikey_order(x: np.ndarray) -> np.ndarray:
    """The order of the rows of a byte matrix by multikey quicksort on 8-byte tokens: rows that tie on a token,
    and they alone, go on to the next; a few rows are sorted at once."""
    if len(x) <= 64:
        rows = [r.tobytes() for r in x]
        return np.array(sorted(range(len(x)), key=rows.__getitem__))
    keys = np.ascontiguousarray(x).view(">u8").astype(np.uint64)
    order = np.argsort(keys[:, 0], kind="stable")
    runs = [(0, len(x), 0)]
    while runs:
        lo, hi, k = runs.pop()
        part = order[lo:hi]
        part = part[np.argsort(keys[part, k], kind="stable")]
        order[lo:hi] = part
        if k + 1 < keys.shape[1]:
            cut = np.concatenate([[0], np.flatnonzero(np.diff(keys[part, k])) + 1, [hi - lo]])
            runs += [(lo + a, lo + z, k + 1) for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) if z - a > 1]
    return order


def _pair(before: np.ndarray, texts: list[bytes], reach: int, length: int) -> np.ndarray:
    (s, t), (i, j) = (np.frombuffer(x, np.uint8) for x in texts), before.tolist()
    n = min(len(s) - i, len(t) - j)
    differ = np.flatnonzero(s[i:i + n] != t[j:j + n])
    right = differ[0] if len(differ) else n
    n = min(i, j)
    differ = np.flatnonzero(s[i - n:i] != t[j - n:j])
    left = n - 1 - differ[-1] if len(differ) else n
    proven = np.zeros((2, reach + 1), bool)
    proven[:, max(0, length - right):left + 1] = True
    return proven


def _common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the rows of two byte matrices, at most ``most``."""
    differ = a != b
    n = np.where(differ.any(1), differ.argmax(1), a.shape[1])
    return np.minimum(n, most)


def group_windows(before: np.ndarray, texts: list[bytes], length: int) -> np.ndarray:
    """For every suffix of a group and every o from 0 to length - GRAM: does the window that begins o
    bytes before the suffix occur at another suffix of the group?"""
    m, reach = len(texts), length - GRAM
    if m == 2:
        return _pair(before, texts, reach, length)
    x = np.zeros((m, reach + length), np.uint8)
    after = np.empty(m, np.int64)
    for i, (t, l) in enumerate(zip(texts, before.tolist(), strict=True)):
        after[i] = len(t) - l
        x[i, reach - l:reach + after[i]] = np.frombuffer(t, np.uint8)
    left, right = np.ascontiguousarray(x[:, :reach][:, ::-1]), np.ascontiguousarray(x[:, reach:])
    o = np.arange(reach + 1)
    proven = np.zeros((m, reach + 1), bool)
    most_l, most_r = np.zeros(m, np.int64), np.zeros(m, np.int64)
    for side in (right, left):
        order = multikey_order(side)
        a, b = order[:-1], order[1:]
        common_r = _common(right[a], right[b], np.minimum(after[a], after[b]))
        common_l = _common(left[a], left[b], np.minimum(before[a], before[b]))
        both = (o >= (length - common_r)[:, None]) & (o <= common_l[:, None])
        for i in (a, b):
            proven[i] |= both
            if side is right:
                most_r[i] = np.maximum(most_r[i], common_r)
            else:
                most_l[i] = np.maximum(most_l[i], common_l)
    open_ = (o >= (length - most_r)[:, None]) & (o <= most_l[:, None]) & ~proven
    for k in np.flatnonzero(open_.any(0)).tolist():
        rows = np.flatnonzero((before >= k) & (after >= length - k))
        part = np.ascontiguousarray(x[rows, reach - k:reach - k + length]).view("<u8")
        h = (part * _table("up", part.shape[1])).sum(1, dtype=np.uint64) if length % 8 == 0 else np.array([hash(r.tobytes()) for r in part])
        h = h ^ (_rotated(part) * _table("down", part.shape[1])).sum(1, dtype=np.uint64)
        _, at, times = np.unique(h, return_inverse=True, return_counts=True)
        proven[rows[times[at] > 1], k] = True
    return proven


def _rotated(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(33)) ^ (x << np.uint64(17)) ^ x


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def _bucket(length: int):
    schema = pa.schema([("h", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])

    def settle(group):
        before = np.array([g[2] for g in group], np.int64)
        for (h, pos, _, _), row in zip(group, group_windows(before, [g[3] for g in group], length), strict=True):
            for first, last in _runs(row):
                yield h, pos - last, pos - first + length

    def run(batches):
        gram, group = None, []
        for b in batches:
            out = []
            for g, *row in zip(*(b.column(c).to_pylist() for c in ("gram", "h", "pos", "before", "bytes")), strict=True):
                if g != gram:
                    if len(group) > 1:
                        out += settle(group)
                    gram, group = g, []
                group.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], schema=schema)
        out = list(settle(group)) if len(group) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], schema=schema)

    return run


def _window_hashes(length: int):
    """For suffixes of groups that no task should hold: the hash of each of their windows, by o."""
    def run(batches):
        for b in batches:
            hashes = []
            for l, t in zip(b.column("before").to_pylist(), b.column("bytes").to_pylist(), strict=True):
                own = {}
                for o in range(max(0, length - (len(t) - l)), l + 1):
                    own[o] = int.from_bytes(hashlib.blake2b(t[l - o:l - o + length], digest_size=8).digest(), "little", signed=True)
                hashes.append([{"o": k, "w": w} for k, w in own.items()])
            yield pa.RecordBatch.from_arrays(
                [b.column("gram"), b.column("h"), b.column("pos"), pa.array(hashes, pa.list_(pa.struct([("o", pa.int32()), ("w", pa.int64())])))],
                names=["gram", "h", "pos", "windows"])

    return run


def repeated_spans(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """(h, start, stop) of the repeated bytes of documents (id, h, text); spans of one document may overlap."""
    spark = keyed.sparkSession
    found = keep(keyed.select("h", "text").filter(F.octet_length("text") >= length).mapInArrow(_anchors(length), "gram long, h long, pos long, stop long"), "anchors")
    proven = found.filter("gram IS NULL").select("h", F.col("pos").alias("start"), "stop")
    found = found.filter("gram IS NOT NULL").select("gram", "h", "pos")
    often = found.groupBy("gram").agg(F.count("*").alias("times")).filter("times > 1")
    repeated = keep(found.join(often, "gram").select("gram", "h", "pos", (F.col("times") > MAX_GROUP).alias("hot")), "repeated-suffixes")
    n = partitions(spark)
    splitters = repeated.stat.approxQuantile("gram", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    edges = spark.sparkContext.broadcast(np.array(sorted(set(splitters)), np.float64))
    places = repeated.distinct().groupBy("h").agg(F.collect_list(F.struct("gram", "pos", "hot")).alias("places"))
    contexts = keyed.join(places, "h").select("id", "h", "text", "places").mapInArrow(
        _contexts(length, edges), "bucket int, gram long, hot boolean, h long, pos long, before int, bytes binary")
    buckets = contexts.filter("NOT hot").drop("hot").repartition(n, "bucket").sortWithinPartitions("gram")
    spans = proven.unionByName(buckets.mapInArrow(_bucket(length), "h long, start long, stop long"))
    if not repeated.filter("hot").isEmpty():
        w = contexts.filter("hot").mapInArrow(_window_hashes(length), "gram long, h long, pos long, windows array<struct<o:int,w:long>>") \
            .select("gram", "h", "pos", F.inline("windows"))
        w = keep(w, "window-hashes")
        twice = w.groupBy("gram", "o", "w").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
        spans = spans.unionByName(w.join(twice, ["gram", "o", "w"], "left_semi")
                                  .select("h", (F.col("pos") - F.col("o")).alias("start"), (F.col("pos") - F.col("o") + length).alias("stop")))
    return spans


def merged_runs(spans: list[dict] | None) -> list[tuple[int, int]]:
    runs: list[list[int]] = []
    for s, e in sorted((x["start"], x["stop"]) for x in spans or ()):
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(e, runs[-1][1])
        else:
            runs.append([s, e])
    return [(s, e) for s, e in runs]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that are left)."""
    spark = docs.sparkSession
    small_batches(spark)
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("text"))
    spans = repeated_spans(keyed, length).groupBy("h").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    schema = spark.createDataFrame([], f"id {keyed.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").schema

    def run(batches):
        out = to_arrow_schema(schema)
        for b in batches:
            cols = [[] for _ in range(5)]
            for t, s in zip(_bytes(b.column("text")), b.column("spans").to_pylist(), strict=True):
                runs = merged_runs(s)
                left = b"".join(t[a:z] for a, z in zip([0, *(e for _, e in runs)], [*(s for s, _ in runs), len(t)], strict=True))
                for c, v in zip(cols, (len(t), len(t) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, f.type) for c, f in zip(cols, list(out)[1:], strict=True))], schema=out)

    return keyed.join(spans, "h", "left").select("id", "h", "text", "spans").mapInArrow(run, schema).withColumnRenamed("id", id_col)
