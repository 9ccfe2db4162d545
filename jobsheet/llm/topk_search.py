"""Exact top-k by inner product: columnar branch and bound (operator 11).

Vectors become integer components floor(``scale`` * x).  Candidates are packed into tiles of
``TILE`` vectors in vertical layout: one run of values per dimension.  A task holds
the tiles of one candidate group (at most ``GROUP_BYTES``) and streams query blocks
past them.  For a query block and a tile, partial products are accumulated one
block of ``STEP`` dimensions at a time, the tile's heaviest dimensions first.  What the
other dimensions can still add is at most the product of the remaining masses
(lengths) of query and candidate; candidates whose sum plus that bound stays below
the query's k-th best score so far are dropped and the survivors compacted, so the
later dimensions are read for survivors only.  Scores are exact integers: the sums run
in float32 or float64 only where no sum can leave the exact range.

Candidate groups and query splits form a grid of cells.  One cell is one
sequential task's work; a query gets at most k + 1 rows from each group, merged at the end.
With many groups every query visits each group once and every candidate is sent once; with
few groups the queries are split, and candidates sent at most ``CELLS`` times.

Defined results: a null id or vector, or one with a null or non-finite component, takes no
part; a shorter vector counts as filled up with zeros (an empty one scores 0); repeated
rows are rows of their own: a query leaves out one row only, its own, and repeated query
rows are answered each; ties go to the smaller id; an empty table or no query gives no
rows; other columns are ignored; components beyond 64 bits saturate, and scores
that don't fit 64 bits raise an OverflowError.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsheet.llm.common import bounded_batches, keep

TILE = 4096
QUERIES = 64
STEP = 16
GROUP_BYTES = 128 << 20
CELLS = 32
_LEAST = np.iinfo(np.int64).min


def usable(id_col: str, vec_col: str) -> Column:
    """The id is there and the vector has only finite components."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.coalesce(finite, F.lit(False))


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .where(usable("vec_id", "v")).select("vec_id", x_of("v", scale).alias("x"))


def x_of(vec_col: str, scale: float) -> Column:
    return F.transform(vec_col, lambda c: F.floor(c * F.lit(float(scale))))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of int64, filled up with zeros to the longest."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if not len(sizes):
        return np.zeros((0, 0), np.int64)
    width = int(sizes.max())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _packed(size: int):
    """Arrow batches of (uid, vec_id, x) to one row for each ``size`` vectors, values dimension by dimension."""
    def pack(batches):
        for b in batches:
            for at in range(0, b.num_rows, size):
                part = b.slice(at, size)
                x = _matrix(part.column("x"))
                most = int(max(x.max(), -x.min())) if x.size else 0  # the least long has no positive twin
                kind = "<i2" if 0 <= most < 1 << 15 else "<i4" if 0 <= most < 1 << 31 else "<i8"
                yield pa.RecordBatch.from_pylist([{
                    "n": len(x), "kind": kind, "uids": part.column("uid").to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                    "ids": part.column("vec_id").to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                    "x": np.ascontiguousarray(x.T.astype(kind)).tobytes()}], schema=_PACKED)
    return pack


_PACKED = pa.schema([("n", pa.int32()), ("kind", pa.string()), ("uids", pa.binary()), ("ids", pa.binary()), ("x", pa.binary())])
_PACKED_SQL = "n int, kind string, uids binary, ids binary, x binary"


def _vertical(row) -> np.ndarray:
    return np.frombuffer(row["x"], row["kind"]).reshape(-1, row["n"]) if row["x"] else np.zeros((0, row["n"]), np.int16)


class Tile:
    """Candidates in vertical layout, heaviest dimension first, with the mass left after each step."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, (self.dims, self.n) = ids, x.shape
        square = x.astype(np.float64) ** 2
        self.order = np.argsort(-square.sum(1), kind="stable")
        self.x, square = x[self.order], square[self.order]
        self.starts = list(range(0, self.dims, STEP))
        left = np.cumsum(square[::-1], 0)[::-1]
        self.left = [np.sqrt(left[s + STEP]) if s + STEP < self.dims else None for s in self.starts]
        self.most = float(np.abs(x.astype(np.float64)).max()) if x.size else 0.0
        self._as: dict[type, np.ndarray] = {}

    def values(self, kind: type) -> np.ndarray:
        if kind not in self._as:
            self._as = {kind: self.x.astype(kind)}  # one at a time
        return self._as[kind]


class Heaps:
    """The k best (score, id) of each query: higher score first, then smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), _LEAST)
        self.id = np.zeros((queries, k), np.int64)
        self.size = np.zeros(queries, np.int64)

    def least(self) -> np.ndarray:
        """What a candidate must reach."""
        return np.where(self.size == self.k, self.score[:, -1].astype(np.float64), -np.inf)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        held = np.arange(self.k) < self.size[:, None]
        r = np.concatenate([np.nonzero(held)[0], row])
        s, i = np.concatenate([self.score[held], score]), np.concatenate([self.id[held], ids])
        order = np.lexsort((i, ~s, r))  # ~s falls as s rises, without overflow
        r, s, i = r[order], s[order], i[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        best = place < self.k
        r, place = r[best], place[best]
        self.score[r, place], self.id[r, place] = s[best], i[best]
        self.size = np.bincount(r, minlength=len(self.size))


def search_tile(tile: Tile, q: np.ndarray, heaps: Heaps) -> None:
    """Put the tile's candidates that can be among the best of the queries ``q`` (a row each) into the heaps."""
    d = min(tile.dims, q.shape[1])
    if not d or not tile.n:  # nothing to multiply: every score is 0
        rows = np.repeat(np.arange(len(q)), tile.n)
        return heaps.add(rows, np.zeros(len(rows), np.int64), np.tile(tile.ids, len(q)))
    full = np.zeros((len(q), tile.dims), np.int64)
    full[:, :d] = q[:, :d]
    full = full[:, tile.order]
    bound = float(np.abs(full.astype(np.float64)).max()) * tile.most * tile.dims
    if bound >= 2**63:
        raise OverflowError("an inner product doesn't fit 64 bits")
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
    x, qs, least = tile.values(kind), full.astype(kind), heaps.least()
    mass = np.cumsum((full.astype(np.float64) ** 2)[:, ::-1], 1)[:, ::-1]
    total = rows = cols = None  # sums of all pairs; once few survive, of the pairs (rows, cols) alone
    for at, s in enumerate(tile.starts):
        e = min(s + STEP, tile.dims)
        if rows is None:
            part = qs[:, s:e] @ x[s:e]
            total = part if total is None else total + part
        else:
            for j in range(s, e):  # one dimension after another, survivors only
                total += qs[rows, j] * x[j][cols]
        if tile.left[at] is None:
            break
        rest = np.sqrt(mass[:, e]) * (1 + 1e-9) + 1e-9
        if rows is None:
            alive = total + rest[:, None] * tile.left[at] >= least[:, None]
            if np.count_nonzero(alive) * 4 <= alive.size:
                rows, cols = np.nonzero(alive)
                total = total[alive]
        else:
            alive = total + rest[rows] * tile.left[at][cols] >= least[rows]
            rows, cols, total = rows[alive], cols[alive], total[alive]
    if rows is None:
        floor = least
        if tile.n > heaps.k:  # at most the tile's own k best, with their ties
            floor = np.maximum(least, np.partition(total, tile.n - heaps.k, axis=1)[:, tile.n - heaps.k])
        rows, cols = np.nonzero(total >= floor[:, None])
        total = total[rows, cols]
    else:
        alive = total >= least[rows]
        rows, cols, total = rows[alive], cols[alive], total[alive]
    heaps.add(rows, total.astype(np.int64), tile.ids[cols])


def _search(k: int):
    def run(batches):
        cell, tiles = None, []
        for b in batches:
            for row in b.to_pylist():
                if row["cell"] != cell:
                    cell, tiles = row["cell"], []
                ids = np.frombuffer(row["ids"], "<i8")
                if not row["is_query"]:
                    tiles.append(Tile(ids, _vertical(row)))
                    continue
                q = np.ascontiguousarray(_vertical(row).T).astype(np.int64)
                heaps = Heaps(len(q), k + 1)
                for tile in tiles:
                    search_tile(tile, q, heaps)
                held = np.arange(k + 1) < heaps.size[:, None]
                at = np.nonzero(held)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["uids"], "<i8")[at]), pa.array(ids[at]), pa.array((q * q).sum(1)[at]),
                     pa.array(heaps.id[held]), pa.array(heaps.score[held])], names=["uid", "query_id", "own", "vec_id", "score"])
    return run


def top_k(df: DataFrame, queries: DataFrame | None = None, k: int = 5, scale: float = 256, id_col: str = "vec_id",
          vec_col: str = "embedding", group_bytes: int = GROUP_BYTES, cells: int = CELLS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest scores among the rows of ``df`` but its own.

    ``queries`` are rows of ``df``; by default those whose id is divisible by 50."""
    spark = df.sparkSession
    if queries is None:
        queries = df.where(F.col(id_col).cast("long") % 50 == 0)
    with bounded_batches(spark, TILE, 64):
        rows = integer_vectors(df, id_col, vec_col, scale).withColumn("uid", F.lit(0).cast("long"))
        tiles = keep(rows.mapInArrow(_packed(TILE), _PACKED_SQL), "topk-tiles")
        asked = keep(integer_vectors(queries, id_col, vec_col, scale).withColumn("uid", F.monotonically_increasing_id()), "topk-queries")
        blocks = keep(asked.mapInArrow(_packed(QUERIES), _PACKED_SQL), "topk-query-blocks")
    size, n_blocks = tiles.select(F.coalesce(F.sum(F.col("n") * 8 * F.greatest(
        F.lit(1), F.length("x") / F.when(F.col("kind") == "<i2", 2).when(F.col("kind") == "<i4", 4).otherwise(8) / F.col("n"))),
        F.lit(0))).first()[0], blocks.count()
    groups = max(1, -(-int(size) // group_bytes))
    splits = max(1, min(-(-cells // groups), n_blocks))
    g, s = F.pmod(F.xxhash64("ids", "x"), F.lit(groups)), F.pmod(F.xxhash64("uids"), F.lit(splits))
    held = tiles.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(splits - 1)), lambda i: g * splits + i)).alias("cell"),
                        F.lit(False).alias("is_query"), "*")
    sent = blocks.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda i: i * splits + s)).alias("cell"),
                         F.lit(True).alias("is_query"), "*")
    dealt = held.unionByName(sent).repartitionByRange(groups * splits, "cell").sortWithinPartitions("cell", "is_query")
    with bounded_batches(spark, 64, 16):
        best = keep(dealt.mapInArrow(_search(k), "uid long, query_id long, own long, vec_id long, score long"), "topk-best")
    w = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    mine = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own"))
    ranked = best.withColumn("mine", mine).withColumn("place", F.row_number().over(w)) \
        .withColumn("seen", F.sum(F.col("mine").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.where(~(F.col("mine") & (F.col("seen") == 1))) \
        .withColumn("rank", (F.col("place") - (F.col("seen") > 0).cast("int")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
