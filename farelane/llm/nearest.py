"""Approximate nearest neighbours: Gaussian (2-stable) projections in kd-trees, with a chi-square stopping test (operator 10).

Largest inner product is turned into smallest distance by one more coordinate, ``sqrt(M**2 - |x|**2)`` (0 for a query), where
M is the largest norm of all vectors. Vectors are projected to ``DIMS`` coordinates with independent normal weights, so the squared
projected distance over the squared true distance follows a chi-square law with ``DIMS`` degrees of freedom.

Index: the top of a kd-tree over the projections is fitted on a bounded sample (about ``TOP_SAMPLE`` rows chosen by hash, projected where they
lie); every vector is put into its cell, and a cell of more than ``BLOCK`` rows (a region of copies, a drifted sample, or more than ``CELLS``
times ``BLOCK`` rows in all) is split by hash into blocks of about that size. Each block is a kd-tree of its own with leaves of ``LEAF`` vectors.

Search, in two rounds: first each query searches one block of its own cell; the k-th distance found there bounds the true one. Then it
goes to every block whose projected box may still hold a neighbour: the stopping test must not yet hold for the box's projected
distance and that bound. Within a block the leaves are read in order of projected distance, more each time, and all their vectors
are verified with exact inner products, until ``leaf distance**2 >= chi2_quantile(CONFIDENCE) * (k-th true distance)**2``: then a
vector not yet seen is nearer than the k-th with a probability of at most 1 - CONFIDENCE.

The queries that go to one block are dealt to chunks of about ``CHUNK``, and the block is copied to its own chunks alone, so no task holds more than one
block and one chunk, whatever their numbers. Copies of one vector meet within a block, where only as many of the smallest ids as can be
returned take part in the ranking, so a vector held by a third of all rows costs no more than any other. Among verified vectors ties are
exact: where scores at the cut can't be told apart in a matrix product they are computed again one by one, and of equal ones the smallest ids stay.

Edges: vectors that are null, zero, or hold null or non-finite components take no part, nor do those whose length is not the most frequent
one (ties: the shorter); a null vec_id takes no part. Rows with one vec_id are candidates and queries of their own; a query leaves
out only its own row, so its vec_id may be among its neighbours, and a repeated query_id has as many lists as rows. With fewer
than k candidates all are returned. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare, table

K = 20
#: Projected coordinates (even, so that the chi-square law has a closed form).
DIMS = 8
CONFIDENCE = 0.97
TOP_SAMPLE = 262_144
#: Vectors of a block, of a leaf of its tree, and queries of a chunk.
BLOCK, LEAF, CHUNK = 16_384, 128, 8192
#: Cells of the top tree at most; beyond that cells are split into more blocks.
CELLS = 65_536
SEED = 20
FOUND = "query_no long, query_id long, vec_id long, score double"


def chi2_quantile(p: float, dims: int = DIMS) -> float:
    """x with P(chi-square of an even number of degrees of freedom <= x) = p."""
    cdf = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
    low, high = 0.0, 1.0
    while cdf(high) < p:
        high *= 2
    for _ in range(100):
        low, high = (low, mid) if cdf(mid := (low + high) / 2) >= p else (mid, high)
    return high


@dataclass
class Top:
    """Upper kd-tree: cut dimension and value of the inner nodes in heap order; boxes of the cells in projected space."""

    projection: np.ndarray
    norm2: float
    cut_dim: np.ndarray
    cut_at: np.ndarray

    def lift(self, x: np.ndarray) -> np.ndarray:
        """With the coordinate that makes all norms equal."""
        return np.concatenate([x, np.sqrt(np.maximum(self.norm2 - (x * x).sum(axis=1), 0))[:, None]], axis=1)

    def project(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        if query:
            return x @ self.projection[:-1]
        return self.lift(x) @ self.projection

    def cells(self, p: np.ndarray) -> np.ndarray:
        node = np.zeros(len(p), np.int64)
        for _ in range(len(self.cut_dim).bit_length()):
            node = 2 * node + 1 + (p[np.arange(len(p)), self.cut_dim[node]] > self.cut_at[node])
        return node - len(self.cut_dim)


def fit_top(sample: np.ndarray, projection: np.ndarray, norm2: float, cells: int) -> Top:
    """From projected vectors."""
    depth = max(0, math.ceil(math.log2(max(1, cells))))
    top = Top(projection, norm2, np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1))
    parts = [sample]
    for node in range(2**depth - 1):
        p = parts[node]
        d = int(np.ptp(p, axis=0).argmax()) if len(p) else 0
        at = float(np.median(p[:, d])) if len(p) else 0.0
        top.cut_dim[node], top.cut_at[node] = d, at
        right = p[:, d] > at
        parts += [p[~right], p[right]]
    return top


def leaves(p: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree over p."""
    out, todo = [], [np.arange(len(p))]
    while todo:
        at = todo.pop()
        if len(at) <= most:
            out.append(at)
            continue
        d = int(np.ptp(p[at], axis=0).argmax())
        order = at[np.argpartition(p[at, d], len(at) // 2)]
        todo += [order[: len(at) // 2], order[len(at) // 2 :]]
    return out


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, products added in order of the components, so that a pair has one score wherever it stands."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * x[:, d]
    return out


def best_of(score: np.ndarray, name: np.ndarray, keep: int, unsure: np.ndarray, ask: Callable[[int, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Columns of the ``keep`` best of each row, by score and then id; unsure: what a score may be off; ask(row, names): exact scores and ids."""
    pick = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
    cut = np.take_along_axis(score, pick, 1).min(axis=1)
    near = score >= (cut - unsure)[:, None]
    for i in np.flatnonzero((near.sum(axis=1) > keep) & np.isfinite(cut)).tolist():
        some = np.flatnonzero(near[i])
        held, ids = ask(i, name[i, some])
        pick[i] = some[np.lexsort((ids, -held))[:keep]]
    return pick


def search_block(top: Top, ids: np.ndarray, nos: np.ndarray, x: np.ndarray, qnos: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, vec_id, score) of each query's best k in a block but its own row (nos, qnos: row numbers); bound: a squared distance known to hold k others, or inf."""
    order = np.lexsort((ids, *x.T[::-1]))
    ids, nos, x = ids[order], nos[order], x[order]
    first = np.flatnonzero(np.append(True, (x[1:] != x[:-1]).any(axis=1)))  # each vector once; its ids ascend
    copies = np.diff(np.append(first, len(x)))
    u = x[first]
    p, pq = top.project(u), top.project(q, query=True)
    leaf = leaves(p, LEAF)
    low, high = np.array([p[m].min(axis=0) for m in leaf]), np.array([p[m].max(axis=0) for m in leaf])
    away = np.zeros((len(q), len(leaf)))  # squared projected distance of each leaf's box
    for d in range(p.shape[1]):
        gap = np.maximum(low[None, :, d] - pq[:, d, None], pq[:, d, None] - high[None, :, d])
        away += np.maximum(gap, 0) ** 2
    visit = np.argsort(away, axis=1, kind="stable")
    qn = (q * q).sum(axis=1) + top.norm2
    unsure = 4 * q.shape[1] * np.finfo(float).eps * np.sqrt((q * q).sum(axis=1) * top.norm2)
    # k + 1 vectors, as one of the rows may be the query's own; by vector, not by row
    keep = k + 1
    best, who = np.full((len(q), keep), -np.inf), np.full((len(q), keep), -1)
    active, at, step = np.arange(len(q)), 0, 2
    while len(active) and at < len(leaf):
        todo = visit[active, at : at + step]
        for m in np.unique(todo):
            rows = active[(todo == m).any(axis=1)]
            score = np.concatenate([best[rows], q[rows] @ u[leaf[m]].T], axis=1)
            name = np.concatenate([who[rows], np.broadcast_to(leaf[m], (len(rows), len(leaf[m])))], axis=1)
            ask = lambda i, v, rows=rows: (exact(np.broadcast_to(q[rows[i]], (len(v), q.shape[1])), u[v]), ids[first[v]])
            pick = best_of(score, name, keep, unsure[rows], ask)
            best[rows], who[rows] = np.take_along_axis(score, pick, 1), np.take_along_axis(name, pick, 1)
        at, step = at + step, step * 2
        if at < len(leaf):
            kth = np.minimum(qn[active] - 2 * best[active].min(axis=1), bound[active])
            active = active[away[active, visit[active, at]] < ratio * np.maximum(kth, 0) + 1e-12]
    row, slot = np.nonzero(who >= 0)
    vec = who[row, slot]
    score = exact(q[row], u[vec])
    some = np.minimum(copies[vec], keep)
    number = np.repeat(np.arange(len(vec)), some)
    place = first[vec][number] + np.arange(len(number)) - np.repeat(np.cumsum(some) - some, some)
    row, score, name = row[number], score[number], ids[place]
    other = nos[place] != qnos[row]
    row, score, name = row[other], score[other], name[other]
    order = np.lexsort((name, -score, row))
    row, score, name = row[order], score[order], name[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], name[rank < k], score[rank < k]


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(v: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda c: c != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by largest inner product."""
    spark = prepare(vectors.sparkSession)
    result = "query_id long, rank int, vec_id long, score double"
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("x")))
    sizes = {r["d"]: r["n"] for r in rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], result)
    dim = min(sizes, key=lambda d: (-sizes[d], d))
    rows = rows.filter(F.size("x") == dim).withColumn("query", F.coalesce(is_query, F.lit(False)))
    rows = rows.withColumn("no", F.monotonically_increasing_id()).checkpoint()
    norm2 = F.aggregate("x", F.lit(0.0), lambda a, c: a + c * c)
    total = rows.agg(F.count("*").alias("n"), F.max(norm2).alias("m"), F.count_if("query").alias("q")).first()
    if not total["q"]:
        return spark.createDataFrame([], result)
    rng = np.random.default_rng(SEED)
    flat = Top(rng.standard_normal((dim + 1, DIMS)), float(total["m"]), np.zeros(0, np.int64), np.zeros(0))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(flat.project(matrix(b.column("x"), dim)).ravel()), DIMS).cast(pa.list_(pa.float64()))], ["p"])

    share = min(1.0, TOP_SAMPLE / total["n"])
    picked = rows.filter(F.pmod(F.xxhash64(F.col("no"), F.lit(SEED)), F.lit(1_000_003)) < share * 1_000_003).select("x")
    sample = matrix(picked.mapInArrow(projected, "p array<double>").limit(2 * TOP_SAMPLE).toArrow().column("p"), DIMS)
    top = fit_top(sample, flat.projection, flat.norm2, min(CELLS, -(-total["n"] // BLOCK)))
    ratio = chi2_quantile(CONFIDENCE)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("x"), dim)
            own = top.cells(top.project(x))
            home = top.cells(top.project(x, query=True))
            yield pa.record_batch([*b.columns, pa.array(own), pa.array(home)], ["no", "vec_id", "x", "query", "cell", "home"])

    placed = rows.select("no", "vec_id", "x", "query").mapInArrow(place, "no long, vec_id long, x array<double>, query boolean, cell long, home long").checkpoint()
    counts = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).checkpoint()
    counts = F.broadcast(counts)  # at most CELLS rows of two longs
    part = lambda cell: F.col(cell) * (1 << 32) + F.pmod(F.xxhash64("no"), F.col("blocks"))
    points = placed.join(counts, "cell").select("no", "vec_id", "x", part("cell").alias("block"))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, at = top.project(matrix(b.column("x"), dim)), b.column("block").to_numpy()
            for one in np.unique(at):
                yield pa.record_batch([pa.array([one]), pa.array([p[at == one].min(axis=0).tolist()]), pa.array([p[at == one].max(axis=0).tolist()])], ["block", "low", "high"])

    ends = [f(F.col(c)[i]).alias(f"{c}{i}") for c, f in (("low", F.min), ("high", F.max)) for i in range(DIMS)]
    boxes = points.mapInArrow(bounds, "block long, low array<double>, high array<double>").groupBy("block").agg(*ends).collect()
    names = np.array([r["block"] for r in boxes])
    low, high = (np.array([[r[f"{c}{i}"] for i in range(DIMS)] for r in boxes]) for c in ("low", "high"))

    def searched(queries: pa.Table, held: pa.Table) -> pa.Table:
        if not len(queries) or not len(held):
            return pa.table({"query_no": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        qnos, qids = queries.column("query_no").to_numpy(), queries.column("query_id").to_numpy()
        row, name, score = search_block(top, held.column("vec_id").to_numpy(), held.column("no").to_numpy(), matrix(held.column("x"), dim), qnos, matrix(queries.column("x"), dim), queries.column("bound").to_numpy(), k, ratio)
        return pa.table({"query_no": qnos[row], "query_id": qids[row], "vec_id": name, "score": score})

    def search(queries: DataFrame) -> DataFrame:
        chunks = queries.groupBy("block").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")).checkpoint()
        asked = queries.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("query_no", F.lit(1)), F.col("chunks"))).drop("chunks")
        spread = points.join(chunks, "block").select("no", "vec_id", "x", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
        return asked.groupBy("block", "chunk").cogroup(spread.groupBy("block", "chunk")).applyInArrow(searched, FOUND)

    # round 1: a block of the query's own cell, or of the cell next to it in number if that is empty
    have = np.unique(names >> 32)

    def first_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home = b.column("home").to_numpy()
            yield pa.record_batch([*(b.column(c) for c in ("no", "vec_id", "x")), pa.array(have[np.minimum(np.searchsorted(have, home), len(have) - 1)])], ["no", "vec_id", "x", "cell"])

    with_block = "query_no long, query_id long, x array<double>, block long, bound double"
    start = placed.filter("query").mapInArrow(first_cell, "no long, vec_id long, x array<double>, cell long").join(counts, "cell")
    start = start.select(F.col("no").alias("query_no"), F.col("vec_id").alias("query_id"), "x", part("cell").alias("block"), F.lit(math.inf).alias("bound")).checkpoint()
    one = search(start).checkpoint()
    kth = one.groupBy("query_no").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    waiting = start.join(kth, "query_no", "left").select("query_no", "query_id", "x", "block", F.when(F.col("n") >= k, F.col("worst")).alias("worst"))

    def other_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("x"), dim)
            worst = b.column("worst").to_numpy(zero_copy_only=False).astype(np.float64)
            far = np.where(np.isnan(worst), np.inf, np.maximum((x * x).sum(axis=1) + top.norm2 - 2 * np.nan_to_num(worst), 0))
            p = top.project(x, query=True)
            seen = b.column("block").to_numpy()
            for i in range(0, len(x), step):
                away = np.zeros((min(step, len(x) - i), len(names)))
                for d in range(DIMS):
                    away += np.maximum(np.maximum(low[None, :, d] - p[i : i + step, d, None], p[i : i + step, d, None] - high[None, :, d]), 0) ** 2
                row, go = np.nonzero((away < ratio * far[i : i + step, None] + 1e-12) & (names[None, :] != seen[i : i + step, None]))
                for a in range(0, len(row), 65_536):
                    take = pa.array(row[a : a + 65_536] + i)
                    yield pa.record_batch([*[b.column(c).take(take) for c in range(3)], pa.array(names[go[a : a + 65_536]]), pa.array(far[row[a : a + 65_536] + i])], ["query_no", "query_id", "x", "block", "bound"])

    step = max(1, 1_000_000 // len(names))  # queries compared with all boxes at once
    two = search(waiting.mapInArrow(other_blocks, with_block).checkpoint())
    order = Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")
    ranked = one.unionByName(two).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: All pairs. The search may miss neighbours (see the recall in the README); at the size of the SQL check it finds all.
SQL = """
WITH all_rows AS (SELECT row_number() OVER () AS no, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
fine AS (
  SELECT *, len(x) AS dim FROM all_rows
  WHERE len(list_filter(x, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0
), held AS (SELECT * FROM fine WHERE dim = (SELECT dim FROM fine GROUP BY dim ORDER BY count(*) DESC, dim LIMIT 1)),
pairs AS (SELECT q.no, q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x) AS score FROM held q JOIN held c ON q.no <> c.no WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id) AS rank FROM pairs) x WHERE rank <= 20
"""
