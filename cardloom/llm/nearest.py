"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Each vector, less the mean of all, is rotated by a random orthogonal matrix and kept as the signs of its components, packed, with two scalars: its length, and how
well the signs stand for it (the inner product of the unit vector with its signs). Against a rotated query of 4-bit components the packed bits give an unbiased estimate of
the inner product and a bound on its error. In a block of codes, those that look best are measured with the original vectors first; the k-th best of
these is a floor, and every vector whose upper bound reaches it is reranked in double precision.

Queries and vectors are dealt into blocks of fixed size; each pair of blocks is one small task, so nothing grows with the tables but the number of tasks. Of each pair only the k best per query leave it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardloom.llm.common import cut, table

K = 20
VECTOR_BLOCK = 8192
QUERY_BLOCK = 4096
#: Standard deviations of the estimate that the error bound spans.
SPAN = 3.0
_PLANES = 4


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix; the same for each dim and seed."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    rows, dim = bits.shape
    padded = np.zeros((rows, -(-dim // 64) * 64), np.uint8)
    padded[:, :dim] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """One-bit codes of the rows of x around a center."""

    def __init__(self, x: np.ndarray, center: np.ndarray, turn: np.ndarray) -> None:
        r = (x - center) @ turn.T
        self.dim = x.shape[1]
        self.length = np.sqrt((r * r).sum(axis=1))
        self.words = pack(r > 0)
        self.ones = (r > 0).sum(axis=1)
        self.fit = np.divide(np.abs(r).sum(axis=1), math.sqrt(self.dim) * self.length, out=np.ones(len(r)), where=self.length > 0)

    def estimate(self, q: np.ndarray, center: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products of queries with the coded vectors, and the bounds of their errors."""
        t = q @ turn.T
        low = t.min(axis=1)
        step = np.maximum((t.max(axis=1) - low) / (2**_PLANES - 1), 1e-300)
        level = np.rint((t - low[:, None]) / step[:, None]).astype(np.uint8)
        dots = np.zeros((len(q), len(self.words)), np.uint32)
        for plane in range(_PLANES):
            bits = pack(level >> plane & 1)
            for w in range(bits.shape[1]):
                dots += np.bitwise_count(bits[:, w, None] & self.words[None, :, w]).astype(np.uint32) << np.uint32(plane)
        root = math.sqrt(self.dim)
        signs = (2 * step[:, None] * dots + 2 * low[:, None] * self.ones - step[:, None] * level.sum(axis=1, dtype=np.int64)[:, None] - self.dim * low[:, None]) / root
        scale = self.length / self.fit
        size = np.sqrt((q * q).sum(axis=1))
        error = np.sqrt(np.maximum(1 - self.fit**2, 0)) * SPAN / math.sqrt(max(1, self.dim - 1)) * size[:, None] + SPAN * step[:, None] / math.sqrt(12)
        return (q @ center)[:, None] + scale * signs, scale * error


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed from the first component to the last, so equal vectors get equal results."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def best_of_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, center: np.ndarray, k: int, rows: int = 128) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of the k best of a block's vectors for each query, the query's own id left out."""
    turn = rotation(x.shape[1])
    codes = Codes(x, center, turn)
    found = []
    look = min(len(ids), 3 * k)
    for lo in range(0, len(q), rows):
        guess, error = codes.estimate(q[lo : lo + rows], center, turn)
        for r in range(len(guess)):
            query, own = q[lo + r], ids == q_ids[lo + r]
            guess[r, own] = -np.inf
            floor = np.sort(x[np.argpartition(guess[r], len(ids) - look)[len(ids) - look :]] @ query)[::-1]
            floor = floor[k] if len(floor) > k else -np.inf  # one lower than the k-th: the query's own vector may be among them
            slack = 1e-9 * (abs(floor) if np.isfinite(floor) else 0)
            near = np.flatnonzero((guess[r] + error[r] >= floor - slack) & ~own)
            if len(near) > k:
                close = x[near] @ query
                near = near[close >= np.partition(close, len(near) - k)[len(near) - k] - 1e-9 * np.abs(close).max()]
            score = inner_products(np.broadcast_to(query, (len(near), len(query))), x[near])
            best = np.lexsort((ids[near], -score))[:k]
            found.append((np.full(len(best), q_ids[lo + r]), ids[near][best], score[best]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def usable(v: Column) -> Column:
    """Not null, not zero, and all components finite."""
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: Column, k: int = K, vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of vectors(vec_id, embedding) for each row that `queries` picks.

    Nearness is the inner product; ties go to the smaller vec_id. Vectors that are null, empty, zero or hold null or non-finite components
    take no part, nor do null ids. A query is compared with vectors of its own dimension only. Of rows that repeat a vec_id the smallest
    vector stands for all. Fewer than k candidates are all returned; a table without rows gives none. Other columns aren't read.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    v = v.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    v = cut(v.withColumn("dim", F.size("v")), "vectors")
    counts = {r.dim: (r.n, r.q) for r in v.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).collect()}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                x = batch.column("v").filter(pa.array(dims == dim)).flatten().to_numpy().reshape(-1, dim)
                total[dim] = total.get(dim, 0) + x.sum(axis=0)
        for dim, s in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array(s)], ["dim", "at", "s"])

    means = v.select("dim", "v").mapInArrow(sums, "dim int, at int, s double").groupBy("dim", "at").agg(F.sum("s").alias("s")).orderBy("dim", "at").collect()
    centers = {dim: np.array([r.s / n for r in means if r.dim == dim]) for dim, (n, _) in counts.items()}
    shared = spark.sparkContext.broadcast(centers)
    grid = spark.createDataFrame([(d, -(-n // vector_block), -(-q // query_block)) for d, (n, q) in counts.items() if q] or [(0, 1, 1)], "dim int, nv int, nq int")
    v = v.join(F.broadcast(grid), "dim")  # a row for each dimension
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    left = v.where("asks").select("dim", block("nq").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("vb"), "vec_id", "v")
    right = v.select("dim", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"), block("nv").alias("vb"), "vec_id", "v")
    right = right.toDF(*right.columns)  # columns of its own: both sides come from one table

    def cell(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        dim = asked.column("dim")[0].as_py()
        both = [(t.column("vec_id").to_numpy(), t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)) for t in (asked, held)]
        a, b, score = best_of_block(*both[0], *both[1], shared.value[dim], k)
        return pa.table({"query_id": a, "vec_id": b, "score": score})

    found = left.groupBy("dim", "qb", "vb").cogroup(right.groupBy("dim", "qb", "vb")).applyInArrow(cell, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for every vector whose vec_id is divisible by 20; edge cases as in nearest."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP2_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
