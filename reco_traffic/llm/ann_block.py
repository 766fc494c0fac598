"""Nearest neighbours by a block matrix join.

Vectors are scaled to length one and quantised to int8 with a scale of their
own; the length of what quantising lost is kept exactly. Blocks of queries meet
blocks of candidates in tiles. In a tile the int8 products give every cosine
with a proven bound on its error; per query, pairs whose upper bound reaches the
k-th best lower bound survive and are computed again in double precision on the
original vectors; heaps of k merge chunk by chunk, and over all tiles at the
end. So the result is exact.

A tile holds ``query_block`` and ``block`` vectors at most; blocks are numbered
by a hash of the id, so identical vectors spread. Queries are copied to every
candidate block and candidates to every query block, as in any block product;
of results only k rows per query and tile leave a tile.

Vectors that are null, zero or hold null or non-finite components, and rows
with a null vec_id, take no part; so do vectors of another width than the most
common one. A query meets every candidate with another vec_id. Rows repeating a
vec_id with the same vector count once. Ties go to the smaller vec_id. Empty
tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2048
BLOCK = 16384
CHUNK = 2048


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): rows that take part, v as array<double>, each once."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    return v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(fine).dropDuplicates(["vec_id", "v"])


def rows(column: pa.Array) -> np.ndarray:
    """A list array of doubles, all of one width, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(u: np.ndarray):
    """(int8 codes, scale, bound on the length of u - scale * codes)."""
    scale = np.abs(u).max(axis=1) / 127
    codes = np.rint(u / scale[:, None]).astype(np.int8)
    lost = np.sqrt(((u - scale[:, None] * codes) ** 2).sum(axis=1)) + 1e-12
    return codes, scale, lost


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, summed from the first component on."""
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for k in range(a.shape[1]):
        x, y = a[:, k], b[:, k]
        dot, aa, bb = dot + x * y, aa + x * x, bb + y * y
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def safe_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As ``cosine``; rows whose squares leave the range of doubles are scaled."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        out = cosine(a, b)
    odd = ~np.isfinite(out) | (np.abs(a).max(axis=1) < 1e-140) | (np.abs(b).max(axis=1) < 1e-140)
    if odd.any():
        out[odd] = cosine(a[odd] / np.abs(a[odd]).max(axis=1, keepdims=True), b[odd] / np.abs(b[odd]).max(axis=1, keepdims=True))
    return out


def tile(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int, chunk: int = CHUNK):
    """(query, candidate, cosine) of each query's k best in the tile."""
    heaps: list[list] = [[] for _ in qid]
    floor = np.full(len(qid), -np.inf)  # a proven lower bound on each query's k-th best
    qc, qs, ql = quantise(unit(q))
    qf = qc.astype(np.float32)  # products of int8 are whole numbers that float32 holds exactly
    reach = np.sqrt(1 + 2 * ql) + ql
    for at in range(0, len(cid), chunk):
        part, ids = c[at : at + chunk], cid[at : at + chunk]
        cc, cs, cl = quantise(unit(part))
        near = (qf @ cc.astype(np.float32).T).astype(float) * qs[:, None] * cs[None, :]
        # |u.w - u'.w'| <= |u - u'| |w| + |u'| |w - w'|
        error = ql[:, None] + reach[:, None] * cl[None, :] + 1e-9
        other = qid[:, None] != ids[None, :]
        low = np.where(other, near - error, -np.inf)
        if low.shape[1] >= k:
            floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
        a, b = np.nonzero(other & (near + error >= floor[:, None]))
        exact = safe_cosine(q[a], part[b])
        for i, j, s in zip(a.tolist(), ids[b].tolist(), exact.tolist()):
            heap, item = heaps[i], (s, -j)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
        full = [h[0][0] if len(h) == k else -np.inf for h in heaps]
        floor = np.maximum(floor, full)
    return [(int(qid[i]), -j, s) for i, h in enumerate(heaps) for s, j in h]


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest by cosine.
    Both tables hold vec_id and embedding."""
    c = usable(vectors)
    row = c.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width, n = (row[0], row[1]) if row else (0, 0)
    c = c.where(F.size("v") == width)
    q = usable(queries).where(F.size("v") == width)
    across, down = max(1, -(-q.count() // query_block)), max(1, -(-n // block))
    place = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = q.select("vec_id", "v", place(across).alias("i"), every(down).alias("j"))
    right = c.select("vec_id", "v", place(down).alias("j"), every(across).alias("i"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        a, b = a.combine_chunks(), b.combine_chunks()
        found = []
        if len(a) and len(b):
            col = lambda t, x: t.column(x).combine_chunks() if t.column(x).num_chunks != 1 else t.column(x).chunk(0)
            found = tile(col(a, "vec_id").to_numpy(), rows(col(a, "v")), col(b, "vec_id").to_numpy(), rows(col(b, "v")), k)
        kinds = (("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))
        return pa.table({name: pa.array([x[n] for x in found], kind) for n, (name, kind) in enumerate(kinds)})

    best = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(run, "query_id long, vec_id long, score double")
    # a query's partial lists: k rows per tile, cut again before they move
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(v.where("vec_id % 50 = 0"), v)
