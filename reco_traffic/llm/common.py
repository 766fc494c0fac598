"""Shared helpers: byte views of Arrow text, word splitting and 64-bit hashes in
numpy, row keys, written tables in the shared folder, connected components.

Words are the maximal runs of ASCII letters and digits and of every byte from
0x80 on, after A-Z are lower-cased. On UTF-8 bytes this equals the pattern
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` over characters.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reco_traffic.session import scratch_path, shuffles_removed

U = np.uint64
CHUNK_BYTES = 1 << 20

_bytes = np.arange(256)
_upper = (_bytes >= 65) & (_bytes <= 90)
LOWER = np.where(_upper, _bytes + 32, _bytes).astype(np.uint8)
IS_WORD = ((_bytes >= 48) & (_bytes <= 57)) | _upper | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection), elementwise."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U)) | U(1)


@functools.lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE, U), np.full(size, BASE_INV, U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse mod 2**64, for i up to n."""
    return _powers(1 << max(21, int(n + 1).bit_length()))


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of codes[t] * BASE**t over i <= t < j."""
    out = np.zeros(len(codes) + 1, U)
    np.cumsum(codes * powers(len(codes))[0][: len(codes)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hash of codes[start:end]; equal contents hash alike."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string or binary array; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES):
    """Slices of the batch with at most ``limit`` text bytes each (a longer text
    stands alone), so that a task's memory follows its longest text."""
    arr = batch.column(batch.schema.get_field_index(column))
    _, off = text_buffers(arr)
    i, n = 0, len(arr)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield batch.slice(i, min(j, n) - i)
        i = min(j, n)


def split_words(raw: np.ndarray, off: np.ndarray):
    """(lower-cased bytes, word starts, word ends, first word of each text and
    the number of words as last entry)."""
    low = LOWER[raw]
    word = IS_WORD[raw]
    if not len(raw):
        none = np.zeros(0, np.int64)
        return low, none, none, np.zeros(len(off), np.int64)
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return low, starts, ends, np.searchsorted(starts, off)


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(prefix_hash(BYTE_CODE[low]), starts, ends)


def i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == U else x.astype(np.int64))


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id and the named columns, with ``_h``: a hash of id and text. The
    pair (doc_id, _h) names a row even if ids repeat or are null; rows that
    repeat both are one document."""
    return docs.select("doc_id", *columns, F.xxhash64("doc_id", "text").alias("_h"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write under spark.checkpoint.dir and read back: cuts lineage, survives
    the loss of any executor."""
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same, with the path, for ``remove_scratch`` once nothing reads it."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forest(u: np.ndarray, w: np.ndarray):
    """The edges as stars: (smallest of its component, other) for every node."""
    nodes, at = np.unique(np.concatenate([u, w]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(nodes))
    while True:
        before = low.copy()
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, a, m)
        np.minimum.at(low, b, m)
        low = low[low]
        if (low == before).all():
            break
    other = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[low[other]], nodes[other]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge.
    Alternating star contractions; each round joins and aggregates with partial
    sums, so a hub never sits in one task, and is written to the shared folder."""
    spark: SparkSession = edges.sparkSession
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = written(e, "cc")
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        e = written(small, "cc")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    out = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return out.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
