"""Best-fit packing of documents into token sequences.

A document's tokens are its ids by the tokenizer, then the end id. Only a
document longer than ``capacity`` is cut: its first piece takes the remainder,
all others are full. Pieces are placed by vector best fit, longest first: every
bin has a residual of tokens, documents and attention cost (the sum of squared
lengths); a piece goes to the bin, feasible under every constraint, that leaves
the smallest weighted residual norm ("norm") or has the largest weighted dot
product with the piece ("dot"); a new bin opens if none is feasible.

Pieces of one length are alike in every dimension, so the greedy rule is run
over the histogram of lengths: bins in one state and pieces of one length move
as counts. The histogram has at most ``capacity`` rows whatever the corpus is,
and is the only thing the driver sees. Its result, runs "pieces a..b of length L
go, p to each, to sequences from s at offset o", is joined to the pieces, which are
numbered within (length, hash bucket), so a very common length is spread over
``buckets`` tasks. The packing equals the sequential greedy one over the whole
corpus.

Null text is empty: one end id. Null and repeated doc_ids are packed as rows of
their own. A very long text is encoded alone. Empty tables give an empty result.
Other columns do not take part.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Beyond these characters the two libraries' Unicode tables may differ.
UNSURE = re.compile("[^\x00-ɏ‐-‧]|<\\|")


@functools.lru_cache(2)
def _encoders(tokenizer: str, ranks: str | None):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(tokenizer)
    if not ranks:
        return exact, None
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return exact, tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def encode(text: str, tokenizer: str, ranks: str | None) -> np.ndarray:
    """The tokenizer's ids. ``ranks`` is the same vocabulary for a faster
    library; texts on which the two could differ go to the tokenizer."""
    exact, fast = _encoders(tokenizer, ranks)
    if fast is None or UNSURE.search(text):
        return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")
    return np.array(fast.encode_ordinary(text), "<u4")


def pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None, ranks: str | None = None, ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): one row per piece."""
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    ranks = ranks or (public_tokenizers.path(RANKS) if tokenizer == public_tokenizers.path(TOKENIZER) else None)

    def cut(batches):
        for batch in batches:
            key, text = batch.column(0).to_pylist(), batch.column(1)
            rows, size = [], 0
            for i, doc in enumerate(key):
                t = text[i].as_py() or ""
                all_ids = np.append(encode(t, tokenizer, ranks), np.uint32(end_id)).astype("<u4")
                first = len(all_ids) % capacity or capacity
                start = 0
                for n, stop in enumerate(range(first, len(all_ids) + 1, capacity)):
                    part = all_ids[start:stop].tobytes()
                    rows.append((doc, n, start, stop - start, zlib.crc32(part), *([part] if ids else [])))
                    start, size = stop, size + len(part)
                if size > 4 << 20:
                    yield out(rows)
                    rows, size = [], 0
            if rows:
                yield out(rows)

    def out(rows):
        cols = list(zip(*rows))
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names[: len(cols)])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def pack_lengths(counts: dict[int, int], capacity: int = 2048, max_docs: int | None = None, max_cost: int | None = None, weights=(1.0, 0.05, 0.05), rule: str = "norm"):
    """Vector best fit over a histogram of lengths. Returns runs (length,
    first, count, sequence, offset, per): pieces first.. of that length go,
    ``per`` to a sequence, one after the other from that offset on, to
    sequences sequence..

    By the norm rule a bin that was best stays best for the next piece of the
    same length, until it has no room; by the dot rule it falls behind the
    others of its state. So equal pieces are placed together either way.
    """
    max_docs = max_docs or capacity
    max_cost = max_cost or capacity * capacity
    if counts and (min(counts) < 1 or max(counts) > capacity or max(counts) ** 2 > max_cost):
        raise ValueError("a piece doesn't fit an empty sequence")
    full = np.array([capacity, max_docs, max_cost], float)
    w = np.array(weights, float) / full**2
    room = np.zeros((1024, 3))  # residual of each group of bins in one state
    many = np.zeros(1024, np.int64)
    first = np.zeros(1024, np.int64)
    groups, bins, runs = 0, 0, []
    for length in sorted(counts, reverse=True):
        left, done = counts[length], 0
        need = np.array([length, 1, length * length], float)
        while left:
            live = np.flatnonzero((many[:groups] > 0) & (room[:groups] >= need).all(1))
            if len(live):
                rest = room[live] - need
                score = (rest * rest * w).sum(1) if rule == "norm" else -(room[live] * need * w).sum(1)
                g = int(live[np.argmin(score)])
                bins_there, at, before = int(many[g]), int(first[g]), room[g].copy()
            else:
                g, bins_there, at, before = -1, left, bins, full
            per = int((before // need).min()) if rule == "norm" else 1
            used = min(bins_there, -(-left // per))
            if used * per > left:  # the last bin isn't filled: by itself
                used, per = (used - 1, per) if used > 1 else (1, left)
            n = used * per
            if g >= 0:
                many[g] -= used
                first[g] += used
            else:
                bins += used
            state = before - per * need
            runs.append((length, done, n, at, int(capacity - before[0]), per))
            left, done = left - n, done + n
            if state[0] >= 1 and state[1] >= 1:
                if groups == len(many):
                    keep = many > 0
                    k = int(keep.sum())
                    room[:k], first[:k], many[:k], many[k:], groups = room[keep], first[keep], many[keep], 0, k
                    if 2 * k > len(many):
                        room, many, first = (np.concatenate([x, np.zeros_like(x)]) for x in (room, many, first))
                room[groups], many[groups], first[groups] = state, used, at
                groups += 1
    return runs


def pack(parts: DataFrame, capacity: int = 2048, buckets: int = 64, **options) -> DataFrame:
    """``parts`` (with doc_id, piece, length) plus sequence_id and offset.
    ``parts`` is read twice and must be a written table."""
    spark = parts.sparkSession
    p = parts.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(buckets)))
    table = p.groupBy("length", "_bucket").count()
    histogram = {r[0]: r[1] for r in table.groupBy("length").agg(F.sum("count")).collect()}  # at most capacity rows
    runs = pack_lengths(histogram, capacity, **options)
    base = table.select("length", "_bucket", F.coalesce(F.sum("count").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    p = p.join(base, ["length", "_bucket"])
    p = p.withColumn("_rank", F.col("_base") + F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start")) - 1)
    by: dict[int, list] = {}
    for length, *run in runs:
        by.setdefault(length, []).append(run)
    # the runs' number depends on capacity, not on the corpus; each task reads them by broadcast variable
    plan = spark.sparkContext.broadcast({k: np.array(v, np.int64).T for k, v in by.items()})
    names = parts.columns

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                rows = np.flatnonzero(length == x)
                begin, _, at, offset, per = plan.value[int(x)]
                run = np.searchsorted(begin, rank[rows], "right") - 1
                seq[rows] = at[run] + (rank[rows] - begin[run]) // per[run]
                off[rows] = offset[run] + (rank[rows] - begin[run]) % per[run] * x
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(seq), pa.array(off)], names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema.fields)
    return p.select(*names, "_rank").mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None, ranks: str | None = None, ids: bool = True, **options) -> DataFrame:
    """Cut, number and place all documents; with ids, each piece carries its
    token ids (little-endian unsigned 32-bit)."""
    return pack(written(pieces(docs, capacity, end_id, tokenizer, ranks, ids), "pieces"), capacity, **options)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, ids=False).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
