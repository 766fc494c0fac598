"""Substring dedup with run-length Burrows-Wheeler indexes.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else in the corpus. Texts are UTF-8 bytes; strings never cross documents.

One index over the whole corpus can't be built in one task, so strings are dealt
out first, without losing a match: the string's anchor is its ``gram``-byte
substring with the smallest hash (the leftmost of equals). Equal strings have
equal anchors. Neighbouring strings with one anchor form a context. Contexts
that are byte-equal are collapsed and counted; all their strings repeat. Only
groups of one anchor with several different contexts go on, and each such group
is indexed as a whole in one task:

* the suffixes of its contexts are sorted, giving the Burrows-Wheeler transform,
  which is kept as runs;
* for the first and last suffix of each run, its text position and the length it
  shares with its neighbour outside are sampled;
* streaming the contexts against the samples gives every position's matching
  statistic, the longest match that starts at any other place: between samples
  it falls by one per byte;
* statistics of ``length`` or more mark the strings that repeat.

A group with more than ``crowd`` contexts would not fit a task. Its strings are
counted one by one by 128-bit hash over the cluster, with partial sums; that is
exact as well.

Null is empty text; texts shorter than ``length`` stay whole. Very long texts
are worked on in slices. Rows are named by (doc_id, hash of id and text); rows
that repeat both are two documents with equal texts. A null doc_id is a value
like others. An empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODE, CHUNK_BYTES, U, chunks, i64, keyed, mix, prefix_hash, range_hash, text_buffers, written

LENGTH = 400
GRAM = 128
CROWD = 4000
BLOCK = 1 << 18
_POSITION = U((1 << 24) - 1)


def anchors(raw: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Contexts of the texts: (text, first string, last string, anchor hash,
    context hash); strings by their start in raw."""
    none = np.zeros(0, np.int64)
    n, width = len(raw), length - gram + 1
    if n < length:
        return none, none, none, none.view(U), none.view(U)
    prefix = prefix_hash(BYTE_CODE[raw])
    at = np.arange(n - gram + 1)
    h = range_hash(prefix, at, at + gram)
    value = (h & ~_POSITION) | at.astype(U)  # equal hashes: the leftmost
    blocks = -(-len(value) // width)
    padded = np.full(blocks * width, ~U(0))
    padded[: len(value)] = value
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    count = n - length + 1
    anchor = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & _POSITION).astype(np.int64)
    text = np.searchsorted(off, np.arange(count), "right") - 1
    inside = np.arange(count) + length <= off[np.minimum(text + 1, len(off) - 1)]
    s = np.flatnonzero(inside)
    if not len(s):
        return none, none, none, none.view(U), none.view(U)
    p = anchor[s]
    new = np.ones(len(s), bool)
    new[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1] + 1)
    first = s[new]
    last = s[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)]
    p = p[new]
    context = mix(range_hash(prefix, first, last + length) ^ mix((p - first).astype(U) + U(99)))
    return text[first], first, last, h[p], context


def slices(part: pa.RecordBatch, column: int, length: int):
    """(rows, bytes, offsets, place of the bytes in their text): the batch's
    texts together, or a very long one in overlapping slices."""
    raw, off = text_buffers(part.column(column))
    if len(raw) <= 2 * CHUNK_BYTES:
        yield raw, off, 0
        return
    for at in range(0, max(len(raw) - length + 1, 1), CHUNK_BYTES):
        piece = raw[at : at + CHUNK_BYTES + length - 1]
        yield piece, np.array([0, len(piece)]), at


def contexts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, _h, at, strings, anchor, context) of docs (doc_id, _h, text)."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                for raw, off, base in slices(part, 2, length):
                    text, first, last, anchor, context = anchors(raw, off, length, gram)
                    rows = pa.array(text)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(rows), part.column(1).take(rows), i64(first - off[text] + base), pa.array((last - first + 1).astype(np.int32)), i64(anchor), i64(context)], names=["doc_id", "_h", "at", "strings", "anchor", "context"])

    return docs.select(F.col("doc_id").cast("long"), "_h", "text").mapInArrow(run, "doc_id long, _h long, at long, strings int, anchor long, context long")


def suffix_order(code: np.ndarray, end: np.ndarray, group: np.ndarray, reach: int):
    """Suffixes of each group's contexts in order, by prefix doubling: a rank
    is the place of the first suffix that is equal so far; each round sorts
    only those that share theirs. code: 1 to 256; end: where each position's
    context ends; equal suffixes stand in the order of their contexts."""
    n = len(code)
    at = np.arange(n)
    size = 5  # characters of 9 bits, below 18 bits for the group
    if len(group) and group.max() >= 1 << 18:
        raise ValueError("too many groups in a block")
    wide = group.astype(np.int64)
    for j in range(size):
        wide <<= 9
        wide[: n - j] += np.where(at[: n - j] + j < end[: n - j], code[j:], 0)
    order = np.argsort(wide)
    new = np.ones(n, bool)
    new[1:] = wide[order[1:]] != wide[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    alone = np.append(new[1:], True) & new
    tied = order[~alone]
    while size < reach and len(tied):
        follow = np.where(tied + size < end[tied], rank[np.minimum(tied + size, n - 1)] + 1, 0)
        pair = rank[tied] * (n + 1) + follow
        by = np.argsort(pair)
        tied, pair = tied[by], pair[by]
        here = np.arange(len(tied))
        block = rank[tied]
        head = np.ones(len(tied), bool)
        head[1:] = block[1:] != block[:-1]
        place = block + here - np.maximum.accumulate(np.where(head, here, 0))
        first = np.ones(len(tied), bool)
        first[1:] = pair[1:] != pair[:-1]
        rank[tied] = np.maximum.accumulate(np.where(first, place, 0))
        alone = np.append(first[1:], True) & first
        tied = tied[~alone]
        size *= 2
    return np.argsort(rank, kind="stable")


def shared_length(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How long the suffixes at a and b agree inside their contexts."""
    low, high = np.zeros(len(a), np.int64), np.minimum(end[a] - a, end[b] - b)
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = range_hash(prefix, a, a + mid) == range_hash(prefix, b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def run_length_index(raw: np.ndarray, off: np.ndarray, group: np.ndarray):
    """The contexts' Burrows-Wheeler runs and samples: (symbol of each run,
    length of each run, samples towards the suffix before, and after). Samples
    are (text positions in order, length shared there)."""
    n = len(raw)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    end = off[1:][owner]
    order = suffix_order(raw.astype(np.int64) + 1, end, group[owner], int(np.diff(off).max(initial=0)))
    symbol = raw[order - 1].astype(np.int64)
    begins = np.zeros(n, bool)
    begins[off[:-1]] = True
    symbol[begins[order]] = -1 - owner[order[begins[order]]]  # what stands before a context is like nothing else
    head = np.ones(n, bool)
    head[1:] = (symbol[1:] != symbol[:-1]) | (group[owner[order[1:]]] != group[owner[order[:-1]]])
    heads = np.flatnonzero(head)
    tails = np.append(heads[1:] - 1, n - 1)
    prefix = prefix_hash(BYTE_CODE[raw])

    def samples(rows: np.ndarray, step: int):
        other = np.clip(rows + step, 0, n - 1)
        a, b = order[rows], order[other]
        alike = (other != rows) & (group[owner[a]] == group[owner[b]])
        size = np.zeros(len(rows), np.int64)
        size[alike] = shared_length(prefix, a[alike], b[alike], end)
        by = np.argsort(a)
        return a[by], size[by]

    return symbol[heads], np.diff(np.append(heads, n)), samples(heads, -1), samples(tails, 1)


def matching_statistics(n: int, before, after) -> np.ndarray:
    """The longest match elsewhere that starts at each of n positions."""
    out = np.zeros(n, np.int64)
    for place, size in (before, after):
        last = np.searchsorted(place, np.arange(n), "right") - 1
        out = np.maximum(out, size[last] - (np.arange(n) - place[last]))
    return out


def repeats(raw: np.ndarray, off: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Positions of contexts at which a string of ``length`` bytes starts that
    starts at another place of the same group too."""
    _, _, before, after = run_length_index(raw, off, group)
    return np.flatnonzero(matching_statistics(len(raw), before, after) >= length)


def joined(starts: np.ndarray, length: int):
    """Merged [start, end) of strings that start at the sorted places."""
    gap = np.flatnonzero(np.diff(starts) > length)
    return starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)] + length


def extract(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """wanted (doc_id, _h, at, strings, anchor, n) with the contexts' bytes."""
    ask = wanted.groupBy("doc_id", "_h").agg(F.collect_list(F.struct("at", "strings", "anchor", "n")).alias("ask"))  # of one document
    ask = ask.select(F.col("doc_id").alias("_d"), F.col("_h").alias("_k"), "ask")
    # rows that repeat id and text give the same bytes twice; one is enough
    d = docs.join(ask, docs["doc_id"].cast("long").eqNullSafe(F.col("_d")) & (docs["_h"] == F.col("_k"))).select(F.col("doc_id").cast("long").alias("doc_id"), "_h", "text", "ask")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = (batch.column(2)[i].as_py() or "").encode()
                ask = batch.column(3)[i].as_py()
                doc, key = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                m = len(ask)
                yield pa.RecordBatch.from_arrays([pa.array([doc] * m, pa.int64()), pa.array([key] * m, pa.int64()), *(pa.array([x[c] for x in ask], k) for c, k in (("at", pa.int64()), ("strings", pa.int32()), ("anchor", pa.int64()), ("n", pa.int64()))), pa.array([data[x["at"] : x["at"] + x["strings"] - 1 + length] for x in ask], pa.binary())], names=["doc_id", "_h", "at", "strings", "anchor", "n", "bytes"])

    got = d.mapInArrow(run, "doc_id long, _h long, at long, strings int, anchor long, n long, bytes binary")
    return got


def index_groups(found: DataFrame, length: int, block: int = BLOCK) -> DataFrame:
    """(doc_id, _h, start, end): strings that repeat, from contexts seen once.
    Whole groups, sorted by anchor, are indexed block by block."""

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            anchor = batch.column(4).to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])), len(anchor))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                part = batch.slice(a, b - a)
                if anchor[a] != last and size >= block:
                    yield from index(held)
                    held, size = [], 0
                held.append(part)
                size += len(text_buffers(part.column(6))[0])
                last = anchor[a]
        if held:
            yield from index(held)

    def index(held):
        t = pa.Table.from_batches(held).combine_chunks()
        # repeated rows bring a context twice: keep one
        where = np.stack([t.column(c).fill_null(-1).to_numpy() for c in (0, 1, 2)], 1)
        t = t.take(pa.array(np.sort(np.unique(where, axis=0, return_index=True)[1])))
        raw, off = text_buffers(t.column(6).combine_chunks() if t.column(6).num_chunks != 1 else t.column(6).chunk(0))
        group = np.unique(t.column(4).to_numpy(), return_inverse=True)[1]
        at = repeats(raw, off, group, length)
        row = np.searchsorted(off, at, "right") - 1
        once = t.column(5).to_numpy()[row] == 1
        at, row = at[once] - off[row[once]], row[once]
        out = [(r, *joined(at[row == r], length)) for r in np.unique(row)]
        if out:
            rows = np.concatenate([np.full(len(s), r) for r, s, _ in out])
            base = t.column(2).to_numpy()[rows]
            pick = pa.array(rows)
            cols = [t.column(c).take(pick).combine_chunks() for c in (0, 1)]
            cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
            yield pa.RecordBatch.from_arrays([*cols, i64(base + np.concatenate([s for _, s, _ in out])), i64(base + np.concatenate([e for _, _, e in out]))], names=["doc_id", "_h", "start", "end"])

    return found.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "doc_id long, _h long, start long, end long")


def count_strings(found: DataFrame, length: int) -> DataFrame:
    """As index_groups, by counting every string of the contexts by its hash."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                raw, off = text_buffers(part.column(6))
                strings = np.diff(off) - length + 1
                row = np.repeat(np.arange(len(strings)), strings)
                s = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings) + off[:-1][row]
                one = range_hash(prefix_hash(BYTE_CODE[raw]), s, s + length)
                two = range_hash(prefix_hash(mix(BYTE_CODE[raw] + U(1))), s, s + length)
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays([part.column(c).take(pick) for c in (0, 1, 5)] + [i64(s - off[:-1][row] + part.column(2).to_numpy()[row]), i64(one), i64(two)], names=["doc_id", "_h", "n", "start", "one", "two"])

    every = written(found.dropDuplicates(["doc_id", "_h", "at"]).mapInArrow(run, "doc_id long, _h long, n long, start long, one long, two long"), "strings")
    twice = every.groupBy("one", "two").agg(F.sum("n").alias("t")).where("t > 1").select("one", "two")
    return every.where("n = 1").join(twice, ["one", "two"]).select("doc_id", "_h", "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(doc_id, _h, spans): the ranges of bytes to remove, as they were found,
    of every document that has any. docs: doc_id, _h, text."""
    all_ = written(contexts(docs, length, gram), "contexts")
    kinds = written(all_.groupBy("anchor", "context").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("doc_id", "_h", "at", "strings"))), "kinds")
    equal = all_.join(kinds.where("n > 1").select("anchor", "context"), ["anchor", "context"]).select("doc_id", "_h", F.col("at").alias("start"), (F.col("at") + F.col("strings") - 1 + length).alias("end"))
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    wanted = kinds.join(groups.select("anchor", "kinds"), "anchor")
    found = written(extract(docs, wanted, length).join(groups.select("anchor", "kinds"), "anchor").select("doc_id", "_h", "at", "strings", "anchor", "n", "bytes", "kinds"), "bytes")
    spans = equal.unionByName(index_groups(found.where(F.col("kinds") <= crowd).drop("kinds"), length))
    spans = spans.unionByName(count_strings(found.where(F.col("kinds") > crowd).drop("kinds"), length))
    return spans.groupBy("doc_id", "_h").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # of one document


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, kept, removed): what stays of every text, as bytes,
    and the removed runs; removed is null and kept the text where none is."""
    d = keyed(docs, "text")
    spans = repeated_spans(d, length, gram, crowd).select(F.col("doc_id").alias("_d"), F.col("_h").alias("_k"), "spans")
    d = d.join(spans, d["doc_id"].cast("long").eqNullSafe(F.col("_d")) & (d["_h"] == F.col("_k")), "left")
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("bytes"), "spans")

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for i in range(batch.num_rows):
                data, cut = batch.column(1)[i].as_py(), merged(batch.column(2)[i].as_py())
                edges = [0, *(x for c in cut for x in c), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([len(data)]), pa.array([kept], pa.binary()), pa.array([[{"start": a, "end": b} for a, b in cut]], kind)], names=["doc_id", "n_bytes", "kept", "removed"])

    schema = "doc_id long, n_bytes long, kept binary, removed array<struct<start: long, end: long>>"
    whole = d.where("spans is null").select("doc_id", F.length("bytes").cast("long").alias("n_bytes"), F.col("bytes").alias("kept"), F.lit(None).cast("array<struct<start: long, end: long>>").alias("removed"))
    return whole.unionByName(d.where("spans is not null").mapInArrow(run, schema))


def query(spark, sf_dir: str) -> DataFrame:
    """The digests, then the kept text; a character cut through is replaced."""
    left = remove(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return left.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.when(F.col("removed").isNull(), F.lit(0)).otherwise(F.size("removed")).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))
