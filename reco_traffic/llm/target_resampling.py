"""Resampling documents towards a target distribution.

Documents and target texts become bags of hashed features: all runs of one to
three consecutive words, joined by one space, each in the bucket of its CRC-32.
A bucket's gain is the logarithm of how much likelier the target is to use it; a
document's weight is the sum of its features' gains, and the documents with the
highest weight plus seeded Gumbel noise are drawn, without replacement.

Head and tail: one pass counts words and pairs of words. At most ``HEAD_WORDS`` of
the most frequent words and ``HEAD_PAIRS`` of the most frequent pairs of such words
are sent to the tasks (2 MB at most): a word's exact CRC state, which is its CRC with its
length and maps the CRC of whatever stands before it to the CRC of both; and a
pair's CRC and bucket. A word is a head word only if its bytes are equal, not its
hash. Words of the tail take their CRC byte by byte, pairs and triples of the
tail are fed on from the state before. Which features are head and which tail
decides the time only: bucket totals are exact over all documents and targets.

What moves: counts of frequent words, at most one row per bucket and task, and
(id, score) rows, range-partitioned to number them. The driver sees the head and
the totals of the buckets.

Nulls: null text has no words; null doc_id draws its noise as the text ``null``
and ties last. Repeated rows each take part, ties between equal rows are broken
by either. Empty texts have weight 0 and, with under ``min_words`` words, are not
drawn; long texts are taken whole, one at a time. Empty documents or an empty
target give empty results or gains of the smoothed counts. Columns other than
doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import functools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U, chunks, mix, split_words, text_buffers, word_hashes, written

BUCKETS = 10_000
HEAD_WORDS, HEAD_PAIRS = 1 << 14, 1 << 16
KEY_BYTES = 16  # head words are at most this long
SHORT = 64  # shifts up to so many bytes have a table each
SLICE_MIN = 4  # a word or pair counts for the head where a slice holds it so often
RANGE_ROWS = 1 << 20
POLY = np.uint32(0xEDB88320)


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ np.where(t & np.uint32(1), POLY, np.uint32(0))
    return t


BYTE_TABLE = _byte_table()


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of CRCs, given by its values at each of their four bytes."""
    out = table[0][crc & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ table[k][(crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


@functools.lru_cache(1)
def _shifts() -> tuple[np.ndarray, np.ndarray]:
    """Maps of "so many zero bytes follow": for 0 to SHORT bytes, and for 2**j."""
    unit = np.arange(256, dtype=np.uint32)
    start = np.stack([unit << np.uint32(8 * k) for k in range(4)])
    short = [start]
    for _ in range(SHORT):
        c = short[-1]
        short.append(BYTE_TABLE[c & np.uint32(255)] ^ (c >> np.uint32(8)))
    double = [short[1]]
    for _ in range(39):
        double.append(_apply(double[-1], double[-1]))
    return np.ascontiguousarray(np.stack(short)).reshape(-1), np.stack(double)


def shift(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The part of the CRC of ``a + b`` that comes from a, b being n bytes long."""
    short, double = _shifts()
    at = np.minimum(n, SHORT) * 1024
    out = short[at + (crc & np.uint32(255))]
    for k in (1, 2, 3):
        out ^= short[at + (256 * k) + ((crc >> np.uint32(8 * k)) & np.uint32(255))]
    far = np.flatnonzero(n > SHORT)
    if len(far):
        rest, c = n[far] - SHORT, out[far]
        for j in range(int(rest.max()).bit_length()):
            c = np.where((rest >> j) & 1 == 1, _apply(double[j], c), c)
        out[far] = c
    return out


def byte_crc(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each low[start:end], byte by byte, over all of them at once."""
    n = ends - starts
    out = np.zeros(len(n), np.uint32)
    for i in np.flatnonzero(n > SHORT):
        out[i] = zlib.crc32(low[starts[i] : ends[i]])
    order = np.flatnonzero(n <= SHORT)
    order = order[np.argsort(-n[order], kind="stable")]
    at, left = starts[order], n[order]
    c = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(int(left[0]) if len(left) else 0):
        m = int(np.searchsorted(-left, -k, "left"))  # those longer than k come first
        c[:m] = BYTE_TABLE[(c[:m] ^ low[at[:m] + k]) & np.uint32(255)] ^ (c[:m] >> np.uint32(8))
    out[order] = c ^ np.uint32(0xFFFFFFFF)
    return out


def packed(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first KEY_BYTES bytes of each word as two integers, zeros behind."""
    n = np.minimum(ends - starts, KEY_BYTES)
    wide = np.concatenate([low, np.zeros(KEY_BYTES, np.uint8)])
    span = np.arange(KEY_BYTES)
    b = np.where(span < n[:, None], wide[starts[:, None] + span], 0).astype(np.uint8)
    return b.view("<u8").reshape(-1, 2)


def _slot(key: np.ndarray) -> np.ndarray:
    return mix(key[:, 0] ^ mix(key[:, 1]))


class Head:
    """Frequent words with their CRC states, frequent pairs with their CRCs."""

    def __init__(self, words: list[bytes], pairs: list[bytes]):
        words = [w for w in words if 0 < len(w) <= KEY_BYTES]
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(words)]
        key = packed(raw, starts, ends).reshape(-1, 2)
        slot, pick = np.unique(_slot(key), return_index=True)
        self.slot, self.key = slot, key[pick]
        self.crc = byte_crc(raw, starts, ends)[pick]
        rank = {words[i]: k for k, i in enumerate(pick.tolist())}
        two = [(p, *p.split(b" ")) for p in pairs]
        two = sorted((rank[a] * len(slot) + rank[b], zlib.crc32(p)) for p, a, b in two if a in rank and b in rank)
        self.pair = np.array([k for k, _ in two], np.int64)
        self.pair_crc = np.array([c for _, c in two], np.uint32)
        self.pair_bucket = (self.pair_crc % np.uint32(BUCKETS)).astype(np.int64)

    def find(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The head word that each word is, or -1."""
        if not len(self.slot) or not len(starts):
            return np.full(len(starts), -1)
        key = packed(low, starts, ends)
        at = np.minimum(np.searchsorted(self.slot, _slot(key)), len(self.slot) - 1)
        same = (self.key[at] == key).all(axis=1) & (ends - starts <= KEY_BYTES)
        return np.where(same, at, -1)


def features(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, head: Head):
    """(word, bucket) of every feature; word is the index where it starts."""
    n = len(starts)
    word = head.find(low, starts, ends)
    tail = np.flatnonzero(word < 0)
    crc = np.zeros(n, np.uint32)
    if len(head.crc):
        crc = head.crc[word]
    crc[tail] = byte_crc(low, starts[tail], ends[tail])
    size = ends - starts
    spaced = shift(np.full(n, zlib.crc32(b" "), np.uint32), size) ^ crc
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)  # words from here to the text's end
    two = np.flatnonzero(left > 1)
    key = np.where((word[two] >= 0) & (word[two + 1] >= 0), word[two] * max(1, len(head.slot)) + word[two + 1], -1)
    if len(head.pair):
        at = np.minimum(np.searchsorted(head.pair, key), len(head.pair) - 1)
        known = head.pair[at] == key
    else:
        at, known = np.zeros(len(two), np.int64), np.zeros(len(two), bool)
    pair = np.zeros(n, np.uint32)
    seen, other = two[known], two[~known]
    pair[other] = shift(crc[other], size[other + 1] + 1) ^ spaced[other + 1]
    if len(seen):
        pair[seen] = head.pair_crc[at[known]]
    three = np.flatnonzero(left > 2)
    triple = shift(pair[three], size[three + 2] + 1) ^ spaced[three + 2]
    bucket = lambda c: (c % np.uint32(BUCKETS)).astype(np.int64)
    seen_bucket = head.pair_bucket[at[known]] if len(seen) else np.zeros(0, np.int64)
    return (np.concatenate([np.arange(n), seen, other, three]),
            np.concatenate([bucket(crc), seen_bucket, bucket(pair[other]), bucket(triple)]))


def frequent(docs: DataFrame, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS) -> Head:
    """The head, counted over all documents. A slice of about 1 MB leaves out
    what it holds under SLICE_MIN times; that moves no total, only the head."""

    def count(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                low, starts, ends, first = split_words(*text_buffers(part.column("text")))
                if not len(starts):
                    continue
                h = word_hashes(low, starts, ends)
                inner = np.setdiff1d(np.arange(len(starts) - 1), first[1:-1] - 1)
                for n, code, a, b in ((1, h, starts, ends), (2, mix(h[inner] * U(3) + mix(h[inner + 1])), starts[inner], ends[inner + 1])):
                    _, at, times = np.unique(code, return_index=True, return_counts=True)
                    at, times = at[times >= SLICE_MIN], times[times >= SLICE_MIN]
                    if n == 1:
                        grams = [low[a[i] : b[i]].tobytes() for i in at if b[i] - a[i] <= KEY_BYTES]
                        times = times[b[at] - a[at] <= KEY_BYTES]
                    else:
                        # the pair as joined by one space, whatever stood between
                        grams = [low[starts[inner[i]] : ends[inner[i]]].tobytes() + b" " + low[starts[inner[i] + 1] : ends[inner[i] + 1]].tobytes() for i in at]
                        keep = np.array([len(g) <= 2 * KEY_BYTES + 1 for g in grams], bool)
                        grams, times = [g for g, k in zip(grams, keep) if k], times[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), n, np.int32)), pa.array(grams, pa.binary()), pa.array(times.astype(np.int64))], names=["n", "gram", "times"])

    met = docs.select("text").mapInArrow(count, "n int, gram binary, times long")
    # counts in steps of a sixteenth of a doubling: a few hundred rows tell where to cut
    step = F.floor(16 * F.log2("times")).cast("int")
    total = written(met.groupBy("n", "gram").agg(F.sum("times").alias("times")).withColumn("step", step), "resampling_head")
    sizes = sorted(((r["n"], r["step"], r["count"]) for r in total.groupBy("n", "step").count().collect()), reverse=True)

    def top(n: int, k: int) -> list[bytes]:
        low = None
        for m, s, many in sizes:
            if m == n and many <= k:
                low, k = s, k - many
            elif m == n:
                break
        return [] if low is None else [bytes(r["gram"]) for r in total.where((F.col("n") == n) & (F.col("step") >= low)).select("gram").collect()]

    return Head(top(1, words), top(2, pairs))


def totals(texts: DataFrame, head) -> np.ndarray:
    """Features per bucket over all texts. ``head``: a broadcast Head."""

    def count(batches):
        out = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                _, bucket = features(*split_words(*text_buffers(part.column("text"))), head.value)
                out += np.bincount(bucket, minlength=BUCKETS)
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain, in thousandths."""
    a, b = float(int(source.sum()) + BUCKETS), float(int(target.sum()) + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * a / ((s + 1) * b))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(draw: int) -> int:
    return math.floor(-1000 * math.log(-math.log((draw + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, head, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score), one row per document."""

    def score(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                low, starts, ends, first = split_words(*text_buffers(part.column("text")))
                word, bucket = features(low, starts, ends, first, head.value)
                by_word = np.zeros(len(starts) + 1, np.int64)
                # exact in doubles: a word starts three features of small gains
                by_word[1:] = np.cumsum(np.bincount(word, gain[bucket], minlength=len(starts)).astype(np.int64))
                weight, n = by_word[first[1:]] - by_word[first[:-1]], np.diff(first)
                many = n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)
                total = weight + np.array([noise(d) for d in part.column("draw").to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (n, many, weight, total))],
                                                 names=["doc_id", "n_words", "n_features", "weight", "score"])

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    d = docs.select("doc_id", "text", F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("draw"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(score, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, n: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with rank: 1, 2, 3... by score downward, ties to smaller doc_id.
    Ranges are written with their number, then numbered each in its own task."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    cut = rows.repartitionByRange(max(1, -(-n // range_rows)), *order).withColumn("_range", F.spark_partition_id())
    cut = written(cut, "resampling_ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = cut.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return cut.join(base, "_range").withColumn("rank", inside + F.col("_base")).drop("_range", "_base")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42,
             head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every document; rank is null
    where it isn't drawn. ``percent`` of the documents with ``min_words`` words
    are drawn."""
    sc = docs.sparkSession.sparkContext
    head = sc.broadcast(frequent(docs, head_words, head_pairs))
    gain = gains(totals(docs, head), totals(target, head))
    every = written(scored(docs, gain, head, seed), "resampling_scores")
    able = every.where(F.col("n_words") >= min_words)
    n = able.count()
    drawn = F.when(F.col("rank") <= percent * n // 100, F.col("rank")).cast("long")
    out = ["doc_id", "n_features", "weight", "score"]
    rest = every.where(F.col("n_words") < min_words).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked(able, n, range_rows).select(*out, drawn.alias("rank")).unionByName(rest)


def query(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
