"""Near-duplicate documents by BagMinHash.

A document is the multiset of its five-word shingles (one to four words: one
shingle of them all). Each shingle's weight, its count, is cut into dyadic
levels (0,1], (1,2], (2,4], ...; every (shingle, level) has a Poisson process
seeded by its hash, with rate equal to the level's width; a point falls on a
register and a weight within the level, and counts if that weight is within the
document's. The earliest point of each register is the signature: two registers
agree with probability equal to the weighted Jaccard similarity. Points beyond
the time at which all registers are surely filled are never made.

Bands of the signature find candidates; the overlap of the whole multisets
decides (similarity 0.8 or more). Documents with the same words in the same
order are collapsed first and come back as members. In a bucket no pairs are
listed: first its documents are held against its smallest one. Where a bucket
still has several classes, the documents outside the smallest class are held
against all of the bucket, inside tasks that return only edges connecting what
the links connect; a crowded bucket is split into tiles of ``crowd`` documents.
So no candidate link between classes is lost.

Documents without words have no copies. A row with a null doc_id takes no part:
it is a class of its own, class_id null. Rows that repeat a doc_id are one
document. Long texts are hashed whole. Other columns take no part in classes and
pass through ``deduplicate``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, chunks, components, forest, i64, mix, prefix_hash, range_hash, split_words, text_buffers, word_hashes, written

SHINGLE = 5
BANDS, ROWS = 25, 5
CROWD = 1024
_STEP = U(0x9E3779B97F4A7C15)
_PLACE = mix(np.arange(11, 11 + SHINGLE, dtype=U)) | U(1)


def shingles(raw: np.ndarray, off: np.ndarray, size: int = SHINGLE):
    """(text index, hash) of every shingle, in text order; and the words'
    hashes with each text's first word."""
    low, starts, ends, first = split_words(raw, off)
    wh = word_hashes(low, starts, ends)
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(wh))
    stop = first[1:][text]
    begin = (at + size <= stop) | ((n[text] < size) & (at == first[:-1][text]))
    at, stop, text = at[begin], stop[begin], text[begin]
    h = np.zeros(len(at), U)
    for k in range(size):
        inside = at + k < stop
        h += np.where(inside, wh[np.minimum(at + k, max(len(wh) - 1, 0))], U(0)) * _PLACE[k]
    return text, mix(h), wh, first


def bags(text: np.ndarray, h: np.ndarray):
    """Sorted by (text, hash): (text, hash, how often it came before)."""
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    at = np.arange(len(h))
    return text, h, at - np.maximum.accumulate(np.where(new, at, 0)), new


def bag_minhash(text: np.ndarray, h: np.ndarray, weight: np.ndarray, texts: int, m: int) -> np.ndarray:
    """texts x m earliest points; inf for texts without shingles."""
    total = np.bincount(text, weight, texts)
    sig = np.full(texts * m, np.inf)
    limit = m * (np.log(m) + 4) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        use = todo[text]
        t0, h0, w0 = text[use], h[use], weight[use]
        level = 0
        while len(t0):
            rate = 1 << max(level - 1, 0)
            low = 0 if level == 0 else rate
            t, w, x = t0, w0, np.zeros(len(t0))
            seed = mix(h0 + U((level + 1) * 0xD1342543DE82EF95 % (1 << 64)))
            while len(t):
                seed = seed + _STEP
                u = mix(seed)
                x = x - np.log(((u >> U(11)).astype(float) + 0.5) * 2.0**-53) / rate
                on = x <= limit[t]
                t, w, x, seed, u = t[on], w[on], x[on], seed[on], u[on]
                v = mix(u ^ U(0xA0761D6478BD642F))
                active = low + 1 + ((v & U(0xFFFFFFFF)) & U(rate - 1)).astype(np.int64) <= w
                np.minimum.at(sig, t[active] * m + ((v[active] >> U(32)) % U(m)).astype(np.int64), x[active])
            level += 1
            on = w0 > (1 << (level - 1))
            t0, h0, w0 = t0[on], h0[on], w0[on]
        todo &= np.isinf(sig.reshape(texts, m)).any(1)
        limit[todo] *= 2
    return sig.reshape(texts, m)


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, e1, e2, bands): a 128-bit hash of the word sequence and one key
    per band; for documents with an id and at least one word."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                raw, off = text_buffers(part.column(1))
                text, h, wh, first = shingles(raw, off)
                n = len(off) - 1
                e1 = range_hash(prefix_hash(wh), first[:-1], first[1:])
                e2 = range_hash(prefix_hash(mix(wh ^ U(0x2545F4914F6CDD1D))), first[:-1], first[1:])
                t, hs, _, new = bags(text, h)
                begin = np.flatnonzero(new)
                weight = np.diff(np.append(begin, len(hs)))
                sig = bag_minhash(t[begin], hs[begin], weight, n, bands * rows).view(U).reshape(n, bands, rows)
                key = np.zeros((n, bands), U) + mix(np.arange(bands, dtype=U) + U(77))
                for k in range(rows):
                    key = mix(key + sig[:, :, k])
                some = np.flatnonzero(first[1:] > first[:-1])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * bands), i64(key[some].reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(some)), i64(e1[some]), i64(e2[some]), lists], names=["doc_id", "e1", "e2", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null").mapInArrow(run, "doc_id long, e1 long, e2 long, bands array<long>")


def item_sets(docs: DataFrame) -> DataFrame:
    """(node, items): the multiset of shingles as sorted 64-bit values, one per
    shingle and occurrence, of docs (node, text)."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                text, h, occ, _ = bags(*shingles(*text_buffers(part.column(1)))[:2])
                items = mix(h + mix(occ.astype(U) + U(5)))
                order = np.lexsort((items, text))
                cut = np.searchsorted(text, np.arange(part.num_rows + 1))
                items = items[order]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([items[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=["node", "items"])

    return docs.select("node", "text").mapInArrow(run, "node long, items binary")


def similar(pairs: DataFrame, threshold: float) -> DataFrame:
    """Of (a, b, items_a, items_b), the (a, b) whose multisets overlap enough."""

    def run(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), U) for c in (2, 3))
                common = len(np.intersect1d(x, y, assume_unique=True))
                if enough(common, len(x), len(y), threshold):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return pairs.select("a", "b", "items_a", "items_b").mapInArrow(run, "a long, b long")


def enough(common, size_a, size_b, threshold: float):
    union = size_a + size_b - common
    return (union > 0) & (common >= threshold * union - 1e-9)


def overlaps(left: list, right: list, width: int = 4096) -> np.ndarray:
    """How many items each of left shares with each of right: products of 0/1
    matrices over the items that both sides hold, ``width`` items at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)

    def cells(sets):
        items = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(both, items)
        hit = at < len(both)
        hit[hit] = both[at[hit]] == items[hit]
        order = np.argsort(at[hit], kind="stable")
        return row[hit][order], at[hit][order]

    (ra, ca), (rb, cb) = cells(left), cells(right)
    for lo in range(0, len(both), width):
        a, b = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        for m, rows, cols in ((a, ra, ca), (b, rb, cb)):
            part = slice(*np.searchsorted(cols, [lo, lo + width]))
            m[rows[part], cols[part] - lo] = 1
        out += a @ b.T
    return out


def open_links(open_: DataFrame, sets: DataFrame, threshold: float, crowd: int) -> DataFrame:
    """(a, b): edges that connect what the links between different classes in
    one bucket connect. ``open_`` is (key, node, root, low): documents of
    buckets with several classes; low is the bucket's smallest class. Those of
    other classes are held against all, tile by tile."""
    out = F.col("root") != F.col("low")
    size = open_.groupBy("key").agg(F.count("*").alias("n"), F.count(F.when(out, 1)).alias("m"))
    parts = size.select("key", F.ceil(F.col("m") / crowd).cast("int").alias("p"), F.ceil(F.col("n") / crowd).cast("int").alias("q"))
    o = open_.join(parts, "key")
    spot = lambda parts, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = o.where(out).select("key", "node", "root", spot("p", 1).alias("i"), every("q").alias("j")).join(sets, "node")
    right = o.select("key", "node", "root", spot("q", 2).alias("j"), every("p").alias("i")).join(sets, "node")
    right = right.toDF(*(f"{c}_" for c in right.columns))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        side = lambda t, x: (t.column(f"node{x}").to_numpy(), t.column(f"root{x}").to_numpy(), [np.frombuffer(s.as_buffer(), U) for s in t.column(f"items{x}")])
        (na, roots_a, sa), (nb, roots_b, sb) = side(a, ""), side(b, "_")
        la, lb = np.array([len(x) for x in sa], float), np.array([len(x) for x in sb], float)
        good = enough(overlaps(sa, sb), la[:, None], lb[None, :], threshold) & (roots_a[:, None] != roots_b[None, :])
        i, j = np.nonzero(good)
        u, w = forest(na[i], nb[j])
        return pa.table({"a": pa.array(u, pa.int64()), "b": pa.array(w, pa.int64())})

    return left.groupBy("key", "i", "j").cogroup(right.groupBy("key_", "i_", "j_")).applyInArrow(run, "a long, b long")


def classes(docs: DataFrame, threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS, crowd: int = CROWD) -> DataFrame:
    """(doc_id, class_id): class_id is the smallest doc_id of the class; every
    document with an id is listed once."""
    sig = written(signatures(docs, bands, rows), "signatures")
    exact = sig.groupBy("e1", "e2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    member = sig.select("doc_id", "e1", "e2").join(exact.where("n > 1"), ["e1", "e2"]).select("doc_id", "rep").distinct()
    reps = sig.join(exact.select("e1", "e2", F.col("rep").alias("doc_id")), ["e1", "e2", "doc_id"], "left_semi").select(F.col("doc_id").alias("node"), F.explode("bands").alias("key")).distinct()
    shared = reps.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1")
    bucket = written(reps.join(shared.select("key", "pivot"), "key"), "buckets")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(bucket.select("node").distinct(), "node", "left_semi")
    sets = written(item_sets(texts), "sets")

    pairs = bucket.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    pairs = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b")
    links = written(similar(pairs, threshold).distinct(), "links")
    root = written(components(links), "roots")
    at = bucket.select("key", "node").join(root, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    split = at.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low < high and n > 2")
    rest = written(at.join(split.select("key", "low"), "key"), "open")
    more = written(open_links(rest, sets, threshold, crowd).distinct(), "links")
    if not more.isEmpty():
        root = written(components(links.unionByName(more)), "roots")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    known = member.join(root.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("root", "rep").alias("class_id"))
    alone = root.join(member.select(F.col("doc_id").alias("node")), "node", "left_anti").select(F.col("node").alias("doc_id"), F.col("root").alias("class_id"))
    found = known.unionByName(alone).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    return ids.join(found, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """Rows of docs, one document of each class: that with the smallest id."""
    gone = classes(docs, **options).where("doc_id <> class_id").select(F.col("doc_id").alias("_gone"))
    left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return left
    # rows that repeat an id: one of them stays
    return left.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(left.where("doc_id is null"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classes(docs).withColumn("kept", F.expr("doc_id = class_id"))


#: All pairs that share a shingle, by exact overlap.
ORACLE = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
s as (select doc_id, unnest([array_to_string(w[i + 1:i + 5], ' ') for i in range(greatest(len(w) - 4, 1))]) as s from w where len(w) > 0),
c as (select doc_id, s, count(*) as n from s group by all),
t as (select doc_id, sum(n) as n from c group by doc_id),
o as (select a.doc_id as a, b.doc_id as b, sum(least(a.n, b.n)) as n from c a join c b on a.s = b.s and a.doc_id <> b.doc_id group by all),
l as (select a, b from o join t x on x.doc_id = a join t y on y.doc_id = b where o.n >= 0.8 * (x.n + y.n - o.n) - 1e-9),
r as (select doc_id as a, doc_id as b from documents union select r.a, l.b from r join l on l.a = r.b)
select a as doc_id, min(b) as class_id, a = min(b) as kept from r group by a
"""
