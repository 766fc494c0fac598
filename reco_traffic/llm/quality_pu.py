"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled 1; the unlabelled set is drawn from all
documents of the training folds, whatever their label. A small network over
style features of the whole text minimises the non-negative unbiased risk

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

with the logistic loss, following the gradient of the negative part back when
it falls below zero. The class prior is estimated on the training folds alone:
the share of positives among their labelled rows, or, where no row is labelled
0, the Elkan-Noto ratio of mean scores of a first fit.

Features are ratios, never the label, language, source or id: frequencies of
pairs of byte classes (letters, capitals, digits, marks, space, line ends,
multi-byte), word and line repetition, word lengths, and the text's length.

Learning uses at most ``sample`` positives and ``sample`` unlabelled rows: those
with the smallest hash of the id, a documented bound for the driver's memory.
Scoring runs over every document, in chunks of bounded size.

Null and empty texts have all-zero counts and get a score like any other. A null
doc_id counts as crc32 of the empty text; it is never learnt from. Repeated rows
are scored alike. Rows of labels with a null label are ignored; an empty label
table, or no positive, gives the constant score ``default``. Other columns pass
through ``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, chunks, mix, split_words, text_buffers, word_hashes

SAMPLE = 12000
THRESHOLD = 0.3
FOLDS = 5

_CLASS = np.zeros(256, np.int64)  # control and the rest
for _k, _chars in enumerate((b"\n", b" \t\r", b"0123456789", bytes(range(97, 123)), bytes(range(65, 91)), b".", b",", b"!?", b"|", b"-'\"()", b":;/", b"#$%&*+<=>@[\\]^_`{}~"), 1):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 13
CLASSES = 14
WIDTH = CLASSES * CLASSES + 14


def features(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """texts x WIDTH style features, each text on its own."""
    n = len(off) - 1
    size = np.diff(off)
    text = np.repeat(np.arange(n), size)
    code = _CLASS[raw]
    pair = text[:-1] * (CLASSES * CLASSES) + code[:-1] * CLASSES + code[1:]
    inside = text[:-1] == text[1:]
    grams = np.bincount(pair[inside], minlength=n * CLASSES * CLASSES).reshape(n, -1)
    x = np.zeros((n, WIDTH), np.float32)
    x[:, : CLASSES * CLASSES] = np.log1p(1000 * grams / np.maximum(size, 1)[:, None])
    low, ws, we, first = split_words(raw, off)
    words = np.diff(first)
    wtext = np.repeat(np.arange(n), words)
    many = np.maximum(words, 1)

    def variety(h: np.ndarray, at: np.ndarray):
        """(share of distinct values, share of the most common one)"""
        order = np.lexsort((h, at))
        a, b = at[order], h[order]
        new = np.ones(len(b), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        begin = np.flatnonzero(new)
        top = np.zeros(n)
        np.maximum.at(top, a[begin], np.diff(np.append(begin, len(b))))
        total = np.maximum(np.bincount(at, minlength=n), 1)
        return np.bincount(a[begin], minlength=n) / total, top / total

    wh = word_hashes(low, ws, we)
    same = np.zeros(n)
    if len(wh) > 1:
        np.add.at(same, wtext[1:], (wh[1:] == wh[:-1]) & (wtext[1:] == wtext[:-1]))
    two = mix(wh[:-1] * U(3) + wh[1:]) if len(wh) > 1 else wh[:0]
    joined = wtext[:-1] == wtext[1:] if len(wh) > 1 else np.zeros(0, bool)
    length = (we - ws).astype(float)
    mean = np.bincount(wtext, length, n) / many
    spread = np.sqrt(np.maximum(np.bincount(wtext, length**2, n) / many - mean**2, 0))
    ends = np.bincount(text, (raw == 46) | (raw == 33) | (raw == 63), n)
    lines = np.bincount(text, raw == 10, n) + 1
    extra = [np.log1p(words) / 4, np.log1p(size) / 4, *variety(wh, wtext), *variety(two[joined], wtext[:-1][joined] if len(wh) else wtext), same / many, mean / 4, spread / 4,
             np.log1p(words / (ends + 1)) / 2, np.log1p(words / lines) / 2, ends / lines / 4, np.sqrt(words) / 30, (words < 40).astype(float)]
    x[:, CLASSES * CLASSES :] = np.stack(extra, 1)
    return x


def nnpu(p: np.ndarray, u: np.ndarray, prior: float, hidden: int = 24, epochs: int = 100, rate: float = 0.03, decay: float = 1e-5, seed: int = 4) -> dict:
    """A one-hidden-layer network minimising the non-negative PU risk by Adam."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([p, u])
    centre, scale = both.mean(0), both.std(0) + 0.02
    p, u = np.clip((p - centre) / scale, -6, 6), np.clip((u - centre) / scale, -6, 6)
    w = [rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v, t = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
    steps = max(1, min(len(p), len(u)) // 512)
    for epoch in range(epochs):
        a, b = rng.permutation(len(p)), rng.permutation(len(u))
        for k in range(steps):
            xp, xu = p[a[k::steps]], u[b[k::steps]]
            x = np.concatenate([xp, xu])
            h = np.tanh(x @ w[0] + w[1])
            g = h @ w[2] + w[3]
            s = 1 / (1 + np.exp(-g))  # loss(+1) = -log s, loss(-1) = -log(1 - s)
            np_, nu = len(xp), len(xu)
            loss = np.logaddexp(0, g)
            negative = loss[np_:].mean() - prior * loss[:np_].mean()
            d = np.zeros(len(x))
            if negative >= 0:
                d[:np_] = prior * (s[:np_] - 1) / np_ - prior * s[:np_] / np_
                d[np_:] = s[np_:] / nu
            else:  # undo the overfit of the negative part
                d[:np_] = prior * s[:np_] / np_
                d[np_:] = -s[np_:] / nu
            dh = np.outer(d, w[2]) * (1 - h * h)
            grads = [x.T @ dh + decay * w[0], dh.sum(0), h.T @ d + decay * w[2], d.sum(keepdims=True)]
            t += 1
            now = rate * min(1, 2 * (1 - epoch / epochs))
            for i, gr in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * gr
                v[i] = 0.999 * v[i] + 0.001 * gr * gr
                w[i] = w[i] - now * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return {"centre": centre.astype(np.float32), "scale": scale.astype(np.float32), "w": [x.astype(np.float32) for x in w]}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    z = np.clip((x - model["centre"]) / model["scale"], -6, 6)
    w = model["w"]
    g = (np.tanh((z[:, :, None] * w[0][None]).sum(1) + w[1]) * w[2]).sum(1) + w[3] if len(z) < 4 else np.tanh(z @ w[0] + w[1]) @ w[2] + w[3]
    return 1 / (1 + np.exp(-g.astype(float)))


def fold(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """(positives, unlabelled, share of positives among labelled rows or None),
    all from folds other than 0. Only ``2 * sample`` ids and their features
    reach the driver."""
    spark = docs.sparkSession
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).where(fold() != 0)
    marked = marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    good, every = marked.agg(F.count(F.when(F.col("quality") == 1, 1)), F.count("*")).first()
    order = (F.xxhash64("doc_id", F.lit(4)), "doc_id")
    a = marked.where("quality = 1").select("doc_id").orderBy(*order).limit(sample)
    b = docs.select("doc_id").where("doc_id is not null").where(fold() != 0).distinct().orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(sample)
    kinds: dict[int, int] = {}
    for bit, rows in ((1, a.collect()), (2, b.collect())):
        for (k,) in rows:
            kinds[k] = kinds.get(k, 0) | bit
    picked = spark.createDataFrame(list(kinds.items()) or [(0, 0)], "doc_id long, kind int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")  # at most 2 * sample ids

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                x = features(*text_buffers(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "kind", "x"])

    got = sorted((r[0], bytes(r[2]), r[1]) for r in rows.mapInArrow(run, "doc_id long, kind int, x binary").collect())
    x = np.array([np.frombuffer(r[1], np.float32) for r in got]).reshape(-1, WIDTH)
    kind = np.array([r[2] for r in got], int)
    return x[kind & 1 > 0], x[kind & 2 > 0], (good / every if good < every else None)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, prior: float | None = None, **options) -> dict | None:
    p, u, share = training_sample(docs, labels, sample)
    if not len(p) or not len(u):
        return None
    prior = prior or share
    if prior is None:  # Elkan-Noto: mean score of all over mean score of the positives
        first = nnpu(p, u, 0.5, **options)
        prior = float(np.clip(predict(first, u).mean() / max(predict(first, p).mean(), 1e-9), 0.05, 0.95))
    return nnpu(p, u, float(prior), **options)


def score(docs: DataFrame, model: dict | None, default: float = 0.5) -> DataFrame:
    """docs plus _score, a double from 0 to 1."""
    if model is None:
        return docs.withColumn("_score", F.lit(float(default)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                x = features(*text_buffers(part.column(part.schema.get_field_index("text"))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(predict(shared.value, x))], names=[*part.schema.names, "_score"])

    return docs.mapInArrow(run, docs.schema.add("_score", "double") if "_score" not in docs.columns else docs.schema)


def score_ids(docs: DataFrame, model: dict | None, default: float = 0.5) -> DataFrame:
    """(doc_id, score): the texts stay in the tasks."""
    if model is None:
        return docs.select("doc_id", F.lit(float(default)).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                x = features(*text_buffers(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(predict(shared.value, x))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Rows of docs with a score of at least ``threshold``."""
    model = fit(docs, labels, **options)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                x = features(*text_buffers(part.column(part.schema.get_field_index("text"))))
                yield part.filter(pa.array(predict(shared.value, x) >= threshold))

    return docs.select(*names).mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_ids(docs, fit(docs, labels))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
