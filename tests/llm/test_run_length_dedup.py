"""Against brute force: every string of the given length, counted in a dict."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reco_traffic.llm import run_length_dedup as R


def brute(texts, length):
    seen = collections.Counter()
    data = [(t or "").encode() for t in texts]
    for d in data:
        for s in range(len(d) - length + 1):
            seen[d[s : s + length]] += 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - length + 1):
            if seen[d[s : s + length]] > 1:
                gone[s : s + length] = True
        runs = int(np.sum(np.diff(np.append(0, gone.astype(int))) == 1))
        out.append((len(d), runs, bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdeé ") for _ in range(k))
    shared = [word(rng.randint(15, 120)) for _ in range(6)]
    texts = [None, "", "a", "ab" * 90, "x" * 200, "x" * 200]
    while len(texts) < n:
        t = word(rng.randint(0, 150))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            t += s[a : rng.randint(a, len(s))] + word(rng.randint(0, 40))
        texts.append(t)
        if rng.random() < 0.2:
            k = rng.randint(0, len(t))
            texts.append(t[:k] + rng.choice(["", "Q"]) + t[k:])
    return texts


@pytest.mark.parametrize("seed, crowd", [(1, 4000), (2, 4000), (3, 2)])
def test_equals_brute_force(spark, seed, crowd):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    got = {r["doc_id"]: r for r in R.remove(docs, length=20, gram=8, crowd=crowd).collect()}
    for i, (n, runs, kept) in enumerate(brute(texts, 20)):
        r = got[i]
        assert (r["n_bytes"], len(r["removed"] or []), bytes(r["kept"])) == (n, runs, kept), (i, texts[i])


def test_repeated_rows_and_null_ids(spark):
    t = "".join(chr(97 + i * i % 23) for i in range(300))
    docs = spark.createDataFrame([(1, t), (1, t), (None, t[:150]), (None, "z" * 10), (2, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["n_bytes"], len(r["kept"])) for r in R.remove(docs, length=50, gram=16).collect()))
    assert got == [(0, 10, 10), (0, 150, 0), (1, 300, 0), (1, 300, 0), (2, 0, 0)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert R.remove(docs).count() == 0


def test_runs_and_statistics():
    data = [b"abracadabra-abracadabra", b"xxabracadyy"]
    raw = np.frombuffer(b"".join(data), np.uint8)
    off = np.array([0, len(data[0]), len(raw)])
    symbols, sizes, before, after = R.run_length_index(raw, off, np.zeros(2, int))
    assert sizes.sum() == len(raw) and len(symbols) < len(raw)
    got = R.matching_statistics(len(raw), before, after)
    for i in range(len(raw)):
        d = 0 if i < off[1] else 1
        best = 0
        for j in range(len(raw)):
            if j != i:
                e = 0 if j < off[1] else 1
                k = 0
                while i + k < off[d + 1] and j + k < off[e + 1] and raw[i + k] == raw[j + k]:
                    k += 1
                best = max(best, k)
        assert got[i] == best


def test_long_text_in_slices(spark, monkeypatch):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh") for _ in range(3000))
    texts = [base, base[1000:1800] + "Z" * 300, base[:500] + base[200:900]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = R.contexts(docs.withColumn("_h", F.lit(0).cast("long")), 100, 32)
    assert whole.agg(F.sum("strings")).first()[0] == sum(len(t) - 99 for t in texts)
    raw = np.frombuffer(base.encode(), np.uint8)
    parts = [(b, len(p)) for p, _, b in R.slices(_batch(base), 0, 100)]
    assert parts[0] == (0, len(raw))


def _batch(text):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])


def test_query_returns_the_kept_text(spark, sf_small):
    """Over the whole table: the text is the input less the removed bytes."""
    import hashlib

    docs = {r["doc_id"]: (r["text"] or "") for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    want = brute(list(docs.values()), 400)
    got = {r["doc_id"]: r for r in R.query(spark, sf_small).collect()}
    for (i, _), (n, runs, kept) in zip(docs.items(), want):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (n, n - len(kept), runs)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert r["text"] == kept.decode("utf-8", "replace")
    assert any(r["n_removed"] for r in got.values())
