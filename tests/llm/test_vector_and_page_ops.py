"""Vectors against all pairs in numpy; archives by exact round trips."""

import base64
import hashlib
import random

import numpy as np
import pytest
import zstandard

from reco_traffic.llm import ann_block as A
from reco_traffic.llm import embedding_dedup as E
from reco_traffic.llm import warc_bundles as W
from reco_traffic.llm.common import components

V = "vec_id long, embedding array<float>, label int"


def vectors(seed, n=300, d=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for k in range(0, n, 3):
        x[k] = x[rng.integers(0, n)] + rng.normal(size=d) * rng.choice([0, 0.05, 0.1, 0.2])
    return x.astype(np.float32)


ODD = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] + [1.0] * 15, 0), (903, [None] + [1.0] * 15, 0), (904, [float("inf")] * 16, 0), (None, [1.0] * 16, 0), (905, [], 0), (906, [1.0, 2.0], 0)]


def frame(spark, x, more=()):
    return spark.createDataFrame([(i, [float(v) for v in r], 0) for i, r in enumerate(x)] + list(more), V)


def cosines(x):
    x = x.astype(float)
    n = np.sqrt((x * x).sum(1))
    return x @ x.T / n[:, None] / n[None, :]


@pytest.mark.parametrize("query_block, block", [(2048, 16384), (7, 40)])
def test_nearest_equal_brute_force(spark, query_block, block):
    x = vectors(1)
    df = frame(spark, x, ODD)
    got = A.nearest(df.where("vec_id % 10 = 0"), df, 5, query_block, block).orderBy("query_id", "rank").collect()
    s = cosines(x)
    for q in range(0, 300, 10):
        mine = [r for r in got if r["query_id"] == q]
        other = [i for i in range(300) if i != q]
        want = sorted(other, key=lambda i: (-s[q, i], i))[:5]
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert np.allclose([r["score"] for r in mine], s[q, want], atol=1e-12)
        assert [r["vec_id"] for r in mine] == want
    assert len(got) == 150


def test_nearest_ties_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (5, [2.0, 0.0], 0), (3, [2.0, 0.0], 0), (3, [2.0, 0.0], 0), (9, [0.0, 1.0], 0)], V)
    got = A.nearest(df.where("vec_id = 0"), df, 5).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 3), (2, 5), (3, 9)]
    assert A.nearest(df.where("vec_id = 77"), df, 5).count() == 0
    assert A.nearest(df.limit(0), df.limit(0), 5).count() == 0


def test_error_bound_holds():
    rng = np.random.default_rng(2)
    u, w = A.unit(rng.normal(size=(200, 24))), A.unit(rng.normal(size=(200, 24)))
    (a, s, la), (b, t, lb) = A.quantise(u), A.quantise(w)
    near = (a.astype(int) @ b.astype(int).T) * s[:, None] * t[None, :]
    bound = la[:, None] + (np.sqrt(1 + 2 * la) + la)[:, None] * lb[None, :] + 1e-9
    assert (np.abs(near - u @ w.T) <= bound).all()


@pytest.mark.parametrize("options", [{}, {"crowd": 20}, {"block": 4, "axes": 3}, {"block": 5, "axes": 1, "cell": 1.0}])
def test_links_equal_brute_force(spark, options):
    x = vectors(3)
    got = {r["vec_id"]: r for r in E.near_duplicates(frame(spark, x, ODD), 0.95, **options).collect()}
    s = cosines(x) >= 0.95
    np.fill_diagonal(s, False)
    root = list(range(300))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, j in zip(*np.nonzero(s)):
        a, b = sorted((find(i), find(j)))
        root[b] = a
    assert s.sum() > 50
    for i in range(300):
        r = got[i]
        assert (r["n_links"], r["component_id"], r["kept"]) == (s[i].sum(), find(i), find(i) == i)
    for i in (900, 901, 902, 903, 904, 905, 906):
        assert (got[i]["n_links"], got[i]["component_id"]) == (0, i)
    assert got[None]["component_id"] is None and len(got) == 308


def test_distances_per_vector_grow_slower_than_vectors():
    """Isotropic vectors of 64 dimensions, the worst case: the pairs held against
    each other in a block, at n and at 4 n, against all pairs."""
    rng, radius, taken = np.random.default_rng(0), (0.1 * 8 / 64) ** 0.5, {}
    for n in (5000, 20000):
        y = A.unit(rng.normal(size=(n, 64)))[:, :8]
        taken[n] = sum(len(i) * len(j) for i, j in E.near_parts(y, y, radius))
        assert taken[n] < 0.4 * n * n
    assert taken[20000] / 20000 < 4 * 0.7 * taken[5000] / 5000


def test_near_parts_lose_no_pair():
    rng = np.random.default_rng(1)
    y, y2 = rng.normal(size=(700, 3)), rng.normal(size=(900, 3))
    y[:200] = y[0]  # many equal ones can't be split
    near = {(a, b) for i, j in E.near_parts(y, y2, 0.3, leaf=20) for a, b in zip(*(x.ravel() for x in np.meshgrid(i, j, indexing="ij")))}
    d = ((y[:, None] - y2[None]) ** 2).sum(2)
    assert {(a, b) for a, b in zip(*np.nonzero(d <= 0.09))} <= near


def test_crowded_cells_are_cut_deeper(spark):
    x = vectors(5, 400, 16)
    df = frame(spark, x).selectExpr("vec_id as node", "1L as n", "embedding as v")
    codes, along = E.depths(df, 16, 0.95, 8, 2, 3.0, 10)
    assert len(codes) and (along > 2).all() and (along <= 8).all()
    p = E.probes(df, 16, 0.95, 8, 2, 3.0, (codes, along)).where("home")
    flat = E.probes(df, 16, 0.95, 8, 2, 3.0, (np.zeros(0, np.int64), np.zeros(0, np.int64))).where("home")
    most = lambda d: d.groupBy("block", "cell").count().agg({"count": "max"}).first()[0]
    assert p.count() == flat.count() == 800 and most(p) < most(flat) / 2


def test_no_vectors(spark):
    assert E.near_duplicates(spark.createDataFrame([], V)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(k, k + 1) for k in range(500, 560)]
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for a, b in edges if a != b for k in (a, b)}


# ---------------------------------------------------------------- archives

PAGES = [(1, "http://a/x y", "<p>one</p>", "k"), (2, None, "<p>one</p>", "k"), (3, "http://b/é\r\nX: y", None, "k"), (4, "http://c", "", "k"), (5, "http://d", "é🎉 \r\n\r\nWARC/1.1\r\n" * 20, "k"),
         (None, "http://e", "<p>one</p>", "k"), (6, "http://f", "z" * 700000, "k"), (7, "http://g", "tail", "k"), (7, "http://g", "tail", "k"), (8, "http://g", "tail", "k")]


def test_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string, data string")
    bundles = W.write_bundles(df, frame_bytes=300, bundle_bytes=2000)
    got = W.read_records(bundles, payload=True).collect()
    assert len(got) == len(PAGES)
    html = {p[0]: p[2] or "" for p in PAGES}
    for r in got:
        data = html[r["page_id"]].encode()
        first = min(p for p, h in html.items() if p is not None and h.encode() == data)
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = r["page_id"] != first
        assert r["record_type"] == ("revisit" if again else "response") and r["refers_to"] == (first if again else None)
        assert bytes(r["payload"]) == (b"" if again else data)
    # only payloads of some length are matched
    apart = W.read_records(W.write_bundles(df, min_payload=5)).collect()
    assert {r["page_id"] for r in apart if r["record_type"] == "revisit"} == {2, None}


def test_seek_by_identifier(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string, data string")
    bundles = W.write_bundles(df, frame_bytes=300, bundle_bytes=2000)
    ids = bundles.selectExpr("explode(index) as x").selectExpr("x.record_id").distinct()
    found = W.fetch(bundles, ids).collect()
    assert {r["record_id"] for r in found} == {r["record_id"] for r in ids.collect()}
    for r in found:
        headers, _, end = W.parse(bytes(r["record"]))
        assert headers["WARC-Record-ID"] == r["record_id"] and end == len(r["record"])


def test_bundle_is_plain_zstandard_and_damage_is_noticed():
    b = W.Bundle(50)
    parts = [W.record(i, f"http://{i}", b"x" * i, hashlib.sha1(b"x" * i).digest(), i, None, False, "2020-01-01T00:00:00Z") for i in range(30)]
    for i, p in enumerate(parts):
        b.add(str(i), p)
    data = b.done()
    table = W.seek_table(data)
    assert b"".join(W.frame(data, e) for e in table) == b"".join(parts)
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == b"".join(parts)
    broken = bytearray(data)
    broken[table[3][0] + 12] ^= 255
    with pytest.raises(Exception):
        W.frame(bytes(broken), table[3])
    with pytest.raises(ValueError):
        W.seek_table(data[:-1])


def test_empty_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.read_records(W.write_bundles(df)).count() == 0
