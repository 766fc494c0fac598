"""The pipeline's stages on a small corpus, against the operators' own rules."""

import collections
import itertools
import random

import corpus_pipeline as C
import numpy as np
import pytest
from test_text_ops import prose, targets, words_of

from reco_traffic.llm import catalog, quality_pu


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, sf_small):
    return sf_small


def test_stages_keep_the_columns_and_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs.count()
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        docs = C.written(out, f"test-{name}")
        assert docs.count() > 0.5 * before
    packed = C.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id", "piece").count() >= docs.count()


def test_run_equals_the_stages(spark, folder):
    a = C.run(spark, folder).select("doc_id", "piece", "ids_crc32")
    b = C.run(spark, folder).select("doc_id", "piece", "ids_crc32")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# ---- a planted corpus, stage by stage, against plain Python -------------------

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
UNIQUE = itertools.count()


def unlike(rng, n):
    """Prose with a number in every word, so that no two texts share a shingle."""
    return " ".join(w + str(next(UNIQUE)) if k % 3 == 0 else w for k, w in enumerate(prose(rng, n).split()))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Good prose; junk; exact and near copies; a passage of 70 words in many."""
    rng = random.Random(21)
    rows, kind = [], {}

    def add(text, what, group=None):
        i = len(rows)
        rows.append((i, text, "en", rng.choice(["a", "b", None]), len(text)))
        kind[i] = (what, group)

    for _ in range(260):
        add(unlike(rng, rng.randint(40, 120)), "good")
    for k in range(80):
        add(" ".join([rng.choice(["buy", "now", "$$$"]) + str(next(UNIQUE))] * 30) + "!!! $$$ ### " * 6, "junk")
    for g in range(6):
        text = unlike(rng, 150)
        for k in range(2 + 2 * g):
            w = text.split(" ")
            if k % 2:  # one word of 150 differs: similarity over 0.9
                w[10 * k % len(w)] = f"changed{next(UNIQUE)}"
            add(" ".join(w), "copy", g)
    passage = ". ".join(" ".join(f"{w}{next(UNIQUE)}" for w in ["shared", "passage", "of", "many", "words", "here", "and", "there", "it", "goes"]) for _ in range(7)) + "."
    for _ in range(25):
        add(unlike(rng, 50) + "\n" + passage + "\n" + unlike(rng, 50), "passage")
    folder = str(tmp_path_factory.mktemp("planted"))
    order = rows[:]
    rng.shuffle(order)
    spark.createDataFrame(order, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, 0 if kind[i][0] == "junk" else 1, 0) for i in range(len(rows)) if i % 2]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, {r[0]: r for r in rows}, kind, passage


def collected(df):
    return {r["doc_id"]: tuple(r) for r in df.collect()}


def plain_scores(model, rows):
    """The network's forward pass, one text and one unit at a time."""
    out = {}
    for i, r in rows.items():
        raw = np.frombuffer((r[1] or "").encode(), np.uint8)
        x = quality_pu.features(raw, np.array([0, len(raw)]))[0].astype(float)
        z = [min(6, max(-6, (a - c) / s)) for a, c, s in zip(x, model["centre"].astype(float), model["scale"].astype(float))]
        w = [m.astype(float) for m in model["w"]]
        h = [np.tanh(sum(a * b for a, b in zip(z, w[0][:, k])) + w[1][k]) for k in range(len(w[1]))]
        out[i] = 1 / (1 + np.exp(-(sum(a * b for a, b in zip(h, w[2])) + w[3][0])))
    return out


def shingles(text):
    w = words_of(text)
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def test_planted_corpus_stage_by_stage(spark, planted):
    folder, rows, kind, passage = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(C.STAGES)

    # quality: exactly the rows that the network, run plainly, scores high enough; junk goes, the rest stays
    good = collected(C.written(stages["quality"](spark, docs, folder), "q"))
    model = quality_pu.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    score = plain_scores(model, rows)
    assert {i for i, s in score.items() if abs(s - quality_pu.THRESHOLD) > 1e-4 and s > quality_pu.THRESHOLD} <= set(good)
    assert not {i for i, s in score.items() if s < quality_pu.THRESHOLD - 1e-4} & set(good)
    assert all(good[i] == rows[i] for i in good)
    junk = {i for i, k in kind.items() if k[0] == "junk"}
    assert not junk & set(good) and len(set(good) - junk) >= 0.97 * (len(rows) - len(junk))

    # near copies: one document, the one of smallest id, of each class of all pairs
    kept_docs = spark.createDataFrame(list(good.values()), docs.schema)
    alone = collected(C.written(stages["near_duplicates"](spark, kept_docs, folder), "n"))
    grams, root = {i: shingles(r[1]) for i, r in good.items()}, {i: i for i in good}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(good), 2):
        over = sum((grams[a] & grams[b]).values())
        if over >= 0.8 * (sum(grams[a].values()) + sum(grams[b].values()) - over):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert set(alone) == {i for i in good if find(i) == i} and all(alone[i] == good[i] for i in alone)
    assert collections.Counter(kind[i][1] for i in alone if kind[i][0] == "copy") == {g: 1 for g in {kind[i][1] for i in good if kind[i][0] == "copy"}}

    # repeated passages: the first place stays, the others lose the passage and nothing else
    alone_docs = spark.createDataFrame(list(alone.values()), docs.schema)
    cut = collected(C.written(stages["repeated_passages"](spark, alone_docs, folder), "p"))
    with_it = sorted(i for i in alone if kind[i][0] == "passage")
    assert set(cut) == set(alone) and len(with_it) > 20
    gone = words_of(passage)
    for i, r in cut.items():
        want = words_of(alone[i][1])
        if i in with_it[1:]:
            at = next(k for k in range(len(want)) if want[k : k + len(gone)] == gone)
            want = want[:at] + want[at + len(gone) :]
            assert r[4] == len(r[1])
        else:
            assert r == alone[i]
        assert words_of(r[1]) == want and r[2:4] == alone[i][2:4]

    # mixing: every document floor(rate) or one more times, sources near their targets
    cut_docs = spark.createDataFrame(list(cut.values()), docs.schema)
    mixed = [tuple(r) for r in C.written(stages["mix_sources"](spark, cut_docs, folder), "m").collect()]
    copies = collections.Counter(mixed)
    size = lambda t: len(t.split())
    sizes = collections.Counter()
    for r in cut.values():
        sizes[r[3]] += size(r[1])
    want = targets(sizes)
    assert set(copies) <= set(cut.values())
    taken = collections.Counter()
    for r in cut.values():
        rate = want[r[3]] / sizes[r[3]]
        assert copies[r] in (int(rate), int(rate) + 1) or copies[r] == round(rate)
        taken[r[3]] += copies[r] * size(r[1])
    longest = max(size(r[1]) for r in cut.values())
    assert all(abs(taken[s] - want[s]) <= 8 * longest for s in sizes)

    # packing: every copy's pieces hold its tokens, sequences are full but for a few
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = stages["pack"](spark, spark.createDataFrame(mixed, docs.schema), folder).collect()
    tokens = {r[0]: len(tok.encode(r[1], add_special_tokens=False).ids) + 1 for r in cut.values()}
    have = collections.Counter()
    for r in packed:
        have[r["doc_id"]] += r["length"]
    assert have == collections.Counter({r[0]: n * tokens[r[0]] for r, n in copies.items()})
    places = collections.defaultdict(list)
    for r in packed:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        p.sort()
        assert p[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(p, p[1:])) and sum(p[-1]) <= 2048
    assert len(places) <= -(-sum(have.values()) // 2048) + 1

    # run() is these stages: same documents, as often, with the same tokens
    whole = collections.Counter()
    for r in C.run(spark, folder).collect():
        whole[r["doc_id"]] += r["length"]
    assert whole == have


def test_odd_rows_pass_every_stage(spark, folder, tmp_path):
    rng = random.Random(1)
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "w " * 50000, "en", "a", 1), (3, " ".join(str(rng.random()) for _ in range(60)), None, None, 2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).count() > 0
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert C.run(spark, f"{tmp_path}/none").count() == 0


def test_every_operator_is_registered():
    names = sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES)
    assert names == list(range(1, 14)) and set(catalog.ORACLES) <= set(catalog.QUERIES)
