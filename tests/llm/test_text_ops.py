"""Text operators against brute force, and the defined results of odd input."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reco_traffic.llm import best_fit_packing as P
from reco_traffic.llm import license_scan as L
from reco_traffic.llm import minhash_dedup as M
from reco_traffic.llm import quality_pu as Q
from reco_traffic.llm import sentence_spans as S
from reco_traffic.llm import source_mix as X

WORDS = ["alpha", "bravo", "Charlie", "delta", "écho", "fox", "golf", "hotel", "india", "juliet", "kilo", "lima", "mike", "under", "the", "license"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def prose(rng, n):
    out = []
    while sum(map(len, out)) < n:
        out.append([rng.choice(WORDS) + rng.choice(["", "", str(rng.randint(0, 99))]) for _ in range(rng.randint(3, 20))])
    return " ".join(" ".join(s) + rng.choice([".", "!", ".\n"]) for s in out)


ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "x", "en", "a", 1), (3, "x", "en", "a", 1),
    (None, "some words here. more words there.", "en", None, 3), (5, "word " * 30000, "en", "b", 150000),
    (6, " \n\t.!?", "en", "b", 7), (7, "日本語 と emoji 🎉 ends", "ja", "b", 20), (8, "A\x00b\x7f", None, "", 4),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(40)] + [(None, 1, 0), (41, None, 0)], "doc_id long, quality int, toxic int")


# ---------------------------------------------------------------- licences


def test_license_base_places_and_labels(spark, odd, empty):
    texts = ["MIT License. mit\nlicense, Apache-License cc by", "Licensed under CC BY-NC 4.0.", "gnu general public", "This work is licensed under the GNU General Public License, version 3. " + prose(random.Random(1), 40)]
    texts += [dict(L.TEMPLATES)["isc"], "under the license of the " * 50]
    rows = L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for t, r in zip(texts, rows):
        w = words_of(t)
        at = [(i, label) for p, label in L.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        assert r["n_words"] == len(w) and r["n_base"] == len(at)
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
    assert "cc-by-nc-4.0" in rows[1]["labels"] and "gpl-3.0" in rows[3]["labels"] and rows[4]["labels"] == "isc" and rows[5]["labels"] == ""
    got = {r["doc_id"]: r for r in L.scan(odd).collect()}
    assert got[1]["n_words"] == 0 and got[1]["score"] == 0 and got[1]["first_word"] is None and got[5]["n_words"] == 30000
    assert L.scan(odd).count() == len(ODD) and L.scan(empty).count() == 0


def test_variants_of_a_notice_are_told_apart(spark):
    """Siblings differ by a word or two; a version of no template gets no label
    of its own, whatever its coverage."""
    gnu = lambda name, version: L.GNU_NOTICE.format(name, version)
    texts = {label: gnu(name, version) for label, name, version in L.GNU_VARIANTS}
    texts |= {"none-a": gnu("", "4"), "none-b": gnu("Library ", "2"), "none-c": "Licensed under CC BY 3.0", "none-d": "Licensed under CC BY-ND 4.0",
              "none-e": "Licensed under the Apache License, Version 1.1", "none-f": "licensed under the GNU Lesser General Public License, version 3",
              "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0", "cc-by-4.0": "Licensed under CC BY 4.0", "gpl-2.0": "licensed under the GNU General Public License, version 2"}
    both = gnu("", "2") + " " + prose(random.Random(1), 40) + " " + gnu("Affero ", "3")
    names = [*texts, "two"]
    docs = spark.createDataFrame(list(enumerate([*texts.values(), both])), "doc_id long, text string")
    own = {l for l, _ in L.TEMPLATES}
    for r in L.scan(docs).collect():
        name, found = names[r["doc_id"]], set(r["labels"].split(",")) & own
        want = {"gpl-2.0-or-later", "agpl-3.0-or-later"} if name == "two" else set() if name.startswith("none") else {name}
        assert found == want, (name, r["labels"])


def test_automaton_statistics_equal_brute_force():
    rng = random.Random(3)
    templates = [("t", " ".join(rng.choice("abcd") for _ in range(12))) for _ in range(4)]
    auto = L.Automaton(templates, {"a b": "x"})
    texts = [words_of(t) for _, t in templates] + [["a", "b"]]
    for _ in range(50):
        w = [rng.choice("abcde") for _ in range(30)]
        ids = [auto.vocabulary.get(x, -1) for x in w]
        got = [n for _, n in auto.stream(ids)]
        for i in range(len(w)):
            best = max((k for k in range(i + 2) if any(w[i - k + 1 : i + 1] == t[j : j + k] for t in texts for j in range(len(t) - k + 1))), default=0)
            assert got[i] == best


def test_chains_bridge_gaps():
    body = dict(L.TEMPLATES)["isc"].split()
    assert L.chain([(0, 0, 10), (11, 11, 10)], 8, 30) == [(20, 0, 20)]
    assert len(L.chain([(0, 0, 10), (50, 11, 10)], 8, 30)) == 2
    assert len(body) > 20


# ---------------------------------------------------------------- packing


def greedy(lengths, capacity, max_docs, max_cost, weights):
    """One piece at a time over explicit bins, longest first."""
    full = np.array([capacity, max_docs, max_cost], float)
    w = np.array(weights) / full**2
    bins = []
    for n in sorted(lengths, reverse=True):
        need = np.array([n, 1, n * n], float)
        fit = [b for b in bins if (b >= need).all()]
        if fit:
            best = min(fit, key=lambda b: float((((b - need) ** 2) * w).sum()))
            best -= need
        else:
            bins.append(full - need)
    return len(bins)


@pytest.mark.parametrize("seed", range(4))
def test_histogram_packing_is_the_greedy_one(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 3, 7, 20, 33, 50, 64]) if rng.random() < 0.6 else rng.randint(1, 64) for _ in range(400)]
    for docs, cost in ((64, 4096), (4, 4096), (64, 2500 + 64 * 64 // 2)):
        runs = P.pack_lengths(dict(collections.Counter(lengths)), 64, docs, cost)
        load, count, spent, seen = collections.Counter(), collections.Counter(), collections.Counter(), collections.Counter()
        for length, first, n, at, off, per in runs:
            assert first == seen[length] and n % per == 0
            seen[length] += n
            for s in range(at, at + n // per):
                assert off == load[s]
                load[s] += length * per
                count[s] += per
                spent[s] += length * length * per
        assert seen == collections.Counter(lengths)
        assert max(load.values()) <= 64 and max(count.values()) <= docs and max(spent.values()) <= cost
        assert len(load) == greedy(lengths, 64, docs, cost, (1.0, 0.05, 0.05))
    assert P.pack_lengths({}) == []


def test_packed_pieces_round_trip(spark, odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = ODD + [(20 + i, prose(random.Random(i), 60 * i), "en", "s", 1) for i in range(12)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = P.pack_documents(docs, capacity=128).collect()
    want = collections.Counter((r[0], zlib.crc32(np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4").tobytes())) for r in rows)
    parts = collections.defaultdict(list)
    for r in got:
        parts[r["doc_id"]].append(r)
    have = collections.Counter()
    for doc, ps in parts.items():
        ps.sort(key=lambda r: (r["piece"], r["sequence_id"]))
        copies = sum(p["piece"] == 0 for p in ps)
        for k in range(copies):
            own = ps[k::copies]
            assert [p["piece"] for p in own] == list(range(len(own)))
            assert all(p["length"] == 128 for p in own[1:]) and [p["start"] for p in own] == [0, *itertools.accumulate(p["length"] for p in own[:-1])]
            assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"] for p in own)
            have[(doc, zlib.crc32(b"".join(bytes(p["ids"]) for p in own)))] += 1
    assert have == want
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(places[-1]) <= 128
    total = sum(r["length"] for r in got)
    assert len(by) <= -(-total // 128) + 2
    assert P.pack_documents(empty).count() == 0


def test_both_tokenizer_libraries_agree():
    import public_tokenizers as T

    rng = random.Random(9)
    slow, ranks = T.path(P.TOKENIZER), T.path(P.RANKS)
    pool = [chr(c) for c in range(0x250)] + list("‐–—‘’“”…") + [" ", "  ", "\n", "'s", "'ll", "the", "license", "123"]
    for _ in range(400):
        t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))
        assert P.encode(t, slow, ranks).tolist() == P.encode(t, slow, None).tolist(), repr(t)
    t = "a <|endoftext|> b 日本 🎉"
    assert P.encode(t, slow, ranks).tolist() == P.encode(t, slow, None).tolist()


# ---------------------------------------------------------------- quality


def test_quality_learns_and_scores(spark, odd, empty, labels):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(600):
        bad = i % 5 == 0
        t = " ".join([rng.choice(WORDS)] * 40) + "!!! $$$ ### " * 5 if bad else prose(rng, 60)
        rows.append((i, t, "en", "s", len(t)))
        if i % 2 == 0:
            marks.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    lab = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = Q.fit(docs, lab)
    got = {r["doc_id"]: r["score"] for r in Q.score_ids(docs, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((got[i] >= Q.THRESHOLD) == (i % 5 != 0) for i in held)
    assert right / len(held) > 0.95 and all(0 <= s <= 1 for s in got.values())
    assert {r["doc_id"] for r in Q.keep_good(docs, lab).collect()} == {i for i, s in got.items() if s >= Q.THRESHOLD}
    assert Q.score_ids(odd, model).where("score between 0 and 1").count() == len(ODD)
    assert Q.score_ids(empty, model).count() == 0
    # labels of the held-out fold must not matter
    flipped = lab.withColumn("quality", F.when(Q.fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in Q.score_ids(docs, Q.fit(docs, flipped)).collect()}
    assert again == got
    assert Q.fit(docs, lab.where("quality = 9")) is None and Q.keep_good(docs, lab.where("quality = 9")).count() == 600


def test_prior_without_negatives(spark):
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, prose(rng, 40) if i % 3 else "zz " * 40, "en", "s", 1) for i in range(300)], SCHEMA)
    lab = spark.createDataFrame([(i, 1, 0) for i in range(300) if i % 3], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in Q.score_ids(docs, Q.fit(docs, lab)).collect()}
    assert np.mean([got[i] for i in got if i % 3]) > np.mean([got[i] for i in got if not i % 3]) + 0.2


# ---------------------------------------------------------------- near copies


def jaccard(a, b):
    x, y = (collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter() for w in (words_of(a), words_of(b)))
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 0.0


@pytest.mark.parametrize("crowd", [1024, 3])
def test_classes_equal_brute_force(spark, crowd):
    rng = random.Random(5)
    texts = ["", None, "one two", "One  two!", "three"]
    for _ in range(12):
        base = prose(rng, 80).split(" ")
        for _ in range(rng.randint(1, 7)):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(WORDS) + "9"
            texts.append(" ".join(w))
    texts.append("spam " * 50)
    texts.append("spam " * 55)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if jaccard(texts[a], texts[b]) >= 0.8:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r["doc_id"]: r["class_id"] for r in M.classes(docs, crowd=crowd).collect()}
    assert got == {i: find(i) for i in range(len(texts))}


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    gaps = []
    for _ in range(150):
        u = rng.integers(0, 2**63, 60).astype(np.uint64)
        a = rng.integers(0, 6, 60)
        b = np.where(rng.random(60) < 0.7, a, rng.integers(0, 6, 60))
        text = np.r_[np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)]
        sig = M.bag_minhash(text, np.r_[u[a > 0], u[b > 0]], np.r_[a[a > 0], b[b > 0]], 2, 125)
        gaps.append((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(gaps)) < 0.01 and np.std(gaps) < 0.06


def test_deduplicate_odd_rows(spark, odd, empty):
    got = M.deduplicate(odd).collect()
    ids = [r["doc_id"] for r in got]
    assert sorted(i for i in ids if i) == [1, 2, 3, 5, 6, 7, 8] and ids.count(None) == 1
    assert M.deduplicate(empty).count() == 0 and M.deduplicate(odd).columns == odd.columns
    classes = M.classes(odd).collect()
    assert sorted(r["doc_id"] for r in classes) == [1, 2, 3, 5, 6, 7, 8]


# ---------------------------------------------------------------- spans


def cut(text):
    """Sentences as lists of words, by the stated rules, one word at a time."""
    out, low = [], (text or "")
    found = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)]
    now = []
    for k, (_, e, w) in enumerate(found):
        now.append(re.sub("[A-Z]", lambda m: m[0].lower(), w))
        gap = low[e : found[k + 1][0] if k + 1 < len(found) else len(low)]
        hard = "\n" in gap or k + 1 == len(found)
        soft = re.search(r"[.!?]([ \t\n\x0b\x0c\r]|$)", gap) is not None
        if hard or len(now) == S.MAX_SENTENCE or (soft and len(now) >= S.MIN_SENTENCE):
            out.append(now)
            now = []
    return out


def test_sentences_follow_the_rules():
    rng = random.Random(6)
    texts = [prose(rng, rng.randint(0, 120)) for _ in range(40)] + ["", "a", "One. Two. Three. Four. Five.", "no end\n\nx y z w v. u", "A.B c"]
    data = [t.encode() for t in texts]
    off = np.append(0, np.cumsum([len(d) for d in data]))
    raw = np.frombuffer(b"".join(data), np.uint8)
    text, begin, end, low, ws, we = S.sentences(raw, off)
    got = [[] for _ in texts]
    for t, b, e in zip(text, begin, end):
        got[t].append([bytes(low[ws[k] : we[k]]).decode() for k in range(b, e)])
    assert got == [cut(t) for t in texts]


def test_spans_equal_brute_force(spark):
    rng = random.Random(7)
    shared = [prose(rng, 60) for _ in range(5)]
    texts = [None, "", "same " * 40]
    for _ in range(30):
        parts = [prose(rng, 30) for _ in range(rng.randint(0, 2))] + [rng.choice(shared) for _ in range(rng.randint(0, 2))]
        rng.shuffle(parts)
        texts.append("\n".join(parts))
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    first, gone = {}, collections.defaultdict(set)
    pieces = [cut(t) for t in texts]
    places = []
    for i, p in enumerate(pieces):
        long = lambda a, b: b - a >= S.SPAN and sum(map(len, p[a:b])) >= S.MIN_WORDS  # noqa: E731, B023
        pairs = {min(((a, b) for b in range(a + 1, len(p) + 1) if long(a, b)), default=None) for a in range(len(p))}
        pairs |= {max(((a, b) for a in range(b) if long(a, b)), default=None) for b in range(1, len(p) + 1)}
        places += [(i, *x) for x in pairs - {None}]
    for i, a, b in sorted(places):
        run = tuple(w for s in pieces[i][a:b] for w in s)
        if run in first and first[run] != (i, a):
            gone[i] |= set(range(a, b))
        first.setdefault(run, (i, a))
    got = {r["doc_id"]: r for r in S.remove(docs).collect()}
    for i, t in enumerate(texts):
        want = [w for k, s in enumerate(pieces[i]) if k not in gone[i] for w in s]
        assert words_of(got[i]["text"]) == want, i
        if not gone[i]:
            assert got[i]["text"] == t and got[i]["n_chars"] == 7
        else:
            assert got[i]["n_chars"] == len(got[i]["text"])


def test_passages_of_fifty_words_are_caught(spark):
    rng = random.Random(11)
    passage = "\n" + " ".join(rng.choice(WORDS) + str(k) for k in range(55)) + ".\n"
    texts = [prose(rng, 30) + passage + prose(rng, 30) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in S.remove(docs).collect()}
    assert left[0] == texts[0]
    for i in range(1, 6):
        assert words_of(left[i]) == words_of(texts[i].replace(passage, "\n"))


def windows_removed(texts):
    """The words that stay if every window of WINDOW words that stands at an
    earlier place is removed, one window at a time."""
    first, out = {}, []
    for i, t in enumerate(texts):
        w = words_of(t)
        gone = set()
        for a in range(len(w) - S.WINDOW + 1):
            j, b = first.setdefault(tuple(w[a : a + S.WINDOW]), (i, a))
            gone |= set(range(max(a, b + S.WINDOW) if i == j else a, a + S.WINDOW)) if (i, a) != (j, b) else set()
        out.append([x for k, x in enumerate(w) if k not in gone])
    return out


def test_passages_without_marks_are_caught_mid_line(spark):
    rng = random.Random(12)
    plain = lambda n: " ".join(rng.choice(WORDS) + str(rng.randint(0, 999)) for _ in range(n))
    shared = [plain(n) for n in (51, 60, 60, 200)]
    texts = [" ".join(x for x in (plain(rng.randint(0, 60)), p, plain(rng.randint(0, 60))) if x) for p in shared for _ in range(12)]
    long = plain(300).split()
    for _ in range(12):  # near copies
        texts.append(" ".join(w for w in long[rng.randint(0, 40) :] if rng.random() < 0.99))
    plains = len(texts)
    texts += ["same " * 200, "a b c " * 40, " ".join([plain(20), shared[1], shared[2], plain(5), shared[1]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: words_of(r["text"]) for r in S.remove(docs).collect()}
    want = windows_removed(texts)
    for i in range(len(texts)):
        if i < 48:
            assert got[i] == want[i], i
        elif i < plains:  # spans of sentences go as well
            assert not collections.Counter(got[i]) - collections.Counter(want[i]), i
        else:
            assert len(got[i]) <= len(want[i]) < 60, i
    assert all(got[i] == words_of(texts[i]) for i in range(0, 48, 12))


def test_passages_of_sentences_are_caught_at_any_offset(spark):
    rng = random.Random(13)
    words = lambda n: [rng.choice(WORDS) + str(rng.randint(0, 999)) for _ in range(n)]
    close = lambda sizes: " ".join(" ".join(words(n)) + "." for n in sizes)
    shared = [" ".join(words(20)) + ". " + " ".join(words(25)) + ". " + " ".join(words(6))]  # begins and ends inside a sentence
    shared += [close(rng.choices(range(*sizes), k=5)) for sizes in ((8, 21), (15, 31)) for _ in range(3)]
    shared = [p for p in shared if len(words_of(p)) >= S.WINDOW]
    texts = []
    for p in shared:
        for k in range(8):  # mid-sentence, or after a sentence of 1 to 25 words
            before = " ".join(words(rng.randint(1, 25))) + (". " if k % 2 else " ")
            texts.append(before + p + " " + close([5, 12]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: words_of(r["text"]) for r in S.remove(docs).collect()}
    assert len(shared) >= 5
    for i, want in enumerate(windows_removed(texts)):
        assert got[i] == want, i
        assert i % 8 == 0 or len(want) == len(words_of(texts[i])) - len(words_of(shared[i // 8])), i


def test_spans_odd_rows(spark, odd, empty):
    got = S.remove(odd).collect()
    assert len(got) == len(ODD) and S.remove(empty).count() == 0 and S.remove(odd).columns == odd.columns
    assert {r["doc_id"]: r["text"] for r in got if r["doc_id"] in (1, 2, 7)} == {1: None, 2: "", 7: ODD[7][1]}


# ---------------------------------------------------------------- mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        over = [s for s in free if left * w[s] / sum(w[x] for x in free) > cap * sizes[s]]
        if not over:
            return fixed | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


def test_mix_targets_and_copies(spark, odd, empty):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(1, 60)), "en", rng.choice(["b", "a", "é", "Z", None, "c"]), 1) for i in range(600)]
    plan = X.mix_plan(spark.createDataFrame(rows, SCHEMA)).collect()
    sizes, taken, longest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in plan:
        s = r["row"]["source"]
        assert r["size"] == len(re.findall(X.WORD, r["row"]["text"]))
        sizes[s] += r["size"]
        taken[s] += r["size"] * r["copies"]
        longest[s] = max(longest[s], r["size"])
        assert 0 <= r["copies"] <= 2
    want = targets(sizes)
    for r in plan:
        s = r["row"]["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 8 * longest[s]
    again = X.mix_plan(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert sorted((r["row"]["doc_id"], r["copies"]) for r in again) == sorted((r["row"]["doc_id"], r["copies"]) for r in plan)
    mixed = X.mix(odd)
    assert mixed.columns == odd.columns and X.mix(empty).count() == 0
    assert len(X.mix_plan(odd).collect()) == len(ODD)


def test_clashing_columns(spark):
    cols = ["row", "size", "copies", "target", "_h", "node", "_class", "spans", "ids", "score", "_at", "_text", "_runs", "_id", "_key", "runs", "at"]
    docs = spark.createDataFrame([(i, prose(random.Random(i % 3), 50), "a", *["v"] * len(cols)) for i in range(9)], ["doc_id", "text", "source", *cols])
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    lab = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, quality int")
    for out in (X.mix(docs), S.remove(docs), M.deduplicate(docs), Q.keep_good(docs, lab)):
        assert out.columns == docs.columns and out.count() >= 0
    assert L.scan(docs).count() == 9 and P.pack_documents(docs).count() == 9 and M.deduplicate(docs).count() == 3


def test_span_dedup_keeps_no_large_table_and_no_shuffles(spark):
    """The table of all spans goes once its repeated part is written, and a
    write's shuffle files go with it; the session's setting stays."""
    import glob

    from reco_traffic import session
    from reco_traffic.llm import common, sentence_spans

    text = " ".join(f"w{i}" for i in range(120))
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string")
    root = session.checkpoint_root(spark).removeprefix("file://")
    before = set(glob.glob(f"{root}/spans-*"))
    assert sentence_spans.remove(docs).where("text = ''").count() == 3
    assert set(glob.glob(f"{root}/spans-*")) == before

    was = spark.conf.get(session.SHUFFLE_CLEANUP)
    with session.shuffles_removed(spark):
        assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == was
    assert common.written(docs.groupBy("text").count(), "counts").count() == 1
