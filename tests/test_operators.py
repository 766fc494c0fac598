"""Hand-made cases for the decided semantics (5-10 rows each)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reco_traffic import schemas
from reco_traffic.functions.columns import congestion_class, cosine_similarity, year_month
from reco_traffic.operators import parse, scoring, similarity, stats, traffic


def rows(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


# ---------------------------------------------------------------- statistics

def test_year_month_utc(spark):
    df = spark.createDataFrame([(1260759144,), (0,), (-1,)], "ts long")
    assert [r[0] for r in df.select(year_month("ts")).collect()] == [200912, 197001, 196912]


def test_monthly_counts_sort_and_names(spark):
    # 1262304000 = 2010-01-01, 1259625600 = 2009-12-01
    data = [(1, 10, 4.0, 1262304000), (2, 10, 3.0, 1262304000), (3, 11, 2.0, 1262304000),
            (4, 12, 5.0, 1259625600), (5, 12, 5.0, 1259625600), (6, 12, 5.0, 1259625600)]
    r = spark.createDataFrame(data, schemas.RATINGS)
    out = stats.monthly_rating_counts(r).collect()
    assert [tuple(x) for x in out] == [(10, 2, 201001), (11, 1, 201001), (12, 3, 200912)]


def test_top_items_per_genre_ties_and_empty_genre(spark):
    items = spark.createDataFrame(
        [(1, "a", "Action|Comedy"), (2, "b", "Action"), (3, "c", "Musical"), (4, "d", "Drama")], schemas.ITEMS)
    ratings = spark.createDataFrame(
        [(1, 1, 4.0, 0), (1, 2, 4.0, 0), (1, 3, 5.0, 0)], schemas.RATINGS)
    out = rows(stats.top_items_per_genre(items, ratings, ["Action", "Music", "Foreign", "Drama"], k=1))
    # tie on 4.0 goes to the smaller id; Music matches Musical (substring);
    # Foreign matches nothing and Drama's item is unrated: no rows
    assert out == [("Action", 1, 1, 4.0), ("Music", 1, 3, 5.0)]
    tok = rows(stats.top_items_per_genre(items, ratings, ["Music"], k=1, match="token"))
    assert tok == []


def test_genre_pairs_plan_has_no_join(spark):
    items = spark.createDataFrame([(1, "a", "Action|Comedy")], schemas.ITEMS)
    plan = stats.genre_item_pairs(items, ["Action", "Comedy"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_item_tags_sorted_distinct(spark):
    t = spark.createDataFrame([(1, 5, "b", 0), (2, 5, "a", 0), (3, 5, "b", 0), (1, 6, "z", 0)], schemas.TAGS)
    assert rows(stats.item_tags(t)) == [(5, "a|b"), (6, "z")]
    items = spark.createDataFrame([(5, "x", "g"), (7, "y", "g")], schemas.ITEMS)
    out = rows(stats.items_with_tags(items, stats.item_tags(t)), "item_id", "tags")
    assert out == [(5, "a|b"), (7, None)]


# ---------------------------------------------------------------- similarity

def test_cosine_zero_vector_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    vals = [r[0] for r in df.select(cosine_similarity("a", "b")).collect()]
    assert vals[0] is None
    assert vals[1] == pytest.approx(1 / math.sqrt(2))


def test_similar_items_strict_threshold_and_zero_vector(spark):
    f = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, [0.0, 1.0])],
                              "item_id int, features array<double>")
    assert rows(similarity.similar_items(f, threshold=0.99)) == [(1, 2, 1.0), (2, 1, 1.0)]
    assert rows(similarity.similar_items(f, threshold=1.0)) == []


@pytest.mark.parametrize("n_blocks", [1, 3, 7])
def test_blocked_similarity_equals_brute_force(spark, n_blocks):
    rng = np.random.default_rng(7)
    vecs = rng.normal(size=(60, 8))
    f = spark.createDataFrame([(i, vecs[i].tolist()) for i in range(60)], "item_id int, features array<double>")
    got = {(a, b): s for a, b, s in similarity.similar_items(f, threshold=0.3, n_blocks=n_blocks).collect()}
    u = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    s = u @ u.T
    want = {(i, j): s[i, j] for i in range(60) for j in range(60) if i != j and s[i, j] > 0.3}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


# ---------------------------------------------------------------- scoring

SIM = "item_id int, other_id int, sim double"


def test_score_single_recent(spark):
    cands = spark.createDataFrame([(1, 100)], "user_id int, item_id int")
    recents = spark.createDataFrame([(1, 200, 5.0, 10)], schemas.RATINGS)
    sim = spark.createDataFrame([(100, 200, 0.8), (200, 100, 0.8)], SIM)
    out = scoring.score_candidates(cands, recents, sim).collect()
    assert out[0]["score"] == pytest.approx(4.0)


def test_score_likes_dislikes_and_limits(spark):
    cands = spark.createDataFrame([(1, 100)], "user_id int, item_id int")
    recents = spark.createDataFrame(
        [(1, 201, 4.0, 1), (1, 202, 5.0, 2), (1, 203, 2.0, 3), (1, 204, 3.0, 4), (1, 205, 5.0, 5)],
        schemas.RATINGS)
    # 204 has rating exactly 3 but similarity exactly 0.7 -> excluded (strict)
    sim = spark.createDataFrame([(100, 201, 0.8), (100, 202, 0.9), (100, 203, 1.0), (100, 204, 0.7)], SIM)
    out = scoring.score_candidates(cands, recents, sim).collect()
    assert out[0]["score"] == pytest.approx((3.2 + 4.5 + 2.0) / 3 + math.log10(2), abs=1e-6)
    # rating exactly 3 counts as "other" (decrease)
    sim2 = spark.createDataFrame([(100, 204, 0.8)], SIM)
    out2 = scoring.score_candidates(cands, recents, sim2).collect()
    assert out2[0]["score"] == pytest.approx(0.8 * 3.0)


def test_candidates_exclude_rated_and_top_k(spark):
    ev = spark.createDataFrame([(1, 10, 4.0, 5)], schemas.RATINGS)
    hist = spark.createDataFrame([(1, 10, 4.0, 5), (1, 12, 3.0, 1)], schemas.RATINGS)
    sim = spark.createDataFrame([(10, 11, 0.9), (10, 12, 0.95), (10, 13, 0.9), (10, 14, 0.5)], SIM)
    out = rows(scoring.similar_candidates(ev, sim, hist, k=2))
    assert out == [(1, 11), (1, 13)]


def test_recent_ratings_k_and_as_of(spark):
    hist = spark.createDataFrame([(1, i, 1.0, i) for i in range(30)], schemas.RATINGS)
    ev = spark.createDataFrame([(1, 5, 1.0, 9)], schemas.RATINGS)
    out = rows(scoring.recent_ratings(hist, 3, ev), "item_id")
    assert out == [(7,), (8,), (9,)]
    assert scoring.recent_ratings(hist, 20).count() == 20


def test_recent_ratings_as_of_equal_a_plain_computation(spark):
    """Whatever the salts, also when later ratings exist; each part of a history
    is cut below the shuffle on user."""
    import random

    rng = random.Random(1)
    data = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(50), float(rng.randrange(5)), rng.randrange(40)) for _ in range(400)]
    hist = spark.createDataFrame(data, schemas.RATINGS)
    ev = spark.createDataFrame([(1, 0, 1.0, 20), (2, 0, 1.0, 39)], schemas.RATINGS)
    want = []
    for u, t in ((1, 20), (2, 39)):
        own = sorted((r for r in data if r[0] == u and r[3] <= t), key=lambda r: (-r[3], r[1], -r[2]))
        want += own[:7]
    key = lambda df: sorted(tuple(r) for r in df.collect())
    for salts in (1, 4, 16):
        assert key(scoring.recent_ratings(hist, 7, ev, salts=salts)) == sorted(want)
    plan = scoring.recent_ratings(hist, 7, ev)._jdf.queryExecution().executedPlan().toString().split("\n")
    by_user = [i for i, x in enumerate(plan) if "Exchange hashpartitioning(user_id" in x and "_part" not in x]
    limits = [i for i, x in enumerate(plan) if "WindowGroupLimit" in x]
    assert len(by_user) == 1 and limits[0] < by_user[0] < limits[-1]


def test_evidence_joins_candidates_to_recents_first(spark):
    """The similarity table is joined on both items, never on the candidate's
    alone."""
    cand = spark.createDataFrame([(1, 10)], "user_id int, item_id int")
    rec = spark.createDataFrame([(1, 11, 4.0, 1)], schemas.RATINGS)
    sim = spark.createDataFrame([(10, 11, 0.9)], SIM)
    out = scoring.candidate_evidence(cand, rec, sim)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.split("\n") if "Join Inner" in x]
    assert len(joins) == 2 and sum("item_id" in j and "_r" in j for j in joins) == 1 and sum("user_id" in j for j in joins) == 1
    assert out.count() == 1


def test_latest_event_per_user(spark):
    ev = spark.createDataFrame([(1, 10, 4.0, 5), (1, 11, 2.0, 7), (1, 9, 2.0, 7), (2, 3, 1.0, 1)], schemas.RATINGS)
    assert rows(scoring.latest_event_per_user(ev), "user_id", "item_id") == [(1, 9), (2, 3)]


def test_no_neighbour_gives_empty_list(spark):
    ev = spark.createDataFrame([(1, 10, 4.0, 5)], schemas.RATINGS)
    sim = spark.createDataFrame([(99, 98, 0.9)], SIM)
    out = scoring.recommend_from_events(ev, sim, ev).collect()
    assert out[0]["user_id"] == 1 and out[0]["recs"] == []


# ---------------------------------------------------------------- parsing

def test_parse_rating_message(spark):
    df = spark.createDataFrame([("1|2|4.5|100",), ("x|2|4.5|100",), ("1|2|4.5",)], "value string")
    assert rows(parse.parse_rating_message(df, on_error="drop")) == [(1, 2, 4.5, 100)]
    with pytest.raises(Exception):
        parse.parse_rating_message(df, on_error="fail").collect()


def test_parse_car_event_speeds(spark):
    t = '"event_time":"2024-01-01 00:00:00"'
    msgs = [f'{{"camera_id":"c",{t},"speed":"33"}}', f'{{"camera_id":"c",{t},"speed":33}}',
            f'{{"camera_id":"c",{t},"speed":"x"}}', f'{{"camera_id":"c",{t}}}', '{"camera_id":"c","speed":"1"}']
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    # a missing speed counts as 0; a speed or time that doesn't parse is rejected
    assert [r["speed"] for r in parse.parse_car_event(df, on_error="drop").collect()] == [33, 33, 0]
    assert [r["speed"] for r in parse.parse_car_event(df, on_error="drop", need_time=False).collect()] == [33, 33, 0, 1]
    with pytest.raises(Exception):
        parse.parse_car_event(df).collect()
    good, bad = parse.split_car_events(df)
    assert good.count() == 3 and sorted(r[0] for r in bad.collect()) == sorted([msgs[2], msgs[4]])


def test_camera_text_lines(spark):
    from reco_traffic.sources.readers import parse_camera_lines, split_camera_lines

    good = ",".join(["'c1'", "x", "car", "x", "2014-08-20 13:00:00", "x", "'40'"] + ["x"] * 6 + ["r9"])
    short = ",".join(["c2"] + ["x"] * 12)
    df = spark.createDataFrame([(";comment",), (good,), (short,), (None,)], "value string")
    out = parse_camera_lines(df, on_error="drop").collect()
    assert [tuple(r) for r in out] == [("c1", "car", "2014-08-20 13:00:00", "40", "r9")]
    accepted, rejected = split_camera_lines(df)
    assert accepted.count() == 1 and {r[0] for r in rejected.collect()} == {short, None}
    with pytest.raises(Exception):
        parse_camera_lines(df).collect()


def _bad_inputs(spark, folder):
    from reco_traffic.sources import readers

    files = {"items": "item_id,title,genres\n1,a,b\n2,,c\n", "ratings": "u,i,r,t\n1,2,3.5,100\n1,3,bad,101\n",
             "tags": "u,i,tag,t\n1,2,x,100\n5,6,y\n"}
    out = {}
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
        out[name] = getattr(readers, f"read_{name}_csv")(spark, str(folder / f"{name}.csv"))
    msgs = spark.createDataFrame([("1|2|4.5|100",), ("1|2|x|100",)], "value string")
    out["rating messages"] = parse.parse_rating_message(msgs)
    out["camera text"] = readers.parse_camera_lines(spark.createDataFrame([("a,b",)], "value string"))
    events = spark.createDataFrame([('{"camera_id":"c","speed":"x"}',)], "value string")
    out["car events"] = parse.parse_car_event(events)
    return out


@pytest.mark.parametrize("name, column", [("items", "item_id"), ("ratings", "user_id"), ("tags", "user_id"),
                                          ("rating messages", "item_id"), ("camera text", "car_id"),
                                          ("car events", "road_id")])
def test_fail_fails_whatever_is_selected(spark, tmp_path, name, column):
    df = _bad_inputs(spark, tmp_path)[name]
    with pytest.raises(Exception):
        df.select(column).collect()
    with pytest.raises(Exception):
        df.count()


def test_csv_rejects(spark, tmp_path):
    from reco_traffic.sources.readers import read_csv_with_rejects, read_ratings_csv

    p = tmp_path / "r.csv"
    p.write_text("userId,movieId,rating,timestamp\n1,2,3.5,100\n1,,4.0,101\n3,4,bad,5\n7,8\n")
    assert read_ratings_csv(spark, str(p), on_error="drop").count() == 1
    good, bad = read_csv_with_rejects(spark, str(p), schemas.RATINGS)
    assert good.count() == 1
    assert sorted((r["value"], r["reason"]) for r in bad.collect()) == [
        ("1,,4.0,101", "required field is empty"), ("3,4,bad,5", "does not convert"), ("7,8", "does not convert")]


def test_starting_needs_a_topic(spark):
    from reco_traffic.sources.readers import read_stream

    with pytest.raises(ValueError):
        read_stream(spark, "text", path="/tmp", starting="latest")


# ---------------------------------------------------------------- traffic

def test_congestion_label_edges(spark):
    df = spark.createDataFrame([(v,) for v in [9.99, 10.0, 99.9, 100.0, 123.0, -5.0]], "v double")
    assert [r[0] for r in df.select(congestion_class("v")).collect()] == [0.0, 1.0, 9.0, 10.0, 10.0, 0.0]


def _totals(spark, data):
    return spark.createDataFrame(
        [(c, __import__("datetime").datetime.fromisoformat(m), s, n) for c, m, s, n in data], schemas.MINUTE_TOTALS)


def test_lagged_features_missing_and_midnight(spark):
    rel = spark.createDataFrame([("a", "a", 0), ("a", "b", 1)], schemas.RELATIONS)
    tot = _totals(spark, [
        ("a", "2024-01-01 23:58:00", 100, 2),   # 50
        ("b", "2024-01-01 23:58:00", 30, 1),    # 30
        ("a", "2024-01-01 23:59:00", 60, 1),    # 60; b missing at L-2
        ("b", "2024-01-02 00:00:00", 20, 2),    # 10; a missing at L-1
        ("a", "2024-01-02 00:01:00", 45, 1),    # label 45 -> class 4
        ("b", "2024-01-02 00:05:00", 45, 1),    # b is not a target
    ])
    out = traffic.lagged_features(tot, rel, lags=3, bucket="1 minute", as_vector=False).collect()
    by_min = {r["minute"].strftime("%H:%M"): r for r in out}
    row = by_min["00:01"]
    assert row["label"] == 4.0
    assert row["features"] == [50.0, 30.0, 60.0, -1.0, -1.0, 10.0]
    # a target without a label value at L gives no row (b is no target; a has
    # no data at 00:00)
    assert "00:00" not in by_min and "00:05" not in by_min


def test_lookback_range(spark):
    tot = _totals(spark, [("a", f"2024-01-01 {h:02d}:00:00", 10, 1) for h in range(24)])
    got = rows(traffic.lookback_window(tot, "2024-01-01 12:40:00", hours=5, bucket="1 hour"), "minute")
    hours = [m[0].hour for m in got]
    assert hours == [10, 11, 12, 13, 14]


def test_camera_minute_totals_int_sum_is_bigint(spark):
    import datetime as dt

    ev = spark.createDataFrame([("c", dt.datetime(2024, 1, 1, 0, 0, s), 2_000_000_000) for s in range(3)],
                               "camera_id string, event_time timestamp_ntz, speed int")
    r = traffic.camera_minute_totals(ev).collect()[0]
    assert r["speed_total"] == 6_000_000_000 and r["car_count"] == 3


def test_search_docs_one_per_key(spark):
    from reco_traffic.sources.writers import one_row_per_key

    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "c", None)], "item_id int, title string, tags string")
    assert rows(one_row_per_key(df, "item_id")) == [(1, "b", "y"), (2, "c", None)]


def test_rejected_outputs(spark):
    df = spark.createDataFrame([("1|2|4.5|100",), ("x|2|4.5|100",), ("1|2|4.5",)], "value string")
    good, bad = parse.split_rating_messages(df)
    assert rows(good) == [(1, 2, 4.5, 100)]
    assert rows(bad) == [("1|2|4.5",), ("x|2|4.5|100",)]


def test_traffic_reads_prune_days_on_every_scan(spark, tmp_path):
    tot = _totals(spark, [(c, f"2024-01-{d:02d} {h:02d}:00:00", 10 * d + h, 1) for c in "ab" for d in range(1, 9) for h in range(24)])
    tot.selectExpr("*", "to_date(minute) as day").write.partitionBy("day").parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    rel = spark.createDataFrame([("a", "a", 0), ("a", "b", 1)], schemas.RELATIONS)
    feats = lambda t: traffic.lagged_features(t, rel, bucket="1 hour", as_of="2024-01-05 01:30:00", hours=6, as_vector=False)
    for df, scans in ((feats(stored), 2), (traffic.latest_minutes(stored, ["a"], "2024-01-02 00:00:00", "2024-01-03 00:00:00"), 1),
                      (traffic.lookback_window(stored, "2024-01-05 01:30:00", 6, "1 hour"), 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = [x.split("]")[0] for x in plan.split("PartitionFilters: ")[1:]]
        assert len(found) == scans and all("day" in x for x in found), plan
    key = lambda df: sorted((r["target_id"], r["minute"], r["label"], tuple(r["features"])) for r in df.collect())
    assert key(feats(stored)) == key(feats(tot)) and len(key(feats(tot))) == 6


def test_lookback_now(spark):
    import datetime as dt

    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, second=0, microsecond=0)
    tot = _totals(spark, [("a", (now - dt.timedelta(minutes=m)).isoformat(sep=" "), 10, 1) for m in range(0, 400, 50)])
    got = traffic.lookback_window(tot, "now", hours=5, bucket="1 minute").count()
    assert got == 6  # minutes 0, 50, ..., 250 ago fall in [now - 297, now + 2]


def test_topic_source_maps_its_start_policy():
    """Options reach the reader; a file source has no start policy. The source
    itself needs its connector's jar."""
    from reco_traffic.sources import readers

    class Reader:
        def __init__(self):
            self.options, self.kind = {}, None

        def format(self, kind):  # noqa: A003
            self.kind = kind
            return self

        def option(self, k, v):
            self.options[k] = v
            return self

        def load(self, *path):
            raise RuntimeError((self.kind, self.options))

    class Session:
        readStream = Reader()  # noqa: N815

    for given, starting, want in [({}, "latest", "latest"), ({}, "earliest", "earliest"), ({"startingOffsets": "earliest"}, "latest", "earliest")]:
        Session.readStream = Reader()
        with pytest.raises(RuntimeError) as e:
            readers.read_stream(Session(), "kafka", {"subscribe": "t", **given}, starting=starting)
        assert e.value.args[0] == ("kafka", {"subscribe": "t", "startingOffsets": want})
    with pytest.raises(ValueError):
        readers.read_stream(Session(), "text", starting="latest")
