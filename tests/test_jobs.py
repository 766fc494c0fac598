"""The end-to-end jobs on the smallest test tables."""

from pyspark.sql import functions as F

from reco_traffic.operators import parse, stats
from reco_traffic.plans import catalog, jobs
from reco_traffic.plans import fixtures as fx
from reco_traffic.session import scratch_path
from reco_traffic.sources import writers


def _csv(spark, df):
    path = scratch_path(spark, "csv")
    writers.write_table(df, path, format="csv", options={"header": "true"})
    return path


def test_load_then_statistics(spark, sf_small):
    out = scratch_path(spark, "catalog")
    written = jobs.load_catalog(spark, _csv(spark, fx.items(spark, sf_small)), _csv(spark, fx.ratings(spark, sf_small)),
                                _csv(spark, fx.tags(spark, sf_small)), out)
    assert set(written) == {jobs.ITEMS_TABLE, jobs.RATINGS_TABLE, jobs.TAGS_TABLE, jobs.ITEM_DOCS_INDEX}
    items = spark.read.parquet(written[jobs.ITEMS_TABLE])
    ratings = spark.read.parquet(written[jobs.RATINGS_TABLE])
    assert ratings.count() == fx.ratings(spark, sf_small).count()
    stat_out = scratch_path(spark, "stats")
    tables = jobs.run_statistics(items, ratings, stat_out, genres=fx.TEST_GENRES)
    got = spark.read.parquet(tables[jobs.RATE_MORE])
    assert got.exceptAll(stats.rating_counts(fx.ratings(spark, sf_small))).count() == 0
    nested = spark.read.parquet(tables[jobs.GENRES_TOP])
    flat = stats.flatten_recs(nested, "genre").select("genre", "rank", "item_id", catalog.r6("score").alias("s"))
    want = catalog.QUERIES["top_items_per_genre"](spark, sf_small).withColumnRenamed("score", "s")
    assert flat.exceptAll(want).count() == 0 and want.exceptAll(flat).count() == 0


def test_offline_job(spark, sf_small):
    out = scratch_path(spark, "offline")
    tables = jobs.run_offline(fx.ratings(spark, sf_small), out, rank=5, iterations=3, threshold=0.9)
    recs = spark.read.parquet(tables[jobs.USER_RECS])
    assert recs.where(F.size("recs") > 20).count() == 0
    sims = spark.read.parquet(tables[jobs.ITEM_RECS])
    assert sims.where((F.col("sim") <= 0.9) | (F.col("item_id") == F.col("other_id"))).count() == 0


def test_replay_camera_events(spark, sf_small):
    text = scratch_path(spark, "cam-text")
    catalog._camera_lines(spark, sf_small).write.text(text)
    out = scratch_path(spark, "cam-json")
    jobs.replay_camera_events(spark, text, out)
    back = parse.parse_car_event(spark.read.text(out))
    assert back.count() == fx.car_events(spark, sf_small).count()


def test_congestion_training(spark, sf_small):
    totals = catalog.fixture_totals(spark, sf_small)
    res = jobs.run_congestion_training(totals, fx.relations(spark), bucket="1 hour").collect()
    assert {r["target_id"] for r in res} <= set(fx.TEST_CAMERAS)
    assert all(0.0 <= r["accuracy"] <= 1.0 for r in res if r["accuracy"] is not None)


def test_rollup_statistics_equal_direct(spark, sf_small):
    r = fx.ratings(spark, sf_small)
    derived = stats.statistics_from_rollup(stats.item_month_rollup(r))
    for name, direct in [("rating_counts", stats.rating_counts(r)), ("average_ratings", stats.average_ratings(r)),
                         ("monthly_rating_counts", stats.monthly_rating_counts(r))]:
        a, b = derived[name], direct
        if "avg" in a.columns:
            a = a.select("item_id", F.round("avg", 9).alias("avg"))
            b = b.select("item_id", F.round("avg", 9).alias("avg"))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_cli_replay(spark, sf_small):
    text = scratch_path(spark, "cli-text")
    catalog._camera_lines(spark, sf_small).write.text(text)
    out = scratch_path(spark, "cli-json")
    assert jobs.main(["replay", text, out]) == 0
    assert spark.read.text(out).count() == fx.car_events(spark, sf_small).count()


def test_cli_streams_and_training(spark, sf_small):
    """The three streaming and training jobs by their command lines."""
    from reco_traffic.streaming import streams

    msgs, out, ckpt = (scratch_path(spark, x) for x in ("cli-msgs", "cli-totals", "cli-ckpt"))
    ev = fx.car_events(spark, sf_small).withColumn("speed", F.floor("speed").cast("int"))
    writers.write_event_json(ev, msgs, columns=["camera_id", "car_id", "event_time", "speed", "road_id"])
    assert jobs.main(["traffic", msgs, out, ckpt, "--bucket", "1 hour", "--once"]) == 0
    view = streams.minute_totals_view(spark, out)
    assert view.agg(F.sum("car_count")).first()[0] == ev.count()

    graph, acc = scratch_path(spark, "cli-graph"), scratch_path(spark, "cli-accuracy")
    writers.write_table(fx.relations(spark), graph)
    assert jobs.main(["congestion", out, graph, acc, "--as-of", "2024-01-20 12:30:00", "--hours", "240", "--bucket", "1 hour"]) == 0
    assert spark.read.parquet(acc).columns == ["target_id", "n_train", "n_test", "accuracy"]

    lines, sim, hist, recs, ckpt2 = (scratch_path(spark, x) for x in ("cli-lines", "cli-sim", "cli-hist", "cli-recs", "cli-ckpt2"))
    spark.createDataFrame([("1|10|4.0|5",), ("bad",)], "value string").write.text(lines)
    writers.write_table(spark.createDataFrame([(10, 11, 0.9), (11, 10, 0.9)], "item_id int, other_id int, sim double"), sim)
    writers.write_table(spark.createDataFrame([(2, 11, 5.0, 1)], fx_ratings_schema()), hist)
    assert jobs.main(["recommend", lines, sim, hist, recs, ckpt2, "--once"]) == 0
    assert [r["user_id"] for r in streams.user_recs_view(spark, recs).collect()] == [1]
    assert [r["value"] for r in streams.rejected_view(spark, recs).collect()] == ["bad"]


def test_cli_grid_folds_and_buckets(spark, sf_small):
    """The stored trial table, the upkeep of a stream's output and the bucketed
    tables, by their command lines."""
    from reco_traffic.operators import als
    from reco_traffic.streaming import streams

    stored, out = scratch_path(spark, "cli-tables"), scratch_path(spark, "cli-grid")
    writers.write_table(fx.ratings(spark, sf_small), f"{stored}/{jobs.RATINGS_TABLE}")
    for _ in range(2):  # the second run finds every point
        assert jobs.main(["tune", stored, out, "--ranks", "2", "3", "--regs", "0.1"]) == 0
    trials = als.read_trials(spark, f"{out}/{jobs.TRIALS}")
    assert trials.count() == 2
    best = spark.read.parquet(f"{out}/{jobs.BEST_PARAMS}").first()
    assert best["rmse"] == trials.agg(F.min("rmse")).first()[0]

    sim, hist = scratch_path(spark, "cli-sim"), scratch_path(spark, "cli-hist")
    writers.write_table(spark.createDataFrame([(10, 11, 0.9), (11, 10, 0.9)], "item_id int, other_id int, sim double"), sim)
    writers.write_table(spark.createDataFrame([(2, 11, 5.0, 1)], fx_ratings_schema()), hist)
    assert jobs.main(["bucket", sim, "similarity", sim + "-b", "4"]) == 0
    assert jobs.main(["bucket", hist, "history", hist + "-b", "4"]) == 0
    lines, recs, ckpt = (scratch_path(spark, x) for x in ("cli-lines", "cli-recs", "cli-ckpt"))
    for i, line in enumerate(["1|10|4.0|5", "2|10|4.0|6"]):
        spark.createDataFrame([(line,)], "value string").write.mode("append").text(lines)
        assert jobs.main(["recommend", lines, sim + "-b", hist + "-b", recs, ckpt, "--once", "--history-buckets", "4",
                          "--similarity-buckets", "4"]) == 0
    assert jobs.main(["fold", "recommend", recs]) == 0
    view = {r["user_id"]: [x["item_id"] for x in r["recs"]] for r in streams.user_recs_view(spark, recs).collect()}
    assert view == {1: [11], 2: []}  # user 2 has rated 11


def fx_ratings_schema():
    from reco_traffic import schemas

    return schemas.RATINGS


def test_scratch_is_refused_off_local(monkeypatch, spark):
    """Without spark.checkpoint.dir only a local master gets a folder."""
    import types

    import pytest

    from reco_traffic import session

    class Conf:
        def get(self, *a):
            return None

    context = types.SimpleNamespace(master="yarn", getConf=lambda: Conf(), getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        session.checkpoint_root(types.SimpleNamespace(conf=Conf(), sparkContext=context))


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    """What a finished job wrote goes, and nothing outside the shared folder."""
    import pytest

    from reco_traffic import session

    monkeypatch.setattr(session, "_made", [])
    path = session.scratch_path(spark, "to-clear")
    spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        session.remove_scratch(spark, str(tmp_path))
