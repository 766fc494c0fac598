"""End-to-end jobs: each reference application as one parameterised function
that composes the operators and writes its tables.

load_catalog            CSV items/ratings/tags -> stored tables + item documents
run_statistics          popularity, monthly popularity, averages, genre top lists
run_offline             ALS user lists + item similarity table
run_als_tuning          parameter grid with held-out RMSE, best row
replay_camera_events    camera text file -> JSON event messages
run_congestion_training lagged features -> one classifier per target, accuracy

Stored collections are directories under ``out`` in ``format`` (parquet by
default; pass a connector's format and options to write elsewhere). Table
names follow the reference's collections.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import als, congestion, scoring, similarity, stats, traffic
from ..session import get_session, scratch_path, shuffle_partitions_for
from ..sources import readers, writers
from ..streaming import streams

# The reference's collection names.
ITEMS_TABLE = "Movie"
RATINGS_TABLE = "Rating"
TAGS_TABLE = "Tag"
ITEM_DOCS_INDEX = "Movie_docs"
RATE_MORE = "RateMoreMovies"
RATE_MORE_RECENTLY = "RateMoreRecentlyMovies"
AVERAGE_SCORES = "AverageMoviesScore"
GENRES_TOP = "GenresTopMovies"
USER_RECS = "UserRecs"
ITEM_RECS = "MovieRecs"
# Tables of this library's own.
TRIALS = "FactorTrials"
BEST_PARAMS = "FactorBestParams"


def _path(out: str, name: str) -> str:
    return f"{out.rstrip('/')}/{name}"


def load_catalog(spark: SparkSession, items_csv: str, ratings_csv: str, tags_csv: str, out: str,
                 format: str = "parquet", options: dict | None = None,  # noqa: A002
                 docs_format: str = "json", docs_options: dict | None = None) -> dict[str, str]:
    """Read the three CSV inputs, store them, and store one search document
    per item with its '|'-joined tags."""
    items = readers.read_items_csv(spark, items_csv)
    ratings = readers.read_ratings_csv(spark, ratings_csv)
    tags = readers.read_tags_csv(spark, tags_csv)
    written = {}
    for name, df in [(ITEMS_TABLE, items), (RATINGS_TABLE, ratings), (TAGS_TABLE, tags)]:
        writers.write_table(df, _path(out, name), format, options)
        written[name] = _path(out, name)
    # the documents come from the stored tables: the text is parsed once
    items = readers.read_table(spark, _path(out, ITEMS_TABLE), schemas.ITEMS, format, options)
    tags = readers.read_table(spark, _path(out, TAGS_TABLE), schemas.TAGS, format, options)
    docs = stats.items_with_tags(items, stats.item_tags(tags))
    writers.write_search_docs(docs, _path(out, ITEM_DOCS_INDEX), "item_id", docs_format, docs_options)
    written[ITEM_DOCS_INDEX] = _path(out, ITEM_DOCS_INDEX)
    return written


def run_statistics(items: DataFrame, ratings: DataFrame, out: str, genres: Sequence[str] = stats.DEFAULT_GENRES,
                   k: int = 10, format: str = "parquet", options: dict | None = None,  # noqa: A002
                   ) -> dict[str, str]:
    """The four statistics tables; genre lists are stored nested (genre, recs).

    The ratings are scanned and shuffled once, into an (item, month) roll-up
    of counts and rating sums, which is persisted (memory and disk; items x
    months rows, far fewer than ratings) and released after the writes. The
    three popularity/average tables and the genre lists all derive from it.
    """
    from pyspark import StorageLevel

    rollup = stats.item_month_rollup(ratings).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        derived = stats.statistics_from_rollup(rollup)
        tables = {
            RATE_MORE: derived["rating_counts"],
            RATE_MORE_RECENTLY: derived["monthly_rating_counts"],
            AVERAGE_SCORES: derived["average_ratings"],
        }
        averages = derived["average_ratings"]
        scored = stats.items_with_score(items.select("item_id", "genres"), averages)
        tables[GENRES_TOP] = stats.nest_recs(stats.top_from_scored(scored, genres, k), "genre")
        for name, df in tables.items():
            writers.write_table(df, _path(out, name), format, options)
    finally:
        rollup.unpersist()
    return {n: _path(out, n) for n in tables}


def run_offline(ratings: DataFrame, out: str, rank: int = als.DEFAULT_RANK, iterations: int = als.DEFAULT_ITERATIONS,
                reg: float = als.DEFAULT_REG, seed: int = 0, k: int = 20, threshold: float = 0.6,
                format: str = "parquet", options: dict | None = None) -> dict[str, str]:  # noqa: A002
    """ALS model -> each user's top-k positive predictions (nested) and the
    flat item-similarity table (pairs above ``threshold``)."""
    model = als.fit_als(ratings, rank, iterations, reg, seed)
    user_recs = stats.nest_recs(als.recommend_for_users(model, k), "user_id")
    writers.write_table(user_recs, _path(out, USER_RECS), format, options)
    sims = similarity.similar_items(als.item_factors(model), threshold)
    writers.write_table(sims, _path(out, ITEM_RECS), format, options)
    return {USER_RECS: _path(out, USER_RECS), ITEM_RECS: _path(out, ITEM_RECS)}


def run_als_tuning(ratings: DataFrame, ranks=als.GRID_RANKS, regs=als.GRID_REGS,
                   iterations: int = als.DEFAULT_ITERATIONS, fraction: float = 0.8, seed: int = 0,
                   trials: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(grid, best): held-out RMSE of every (rank, reg) and the best row. Run
    again with the same ``trials`` table, a stopped grid goes on."""
    train, test = als.split_train_test(ratings, fraction, seed, key=["user_id", "item_id", "ts"])
    grid = als.grid_search_als(train, test, ranks, regs, iterations, seed, trials)
    return grid, als.best_params(grid)


def replay_camera_events(spark: SparkSession, text_path: str, out: str | None = None, format: str = "text",  # noqa: A002
                         options: dict | None = None) -> None:
    """Camera text lines -> one JSON message per event (to a topic with
    ``format="kafka"`` and its options, or text files offline)."""
    events = readers.read_camera_text(spark, text_path)
    writers.write_event_json(events, out, format, options)


def run_congestion_training(totals: DataFrame, relations: DataFrame, as_of=None, hours: float = 5,
                            bucket: str = "1 minute", targets=None, fraction: float = 0.8, seed: int = 0) -> DataFrame:
    """Per target camera: training rows of the look-back (stored once), one
    multinomial classifier, held-out accuracy -> (target_id, n_train, n_test,
    accuracy). ``targets`` defaults to those of the configured graph."""
    rows = traffic.lagged_features(totals, relations, 3, bucket, as_of, hours)
    path = scratch_path(rows.sparkSession, "training-rows")
    writers.write_table(rows, path)
    if targets is None:
        targets = [r[0] for r in relations.select("target_id").distinct().orderBy("target_id").collect()]  # a parameter table
    return congestion.evaluate_per_target(rows.sparkSession.read.parquet(path), targets, fraction, seed)


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the inputs, from the file system's own summary."""
    jvm, total = spark.sparkContext._jvm, 0
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        total += hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(hpath).getLength()
    return total


def size_shuffles(spark: SparkSession, *paths: str, growth: float = 4.0) -> None:
    """Shuffle partitions from the size of the inputs, taken to grow by
    ``growth`` when decoded; never fewer than the session has cores."""
    n = shuffle_partitions_for(int(growth * input_bytes(spark, *paths)), cores=spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))


def main(argv=None) -> int:
    """``python -m reco_traffic.plans.jobs <job> ...``."""
    ap = argparse.ArgumentParser(prog="reco_traffic.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)

    def job(name, *args):
        p = sub.add_parser(name)
        for x in args:
            p.add_argument(x)
        return p

    job("load", "items_csv", "ratings_csv", "tags_csv", "out")
    job("statistics", "tables", "out")
    job("offline", "tables", "out")
    p = job("tune", "tables", "out")
    p.add_argument("--ranks", type=int, nargs="+", default=als.GRID_RANKS)
    p.add_argument("--regs", type=float, nargs="+", default=als.GRID_REGS)
    job("replay", "text", "out")
    p = job("traffic", "messages", "out", "checkpoint")
    p.add_argument("--bucket", default="1 minute")
    q = job("recommend", "messages", "similarity", "history", "out", "checkpoint")
    q.add_argument("--history-buckets", type=int, help="the history is partitioned by so many user buckets")
    q.add_argument("--similarity-buckets", type=int, help="the similarity table is partitioned by so many item buckets")
    p2 = job("bucket", "table", "kind", "out", "buckets")
    p2.description = "Store a rating history (kind history) or similarity table (kind similarity) for --*-buckets."
    p3 = job("fold", "kind", "out")
    p3.description = "Bring older batches of a stream's output (kind traffic or recommend) into its base tables."
    for x in (p, q):
        x.add_argument("--format", default="text")
        x.add_argument("--option", action="append", default=[], help="name=value of the stream source")
        x.add_argument("--once", action="store_true", help="drain what is there and stop")
    p = job("congestion", "totals", "relations", "out")
    p.add_argument("--as-of", default="now")
    p.add_argument("--hours", type=float, default=5)
    p.add_argument("--bucket", default="1 minute")
    a = ap.parse_args(argv)
    owned = SparkSession.getActiveSession() is None
    spark = get_session()
    if a.job == "load":
        size_shuffles(spark, a.items_csv, a.ratings_csv, a.tags_csv)
        load_catalog(spark, a.items_csv, a.ratings_csv, a.tags_csv, a.out)
    elif a.job in ("statistics", "offline", "tune"):
        size_shuffles(spark, a.tables)
        ratings = spark.read.parquet(_path(a.tables, RATINGS_TABLE))
        if a.job == "statistics":
            run_statistics(spark.read.parquet(_path(a.tables, ITEMS_TABLE)), ratings, a.out)
        elif a.job == "offline":
            run_offline(ratings, a.out)
        else:
            _, best = run_als_tuning(ratings, a.ranks, a.regs, trials=_path(a.out, TRIALS))
            writers.write_table(best, _path(a.out, BEST_PARAMS))
    elif a.job == "replay":
        replay_camera_events(spark, a.text, a.out)
    elif a.job in ("traffic", "recommend"):
        options = dict(x.split("=", 1) for x in a.option)
        source = readers.read_stream(spark, a.format, options, None if a.format == "kafka" else a.messages)
        trigger = {"availableNow": True} if a.once else None
        if a.job == "traffic":
            query = streams.stream_camera_minutes(source.select("value"), a.out, a.checkpoint, a.bucket,
                                                  trigger or streams.TRAFFIC_TRIGGER, on_error="drop")
        else:
            query = streams.stream_recommend(source, spark.read.parquet(a.similarity), spark.read.parquet(a.history), a.out,
                                             a.checkpoint, trigger=trigger or streams.RECOMMEND_TRIGGER, on_error="drop",
                                             history_buckets=a.history_buckets, sim_buckets=a.similarity_buckets)
        query.awaitTermination()
    elif a.job == "bucket":
        write = {"history": scoring.write_history, "similarity": scoring.write_similarity}[a.kind]
        write(spark.read.parquet(a.table), a.out, int(a.buckets))
    elif a.job == "fold":
        {"traffic": streams.fold_minute_totals, "recommend": streams.fold_recommendations}[a.kind](spark, a.out)
    elif a.job == "congestion":
        totals = streams.minute_totals_view(spark, a.totals)
        relations = readers.read_table(spark, a.relations, schemas.RELATIONS)
        writers.write_table(run_congestion_training(totals, relations, a.as_of, a.hours, a.bucket), a.out)
    if owned:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
