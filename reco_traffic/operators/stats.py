"""Batch rating statistics: popularity, monthly popularity, average score,
best items per genre, and tag-enriched item documents.

All functions are lazy DataFrame -> DataFrame. Aggregations are algebraic
(count, sum, avg), so Spark combines them map-side before the shuffle and a
hot item or month costs one partial row per input partition, not all of its
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import year_month

# The reference's genre list, in its order, spelling included
# ("Famil y" and no "Children").
DEFAULT_GENRES = [
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Famil y", "Fantasy",
    "Foreign", "History", "Horror", "Music", "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
]


def rating_counts(ratings: DataFrame) -> DataFrame:
    """Ratings per item -> (item_id, count)."""
    return ratings.groupBy("item_id").agg(F.count("item_id").alias("count"))


def add_year_month(df: DataFrame, ts_col: str = "ts", out: str = "yearmonth") -> DataFrame:
    """Append the int ``yyyyMM`` (UTC) of an epoch-seconds column."""
    return df.withColumn(out, year_month(ts_col))


def monthly_rating_counts(ratings: DataFrame, ts_col: str = "ts", sort: bool = True) -> DataFrame:
    """Ratings per (month, item) -> (item_id, count, yearmonth), newest month
    first, then most rated, then item id.

    The global order is a range-partitioned sort; pass ``sort=False`` when the
    result is only stored or joined.
    """
    counted = (
        add_year_month(ratings.select("item_id", ts_col), ts_col)
        .groupBy("yearmonth", "item_id")
        .agg(F.count("item_id").alias("count"))
        .select("item_id", "count", "yearmonth")
    )
    if sort:
        counted = counted.orderBy(F.desc("yearmonth"), F.desc("count"), F.asc("item_id"))
    return counted


def average_ratings(ratings: DataFrame) -> DataFrame:
    """Average rating per item -> (item_id, avg)."""
    return ratings.groupBy("item_id").agg(F.avg("rating").alias("avg"))


def items_with_score(items: DataFrame, averages: DataFrame) -> DataFrame:
    """Items inner-joined with their average; unrated items drop out."""
    return items.join(averages, "item_id")


def _genre_match(genres_col: Column, genre: Column, match: str) -> Column:
    if match == "contains":
        return F.lower(genres_col).contains(F.lower(genre))
    if match == "token":
        return F.array_contains(F.split(F.lower(genres_col), r"\|"), F.lower(genre))
    raise ValueError(f"unknown match {match!r}; use 'contains' or 'token'")


def genre_item_pairs(
    items: DataFrame,
    genres: Sequence[str] = DEFAULT_GENRES,
    match: str = "contains",
    genres_col: str = "genres",
    out: str = "genre",
) -> DataFrame:
    """(item, genre) for every listed genre the item's genre string matches.

    ``match="contains"`` is the reference's case-insensitive substring test
    (so "Music" also matches "Musical"); ``"token"`` matches whole
    '|'-separated genres. The genre list is a bounded parameter, so the match
    runs per row as ``explode(filter(array(genres), ...))`` inside the scan's
    code-generated stage: no cartesian product, no nested-loop join, no
    shuffle.
    """
    unique = list(dict.fromkeys(genres))
    if not unique:
        return items.select("*", F.lit(None).cast("string").alias(out)).where(F.lit(False))
    arr = F.array(*[F.lit(g) for g in unique])
    gcol = F.col(genres_col)
    matched = F.filter(arr, lambda g: _genre_match(gcol, g, match))
    return items.select("*", F.explode(matched).alias(out))


def top_items_per_genre(
    items: DataFrame,
    ratings: DataFrame,
    genres: Sequence[str] = DEFAULT_GENRES,
    k: int = 10,
    match: str = "contains",
) -> DataFrame:
    """The k best-average items per genre -> (genre, rank, item_id, score).

    Ties are broken by item id. Genres matching no rated item give no row.
    ``row_number() <= k`` is planned as a partial WindowGroupLimit before the
    shuffle on genre, so even a genre holding most items sends at most k rows
    per input partition to its final task.
    """
    scored = items_with_score(items.select("item_id", "genres"), average_ratings(ratings))
    return top_from_scored(scored, genres, k, match)


def top_from_scored(scored: DataFrame, genres: Sequence[str] = DEFAULT_GENRES, k: int = 10,
                    match: str = "contains") -> DataFrame:
    """``top_items_per_genre`` from items already joined with their average
    (columns item_id, genres, avg)."""
    pairs = genre_item_pairs(scored, genres, match)
    w = Window.partitionBy("genre").orderBy(F.desc("avg"), F.asc("item_id"))
    return (
        pairs.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("genre", "rank", "item_id", F.col("avg").alias("score"))
    )


def nest_recs(
    flat: DataFrame,
    key: str,
    item_col: str = "item_id",
    score_col: str = "score",
    as_name: str = "recs",
) -> DataFrame:
    """(key, item, score) rows -> (key, recs array<struct<item_id, score>>)
    ordered by score descending, then item id.

    Meant for bounded lists (top-k output). Lists without a bound (all
    neighbours above a threshold) are stored flat, one row per pair.
    """
    packed = F.struct((-F.col(score_col)).alias("neg"), F.col(item_col).alias("item"), F.col(score_col).alias("s"))
    return flat.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(packed)),
            lambda x: F.struct(x["item"].alias("item_id"), x["s"].alias("score")),
        ).alias(as_name)
    )


def flatten_recs(nested: DataFrame, key: str, recs_col: str = "recs") -> DataFrame:
    """Inverse of ``nest_recs``: (key, rank, item_id, score)."""
    return nested.select(key, F.posexplode(recs_col).alias("pos", "rec")).select(
        key, (F.col("pos") + 1).cast("int").alias("rank"), F.col("rec.item_id").alias("item_id"),
        F.col("rec.score").alias("score"),
    )


def item_tags(tags: DataFrame, sep: str = "|") -> DataFrame:
    """Distinct tags of each item, sorted and joined with ``sep`` -> (item_id, tags).

    Repeats go first, by hash over (item, tag) with partial aggregation, so a hot
    item's rows are spread over all tasks and only its distinct tags meet.
    """
    each = tags.select("item_id", "tag").distinct()
    return each.groupBy("item_id").agg(F.concat_ws(sep, F.array_sort(F.collect_list("tag"))).alias("tags"))


def items_with_tags(items: DataFrame, tags_per_item: DataFrame) -> DataFrame:
    """Items left-joined with their joined tags; untagged items keep NULL."""
    return items.join(tags_per_item, "item_id", "left").select("item_id", "title", "genres", "tags")


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("user_id").distinct()


def distinct_items(ratings: DataFrame) -> DataFrame:
    return ratings.select("item_id").distinct()


def item_month_rollup(ratings: DataFrame, ts_col: str = "ts") -> DataFrame:
    """(yearmonth, item_id, count, rating_sum): one scan and one (map-side
    combined) shuffle of the ratings, from which popularity, monthly
    popularity and averages all follow without touching the ratings again."""
    return (
        add_year_month(ratings.select("item_id", "rating", ts_col), ts_col)
        .groupBy("yearmonth", "item_id")
        .agg(F.count("item_id").alias("count"), F.sum("rating").alias("rating_sum"))
    )


def statistics_from_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    """rating_counts, monthly_rating_counts and average_ratings from
    ``item_month_rollup`` (items x months rows instead of all ratings)."""
    per_item = rollup.groupBy("item_id").agg(F.sum("count").alias("count"), F.sum("rating_sum").alias("_s"))
    return {
        "rating_counts": per_item.select("item_id", "count"),
        "monthly_rating_counts": rollup.select("item_id", "count", "yearmonth").orderBy(
            F.desc("yearmonth"), F.desc("count"), F.asc("item_id")),
        "average_ratings": per_item.select("item_id", (F.col("_s") / F.col("count")).alias("avg")),
    }
