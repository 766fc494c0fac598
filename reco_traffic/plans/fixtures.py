"""Map the driver's test tables onto this engine's inputs.

The reference reads movie/rating/tag CSV files and camera event text that are
not available; these mappings give inputs of the same shape, derived by Spark
from the given parquet tables so that every query's work grows with them.

ratings   orders JOIN lineitem  (customer rates part)
items     part                  (genres = type + name words, '|'-separated)
tags      lineitem              (tag = order priority)
car events  events              (camera = event_type, speed = value)
factors   embeddings            (vec_id doubles as item id)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import epoch_seconds

# Fixed values of the test fixture (parameters of the queries, not of the
# operators): the genre list probed against part names/types, the camera
# relation graph over the five event types, and the thresholds that make the
# 64-dimensional test embeddings produce neighbours.
TEST_GENRES = ["SMALL", "red", "ring", "Foreign"]
TEST_CAMERAS = ["click", "error", "purchase", "signup", "view"]
TEST_SIM_THRESHOLD = 0.25
TEST_CANDIDATE_THRESHOLD = 0.15
TEST_SCORE_THRESHOLD = 0.2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _rating_value(quantity) -> F.Column:
    # 0.5 .. 5.0 in half steps from the line quantity
    q = F.floor(quantity).cast("int")
    return (F.lit(0.5) * (F.lit(1) + F.pmod(q - 1, F.lit(10)))).cast("double")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id int, item_id int, rating double, ts bigint epoch seconds)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        _rating_value(F.col("l_quantity")).alias("rating"),
        epoch_seconds(F.col("o_orderdate")).alias("ts"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id int, title string, genres string)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", F.col("p_type"), F.regexp_replace(F.col("p_name"), " ", "|")).alias("genres"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id int, item_id int, tag string, ts bigint)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        F.col("o_orderpriority").alias("tag"),
        epoch_seconds(F.col("o_orderdate")).alias("ts"),
    )


def car_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera events: (camera_id, car_id, event_time ts_ntz, speed double, road_id)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("camera_id"),
        F.col("user_id").cast("string").alias("car_id"),
        F.col("ts").alias("event_time"),
        F.col("value").alias("speed"),
        F.col("event_id").cast("string").alias("road_id"),
    )


def relations(spark: SparkSession, cameras=None) -> DataFrame:
    """Every target camera related to every listed camera, in list order.

    Like the reference's configured camera graph this is a small, fixed
    parameter table (targets x related), not data.
    """
    cams = list(cameras or TEST_CAMERAS)
    rows = [(t, r, i) for t in cams for i, r in enumerate(cams)]
    return spark.createDataFrame(rows, "target_id string, related_id string, pos int")


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id int, features array<float>) from the embeddings table."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("int").alias("item_id"), F.col("embedding").alias("features"))


# DuckDB counterparts used by the oracle SQL.
SQL_RATINGS = """
select cast(o_custkey as int) as user_id, cast(l_partkey as int) as item_id,
       cast(0.5 * (1 + ((cast(floor(l_quantity) as int) - 1) % 10 + 10) % 10) as double) as rating,
       cast(epoch(o_orderdate) as bigint) as ts
from lineitem join orders on l_orderkey = o_orderkey"""

SQL_ITEMS = """
select cast(p_partkey as int) as item_id, p_name as title,
       p_type || '|' || replace(p_name, ' ', '|') as genres
from part"""

SQL_TAGS = """
select cast(o_custkey as int) as user_id, cast(l_partkey as int) as item_id,
       o_orderpriority as tag, cast(epoch(o_orderdate) as bigint) as ts
from lineitem join orders on l_orderkey = o_orderkey"""

SQL_CAR_EVENTS = """
select event_type as camera_id, cast(user_id as varchar) as car_id, ts as event_time,
       value as speed, cast(event_id as varchar) as road_id
from events"""


def sql_values(rows, columns, alias: str = "t") -> str:
    """A VALUES list for a small fixed parameter table in the oracle SQL."""
    def lit(v):
        return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(values {body}) as {alias}({', '.join(columns)})"


def sql_relations(cameras=None, alias: str = "rel") -> str:
    cams = list(cameras or TEST_CAMERAS)
    return sql_values([(t, r, i) for t in cams for i, r in enumerate(cams)], ["target_id", "related_id", "pos"], alias)
