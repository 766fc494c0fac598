"""Road-camera speed aggregation and congestion features.

Per camera and time bucket the engine keeps (speed_total, car_count). A
training row for target camera t at label bucket L holds the average speed
of each related camera at L-3, L-2, L-1 (bucket-major, then relation order,
-1.0 where a bucket has no data) and the congestion class of t's own
average speed at L. The reference builds these rows in a driver loop over
one day's hash per camera; here they are two joins and one bounded
aggregation over the whole totals table, with real timestamps (no cut at
midnight).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import congestion_class, safe_ratio


def bucket_seconds(bucket: str) -> int:
    """Seconds in a bucket such as '1 minute', '5 minutes', '1 hour'."""
    n, unit = bucket.split()
    unit = unit.lower().rstrip("s")
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    return int(n) * scale


def camera_minute_totals(
    events: DataFrame,
    bucket: str = "1 minute",
    ts_col: str = "event_time",
    camera_col: str = "camera_id",
    speed_col: str = "speed",
) -> DataFrame:
    """Per camera and bucket: (camera_id, minute, speed_total, car_count).

    Sum and count are combined map-side, so a camera holding a third of all
    events ships one partial row per (bucket, input partition). An int speed
    sums to bigint (no overflow).
    """
    speed = F.col(speed_col)
    return (
        events.groupBy(F.col(camera_col).alias("camera_id"), F.window(ts_col, bucket).alias("w"))
        .agg(F.sum(speed).alias("speed_total"), F.count(F.lit(1)).alias("car_count"))
        .select("camera_id", F.col("w.start").alias("minute"), "speed_total", "car_count")
    )


def average_speed(totals: DataFrame) -> DataFrame:
    """totals + avg_speed = speed_total / car_count (NULL when the count is 0)."""
    return totals.withColumn("avg_speed", safe_ratio("speed_total", "car_count"))


def _ntz(t: dt.datetime):
    return F.to_timestamp_ntz(F.lit(t.strftime("%Y-%m-%d %H:%M:%S")))


def label_range(as_of, hours: float = 5, bucket: str = "1 minute", lags: int = 3):
    """(first, last) label bucket start of the look-back, as NTZ literals.
    ``as_of="now"`` uses the current UTC time, as the reference does.

    The reference walks i = N..1 with N = hours*60 one-minute steps and labels
    bucket now - i + 3, i.e. [now - N + 3, now + 2] in buckets, ``now``
    truncated to its bucket. The same offsets apply for any bucket width;
    buckets are aligned to the epoch like ``window``.
    """
    step = bucket_seconds(bucket)
    n = int(round(hours * 3600 / step))
    if isinstance(as_of, str) and as_of == "now":
        t = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    else:
        t = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    epoch = dt.datetime(1970, 1, 1)
    base = epoch + dt.timedelta(seconds=int((t.replace(tzinfo=None) - epoch).total_seconds()) // step * step)
    first = base - dt.timedelta(seconds=(n - lags) * step)
    last = base + dt.timedelta(seconds=(lags - 1) * step)
    return _ntz(first), _ntz(last)


def lookback_window(totals: DataFrame, as_of, hours: float = 5, bucket: str = "1 minute", lags: int = 3,
                    col: str = "minute") -> DataFrame:
    """Rows whose bucket is a label bucket of the look-back ending at ``as_of``."""
    first, last = label_range(as_of, hours, bucket, lags)
    return between(totals, first, last, col)


DAY = "day"


def between(totals: DataFrame, first, last, col: str = "minute") -> DataFrame:
    """Rows with ``col`` in [first, last]. Of a store partitioned by ``day``
    only the days touched are read: the range is put on that column as well."""
    out = totals.where((F.col(col) >= first) & (F.col(col) <= last))
    if DAY in totals.columns:
        out = out.where((F.col(DAY) >= F.to_date(first)) & (F.col(DAY) <= F.to_date(last)))
    return out


def latest_minutes(totals: DataFrame, cameras: Sequence[str], start, end) -> DataFrame:
    """The per-bucket values of some cameras in [start, end]. A store with a
    ``day`` partition column is read for the days touched only."""
    lo = F.to_timestamp_ntz(F.lit(str(start)))
    hi = F.to_timestamp_ntz(F.lit(str(end)))  # literal bounds reach the scan as pushed filters
    return between(totals.where(F.col("camera_id").isin(list(cameras))), lo, hi)


def lag_table(totals: DataFrame, lags: int = 3, bucket: str = "1 minute") -> DataFrame:
    """(camera_id, minute, v1..v<lags>): per camera and label bucket L its
    average speed at L-1, L-2, ... (NULL without data). One partial aggregate
    over lags rows per total."""
    step = bucket_seconds(bucket)
    avg = average_speed(totals).select("camera_id", "minute", F.col("avg_speed").alias("v"))
    shifted = avg.withColumn("lag", F.explode(F.sequence(F.lit(1), F.lit(lags)))).select(
        "camera_id", (F.col("minute") + F.expr(f"make_dt_interval(0, 0, 0, lag * {step})")).alias("minute"), "lag", "v")
    return shifted.groupBy("camera_id", "minute").agg(
        *[F.max(F.when(F.col("lag") == j, F.col("v"))).alias(f"v{j}") for j in range(1, lags + 1)])


def lagged_features(
    totals: DataFrame,
    relations: DataFrame,
    lags: int = 3,
    bucket: str = "1 minute",
    as_of=None,
    hours: float = 5,
    missing: float = -1.0,
    width: int = 10,
    top: int = 10,
    as_vector: bool = True,
) -> DataFrame:
    """Training rows -> (target_id, minute, label, features).

    ``relations`` is (target_id, related_id, pos): the ordered related cameras
    of each target (a configured graph of bounded size). ``features`` has
    lags * R values, bucket-major (L-lags first) then by ``pos``. A target
    without data at L gives no row; a related camera without data at L-j
    contributes ``missing``. With ``as_of`` only label buckets of that
    look-back are produced, and only the totals they need are read: labels in
    [first, last], features in [first - lags, last - 1].

    The lags of a camera are gathered once (``lag_table``), then joined to the
    related cameras of each target.
    """
    labels, before = totals, totals
    if as_of is not None:
        first, last = label_range(as_of, hours, bucket, lags)
        back = lambda n: F.expr(f"make_dt_interval(0, 0, 0, {n * bucket_seconds(bucket)})")
        labels, before = between(totals, first, last), between(totals, first - back(lags), last - back(1))
    labels = average_speed(labels).select(F.col("camera_id").alias("target_id"), "minute",
                                          F.col("avg_speed").alias("label_v"))
    wanted = labels.join(relations.select("target_id", "related_id", "pos"), "target_id")
    feat = lag_table(before, lags, bucket).withColumnRenamed("camera_id", "related_id")
    values = [F.coalesce(F.col(f"v{j}"), F.lit(float(missing))) for j in range(lags, 0, -1)]
    filled = wanted.join(feat, ["related_id", "minute"], "left").select(
        "target_id", "minute", "label_v", F.struct("pos", F.array(*values).alias("v")).alias("s"))
    # one struct per related camera: bounded by the graph
    rows = filled.groupBy("target_id", "minute").agg(
        F.max("label_v").alias("label_v"), F.array_sort(F.collect_list("s")).alias("_s"))
    def at(k: int):
        return F.transform("_s", lambda x: x["v"][k])

    feats = F.flatten(F.array(*[at(k) for k in range(lags)]))
    return rows.select("target_id", "minute", congestion_class(F.col("label_v"), width, top).alias("label"),
                       (array_to_vector(feats) if as_vector else feats).alias("features"))
