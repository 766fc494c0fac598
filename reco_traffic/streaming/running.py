"""Running totals of cameras as Spark state, for stores that replace by key.

Each (camera, bucket) is a key of ``transformWithState``: its state is the total
so far, and every micro-batch that brings events of it puts out the whole new
total, so a store need only replace the row of that key. A timer closes a key
that has been quiet for ``close_after``: its state goes, the row stays. An event
that comes later still opens the key anew, with a new ``opened`` time in its
row's key, and counts from zero; a key's total is the sum over its openings. So
no event is lost however late it is, and the state holds only the keys of the
last ``close_after``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.columns import epoch_seconds, instant_as_ntz
from ..operators import parse
from ..operators.traffic import bucket_seconds
from . import tables
from .streams import DAY, TRAFFIC_TRIGGER, _start

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: The only store that holds the state of ``transformWithState``.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = ["camera_id", "minute", "opened"]
SCHEMA = T.StructType([
    T.StructField("camera_id", T.StringType()),
    T.StructField("minute", T.TimestampNTZType()),
    T.StructField("opened", T.LongType()),
    T.StructField("speed_total", T.DoubleType()),
    T.StructField("car_count", T.LongType()),
    T.StructField(DAY, T.DateType()),
])
#: Event rows after parsing, per key; the key's minute travels as epoch seconds.
OUTPUT = "camera_id string, second long, opened long, speed_total double, car_count long"


def running_total(close_after_ms: int) -> StatefulProcessor:
    """The processor of a key. Its class is local, so that Spark's workers get it
    whole: the one on the driver may not have this package on its path."""
    class RunningTotal(StatefulProcessor):
        """State of a key: (opened, last seen, speed total, count), times in ms."""

        def __init__(self, close_after_ms: int):
            self.close_after = close_after_ms

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.total = handle.getValueState("total", "opened long, seen long, speed double, n long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            now = timerValues.getCurrentProcessingTimeInMs()
            speed, n = 0.0, 0
            for part in rows:
                speed += float(part["speed"].fillna(0).sum())
                n += len(part)
            if self.total.exists():
                opened, _, s, m = self.total.get()
                speed, n = speed + s, n + m
            else:
                opened = now
                self.handle.registerTimer(now + self.close_after)  # one timer a key
            self.total.update((opened, now, speed, n))
            yield pd.DataFrame({"camera_id": [key[0]], "second": [key[1]], "opened": [opened], "speed_total": [speed], "car_count": [n]})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            if self.total.exists():
                quiet_at = self.total.get()[1] + self.close_after
                if quiet_at <= timerValues.getCurrentProcessingTimeInMs():
                    self.total.clear()
                else:
                    self.handle.registerTimer(quiet_at)
            return iter([])

        def close(self) -> None:
            pass

    return RunningTotal(close_after_ms)


def running_totals(events: DataFrame, bucket: str = "1 minute", close_after: str = "2 hours", ts_col: str = "event_time",
                   time_basis: str = "event") -> DataFrame:
    """(camera_id, minute, opened, speed_total, car_count, day) of every key that
    a micro-batch brings events of; ``events`` (camera_id, speed, time) streams."""
    step = bucket_seconds(bucket)
    ts = F.col(ts_col) if time_basis == "event" else instant_as_ntz(F.current_timestamp())
    second = epoch_seconds(ts)
    rows = events.select("camera_id", (second - F.pmod(second, F.lit(step))).alias("second"), F.col("speed").cast("double").alias("speed"))
    out = rows.groupBy("camera_id", "second").transformWithStateInPandas(
        running_total(bucket_seconds(close_after) * 1000), OUTPUT, "Update", "ProcessingTime")
    minute = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, second)")
    return out.select("camera_id", minute.alias("minute"), "opened", "speed_total", "car_count", F.to_date(minute).alias(DAY))


def stream_running_totals(events: DataFrame, out: str, checkpoint: str, bucket: str = "1 minute", close_after: str = "2 hours",
                          trigger: dict | None = TRAFFIC_TRIGGER, ts_col: str = "event_time", time_basis: str = "event",
                          speed_type: str = "double", on_error: str = "fail") -> StreamingQuery:
    """Start the running totals. ``events`` holds raw messages (``value``) or
    parsed events. Every micro-batch writes the rows it replaces; with
    ``on_error="drop"`` malformed messages are left out here, and
    ``stream_rejected_events`` keeps them."""
    if "camera_id" not in events.columns:
        events = parse.parse_car_event(events, "value", on_error, speed_type, need_time=time_basis == "event")
    totals = running_totals(events, bucket, close_after, ts_col, time_basis)

    def replace(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(batch, out, batch_id, [DAY])

    conf, wanted = events.sparkSession.conf, {STATE_STORE: ROCKSDB}
    if trigger and not trigger.get("processingTime"):
        # timers ask for one more micro-batch for ever, which a run that only drains what is there would wait for
        wanted[NO_DATA_BATCHES] = "false"
    before = {k: conf.get(k) for k in wanted}
    for k, v in wanted.items():
        conf.set(k, v)
    try:
        return _start(totals.writeStream.outputMode("update").foreachBatch(replace), checkpoint, trigger)
    finally:
        for k, v in before.items():
            conf.set(k, v)


def stream_rejected_events(messages: DataFrame, out: str, checkpoint: str, trigger: dict | None = TRAFFIC_TRIGGER,
                           time_basis: str = "event") -> StreamingQuery:
    """Keep the raw messages that don't parse as car events, a batch per micro-batch."""
    _, bad = parse.split_car_events(messages, "value", need_time=time_basis == "event")
    return _start(bad.writeStream.foreachBatch(lambda batch, batch_id: tables.write_batch(batch, out, batch_id)), checkpoint, trigger)


def newest_totals(rows: DataFrame) -> DataFrame:
    """The newest row of every opening of a key: the table's fold."""
    return tables.latest_per_key(rows, KEYS)


def running_totals_view(spark: SparkSession, out: str) -> DataFrame:
    """Current (camera_id, minute, speed_total, car_count)."""
    now = newest_totals(tables.read_rows(spark, out, SCHEMA, DAY))
    return now.groupBy("camera_id", "minute").agg(F.sum("speed_total").alias("speed_total"), F.sum("car_count").alias("car_count"))


def fold_running_totals(spark: SparkSession, out: str, upto: int | None = None) -> int:
    """Bring older batches into the table partitioned by day."""
    return tables.fold(spark, out, SCHEMA, DAY, newest_totals, upto)
