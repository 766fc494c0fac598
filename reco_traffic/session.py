"""Session construction and the shared scratch / checkpoint location."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. The session time zone is pinned so that
# formatted months and minute buckets do not depend on the machine.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state off the JVM heap, checkpointed incrementally
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


_local_root: str | None = None


def get_session(
    master: str | None = None,
    app_name: str = "reco_traffic",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster ``master`` is left to spark-submit; locally pass ``local[N]``.
    ``shuffle_partitions`` should be sized so one shuffle partition holds
    roughly 128-256 MB at the target data size; AQE coalesces small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(BASE_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            conf["spark.ui.enabled"] = "false"  # a cluster's own setting is left alone
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a folder every executor can reach and it is
    used as given; without it, a cluster run is refused, since a machine-local
    folder would be empty for every other executor. Only with a ``local``
    master (tests) a fresh temporary folder is made, registered, and removed
    when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        global _local_root
        root = _local_root = _local_root or tempfile.mkdtemp(prefix="reco-traffic-ckpt-")
        atexit.register(shutil.rmtree, root, True)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - a session that refuses it still gets setCheckpointDir below
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made under ``scratch_path`` once nothing reads it."""
    if not path.startswith(checkpoint_root(spark)):
        raise ValueError(f"{path} is no scratch folder")
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside are removed as each write ends; else
    they stay on the executors' disks until the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder. Results are lazy
    and read such folders, so they stay until ``clear_scratch``."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write under a fresh scratch path and read back: cuts the lineage, survives
    the loss of any executor, and the shuffle files behind it go."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete every folder that ``scratch_path`` named in this process, once the
    results that read them have been written or collected. Returns how many."""
    n = len(_made)
    while _made:
        remove_scratch(spark, _made.pop())
    return n


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 200 * 2**20, cores: int | None = None) -> int:
    """Shuffle partitions so that each holds about ``target_bytes`` (fits an
    executor task without spilling), and at least one per core. For example
    a 20 TB shuffle at 200 MB per partition gives ~100k partitions; AQE then
    coalesces the ones that turn out small."""
    by_size = -(-int(shuffle_bytes) // int(target_bytes))
    return max(1, by_size, int(cores or 1))
