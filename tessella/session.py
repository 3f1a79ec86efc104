"""Session settings and materialised intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no stack capture per column expression
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tessella")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in SETTINGS.items():
        b = b.config(k, v)
    return b.getOrCreate()


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PART_MB = 4  # of shuffled pixels; they take 30 to 100 times as much once unpacked and sorted


def small_parts(spark: SparkSession) -> None:
    """Adaptive execution joins shuffle partitions up to ``ADVISORY`` packed bytes: sets the session's limit for pixels unless it is smaller already."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ADVISORY))
    if now > PART_MB << 20:
        spark.conf.set(ADVISORY, f"{PART_MB}m")


def dealt(df: DataFrame, *by) -> DataFrame:
    """``df`` dealt by the keys ``by`` over all ``spark.sql.shuffle.partitions``, for Python: adaptive execution would join partitions by their bytes,
    and one MB of runs is a minute of work; partitions of a given number stay as they are."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, which every node can reach.

    A machine-local folder is taken only when that setting is empty and the master is local.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if path:
        return path
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
    path = tempfile.mkdtemp(prefix="tessella-")
    sc.setCheckpointDir(path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tessella/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def save(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors,
    and gives Catalyst true sizes for the joins that follow. What the query shuffled is deleted with its end: only the table is read again."""
    path = new_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table of a ``save`` that nothing reads any more: its successor is written."""
    path = getattr(df, "saved_path", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
